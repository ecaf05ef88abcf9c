"""The operators of rillflow.llm against brute force on small tables with nulls, ties, repeats and odd columns."""

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from conftest import DATA

from rillflow.llm import neardup, pieces, queries
from rillflow.llm.arrays import BLOCK, text_slices, word_bounds, word_hashes
from rillflow.llm.fingerprints import fingerprint_edits, fingerprints, inserted, to_text
from rillflow.llm.licenses import Scanner, align, longest_rise, scan_licenses
from rillflow.llm.lines import line_dedup, quality_rules
from rillflow.llm.mixing import mix
from rillflow.llm.neardup import near_duplicates
from rillflow.llm.pieces import decode_texts, encode_texts, piece_digests, vocabulary
from rillflow.llm.substrings import substring_dedup
from rillflow.llm.tables import components
from rillflow.llm.toxicity import fit_rows, fit_toxicity, score_toxicity
from rillflow.llm.urls import judge_urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, anchor string, _w string, spans string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    full = [(i, t, "en", s, len(t or ""), "x", "y", None, "z") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def corpus(seed=5, n=60):
    r = random.Random(seed)
    vocab = ["the", "of", "a", "it", "é", "Zu", "x" * 70, "#1"] + [f"w{i}" for i in range(80)]
    base = [" ".join(r.choices(vocab, k=40)) for _ in range(6)]
    rows = []
    for i in range(n):
        kind = r.randrange(7)
        words = " ".join(r.choices(vocab, k=r.randrange(0, 60))).split()
        if kind < 3:
            copy = r.choice(base).split()
            for _ in range(r.randrange(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(vocab)
            words = copy if kind < 2 else words + copy
        rows.append((i * 3 + 1, r.choice([" ", "\n", " \t"]).join(words), f"s{i % 4}"))
    rows += [(1000, None, "s0"), (1001, "", None), (1002, " \n ", "s1"), (1003, "the " * 400, "s1"), (None, base[0], "s2"), (None, base[0], "s2"), (4, rows[1][1], "s1"), (1004, "y" * 3000, "s1"), rows[0], (1006, base[1], "s3"), (1007, base[1], "s3")]
    return rows


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, ROWS).limit(0)


def test_word_hashes_long_words_and_blocks():
    text = " ".join(["ab", "B" * (2 * BLOCK + 5), "c", "ab", "b" * (2 * BLOCK + 5)]).encode()
    buf, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    start, end, first = word_bounds(buf, off)
    h = word_hashes(buf, start, end)
    folded = word_hashes(buf, start, end, fold=True)
    assert list(first) == [0, 5] and h[0] == h[3] and h[1] != h[4] and folded[1] == folded[4]
    import pyarrow as pa

    assert [x[0] for x in text_slices(pa.array(["a" * 9, None, "b"]), limit=4)] == [0, 1]


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(12)]
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pieces(spark, docs, empty):
    import sentencepiece

    path = queries.model_path()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t or "" for _, t, _ in ROWS] + ["  a  b ", "é漢😀Ⅷ\x00", "▁▁a", "ab" * 700, "a" * 999, " " * 100, "<s>x</s>"]
    v = vocabulary(path)
    for t in texts:
        ids = sp.encode(t)
        assert v.encode(t) == ids and v.decode(ids) == sp.decode(ids)
    got = Counter(tuple(r) for r in piece_digests(docs, path).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter((i, len(e := sp.encode(t or "")), sha(",".join(map(str, e))), sha(sp.decode(e))) for i, t, _ in ROWS)
    assert got == want
    back = decode_texts(encode_texts(docs, path), path)
    assert Counter(r.text for r in back.collect()) == Counter(t or "" for _, t, _ in ROWS)
    assert piece_digests(empty, path).count() == 0


def test_licenses(spark, docs, empty):
    assert [[3, 1, 2, 5, 4][i] for i in longest_rise([3, 1, 2, 5, 4])] in ([1, 2, 5], [1, 2, 4])
    assert align("a b c d".split(), "x a b y d".split()) == [(0, 1), (1, 2), (3, 4)]
    s = Scanner()
    mit = "noise noise\nReleased under the MIT License.\nmore Released under the MIT license"
    assert [x[0] for x in s.scan(mit)] == ["MIT", "MIT"]
    near = "Permission is hereby granted free of charge to any person obtaining a copy of this program and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    assert [x[0] for x in s.scan(near)] == ["MIT-text"] and not s.scan("the license of the work")
    got = scan_licenses(table(spark, [(1, mit, "a"), (2, None, "a"), (3, "", None)])).orderBy("doc_id").collect()
    assert [(r.best, r.n_matches) for r in got] == [("MIT", 2), (None, 0), (None, 0)]
    assert scan_licenses(docs).count() == len(ROWS) and scan_licenses(empty).count() == 0


def norm(line):
    return " ".join(WORD.findall(line.lower()))


def row_key(*values):
    """Spark's xxhash64 of some strings."""
    seed = 42
    for v in values:
        seed = seed if v is None else xxhash.xxh64_intdigest(v.encode(), seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def test_line_dedup(spark, docs, empty):
    extra = [(i + 2000, "Common line of the site\nown words of number %d here" % i, f"h{i % 12}") for i in range(30)]
    extra += [(2000, "Common line of the site\nand another text", "h0"), (2000, "Common line of the site\nand another text", "h1"), extra[0]]
    extra += [(2100, "common  LINE of the site\n" * 2 + "x" * 200_000, "h2"), (None, "a line without id at all", "h1"), (None, "A line without id at all ", "h2"), (None, "a line without id at all", "h3")]
    rows = ROWS + extra
    out = line_dedup(table(spark, rows), min_sites=3, min_words=3)
    sites, first = defaultdict(set), {}
    key = lambda i, t, s: (i is None, i or 0, row_key(t, s))
    for i, t, s in rows:
        for x in {norm(x) for x in (t or "").split("\n") if len(WORD.findall(x)) >= 3}:
            if s is not None:
                sites[x].add(s)
            first[x] = min(first.get(x, key(i, t, s)), key(i, t, s))
    want = Counter()
    for i, t, s in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(WORD.findall(x)) >= 3 and len(sites[norm(x)]) >= 3 and first[norm(x)] != key(i, t, s))]
        want[i, None if t is None else "\n".join(kept), 0 if t is None else len(lines) - len(kept)] += 1
    got = Counter((r.doc_id, r.text, r._removed) for r in out.collect())
    assert got == want
    assert out.columns[:9] == docs.columns and line_dedup(empty).count() == 0
    assert any(removed for (_, _, removed) in got)


def test_toxicity(spark, docs, empty):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = [f"w{r.randrange(300)}" for _ in range(40)] + (r.choices(["nasty", "vile", "foul"], k=3) if bad else [])
        r.shuffle(words)
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(bad), 1))
    table_ = table(spark, rows)
    model = fit_toxicity(table_.where("doc_id < 300"), spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    got = {x.doc_id: x for x in score_toxicity(table_, model).collect()}
    held = [(got[i].toxic, i % 4 == 0) for i in range(300, 400)]
    assert sum(a == b for a, b in held) >= 98
    assert np.all(np.diff(model.cuts) >= 0) and all(0 <= x.severity <= 2 for x in got.values())
    assert score_toxicity(docs, model).count() == len(ROWS) and score_toxicity(empty, model).count() == 0
    none = fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int, quality int"))
    assert not any(x.toxic for x in score_toxicity(docs, none).collect())
    assert len(fit_rows([np.array([1, 2])], np.array([1])).index) == 0


def test_near_duplicates(spark, docs, empty):
    fold = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})

    def shingles(t):
        w = WORD.findall((t or "").translate(fold))
        return {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    rows = [(i, t, shingles(t)) for i, t, _ in ROWS]
    known = [x for x in rows if x[0] is not None and x[2]]
    parent = {(i, t): (i, t) for i, t, _ in known}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in known:
        for b in known:
            if 100 * len(a[2] & b[2]) >= 85 * len(a[2] | b[2]):
                x, y = find(a[:2]), find(b[:2])
                parent[max(x, y)] = min(x, y)
    low = defaultdict(lambda: 10**9)
    for k in parent:
        low[find(k)] = min(low[find(k)], k[0])
    want = Counter()
    for i, t, s in rows:
        c = None if i is None else (low[find((i, t))] if s else i)
        want[i, len(s), c, i is None or c == i] += 1
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, percent=85).collect())
    assert got == want
    assert near_duplicates(empty).count() == 0


def test_near_copies_in_a_star_group(spark):
    """Copies of one text with ever more edits: some link to the base, some only to each other, most to nothing."""
    r = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for p in r.sample(range(120), r.randrange(0, 6)):
            words[p] = f"n{i}x{p}"
        rows.append((i, " ".join(words), "s"))
    docs = table(spark, rows)
    sets = {i: {tuple(t.split()[p : p + 5]) for p in range(116)} for i, t, _ in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {r.doc_id: r.component_id for r in near_duplicates(docs, percent=85).collect()} == {i: find(i) for i in sets}


def test_urls(spark):
    urls = ["http://A.Example.net/en/1?x#y", "https://x.net", "https://x.net/a", "nothing", None, "http://m.casino-win.example.com/de/1", "x://b.org/fr/z", "http://b.org/fr", "http://notnet/a", "http://q.example.org/k?a=1&b=2"]
    urls += [f"http://site{i}.example.org/p/{i}" for i in range(60)] + [f"http://free-bets{i}.casino-x.example.org/p/{i}" for i in range(20)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in judge_urls(pages, trees=3).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(9)] == [
        ("a.example.net", "/en/1", "example.net/en/"), ("x.net", "", None), ("x.net", "/a", "net/"), ("", "", None), ("", "", None),
        ("m.casino-win.example.com", "/de/1", "example.com/de/"), ("b.org", "/fr/z", "org/fr/"), ("b.org", "/fr", None), ("notnet", "/a", None),
    ]
    assert got[0].verdict == "allow" and got[2].verdict == "block"
    assert all((got[i].verdict == "block") == (i >= 70) for i in range(10, 90))
    one = judge_urls(pages.where("page_id < 5")).collect()
    assert all(r.verdict == "allow" for r in one if r.rule is None) and judge_urls(pages.limit(0)).count() == 0


def test_mixing(spark, empty):
    r = random.Random(4)
    rows = [(i, " ".join(["w"] * r.randrange(1, 300)), r.choice(["a", "a", "a", "b", None])) for i in range(300)] + [(900, None, "a"), (901, "", "b")]
    docs = table(spark, rows)
    powers = {"source": 0.5, "lang": 0.7, "topic": 0.6}
    out = mix(docs, powers, keep=0.5).collect()
    assert len(out) == len(rows) and mix(empty).count() == 0
    total = sum(x._tokens for x in out)
    for f, p in ((lambda x: x.source, 0.5), (lambda x: x._topic, 0.6)):
        have, want = Counter(), Counter()
        for x in out:
            have[f(x)] += x._tokens
            want[f(x)] += x._tokens * x._weight
        have = {k: v for k, v in have.items() if v}
        share = {k: v**p for k, v in have.items()}
        for k in have:
            assert abs(want[k] / total - share[k] / sum(share.values())) < 1e-6
    assert not any(x._kept for x in out if x._tokens == 0)
    again = {(x.doc_id, x._kept) for x in mix(docs.repartition(7), powers, keep=0.5).collect()}
    assert again == {(x.doc_id, x._kept) for x in out}


def base_counts(t):
    t = t or ""
    w = WORD.findall(t)
    grams = Counter(tuple(w[p : p + 3]) for p in range(len(w) - 2))
    repeat = {q for p in range(len(w) - 2) if grams[tuple(w[p : p + 3])] > 1 for q in (p, p + 1, p + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeat)


def test_quality_rules(spark, docs, empty):
    shared = "this line is on nearly every page of the host\n" * 1
    rows = ROWS + [(3000 + i, shared * 8 + " ".join(f"u{i}n{j}" for j in range(40 + 2 * i)), "big") for i in range(40)]
    got = quality_rules(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((i, *base_counts(t)) for i, t, _ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    big = {r.doc_id: r for r in got if r.doc_id and r.doc_id >= 3000}
    for i, r in big.items():
        own = 40 + 2 * (i - 3000)
        if not r.base_failed:
            assert r.kept == (i == 3000 or own >= 0.5 * r.n_words)
    assert quality_rules(empty).count() == 0


def test_quality_rules_count_documents(spark):
    """One document repeated counts once; in a host of any size a line in ``max_docs`` documents is above the limit."""
    own = lambda i: " ".join(f"o{i}x{j}" for j in range(60))
    shared = "\n".join(" ".join(f"s{k}y{j}" for j in range(40)) for k in range(4))
    rows = [(1, f"{shared}\n{own(1)}", "a")] * 12 + [(2, f"{shared}\n{own(2)}", "a")]
    assert all(r.kept for r in quality_rules(table(spark, rows)).collect())
    hot = [(i, f"{shared}\n{own(i)}" if i % 40 == 0 else own(i), "hot") for i in range(1200)]
    kept = {r.doc_id: r.kept for r in quality_rules(table(spark, hot), max_docs=30).collect()}
    assert kept == {i: i % 40 != 0 or i == 0 for i in range(1200)}
    assert all(r.kept for r in quality_rules(table(spark, hot), max_docs=31).collect())


def plain_print(text):
    """Sums of +1 and -1 of the first 128 bits of the paragraphs' hashes, then of each of the 1024 numbers of 16 bits that follow."""
    lanes = [0] * (128 + 1024)
    for line in text.split("\n"):
        if line:
            digest = hashlib.shake_128(line.encode()).digest(16 + 2 * 1024)
            bits = int.from_bytes(digest[:16], "big")
            for i in range(128):
                lanes[i] += 1 if bits >> (127 - i) & 1 else -1
            for i in range(1024):
                lanes[128 + i] += digest[16 + 2 * i] * 256 + digest[17 + 2 * i]
    return lanes


def plain_likeness(a, b):
    a, b = a[:128], b[:128]
    both = sum(x * x for x in a) + sum(x * x for x in b)
    return max(0.0, 1 - sum((x - y) ** 2 for x, y in zip(a, b, strict=True)) / both) if both else 1.0


@pytest.mark.parametrize("part", [1, 4, 4000])
def test_fingerprints(spark, docs, empty, part):
    """Against sums made bit by bit; the order is cut into many parts, one with repeated ids and rows without."""
    written = lambda lanes: base64.b64encode(b"".join((x % 65536).to_bytes(2, "big") for x in lanes)).decode()
    many = [(7, f"seven {i}\nline {i % 5}", "s") for i in range(60)] + [(None, f"none {i}", "s") for i in range(40)] + [(7, "seven 3\nline 3", "s")] * 5
    rows = ROWS + many
    order = sorted(((i, t or "") for i, t, _ in rows), key=lambda x: (x[0] is None, -(x[0] or 0), -row_key(x[1])))
    want = Counter()
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        a, b, c = plain_print(t), plain_print(edited), plain_print(n)
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), round(plain_likeness(a, b), 9), round(plain_likeness(a, c), 9)] += 1
    got = Counter((*tuple(r)[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in fingerprint_edits(table(spark, rows).repartition(3), part).collect())
    assert got == want


def test_fingerprints_are_multisets(spark, empty):
    a, b = fingerprints(["x\ny\nz", "z\nx\ny"])
    assert (a == b).all() and to_text(a) != to_text(fingerprints(["x\ny"])[0])
    assert inserted(inserted(to_text(a), ["new"]), ["new"], -1) == to_text(a) == inserted(to_text(fingerprints(["x\ny"])[0]), ["z"])
    long = "\n".join(["p", "q", "r"] * 40_000)
    assert list(fingerprints([long])[0]) == [((40_000 * x + 32768) % 65536) - 32768 for x in plain_print("p\nq\nr")]
    assert fingerprint_edits(empty).count() == 0
    assert fingerprint_edits(table(spark, [(None, "a", "s"), (None, None, "s")])).count() == 2


def test_substring_dedup(spark, docs, empty):
    first = {}
    for i, t, _ in ROWS:
        w = WORD.findall(t or "")
        for p in range(len(w) - 12):
            if i is not None:
                k = tuple(w[p : p + 13])
                first[k] = min(first.get(k, i), i)
    want = Counter()
    for i, t, _ in ROWS:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for p in range(len(w) - 12):
            if i is not None and first[tuple(w[p : p + 13])] < i:
                gone[p : p + 13] = [True] * 13
        left = [x for x, g in zip(w, gone, strict=True) if not g]
        want[i, len(w), len(w) - len(left), hashlib.sha256(" ".join(left).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in substring_dedup(docs).collect()) == want
    assert substring_dedup(empty).count() == 0


def test_substring_chains(spark):
    """Long copies, a fork in the middle, a chain over many anchors and a third of all rows with one passage, against the definition."""
    r = random.Random(12)
    long = [f"v{r.randrange(4000)}" for _ in range(900)]
    common = [f"c{i}" for i in range(70)]
    rows = [(1, " ".join(long), "s"), (2, " ".join(long[:450] + ["fork"] + long[450:]), "s"), (3, "\n".join(long), "s"), (9, " ".join(["x"] * 40 + long[100:300] + ["same"] * 60), "s")]
    rows += [(20 + i, " ".join([f"p{i}a{j}" for j in range(i % 30)] + common + [f"q{i}b{j}" for j in range(15)]), "s") for i in range(60)]
    rows += [(5, " ".join(["same"] * 50), "s"), (5, " ".join(common), "s"), (None, " ".join(long), "s"), (4, "tail " + " ".join(long[-13:]), "s")]
    first, want = {}, Counter()
    for i, t, _ in rows:
        w = t.split()
        for p in range(len(w) - 12):
            if i is not None:
                first[tuple(w[p : p + 13])] = min(first.get(tuple(w[p : p + 13]), i), i)
    for i, t, _ in rows:
        w = t.split()
        gone = [False] * len(w)
        for p in range(len(w) - 12):
            if i is not None and first[tuple(w[p : p + 13])] < i:
                gone[p : p + 13] = [True] * 13
        left = [x for x, g in zip(w, gone, strict=True) if not g]
        want[i, len(w), len(w) - len(left), hashlib.sha256(" ".join(left).encode()).hexdigest()] += 1
    assert Counter(tuple(x) for x in substring_dedup(table(spark, rows).repartition(5)).collect()) == want


def test_places_beyond_a_text_are_passed_over():
    import pyarrow as pa

    from rillflow.llm.substrings import PLACE, _read

    kind = pa.list_(pa.struct([("place", pa.int64()), ("total", pa.int64()), ("opened", pa.bool_())]))
    parts = [[{"place": 1 * PLACE + 1, "total": 2, "opened": True}, {"place": 2 * PLACE + 1, "total": 3, "opened": False}]]
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([1]), pa.array(["a b c d e"]), pa.array(parts, kind)], ["doc_id", "tkey", "text", "parts"])
    (out,) = _read(3)(iter([batch]))
    assert out.column("at").to_pylist() == [1, 1] and out.column("size").to_pylist() == [2, 1]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    cur = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    want = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in cur.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == want


def test_texts_with_a_common_frame_meet_by_long_bands(spark, monkeypatch):
    """Unlike pages of one frame: all links are found, and few of the pairs are made."""
    r, made = random.Random(11), []
    texts = []
    for _ in range(260):
        w = [f"f{i}" for i in range(200)]
        for p in range(10, 200, 14):
            w[p] = f"v{r.randrange(9)}"
        texts.append(w)
    for i in range(40):  # one field or two changed: some links, between pages that are heads of nothing
        w = list(texts[i * 3])
        for p in r.sample(range(10, 200, 14), 1 + i % 3):
            w[p] = f"v{r.randrange(9)}"
        texts.append(w)
    sets = [{tuple(w[p : p + 5]) for p in range(196)} for w in texts]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    across = neardup._across
    monkeypatch.setattr(neardup, "_across", lambda *a: made.append(across(*a)) or made[-1])
    long_bands = neardup._by_long_bands
    used = []
    monkeypatch.setattr(neardup, "_by_long_bands", lambda nodes, *a: used.append(nodes.count()) or long_bands(nodes, *a))
    monkeypatch.setattr(neardup, "drop", lambda *a: None)
    got = {x.doc_id: x.component_id for x in near_duplicates(table(spark, [(i, " ".join(w), "s") for i, w in enumerate(texts)]), percent=85, bands=44).collect()}
    assert got == {i: find(i) for i in range(len(texts))}
    assert used and used[0] > 200 and made[0].count() < 10 * len(texts)


def test_long_bands_miss_as_little_as_short_ones():
    for percent in (60, 80, 85, 95):
        for members in (0, 1, 400, 10**6, 10**9):
            rows, bands = neardup.deep_bands(members, percent)
            assert (1 - (percent / 100) ** rows) ** bands < 1.1e-9 and rows % 2 == 0
    assert neardup.deep_bands(10**6, 80)[1] < 20_000


def test_remembered_words_are_bounded(monkeypatch):
    """Texts without spaces leave nothing behind, and short words are forgotten once they are too many."""
    monkeypatch.setattr(pieces, "REMEMBERED", 2_000)
    vocab = vocabulary(queries.model_path())
    known, r = pieces._Known(vocab), random.Random(2)
    for _ in range(30):
        words = {"".join(r.choices("ab漢字かな", k=k)) for k in (3, 4, 5, 9, 200, 3000)}
        known.learn(words)
        for w in words:
            ids = vocab.encode_words([w])[0]
            assert known[w][:2] == (len(ids), ",".join(map(str, ids)))
        assert sum(map(len, known)) <= 2_000 + 30 * 24 + 3_300
    known.learn(set())
    assert all(len(w) <= pieces.LONG for w in known)
