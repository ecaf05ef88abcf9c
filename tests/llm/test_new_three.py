"""Top-k search, token alignment and fill-in-middle against brute force."""

import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import DATA

from rillflow.llm import queries
from rillflow.llm.alignment import Aligner, align_tokenizers, token_groups
from rillflow.llm.impacts import Block, integers, top_k
from rillflow.llm.middles import UNIT, cut_ends, fill_in_middle, restored

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", ["op11_topk", "op13_fill_in_middle"])
def test_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    cur = duck.execute(queries.ORACLE_SQL[name])
    order = [d[0] for d in cur.description]
    want = sorted(repr([r[order.index(c)] for c in names]) for r in cur.fetchall())
    assert sorted(repr([r[c] for c in names]) for r in df.collect()) == want and want


# ---- top-k


def best(rows, k, every=50):
    """Plain top-k of (vec_id, components or None); rows are told apart by their place."""
    out = []
    usable = [(p, i, v) for p, (i, v) in enumerate(rows) if i is not None and v is not None]
    for p, i, q in usable:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for o, j, v in usable if o != p)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_topk_ties_copies_and_odd_rows(spark):
    r = random.Random(3)
    rows = [(i, [r.randrange(-3, 4) for _ in range(5)]) for i in range(400)]
    rows += [(500 + i, [2, 2, 2, 2, 2]) for i in range(60)] + [rows[50], rows[50], (700, [9]), (701, []), (702, None), (None, [5] * 5), (750, [1 << 40] * 5), (751, [-(1 << 40)] * 4), (800, [0] * 5)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, v array<bigint>, rank string, q int").repartition(3)
    big = (1 << 63) - 1
    want = [(q, n, i, max(-big - 1, min(big, s))) for q, n, i, s in best(rows, 7)]
    assert found(top_k(df, df.vec_id % 50 == 0, 7)) == want
    assert top_k(df.limit(0), df.vec_id % 50 == 0, 7).count() == 0
    few = df.where("vec_id IN (0, 1, 50)").dropDuplicates(["vec_id"])
    assert found(top_k(few, few.vec_id % 50 == 0, 7)) == best([x for x in rows[:60] if x[0] in (0, 1, 50)], 7)


def test_topk_many_blocks(spark, monkeypatch):
    from rillflow.llm import impacts

    monkeypatch.setattr(impacts, "BLOCK", 90)
    monkeypatch.setattr(impacts, "SLICE", 2)
    monkeypatch.setattr(impacts, "CHUNK", 5)
    x = np.floor(256 * np.random.default_rng(1).normal(size=(600, 16)) / 4).astype(int)
    x[100:160] = x[7] + np.random.default_rng(2).integers(-1, 2, size=(60, 16))
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, v array<bigint>")
    assert found(top_k(df, df.vec_id % 20 == 0, 5)) == best(rows, 5, 20)


def test_block_stops_on_proof_before_all_postings():
    x = np.floor(256 * np.random.default_rng(4).normal(size=(4096, 64)) / 8).astype(np.int64)
    block, part = Block(np.arange(4096), np.arange(4096), x), []
    for own in range(0, 4096, 100):
        exact = x @ x[own]
        exact[own] = np.iinfo(np.int64).min
        at, done = block.search(x[own], own, 5, None)
        assert own not in at and set(np.flatnonzero(exact >= np.sort(exact)[-5])) <= set(at)
        part.append((done / x.size, len(at) / 4096))
    assert np.mean(part, axis=0).sum() < 0.9  # postings and rescored rows, of what a scan would read


def test_integers(spark):
    rows = [(1, [0.5, -0.001]), (2, [float("nan")]), (3, [float("inf")]), (4, [None]), (5, None), (6, [])]
    df = spark.createDataFrame(rows, "i int, e array<float>").select("i", integers(__import__("pyspark").sql.functions.col("e"), 256).alias("v"))
    assert {r.i: r.v for r in df.collect()} == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: []}


# ---- tokenizers

TEXTS = [
    "The quick brown fox, isn't it?", "the the the  the\n\n the\tthe ", "  two  spaces   three    end  ", "日本語の文章です。空白はありません。" * 30, "naïve café — Ünïcode 🙂 🇫🇷 é", "", None, " ", "\n", "a", "▁low line▁", "x\u0000y \u0001 z", "<s> </s> <unk> <0x41> <|endoftext|> <|endoftext|>x",
    "tab\there  nbsp  em \x1cfs \x85nel", "123456 7890 3.14159 1,000", "word" * 400, "'s 't 're I'm we'll YOU'RE", "#$%^&*()_+{}|:<>?", "  a b ", "\r\n\r\n x", "the quick brown fox, isn't it?", "中 文 字 a中 b文",
]


def byte_table():
    """Token bytes of side A, from the library's own decoder."""
    shown = {}
    n = 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            shown[chr(b)] = b
        else:
            shown[chr(256 + n)] = b
            n += 1
    vocab = json.load(open(BYTES))["model"]["vocab"]
    return {i: bytes(shown[c] for c in t) for t, i in vocab.items()}


def plain_alignment(rows):
    """doc_id -> results; rows are (doc_id, text), whole texts through the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side, b_side, a_bytes = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES), byte_table()
    a_side.encode_special_tokens = True
    found, counts = [], Counter()
    for i, t in rows:
        groups, links, a, b = [], [], [], []
        if t:
            a, b = a_side.encode(" " + t, add_special_tokens=False).ids, b_side.encode(t)
            x = [a_bytes[j] for j in a]
            y = [bytes([int(p[3:5], 16)]) if b_side.is_byte(j) else p.replace("▁", " ").encode() for j in b for p in [b_side.id_to_piece(j)]]
            if b"".join(x) != (" " + t).encode() or b"".join(y) != (" " + t).encode():
                a, b, x, y = [], [], [], []
            ends = [dict((sum(map(len, s[: n + 1])), n) for n in range(len(s))) for s in (x, y)]
            p = r = 0
            for e in sorted(set(ends[0]) & set(ends[1])):
                q, s = ends[0][e], ends[1][e]
                groups.append(",".join(map(str, a[p : q + 1])) + "|" + ",".join(map(str, b[r : s + 1])))
                links.append((a[q], b[s]))
                p, r = q + 1, s + 1
        counts.update(links)
        found.append((i, a, b, groups, links))
    high = defaultdict(int)
    for (_, b), n in counts.items():
        high[b] = max(high[b], n)
    return [(i, len(a), len(b), len(g), len(k), sum(counts[x] == high[x[1]] for x in k), sum(counts[x] for x in k), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, a, b, g, k in found]


def test_alignment_against_whole_texts(spark):
    r = random.Random(9)
    words = [w for t in TEXTS if t for w in re.split("( )", t)]
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "".join(r.choices(words, k=r.randrange(1, 60)))) for i in range(60)]
    rows += [(None, "the end"), (0, TEXTS[0]), (3, "the " * 3000), (7, None)]
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, pairs string, row int").repartition(3)
    got = align_tokenizers(df, BYTES, PIECES)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain_alignment(rows)))
    assert align_tokenizers(df.limit(0), BYTES, PIECES).count() == 0
    shown = {x.doc_id: x.groups for x in token_groups(df.where("doc_id IN (5, 9)"), BYTES, PIECES).collect()}
    assert shown[5] == "" and shown[9].count("|") == 1


def test_alignment_of_the_given_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = queries.QUERIES["op12_token_alignment"](spark, DATA)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain_alignment(rows)))


def test_streams_of_small_batches(spark):
    """Counts that go on in the next batch, and ids in several parts."""
    rows = [(i, f"the quick {w} of the end {w}") for i in range(40) for w in ("fox", "zebra", "café")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = sorted(map(repr, map(tuple, align_tokenizers(df, BYTES, PIECES).collect())))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted(map(repr, plain_alignment(rows)))


def test_new_words_are_encoded_in_runs():
    """A library call a word costs more than the word; a run with words that don't come back gives what single words give."""
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("abcdeéx", k=r.randrange(2, 9))) for _ in range(200)) for _ in range(20)]
    sides = Aligner(BYTES, PIECES)
    encode, asked = sides.a, []

    class Counting:
        def encode_batch(self, texts, **more):
            asked.extend(texts)
            return encode.encode_batch(texts, **more)

    sides.a = Counting()
    sides.aligned(texts)
    assert len(sides.known) > 3000 and len(asked) < 200
    odd = ["one ① two", "x\u00a0y ﬁn", "  ab  cd ", "\ufeff ab", "long" * 30 + " ① ab", "", "ab \n cd\n\n", "\n ab \u3000 x "]
    mixed = odd + [" ".join(r.choices([*odd, *texts[0].split()], k=40)) for _ in range(30)]
    numbers, words = sides.aligned(mixed)[:2]
    for text, n, w in zip(mixed, numbers.tolist(), words, strict=True):
        _, n_a, n_b, n_groups, *_, digest = plain_alignment([(0, text)])[0]
        assert (n, hashlib.sha256(w.encode()).hexdigest() if w else "") == ([n_a, n_b, n_groups], digest), text
    assert 0 in numbers[:, 0] and max(map(len, sides.known)) <= 64


# ---- fill in the middle


def plain_middle(i, t):
    t = t or ""
    units = re.findall(UNIT, t)
    assert "".join(units) == t
    h = hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[j : j + 8], 16) for j in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, n, "plain", None, None, t
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_middles(spark):
    r = random.Random(4)
    rows = [(i, "".join(r.choices(["a", "Word", " ", "\n", "é", "🙂", "<", "P>", "S", ">", "<<", "1"], k=r.randrange(0, 30)))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, "x<M>y"), (None, "no id here"), (403, "Ab c" * 50_000), rows[0], (404, "z" * 100_000)]
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, output string, n int").repartition(3)
    out = fill_in_middle(df)
    out = out.withColumn("back", restored(out.output, out.form))
    got = sorted(map(repr, map(tuple, out.collect())))
    assert got == sorted(repr((*plain_middle(i, t), t or "")) for i, t in rows)
    assert {eval(x)[2] for x in got} == {"plain", "psm", "spm"}
    assert fill_in_middle(df.limit(0)).count() == 0
    all_cut = fill_in_middle(df, rate=100, spm=100, seed="s", marks=("[p]", "[s]", "[m]"))
    texts = {i: t or "" for i, t in rows}
    for x in all_cut.withColumn("back", restored(all_cut.output, all_cut.form, ("[p]", "[s]", "[m]"))).collect():
        assert x.back == texts[x.doc_id] and x.form == ("spm" if x.back else "plain")


def test_cut_ends_at_each_rank():
    units, text = re.compile(UNIT), "ab  c1"
    ends = [0, 2, 3, 4, 5, 6]
    assert all(cut_ends(units, text, a, b) == (ends[a], ends[b]) for a in range(6) for b in range(a, 6))
