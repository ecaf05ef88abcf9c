"""Notices at the least coverage against a scan at every place."""

import random
import time

from test_llm import table

from rillflow.llm.licenses import TEMPLATES, Scanner, align, scan_licenses, words_of


def test_licenses_lack_any_word():
    """A notice without one word, or with another word there, is found wherever a scan at every place finds it."""
    s = Scanner()
    for name, text in TEMPLATES:
        words = words_of(text)
        need = next(n for n in range(len(words) + 1) if 100 * n >= 80 * len(words))
        for i in range(len(words)):
            for notice in (words[:i] + words[i + 1 :], words[:i] + ["otherword"] + words[i + 1 :]):
                full = ["before", *notice, "after"]
                reach = len(words) + len(words) // 4
                every = any(len(align(words, full[max(0, p - reach) : p + reach + 1])) >= need for p in range(len(full)))
                assert every == (name in [x[0] for x in s.scan(" ".join(full))]), (name, i)
    for first in ("Licensed", "available", "distributed"):
        assert [x[:2] for x in s.scan(f"text {first} under the MIT License and more")] == [("MIT", 0.8)]


def everywhere(s, t, words):
    """The best alignment of any stretch of the text."""
    template = s.templates[t][1]
    reach = len(template) + len(template) // 4
    return max(len(align(template, words[p : p + reach])) for p in range(len(words)))


def test_edited_notices_in_noise():
    """Notices with some words replaced, dropped or added, among noise: found if and only if a scan at every place finds them."""
    s, r = Scanner(), random.Random(7)
    vocab = ["license", "the", "of", "software", "work", *(f"n{i}" for i in range(60))]
    found = 0
    for i in range(120):
        t = i % len(TEMPLATES)
        words = list(s.templates[t][1])
        for _ in range(r.randrange(0, max(2, len(words) // 6))):
            p = r.randrange(len(words))
            words[p : p + 1] = r.choice([[], ["other"], [words[p], "more"]])
        text = r.choices(vocab, k=r.randrange(0, 40)) + words + r.choices(vocab, k=r.randrange(0, 40))
        got = s.scan(" ".join(text))
        names, best = {x[0] for x in got}, {name: everywhere(s, k, text) for k, (name, _) in enumerate(s.templates)}
        want = {name for k, (name, _) in enumerate(s.templates) if best[name] >= s.need[k]}
        size = {name: len(words) for name, words in s.templates}
        assert all(max(x[1] for x in got if x[0] == n) * size[n] >= best[n] - 1e-9 for n in names)
        assert names == want, (i, names, want)
        found += bool(want)
    assert found > 60


def test_long_and_odd_texts(spark):
    """A key word at every place of a long text costs its length; notices before and after it are found."""
    mit = "Released under the MIT License."
    long = f"{mit} {'license mit apache '.strip()} " + "license " * 300_000 + mit
    began = time.time()
    assert [x[0] for x in Scanner().scan(long)] == ["MIT", "MIT"]
    assert time.time() - began < 20
    rows = [(1, long, "a"), (2, "x" * 3_000_000, "a"), (2, "x" * 3_000_000, "a"), (None, mit, None), (3, None, "a")]
    got = sorted(((r.doc_id, r.best, r.n_matches) for r in scan_licenses(table(spark, rows)).collect()), key=str)
    assert got == sorted([(1, "MIT", 2), (2, None, 0), (2, None, 0), (None, "MIT", 1), (3, None, 0)], key=str)
