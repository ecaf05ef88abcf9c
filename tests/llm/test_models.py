"""Fitted models against plain optimisers, plain features and rows that weren't fitted on."""

import random
import re

import numpy as np
from conftest import DATA
from pyspark.sql import functions as F
from test_llm import table

from rillflow.llm.arrays import text_slices
from rillflow.llm.queries import read
from rillflow.llm.toxicity import OFTEN, STEMS, CumulativeLink, features, fit_toxicity, score_toxicity, training_rows
from rillflow.llm.urls import UrlModel, judge_urls


def test_descent_against_plain_steps():
    """Weights and cuts against many small proximal steps on a dense matrix."""
    r = np.random.default_rng(3)
    x = (r.random((200, 12)) < 0.3).astype(float)
    grade = np.digitize(x @ np.array([3, 2, 1, *np.zeros(9)]) + r.normal(0, 1, 200), [1.5, 3.5])
    above = (grade[:, None] > np.arange(2)).astype(float)
    row, column = np.nonzero(x)
    w, cuts = CumulativeLink(3)._descend(row, column, 12, above, 0.02, 3000)
    scale = np.sqrt(x.sum(axis=0) / 200)
    z = x / scale
    v, c = np.zeros(12), np.zeros(2)
    for _ in range(30_000):
        wrong = 1 / (1 + np.exp(-((z @ v)[:, None] - c))) - above
        v = v - 0.05 * z.T @ wrong.sum(axis=1) / 200
        v = np.sign(v) * np.maximum(np.abs(v) - 0.05 * 0.02, 0)
        c = c + 0.05 * wrong.mean(axis=0)
    assert np.abs(w - v / scale).max() < 1e-3 and np.abs(cuts - c).max() < 1e-3 and (np.diff(cuts) >= 0).all()


def test_features_against_plain_words():
    import pyarrow as pa

    r = random.Random(2)
    words = ["Nasty", "nasty", "nastiness", "überaus", "x" * 300, "a", "...", "don't", "co-op"]
    texts = [" ".join(r.choices(words, k=r.randrange(0, 30))) for _ in range(40)] + ["", None]
    for lo, buf, offsets in text_slices(pa.array(texts)):
        row, bucket = features(buf, offsets)
        for i, t in enumerate(texts[lo : lo + len(offsets) - 1]):
            found = [w.lower() for w in re.findall(rb"[^\x09-\x0d\x20-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+", (t or "").encode())]
            want = set()
            for size in (None, *STEMS):
                some = [w if size is None else w[:size] for w in found if size is None or len(w) > size]
                want |= {(size, w, often) for w in some for often in {False, some.count(w) >= OFTEN}}
            assert (row == i).sum() == len(want) and len(set(bucket[row == i])) == len(want)


def test_toxicity_held_out(spark):
    """Fitted on half of the labelled documents: nearly all toxic ones of the other half are found, and hardly a clean one."""
    path = DATA.replace("sf0.001", "sf0.1")
    docs, labels = read(spark, path, "documents"), read(spark, path, "labels").where("toxic IS NOT NULL")
    model = fit_toxicity(docs, labels.where("doc_id % 2 = 0"))
    rows = score_toxicity(docs, model).join(labels.where("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("label")), "doc_id")
    pairs = [(r.toxic, r.label == 1) for r in rows.collect()]
    bad = [a for a, b in pairs if b]
    assert len(bad) > 5 and sum(bad) >= 0.9 * len(bad) and sum(a for a, b in pairs if not b) <= 0.01 * len(pairs)


def test_training_rows_are_bounded(spark):
    docs = table(spark, [(i, f"text {i}", "s") for i in range(400)] + [(None, "x", "s"), (5, "again", "s")])
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(400)] + [(7, 1, 1), (None, 1, 1), (8, None, 0)], "doc_id long, toxic int, quality int")
    assert training_rows(docs, labels, 1000).count() == 401
    some = [training_rows(docs.repartition(n), labels, 50).collect() for n in (2, 7)]
    assert 45 <= len(some[0]) <= 51 and sorted(some[0]) == sorted(some[1])


def test_toxicity_of_odd_rows(spark):
    long = "fine words " * 200_000 + "vile"
    rows = [(i, ("vile nasty " if i % 3 == 0 else "kind good ") + f"w{i}", "s") for i in range(90)]
    odd = [(900, long, None), (901, None, "s"), (901, None, "s"), (None, "vile nasty", "s"), (902, "", "s"), (3, rows[3][1], "s")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(90)], "doc_id long, toxic int, quality int")
    model = fit_toxicity(table(spark, rows), labels)
    got = score_toxicity(table(spark, rows + odd).withColumnRenamed("anchor", "grade"), model).collect()
    assert len(got) == 96 and len({(r.p_toxic, r.grade) for r in got if r.doc_id in (901, 902)}) == 1
    assert all(r.toxic for r in got if r.doc_id is None or r.doc_id == 3)


def test_urls_held_out(spark):
    """URLs of the test pages that the trees weren't fitted on: most of both labels are told right."""
    model = UrlModel(read(spark, DATA.replace("sf0.001", "sf0.1"), "pages"))
    got = {r.label: (r.n, r.blocked) for r in model.held_out().collect()}
    assert got[0.0][0] > 200 and got[0.0][1] <= 0.1 * got[0.0][0]
    assert got[1.0][0] > 20 and got[1.0][1] >= 0.6 * got[1.0][0], got


def test_odd_urls(spark):
    """Repeated rows, null ids, long URLs, columns with the names of features; each row gets one verdict, alike for alike."""
    urls = [f"http://w{i}.example.org/{i}" for i in range(40)] + [f"http://casino-{i}.example.org/" for i in range(15)]
    urls += ["http://casino-1.example.org/"] * 5 + ["http://" + "a" * 200_000 + ".net/" + "b/" * 50_000, "x://", "://", "http://?", "", None]
    rows = [(None if i % 9 == 0 else i, u, "s", "t", 1, 2.0) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, suffix string, fold int, score double")
    got = judge_urls(pages, trees=2).collect()
    assert len(got) == len(urls) and all(r.verdict in ("allow", "block") for r in got)
    assert len({(r.score, r.verdict) for r in got if r.host == "casino-1.example.org"}) == 1
    assert [r.rule for r in got if r.host.startswith("aaa")] == ["net/"] and sum(r.host == "" for r in got) == 5
