"""Next fit against the plain fold."""

import random
from collections import defaultdict

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from rillflow.operators import packing
from rillflow.operators.packing import next_fit
from rillflow.plans import catalogs, registry


def fold(rows, cap, most=None):
    """(key, order): (bin, offset) of (key, order, size)."""
    groups, out = defaultdict(list), {}
    for k, o, x in rows:
        groups[k].append((o, x))
    for k, g in groups.items():
        b, n, size = 0, 0, 0.0
        for o, x in sorted(g):
            if (n if most else size) and (size + x > cap or (most and n >= most)):
                b, n, size = b + 1, 0, 0.0
            out[k, o] = (b, pytest.approx(size, abs=1e-5))
            n, size = n + 1, size + x
    return out


@pytest.mark.parametrize("most", [None, 5])
def test_next_fit(spark, most):
    r = random.Random(3)
    rows = [("hot" if i % 3 else r.choice(["a", None, "null"]), i, r.choice([0.0, 0.0, 0.25, 1.5, 3.0, 9.75, 10.0, 10.25, 40.0])) for i in range(700)]
    rows += [("tiny", i, 0.0) for i in range(9)] + [("far", 0, 1.0), ("far", 1, 90000.0), ("far", 2, 1.0)]
    df = spark.createDataFrame(rows, "k string, o long, x double").repartition(5)
    got = {(g.k, g.o): (g.bin, g.offset) for g in next_fit(df, ["k"], "o", "x", 10.0, most).collect()}
    assert got == fold(rows, 10.0, most)


def test_written_tables_do_not_grow_with_bins(spark, monkeypatch):
    """Two, whether a key has one bin or 600."""
    written, cut = [], packing.cut
    monkeypatch.setattr(packing, "cut", lambda df: written.append(df) or cut(df))
    df = spark.range(600).select(F.lit("k").alias("k"), F.col("id").alias("o"), F.lit(1).alias("x"))
    counts = []
    for most in (600, 1):
        assert next_fit(df, ["k"], "o", "x", 1e6, most).agg(F.max("bin")).first()[0] == 600 // most - 1
        counts.append(len(written))
        written.clear()
    assert counts == [2, 2]


@pytest.mark.parametrize("sizes", [[0], [7], [0, 0, 0, 3, 11], [1, 2, 10, 12], [0, 0, 25]])
@pytest.mark.parametrize("most", [None, 5])
def test_next_fit_in_many_shards(spark, monkeypatch, most, sizes):
    """Shards of a few rows: bins that never meet (equal sizes), longer than shards (no sizes), or shut by an over-long row."""
    monkeypatch.setattr(packing, "ROWS", 9)
    r = random.Random(5)
    rows = [("hot" if i % 4 else r.choice([None, "null", "a"]), i, r.choice(sizes)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o long, x long").repartition(5)
    assert {(g.k, g.o): (g.bin, g.offset) for g in next_fit(df, ["k"], "o", "x", 10.0, most).collect()} == fold(rows, 10.0, most)
    once = {(k, o // 3): max(y for a, b, y in rows if (a, b // 3) == (k, o // 3)) for k, o, _ in rows}
    got = next_fit(df.withColumn("o", F.floor(F.col("o") / 3)), ["k"], "o", "x", 10.0, most, repeats=True, offsets=False)
    assert got.columns == ["k", "o", "bin"]
    assert sorted((str(g.k), g.o, g.bin) for g in got.collect()) == sorted((str(k), o, b) for (k, o), (b, _) in fold([(k, o, x) for (k, o), x in once.items()], 10.0, most).items())


def test_next_fit_of_no_rows_and_of_large_capacities(spark):
    empty = spark.createDataFrame([], "k string, o long, x double")
    assert next_fit(empty, ["k"], "o", "x", 10.0).collect() == []
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate([None, 6e18, 2e18, 1e18, 9e18, 0.0])], "k string, o long, x double")
    rows = [("a", i, x) for i, x in enumerate([0.0, 6e18, 2e18, 1e18, 9e18, 0.0])]
    for cap, df in ((8e18, df), (8e18, df.withColumn("x", F.col("x").cast("long")))):
        assert {g.o: g.bin for g in next_fit(df, ["k"], "o", "x", cap).collect()} == {o: b for (_, o), (b, _) in fold(rows, cap).items()}


def test_queries_fold_whole_groups(spark, duck):
    def group(path):
        parts = path.split("/")
        return "/".join(parts[:2]) if parts[0] in ("videos", "images") and len(parts) > 2 else parts[0] if len(parts) > 1 else "."

    got = registry.queries()["pack_batches"](spark, DATA).collect()
    sizes = {r.path: r.bytes for r in catalogs.files(spark, DATA).collect()}
    want = fold([(group(p), p, float(b)) for p, b in sizes.items()], 2_000_000, 50)
    assert {(r.key, r.path): r.batch for r in got} == {k: b for k, (b, _) in want.items()}
    assert {r.key for r in got} == {"meta", "data", "videos/head", "videos/wrist", "."} and all(r.last == (r.key == "meta") for r in got)


def test_videos_end_at_a_row_that_fits_no_file(spark):
    """By a plain cursor over files: an over-long row passes all files, and nothing after it is covered."""
    r = random.Random(8)
    rows = [(d, i, r.choice([0.0, 0.5, 1.0, 2.5, 4.0, 9.0]) if i else 1.0) for d in range(6) for i in range(40)] + [(7, i, x) for i, x in enumerate([4.0, 11.0, 1.0])] + [(8, 0, 11.0), (8, 1, 1.0)]
    rows += [(2, 40, 10.5), (2, 41, 1.0)]
    df = spark.createDataFrame(rows, "d int, i int, x double").repartition(4)
    n_files = lambda d: 3 + 9 * (d % 2)
    want = {}
    for d in {x[0] for x in rows}:
        cursor, offset = 0, 0.0
        for _, i, x in sorted(x for x in rows if x[0] == d):
            while cursor < n_files(d) and offset + x > 10.0:
                cursor, offset = cursor + 1, 0.0
            if cursor >= n_files(d):
                break
            want[d, i] = (cursor, offset, offset + x)
            offset += x
    got = catalogs.video_windows(df, "d", "i", "x", 10.0, 3 + 9 * (F.col("d") % 2)).collect()
    assert {(g.d, g.i): (g.file, g.start_s, g.end_s) for g in got} == want and (7, 0) in want and (7, 1) not in want and (8, 1) not in want
