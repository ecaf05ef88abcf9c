"""Window functions over ordered streams: previous rows, running sums, islands, bursts, velocities, running offsets.

Rows of a key are ordered by (t, seq).  A key with many rows is cut into buckets of about
as many (``buckets``): windows run inside a bucket, and what the buckets before it leave comes
from an aggregate of one row a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .buckets import Buckets, spread
from .cuts import cut


def _with_edges(rows: DataFrame, edge: DataFrame, by: list[str], values: dict[str, Column]) -> DataFrame:
    """by, t, seq, _b, _tag, _row and values: all rows, and before those of each bucket its row of ``edge``; one exchange serves the windows."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "_b"])
    kind = rows.select(row.alias("r")).schema["r"].dataType
    own = rows.select(*by, "t", F.col("seq").cast("long").alias("seq"), "_b", F.lit(1).alias("_tag"), row.alias("_row"), *[v.alias(n) for n, v in values.items()])
    none = F.lit(None).cast("long")
    return own.unionByName(edge.select(*by, none.alias("t"), none.alias("seq"), "_b", F.lit(0).alias("_tag"), F.lit(None).cast(kind).alias("_row"), *values))


def previous(rows: DataFrame, by: list[str], fields: list[str], picks: dict[str, Column | None], buckets: Buckets | None = None) -> DataFrame:
    """``rows`` with a struct of ``fields`` for each pick: the last row before it that the pick's condition holds for (None: any)."""
    value, rows = F.struct(*fields), rows.drop(*picks)
    buckets = buckets or spread(rows, by)
    if not buckets.split:
        order = W.partitionBy(*by).orderBy("t", "seq")
        past = order.rowsBetween(W.unboundedPreceding, -1)
        return rows.select("*", *[(F.lag(value).over(order) if c is None else F.last(F.when(c, value), True).over(past)).alias(n) for n, c in picks.items()])
    rows, place = buckets.place(rows), F.struct("t", "seq")
    values = {f"_v_{n}": value if c is None else F.when(c, value) for n, c in picks.items()}
    last = [F.max_by(v, place if picks[n[3:]] is None else F.when(picks[n[3:]], place)).alias(n) for n, v in values.items()]
    over = W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    edge = rows.groupBy(*by, "_b").agg(*last)
    edge = edge.select(*by, "_b", *[F.last(n, True).over(over).alias(n) for n in values])
    here = W.partitionBy(*by, "_b").orderBy("_tag", "t", "seq").rowsBetween(W.unboundedPreceding, -1)
    both = _with_edges(rows, edge, by, values)
    for n in values:
        both = both.withColumn(f"_p{n}", F.last(n, True).over(here))
    return both.where("_tag = 1").select("_row.*", *[F.col(f"_p_v_{n}").alias(n) for n in picks])


def running_sum(rows: DataFrame, by: list[str], amount: str, out: str, buckets: Buckets | None = None) -> DataFrame:
    """``rows`` with the sum of ``amount`` up to and with each row."""
    buckets = buckets or spread(rows, by)
    if not buckets.split:
        return rows.withColumn(out, F.sum(amount).over(W.partitionBy(*by).orderBy("t", "seq").rowsBetween(W.unboundedPreceding, 0)))
    rows, over = buckets.place(rows.drop(out) if out != amount else rows), W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    edge = rows.groupBy(*by, "_b").agg(F.sum(amount).alias("_v")).select(*by, "_b", F.coalesce(F.sum("_v").over(over), F.lit(0)).alias("_v"))
    here = W.partitionBy(*by, "_b").orderBy("_tag", "t", "seq").rowsBetween(W.unboundedPreceding, 0)
    both = _with_edges(rows, edge, by, {"_v": F.col(amount)}).withColumn("_s", F.sum("_v").over(here))
    return both.where("_tag = 1").select("_row.*", F.col("_s").alias(out))


def numbered(rows: DataFrame, by: list[str], out: str, buckets: Buckets | None = None) -> DataFrame:
    """``rows`` with their number in the key, from 0."""
    buckets = buckets or spread(rows, by)
    if not buckets.split:
        return rows.withColumn(out, F.row_number().over(W.partitionBy(*by).orderBy("t", "seq")).cast("long") - 1)
    rows = running_sum(rows.withColumn("_one", F.lit(1).cast("long")), by, "_one", out, buckets)
    return rows.withColumn(out, F.col(out) - 1).drop("_one")


def bursts(rows: DataFrame, by: list[str], gap: int) -> DataFrame:
    """Sessions of each key: a new one starts where ``t`` is more than ``gap`` after the row before."""
    rows = rows.select(*by, "t", "seq")
    buckets = spread(rows, by)
    rows = previous(rows, by, ["t"], {"_p": None}, buckets)
    rows = rows.select(*by, "t", "seq", F.coalesce((F.col("t") - F.col("_p.t") > gap).cast("long"), F.lit(0)).alias("_new"))
    rows = running_sum(cut(rows) if buckets.split else rows, by, "_new", "burst", buckets)  # cut, as a running sum over buckets reads its rows twice
    return rows.groupBy(*by, "burst").agg(F.min("t").alias("start_us"), F.max("t").alias("end_us"), F.count("*").alias("n"))


def islands(rows: DataFrame, by: list[str], flag: str, order: str) -> DataFrame:
    """Runs of neighbours whose flag is true: first and last ``order``, rows, first and last t.

    The rows of a run have the same last row without the flag before them.
    """
    rows = rows.select(*by, "t", F.col(order).cast("long").alias("seq"), F.coalesce(F.col(flag), F.lit(False)).alias("_f"))
    rows = previous(rows, by, ["t", "seq"], {"_p": ~F.col("_f")}).where("_f")
    ends = F.min("seq").alias("first"), F.max("seq").alias("last"), F.count("*").alias("rows"), F.min("t").alias("start_us"), F.max("t").alias("end_us")
    return rows.groupBy(*by, "_p").agg(*ends).drop("_p")


def segments(runs: DataFrame, by: list[str]) -> DataFrame:
    """``islands`` with their number ``seg`` in the key, from 0."""
    rows = cut(runs.withColumn("t", F.col("start_us")).withColumn("seq", F.col("first")))
    return numbered(rows, by, "seg").drop("t", "seq")


def backward_velocity(value: str, w, fps: float) -> Column:
    """(v[k] - v[k-1]) * fps; the first row has the second's, a single row 0."""
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    return F.coalesce((F.col(value) - before) * fps, (after - F.col(value)) * fps, F.lit(0.0))


def velocity_of(rows: DataFrame, by: list[str], order: list[str], value: str, fps: float, out: str = "v") -> DataFrame:
    """``rows`` with the backward velocity; a key is one episode, whose frames are ordered in one task."""
    return rows.withColumn(out, backward_velocity(value, W.partitionBy(*by).orderBy(*order), fps))


def running_offsets(rows: DataFrame, by: list[str], order: list[str], length: str) -> DataFrame:
    """from_idx and to_idx of consecutive pieces of a key that fits a task."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(length).over(w), F.lit(0))
    return rows.withColumn("from_idx", start).withColumn("to_idx", start + F.col(length))


def first_of_equal(rows: DataFrame, by: list[str], key: str, buckets: Buckets | None = None) -> DataFrame:
    """Of neighbours with the same key only the first; later repeats of a key stay."""
    rows = previous(rows, by, [key], {"_p": None}, buckets)
    return rows.where(F.col("_p").isNull() | (F.col(f"_p.{key}") != F.col(key))).drop("_p")


def last_of_equal(rows: DataFrame, by: list[str], order: str, key: str) -> DataFrame:
    """Of neighbours with the same key only the last; later repeats of a key stay."""
    after = F.lead(key).over(W.partitionBy(*by).orderBy(order))
    return rows.withColumn("_n", after).where(F.col("_n").isNull() | (F.col("_n") != F.col(key))).drop("_n")
