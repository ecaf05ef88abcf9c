"""Exact quantiles by group, without all values of a large group in one place.

Spark's ``percentile`` holds every distinct value of a group in one task.  Groups with many rows
are narrowed instead: their values are counted in cells between the least and the greatest, the cell that
holds a rank gives the next bounds, and after two or three rounds so few values are left
that they are sorted.  A round is one aggregation with a row a cell; nothing is sampled, the results are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import buckets
from .cuts import cut, drop

CELLS = 4096


def grouped(rows: DataFrame, by: list[str], aggregates: list[Column], points: dict[str, tuple[Column, float]], most: int | None = None) -> DataFrame:
    """by, ``aggregates``, and for each of ``points`` the quantile of its expression; one aggregation unless a group has many rows."""
    if buckets.heavy(rows, by, most) is None:
        return rows.groupBy(*by).agg(*aggregates, *[F.percentile(c, p).alias(name) for name, (c, p) in points.items()])
    values: dict[str, tuple[Column, dict[str, float]]] = {}
    for name, (c, p) in points.items():
        values.setdefault(str(c), (c, {}))[1][name] = p
    out, key = rows.groupBy(*by).agg(*aggregates), [F.col(c) for c in by]
    for c, own in values.values():
        found = quantiles(rows.select(*by, c.alias("_value")), by, "_value", own, most).select(F.struct(*key).alias("_g"), *own)
        out = out.join(found, F.struct(*key).eqNullSafe(F.col("_g")), "left").drop("_g")
    return out


def quantiles(rows: DataFrame, by: list[str], value: str, points: dict[str, float], most: int | None = None) -> DataFrame:
    """by, and for each of ``points`` the interpolated quantile of the column ``value``; nulls and NaN don't count.

    Groups without a value are left out.  ``most``: rows of a group that are taken as they are.
    """
    v = F.col(value).cast("double")
    rows = rows.select(*by, F.when(~F.isnan(v), v).alias("_v")).where("_v IS NOT NULL")
    exact = [F.percentile("_v", p).alias(name) for name, p in points.items()]
    found = buckets.heavy(rows, by, most)
    if found is None:
        return rows.groupBy(*by).agg(*exact)
    hot, limit = found
    group = F.struct(*[F.col(c) for c in by])
    heavy = hot.select(group.alias("_g"), F.col("_n").alias("n"))
    rows = rows.select(group.alias("_k"), "_v").join(F.broadcast(heavy.select("_g", F.lit(True).alias("_hot"))), F.col("_k").eqNullSafe(F.col("_g")), "left")
    few = rows.where("_hot IS NULL").groupBy("_k").agg(*exact)
    many = cut(rows.where("_hot").select("_k", "_v"))
    ranks = F.array(*[f(F.lit(float(p)) * (F.col("n") - 1)).cast("long") for p in points.values() for f in (F.floor, F.ceil)])
    ends = many.groupBy("_k").agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    state = cut(ends.select("_k", "n", F.explode(F.array_distinct(ranks)).alias("rank"), "low", "high", F.lit(0).cast("long").alias("below"), F.col("n").alias("size")))
    settled = F.expr(f"high <= low OR size <= {limit}")
    within = lambda ranges: many.join(F.broadcast(ranges.withColumnRenamed("_k", "_g")), F.col("_k").eqNullSafe(F.col("_g"))).where("_v BETWEEN low AND high")
    while not (open_ := state.where(~settled)).isEmpty():
        cell = F.least(F.floor((F.col("_v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * CELLS), F.lit(CELLS - 1))
        cells = within(open_.select("_k", "low", "high").distinct()).groupBy("_k", "low", "high", cell.alias("cell")).agg(F.count("*").alias("c"), F.min("_v").alias("a"), F.max("_v").alias("b"))
        past = W.partitionBy("_k", "low", "high").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)  # CELLS rows at most
        cells = cells.withColumn("before", F.coalesce(F.sum("c").over(past), F.lit(0)))
        place = F.col("rank") - F.col("below")
        next_ = open_.join(cells, ["_k", "low", "high"]).where((place >= F.col("before")) & (place < F.col("before") + F.col("c")))
        next_ = next_.select("_k", "n", "rank", F.col("a").alias("low"), F.col("b").alias("high"), (F.col("below") + F.col("before")).alias("below"), F.col("c").alias("size"))
        before, state = state, cut(state.where(settled).unionByName(next_))
        drop(before)
    left = within(state.where("high > low").select("_k", "low", "high").distinct()).groupBy("_k", "low", "high").agg(F.sort_array(F.collect_list("_v")).alias("_s"))  # ``limit`` values at most
    done = state.join(left, ["_k", "low", "high"], "left").select("_k", "n", "rank", F.coalesce(F.get("_s", (F.col("rank") - F.col("below")).cast("int")), "low").alias("x"))
    out = []
    for name, p in points.items():
        at = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.max(F.when(F.col("rank") == F.floor(at), F.col("x"))), F.max(F.when(F.col("rank") == F.ceil(at), F.col("x")))
        part = F.max(at - F.floor(at))
        out.append(F.when(low == high, low).otherwise((1 - part) * low + part * high).alias(name))
    both = few.unionByName(done.groupBy("_k").agg(*out))
    return both.select("_k.*", *points)
