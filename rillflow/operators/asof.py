"""As-of joins as one exchange by key and one sort for each direction.

Both sides are tagged and united; a window carries the last source to each tick.  A
key with many rows is cut into buckets of about as many (``buckets``), each of which starts with one
extra row: the last source of the buckets before it, from an aggregate of one row a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .buckets import Buckets, spread


def asof_many(left: DataFrame, right: DataFrame, by: list[str], payload: list[str], picks: dict[str, tuple[Column | None, str]], buckets: Buckets | None = None) -> DataFrame:
    """``left`` with a struct (t, seq, payload) for each of ``picks``; null where there is none.

    ``picks`` maps a name to which rows of ``right`` count (null: all) and a direction:
    ``backward`` takes the greatest t at or before the tick, the last seq of equal ones,
    ``before`` the greatest strictly before it, ``forward`` the least at or after it, the
    first seq of equal ones.  All picks share one exchange; a direction is one sort.
    Rows without a key or t match nothing.  ``buckets``, if given, are of both sides' rows.
    """
    names = list(picks)
    ahead = {n: picks[n][1] == "forward" for n in names}
    value = F.struct("t", "seq", *payload)
    kind = right.select(value.alias("v")).schema["v"].dataType
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    row_kind = left.select(row.alias("r")).schema["r"].dataType
    none, no_row, no_seq = F.lit(None).cast(kind), F.lit(None).cast(row_kind), F.lit(None).cast("long")
    right = right.where(F.col("t").isNotNull())
    source = right.select(*by, "t", F.col("seq").cast("long").alias("seq"), F.lit(0).alias("_tag"), no_row.alias("_row"), *[(value if picks[n][0] is None else F.when(picks[n][0], value)).alias(f"_{n}") for n in names])
    ticks = left.select(*by, F.col("t"), no_seq.alias("seq"), F.lit(1).alias("_tag"), row.alias("_row"), *[none.alias(f"_{n}") for n in names])
    both = source.unionByName(ticks)
    if buckets is None:
        buckets = spread(right.select(*by, "t").unionByName(left.select(*by, "t")), by)
    keys = by
    if buckets.split:
        keys = [*by, "_b"]
        both = buckets.place(both)
        # a row for each bucket: what the nearest buckets before and after it leave
        edge = both.groupBy(*keys).agg(*[(F.min if ahead[n] else F.max)(f"_{n}").alias(f"_{n}") for n in names], F.min("t").alias("_low"), F.max("t").alias("_high"))
        over = {n: W.partitionBy(*by).orderBy(F.desc("_b") if ahead[n] else F.asc("_b")).rowsBetween(W.unboundedPreceding, -1) for n in names}
        edge = edge.select(*keys, "_low", "_high", *[F.last(f"_{n}", True).over(over[n]).alias(f"_{n}") for n in names])
        for forward in sorted(set(ahead.values())):
            own = [n for n in names if ahead[n] == forward]
            t = F.col("_high" if forward else "_low")
            both = both.unionByName(edge.select(*keys, t.alias("t"), no_seq.alias("seq"), F.lit(-1).alias("_tag"), no_row.alias("_row"), *[(F.col(f"_{n}") if n in own else none).alias(f"_{n}") for n in names]))
    place = W.partitionBy(*keys)
    # what a bucket starts with, then sources before ticks of the same time, or after them
    sources_first, ticks_first = F.col("_tag"), F.when(F.col("_tag") == 0, 2).otherwise(F.col("_tag"))
    order = {
        "backward": place.orderBy("t", sources_first, "seq"),
        "before": place.orderBy("t", ticks_first, "seq"),
        "forward": place.orderBy(F.desc("t"), sources_first.asc(), F.desc("seq")),
    }
    found = both
    for n in names:
        found = found.withColumn(f"_{n}", F.last(f"_{n}", True).over(order[picks[n][1]].rowsBetween(W.unboundedPreceding, 0)))
    whole = F.col("t").isNotNull()
    for c in by:
        whole = whole & F.col(c).isNotNull()
    return found.where("_row IS NOT NULL").select("_row.*", *[F.when(whole, F.col(f"_{n}")).alias(n) for n in names])


def asof(left: DataFrame, right: DataFrame, by: list[str], payload: list[str], prefix: str = "src", direction: str = "backward", strict: bool = False, buckets: Buckets | None = None) -> DataFrame:
    """``asof_many`` with one pick."""
    return asof_many(left, right, by, payload, {prefix: (None, "before" if strict else direction)}, buckets)


def nearest(left: DataFrame, right: DataFrame, by: list[str], payload: list[str], prefix: str = "src", buckets: Buckets | None = None) -> DataFrame:
    """The nearer of the sources strictly before and at or after each tick; the earlier one if both are as near."""
    out = asof_many(left, right, by, payload, {"_before": (None, "before"), "_after": (None, "forward")}, buckets)
    gap_before, gap_after = F.col("t") - F.col("_before.t"), F.col("_after.t") - F.col("t")
    after = F.col("_before").isNull() | (gap_after < gap_before)
    return out.withColumn(prefix, F.when(after & F.col("_after").isNotNull(), F.col("_after")).otherwise(F.col("_before"))).drop("_before", "_after")


def interpolated(left: DataFrame, right: DataFrame, by: list[str], field: str, tolerance: int, out: str = "v") -> DataFrame:
    """``out``: the field's linear value at each tick between its neighbours, null unless both are within ``tolerance``; an exact hit is itself."""
    df = asof_many(left, right, by, [field], {"_p": (None, "backward"), "_n": (None, "forward")})
    return between(df, field, tolerance, out).drop("_p", "_n")


def between(df: DataFrame, field: str, tolerance: int, out: str) -> DataFrame:
    """The linear value at ``t`` between the picks _p and _n."""
    span = F.col("_n.t") - F.col("_p.t")
    alpha = F.when(span > 0, (F.col("t") - F.col("_p.t")) / span).otherwise(F.lit(0.0))
    line = F.col(f"_p.{field}") + alpha * (F.col(f"_n.{field}") - F.col(f"_p.{field}"))
    near = (F.col("t") - F.col("_p.t") <= tolerance) & (F.col("_n.t") - F.col("t") <= tolerance)
    value: Column = F.when(F.col("_p.t") == F.col("t"), F.col(f"_p.{field}")).when(near, line)
    return df.withColumn(out, value)
