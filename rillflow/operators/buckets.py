"""Keys cut into buckets of about as many rows.

Ordered windows need the rows of a key in one place.  A key with many rows is cut at
quantiles of its order, so that it spreads over many tasks however its rows lie in time; all other keys are one
bucket each.  How many rows are many follows the rows a task: a fourth of them, and ``ROWS`` at least.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cuts import cut

#: Rows that a task takes without thought.
ROWS = 1 << 18


@dataclass(frozen=True)
class Buckets:
    """Bounds of the keys that are cut; ``bounds`` is None if none is."""

    by: tuple[str, ...]
    bounds: DataFrame | None = None
    longest: int = 0

    @property
    def split(self) -> bool:
        return self.bounds is not None

    def place(self, rows: DataFrame, t: Column | None = None) -> DataFrame:
        """``rows`` with the number ``_b`` of their bucket in the key, rising with ``t``; rows without t are in the first."""
        if self.bounds is None:
            return rows.withColumn("_b", F.lit(0))
        t = F.col("t") if t is None else t
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(self.longest.bit_length()))])
        found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("_bounds", at + step - 1) <= F.col("_at"), at + step).otherwise(at))
        same = F.lit(True)
        for c in self.by:
            same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        both = rows.withColumn("_at", t).join(F.broadcast(self.bounds), same, "left")  # rows by the bounds of the keys that are cut: 8 x tasks at most
        return both.withColumn("_b", found).drop("_at", "_bounds", *[f"_k_{c}" for c in self.by])


def heavy(rows: DataFrame, by: list[str], most: int | None = None) -> tuple[DataFrame, int] | None:
    """Keys with more rows than the limit and their count ``_n`` (4 x tasks at most), and the limit; None if there are none."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(*by).agg(F.count("*").alias("_n"))
    total, top = counts.agg(F.sum("_n"), F.max("_n")).first()
    limit = max(ROWS if most is None else most, (total or 0) // (4 * tasks))
    return (cut(counts.where(F.col("_n") > limit)), limit) if (top or 0) > limit else None


def spread(rows: DataFrame, by: list[str], known: Buckets | None = None, t: str = "t", most: int | None = None) -> Buckets:
    """Buckets of ``rows`` by key in the order of ``t``: one count of the keys, and quantiles of those over the limit.

    ``known`` buckets of the same or a coarser key that nothing had to be cut for hold for any part of their rows.
    """
    if known is not None and not known.split:
        return Buckets(tuple(by))
    found = heavy(rows, by, most)
    if found is None:
        return Buckets(tuple(by))
    counts, limit = found
    top = counts.agg(F.max("_n")).first()[0]
    pieces = -(-top // limit) + 1
    names = [F.col(c).alias(f"_k_{c}") for c in by]
    hot = counts.select(*names, "_n")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    own = rows.select(*by, F.col(t).alias("_at")).join(F.broadcast(hot), same)
    ends = F.percentile_approx("_at", [i / pieces for i in range(1, pieces)], max(10_000, 16 * pieces))
    bounds = own.groupBy(*[f"_k_{c}" for c in by]).agg(ends.alias("_q"), F.max("_n").alias("_n"))
    # a lesser key takes fewer of the bounds
    step = F.greatest(F.lit(1), F.floor(F.lit(pieces) * limit / F.col("_n")).cast("int"))
    bounds = bounds.withColumn("_s", step).select(*[f"_k_{c}" for c in by], F.expr("array_distinct(filter(_q, (x, i) -> (i + 1) % _s = 0))").alias("_bounds"))
    return Buckets(tuple(by), cut(bounds), pieces)
