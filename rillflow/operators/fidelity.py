"""Fidelity metrics: vector drift, pixel errors, summaries, correlations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .qc import r6
from .quantiles import grouped

EPS = 1e-8


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(EPS))


def angle(cos: Column) -> Column:
    return F.degrees(F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cos))))


def relative_l2(a: Column, ref: Column) -> Column:
    gap = F.aggregate(F.zip_with(a, ref, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(gap) / F.greatest(F.sqrt(dot(ref, ref)), F.lit(EPS))


def summary(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean, population deviation, median, range, p05 and p95 of finite values, and how many weren't finite."""
    x = F.col(value)
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    y = F.when(finite, x)
    moments = [F.count(y).alias("n"), F.count_if(~finite).alias("infinite_frames"), r6(F.avg(y)).alias("mean"), r6(F.stddev_pop(y)).alias("std"), r6(F.min(y)).alias("low"), r6(F.max(y)).alias("high")]
    df = grouped(rows, by, moments, {"median": (y, 0.5), "p05": (y, 0.05), "p95": (y, 0.95)})
    return df.select(*by, "n", "infinite_frames", "mean", "std", r6(F.col("median")).alias("median"), "low", "high", r6(F.col("p05")).alias("p05"), r6(F.col("p95")).alias("p95"))


def pixel_errors(a: Column, b: Column, channels: int = 1) -> dict[str, Column]:
    """Errors of two arrays of 0..255 values, ``channels`` values a pixel: ``b`` less ``a``; PSNR is infinite for equal ones.

    Percentiles of absolute errors are interpolated; a pixel is unchanged if all its
    channels are.  With several channels there are mae_i and bias_i of each.
    """
    delta = F.zip_with(b, a, lambda x, y: (x - y).cast("double"))
    gap, n = F.transform(delta, F.abs), F.size(a)
    ordered = F.array_sort(gap)

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)

    def at(q: float) -> Column:
        place = (n - 1) * q
        low = F.floor(place).cast("int")
        x, y = F.get(ordered, low), F.get(ordered, F.least(low + 1, n - 1))
        return x + (y - x) * (place - low)

    mse = total(F.transform(gap, lambda x: x * x)) / n
    pixels = F.sequence(F.lit(0), (n / channels).cast("int") - 1)
    changed = lambda p: F.array_max(F.slice(gap, p * channels + 1, F.lit(channels))) > 0
    out = {
        "mse": mse,
        "rmse": F.sqrt(mse),
        "mae": total(gap) / n,
        "psnr_db": F.when(mse == 0, F.lit(float("inf"))).otherwise(10 * F.log10(255.0 * 255.0 / mse)),
        "max_abs": F.array_max(gap),
        "p95_abs": at(0.95),
        "p99_abs": at(0.99),
        "unchanged": F.size(F.filter(pixels, lambda p: ~changed(p))) / (n / channels),
    }
    for c in range(channels if channels > 1 else 0):
        mine = lambda values, c=c: F.filter(values, lambda x, i: i % channels == c)
        out |= {f"mae_{c}": total(mine(gap)) / (n / channels), f"bias_{c}": total(mine(delta)) / (n / channels)}
    return out
