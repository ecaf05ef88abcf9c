"""Writers: episode tables, metric rows, manifests and reports, rewritten topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_episodes(rows: DataFrame, path: str, fps: float = 30.0, codec: str = "zstd") -> None:
    """Control rows as one Parquet folder a recording, with frame_index and timestamp; ``codec`` none, gzip, snappy or zstd.

    Spark's committer writes to a staging folder and renames at the end; an existing
    path is an error, so a failed run leaves nothing half written under it.
    """
    out = rows.withColumn("frame_index", F.col("k")).withColumn("timestamp", F.col("k") / fps)
    out.write.option("compression", codec).partitionBy("bag_id").parquet(path)


def convert(rows: DataFrame, status: DataFrame, path: str, on_error: str = "skip", fps: float = 30.0) -> DataFrame:
    """Write the rows of recordings that convert, and return the manifest: one row a recording, failures with their error.

    ``on_error`` fail: the first failure (least recording) is an error, and nothing is
    written.  If no recording converts, that is an error too.
    """
    if on_error not in ("skip", "fail"):
        raise ValueError("on_error must be skip or fail")
    failed = status.where("status = 'failed'").orderBy("bag_id").select("bag_id", "error").first()
    if failed is not None and on_error == "fail":
        raise ValueError(f"recording {failed.bag_id}: {failed.error}")
    good = status.where("status = 'converted'")
    if good.isEmpty():
        raise ValueError("no recording converts")
    write_episodes(rows.join(good.select("bag_id"), "bag_id", "left_semi"), f"{path}/data", fps)
    record = F.to_json(F.struct(*[F.col(c) for c in status.columns])).alias("manifest")
    write_report(status, f"{path}/meta/conversion")
    return status.select("bag_id", "status", record)


def write_report(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines: conversion status, quality verdicts."""
    rows.write.json(path)


def write_metric_rows(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Per-frame rows as CSV with a fixed list of columns; extra ones are left out."""
    rows.select(*columns).write.option("header", True).csv(path)


def manifest(rows: DataFrame, info: dict[str, str]) -> DataFrame:
    """One JSON text a recording: rows, held rows and the given settings."""
    audit = rows.groupBy("bag_id").agg(F.count("*").alias("rows"), F.count_if("hold").alias("held"))
    return audit.select("bag_id", F.to_json(F.struct("rows", "held", *[F.lit(v).alias(k) for k, v in info.items()])).alias("manifest"))


def same_schema(one: DataFrame, other: DataFrame) -> list[str]:
    """Columns in which two episode tables differ; empty if they can be appended."""
    a, b = dict(one.dtypes), dict(other.dtypes)
    return sorted(c for c in a.keys() | b.keys() if a.get(c) != b.get(c))


def differing(episodes: DataFrame) -> DataFrame:
    """bag_id, what: episodes (bag_id, fps, state_dim, action_dim, cameras) that differ from the first one, and in what."""
    first = episodes.orderBy("bag_id").limit(1).collect()
    if not first:
        return episodes.select("bag_id", F.lit("").alias("what")).limit(0)
    parts = [F.when(F.sort_array("cameras") != F.array(*map(F.lit, sorted(first[0]["cameras"]))), "cameras")]
    parts += [F.when(F.col(c) != F.lit(first[0][c]), c) for c in ("fps", "state_dim", "action_dim")]
    what = F.array_join(F.array_sort(F.filter(F.array(*parts), lambda x: x.isNotNull())), ",")
    return episodes.select("bag_id", what.alias("what")).where("what <> ''")


def rewrite_topic(messages: DataFrame, topic: str, name: str, payload: Column, column: str = "raw") -> DataFrame:
    """All messages, those of one topic with another name and payload; stamps stay."""
    hit = F.col("topic") == topic
    return messages.withColumn(column, F.when(hit, payload).otherwise(F.col(column))).withColumn("topic", F.when(hit, name).otherwise(F.col("topic")))
