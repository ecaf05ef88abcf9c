"""Streaming queries run over what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import query

HOURS = 48
BURSTS = f"""WITH s AS (SELECT *, epoch_us(ts) AS t, lag(epoch_us(ts)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS before FROM events),
g AS (SELECT *, sum(CAST(coalesce(t - before > {HOURS * 3_600_000_000}, false) AS INT)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS burst FROM s)
SELECT user_id, event_type, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n FROM g GROUP BY user_id, event_type, burst"""


def event_stream(spark, sf_dir):
    """The event table as a stream; a pattern, as Spark's stream source takes a folder or a pattern, not one file."""
    kind = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(kind).parquet(f"{sf_dir}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))


@query(BURSTS)
def stream_bursts(spark, sf_dir):
    """Bursts by a stateful stream over the event table, the open ones of its end included."""
    from ..streaming import live

    return live.closed_bursts(event_stream(spark, sf_dir), f"{HOURS} hours", "1 hour")
