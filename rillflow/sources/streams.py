"""Stream tables of recordings: one row a message, keyed by recording and topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Roles of the topics.
ROLES = {"view": "camera", "click": "arm_state", "purchase": "arm_command", "signup": "arm_command", "error": "ee_state"}
CONTINUOUS = ("view", "click", "error")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bag_id, topic, seq, t, h, value, k: recording, stream, number, receive and header time in microseconds.

    One message in 1009 has a header that was never set (0).
    """
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    return e.select(
        F.col("user_id").alias("bag_id"),
        F.col("event_type").alias("topic"),
        F.col("event_id").alias("seq"),
        t.alias("t"),
        F.when(F.col("event_id") % 1009 == 0, F.lit(0)).otherwise(t - (F.col("value") * 1000).cast("long")).alias("h"),
        "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


def literal(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schema)
