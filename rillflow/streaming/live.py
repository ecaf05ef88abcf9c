"""Live streams: log tails, running metric states, bursts, rate limits."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import logs
from ..operators.cuts import shared_dir
from ..plans.training_logs import STATE, latest_state
from .growing import register

ORDER = ["made", "file", "place"]


def tail(spark: SparkSession, folder: str) -> DataFrame:
    """job, line of log files as they grow, with their order: time and name of the file, the byte that the line starts at.

    The job is the file's folder.  Whole lines only; what is appended later is read by the
    next batch, and a restart goes on after the last line that was read (``growing``).
    """
    register(spark)
    return spark.readStream.format("growing_logs").load(folder)


def metric_states(lines: DataFrame, mode: str = "update") -> DataFrame:
    """Each job's state after every batch: step, total, eta and loss, kept between batches; lines count in their order.  ``mode`` append is for sinks that know no updates."""
    c = F.col("line")
    df = lines.select("job", *ORDER, *[v.alias(k) for k, v in logs.progress(c).items()], *[v.alias(k) for k, v in logs.metrics(c).items() if k in ("step", "loss")])

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = state.get if state.exists else (0, None, None, None)
        now = dict(zip(("step", "total", "eta", "loss"), old, strict=True))
        rows = pd.concat(list(batches)).sort_values(ORDER)[["bar_step", "bar_total", "eta_s", "step", "loss"]].astype(object)
        now = latest_state(rows.where(rows.notna(), None).itertuples(index=False), now)
        state.update((now["step"], now["total"], now["eta"], now["loss"]))
        yield pd.DataFrame([{"job": key[0], "step": now["step"], "total": now["total"], "eta_s": now["eta"], "loss": now["loss"]}])

    return df.groupBy("job").applyInPandasWithState(fold, STATE, "step long, total long, eta_s long, loss double", mode, GroupStateTimeout.NoTimeout)


def log_sink(lines: DataFrame, path: str, state: str):
    """Lines of running jobs appended to ``path`` as JSON, a folder a job; Spark's file sink writes each batch once."""
    shown = lines.select("job", F.unix_timestamp("made").cast("double").alias("ts"), F.col("line").alias("message"))
    return shown.writeStream.format("json").partitionBy("job").option("path", path).option("checkpointLocation", state).trigger(availableNow=True).start()


def live_bursts(events: DataFrame, gap: str, late: str) -> DataFrame:
    """Sessions of each recording and stream on event time; the end is the last message, not the gap's end."""
    df = events.withWatermark("ts", late)
    return df.groupBy(F.session_window("ts", gap), "user_id", "event_type").agg(F.count("*").alias("n"), F.max("ts").alias("end_ts")).select("user_id", "event_type", F.col("session_window.start").alias("start_ts"), "end_ts", "n")


def throttled(events: DataFrame, width: str, late: str) -> DataFrame:
    """At most one message of each recording in a time bucket."""
    df = events.withColumn("bucket", F.window("ts", width)["start"]).withWatermark("ts", late)
    return df.dropDuplicatesWithinWatermark(["user_id", "bucket"])


def run_available(df: DataFrame, mode: str = "append", state: str | None = None) -> DataFrame:
    """Run a stream over what is there and return the rows it wrote.

    Each batch is a folder of its number, written anew if the batch is tried again, so no
    row comes twice.  A source without rows gives an empty table.
    """
    spark = df.sparkSession
    out, kind = shared_dir(spark, "stream"), df.schema
    state = state or shared_dir(spark, "stream-state")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = df.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    spark.createDataFrame([], kind).write.mode("append").parquet(f"{out}/batch=-1")
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*")


def state_sink(states: DataFrame, path: str, state: str, every: str = "1 second", available: bool = False):
    """The last row of each job of an appended stream as ``path``/job.json, replaced by a rename, at most once in ``every``."""
    register(states.sparkSession)
    trigger = {"availableNow": True} if available else {"processingTime": every}
    return states.writeStream.format("job_states").outputMode("append").option("checkpointLocation", state).trigger(**trigger).start(path)


#: Later than any event: it closes all sessions.
CLOSING = "9999-01-01"


def closed_bursts(events: DataFrame, gap: str, late: str) -> DataFrame:
    """``live_bursts`` of all that is there, open sessions included.

    The stream runs twice on one checkpoint: over the events, then over one closing row in a second
    source that moves the watermark past every session.
    """
    spark = events.sparkSession
    own = events.select("user_id", "event_type", "ts")
    folder, state = shared_dir(spark, "closing"), shared_dir(spark, "stream-state")
    none = own.schema
    spark.createDataFrame([], none).write.parquet(folder)
    rows = live_bursts(own.unionByName(spark.readStream.schema(none).parquet(folder)), gap, late)
    closed = run_available(rows, state=state)
    spark.range(1).select(*[(F.lit(CLOSING) if c == "ts" else F.lit(None)).cast(none[c].dataType).alias(c) for c in own.columns]).write.mode("append").parquet(folder)
    return closed.unionByName(run_available(rows, state=state)).drop("batch")
