"""Watched jobs: states with timers and expiry.

A job that says nothing for a while has ended, which no line tells: a timer does.  Needs
Spark's RocksDB state store (``store``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: Progress events: what a job's watcher tells.
EVENTS = "job string, event string, at bigint, step bigint, detail string"


def store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Watchdog(StatefulProcessor):
    """Rows are (job, at, step, code): a sign of life with its time in ms, a step or null, an exit code or null.

    Emits ``started`` once, ``progress`` where the step rises, ``done`` or ``failed`` at an exit
    code, and ``lost`` once the watermark is ``silence`` ms past the last sign of life.
    Afterwards the job is closed: late rows don't open it again until ``keep`` ms later.
    """

    def __init__(self, silence: int):
        self.silence = silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at bigint, step bigint, open boolean")

    def _set(self, at: int, step: int | None, is_open: bool) -> None:
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        self.seen.update((at, step, is_open))
        if is_open:
            self.handle.registerTimer(at + self.silence)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        job, out = key[0], []
        old = self.seen.get() if self.seen.exists() else None
        last, best, is_open = (old[0], old[1], old[2]) if old else (0, None, True)
        if old is None:
            out.append("started")
        events = []
        parts = list(rows)  # the rows of a job in one batch
        for row in pd.concat(parts).sort_values("at", kind="stable").itertuples(index=False):
            if not is_open:
                break
            at = int(row.at)
            step, code = (None if pd.isna(x) else int(x) for x in (row.step, row.code))
            last = max(last, at)
            if out:
                events.append((job, "started", at, step, None))
                out.clear()
            if step is not None and (best is None or step > best):
                best = step
                events.append((job, "progress", at, step, None))
            if code is not None:
                is_open = False
                events.append((job, "done" if code == 0 else "failed", at, best, str(code)))
        self._set(last, best, is_open)
        yield pd.DataFrame(events, columns=["job", "event", "at", "step", "detail"]).astype({"step": "Int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        old = self.seen.get() if self.seen.exists() else None
        if old is None or not old[2]:
            return
        self.seen.update((old[0], old[1], False))
        frame = pd.DataFrame([(key[0], "lost", int(old[0]) + self.silence, old[1], None)], columns=["job", "event", "at", "step", "detail"])
        yield frame.astype({"step": "Int64"})

    def close(self) -> None:
        pass


def watched(signs: DataFrame, silence: int, late: str = "0 seconds") -> DataFrame:
    """Progress events of ``signs`` (job, ts, step, code) on event time; ``silence`` in ms."""
    rows = signs.withWatermark("ts", late).select("job", "ts", F.unix_millis("ts").alias("at"), F.col("step").cast("long").alias("step"), F.col("code").cast("long").alias("code"))
    return rows.groupBy("job").transformWithStateInPandas(Watchdog(silence), EVENTS, "Append", "EventTime")


class Answers(StatefulProcessor):
    """A cache of answers: a question asked again within ``ttl`` ms of its answer is a hit, and doesn't renew it."""

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "answer string", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            out = []
            for row in part.itertuples(index=False):
                hit = self.kept.exists()
                if not hit:
                    self.kept.update((row.answer,))
                out.append((key[0], self.kept.get()[0], bool(hit)))
            yield pd.DataFrame(out, columns=["question", "answer", "hit"])

    def close(self) -> None:
        pass


def cached(asked: DataFrame, ttl: int) -> DataFrame:
    """question, answer, hit of ``asked`` (question, answer), kept for ``ttl`` ms of processing time."""
    kind: StructType | str = "question string, answer string, hit boolean"
    return asked.groupBy("question").transformWithStateInPandas(Answers(ttl), kind, "Append", "ProcessingTime")
