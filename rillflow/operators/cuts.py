"""Lineage cuts: tables written and read back."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings while a table is written.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
_lock = threading.Lock()
#: For each session that writes now: how many writes, and its settings before the first.
_writers: dict[int, tuple[int, dict[str, str | None]]] = {}
#: Folders of the tables that are still there.
_tables: set[str] = set()


def shared_dir(spark: SparkSession, name: str = "rillflow") -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors see.

    Where that isn't set, a local session gets a temporary folder and a cluster an error.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        top = tempfile.mkdtemp(prefix="rillflow-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _writing(spark: SparkSession) -> Iterator[None]:
    """``WRITING`` holds while any thread of the session writes; the last one to end restores what was."""
    with _lock:
        n, before = _writers.get(id(spark), (0, {k: spark.conf.get(k, None) for k in WRITING}))
        _writers[id(spark)] = n + 1, before
        for k, v in WRITING.items():
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _lock:
            n, before = _writers.pop(id(spark))
            if n > 1:
                _writers[id(spark)] = n - 1, before
            else:
                for k, v in before.items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read back from a written table: lineage ends here and survives lost executors.

    Nothing reads the plan's shuffle files after the write, so Spark may drop them then.
    Batches for Python are kept small: long texts and sets would make them large.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    with _writing(spark):
        df.write.option("compression", "zstd").parquet(path)
    _tables.add(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _tables.discard(path)


def drop(*tables: DataFrame) -> None:
    """Delete tables of ``cut`` that nothing reads any more; other DataFrames are left alone."""
    for t in tables:
        if path := getattr(t, "_cut_path", None):
            _delete(t.sparkSession, path)


def clear(spark: SparkSession) -> None:
    """Delete all tables that are left, once the results that read them are written or no longer wanted."""
    for path in sorted(_tables):
        _delete(spark, path)
