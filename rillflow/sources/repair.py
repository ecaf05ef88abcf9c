"""Repair of datasets whose writer died: readable shards, the episodes in them, and a trimmed copy."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .discovery import listing

#: Bytes that a finished Parquet file ends with.
FOOTER = b"PAR1"


def probed(spark: SparkSession, root: str) -> DataFrame:
    """path, chunk, file, broken of a dataset's data files: one without a footer was still open.

    The last bytes are read where the task runs.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            broken = []
            for path, size in zip(batch["path"], batch["bytes"], strict=True):
                where, name = fs.FileSystem.from_uri(path)
                with where.open_input_file(name) as f:
                    broken.append(size < 12 or f.read_at(4, size - 4) != FOOTER)
            yield pd.DataFrame({"path": batch["path"], "broken": broken})

    files = listing(spark, root, "*.parquet").where(F.col("path").contains("/data/")).select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), "bytes")
    found = files.mapInPandas(run, "path string, broken boolean")
    number = lambda i: F.regexp_extract("path", r"chunk-(\d+)/file-(\d+)", i).try_cast("long")
    return found.select("path", number(1).alias("chunk"), number(2).alias("file"), "broken")


def readable(shards: DataFrame) -> DataFrame:
    """``shards`` with usable: those before the first broken one by (chunk, file); only the newest file is ever left open."""
    place = F.struct("chunk", "file", "path")
    first = shards.agg(F.min(F.when(F.col("broken"), place)).alias("first"))  # one row
    return shards.join(F.broadcast(first)).withColumn("usable", F.col("first").isNull() | (place < F.col("first"))).drop("first")


def frames(spark: SparkSession, root: str) -> DataFrame:
    """The frames of the readable shards, with chunk and file.  No tasks table: no episode was ever finished."""
    rows = readable(probed(spark, root)).where("usable").select("path", "chunk", "file")
    paths = [r.path for r in rows.select("path").collect()]  # names of files only
    if not paths or listing(spark, root, "tasks.parquet").isEmpty():
        return spark.createDataFrame([], "episode long, task long, chunk long, file long")
    df = spark.read.parquet(*paths)
    number = lambda i: F.regexp_extract(F.col("_metadata.file_path"), r"chunk-(\d+)/file-(\d+)", i).try_cast("long")
    return df.select(F.col("episode_index").cast("long").alias("episode"), F.col("task_index").cast("long").alias("task"), number(1).alias("chunk"), number(2).alias("file"))


def trimmed(spark: SparkSession, root: str, keep_through: int, out: str) -> int:
    """Write the frames of episodes up to ``keep_through`` to ``out``, by shard; how many frames are left behind.

    Files aren't changed in place: a lost executor could leave half a dataset.
    """
    rows = readable(probed(spark, root)).where("usable")
    paths = [r.path for r in rows.select("path").collect()]
    df = spark.read.parquet(*paths)
    number = lambda i: F.regexp_extract(F.col("_metadata.file_path"), r"chunk-(\d+)/file-(\d+)", i)
    kept = df.where(F.col("episode_index") <= keep_through).withColumn("chunk", number(1)).withColumn("file", number(2))
    kept.write.option("compression", "snappy").partitionBy("chunk", "file").parquet(out)
    return df.count() - spark.read.parquet(out).count()
