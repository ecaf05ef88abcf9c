"""Recordings, episodes and datasets found in a file listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, bytes, mtime of the files below a folder, or of one file; contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"))


def recordings(files: DataFrame) -> DataFrame:
    """bag, storage, bytes, mtime: folders with a metadata.yaml, .db3 or .mcap; sqlite3 wins over mcap.

    A single .db3 or .mcap file stands for its folder.
    """
    name = F.substring_index("path", "/", -1)
    marks = files.where((name == "metadata.yaml") | name.endswith(".db3") | name.endswith(".mcap"))
    bag = F.regexp_replace("path", "/[^/]*$", "")
    kind = F.when(F.max(name.endswith(".db3")), "sqlite3").when(F.max(name.endswith(".mcap")), "mcap").otherwise("unknown")
    return marks.groupBy(bag.alias("bag")).agg(kind.alias("storage"), F.sum("bytes").alias("bytes"), F.max("mtime").alias("mtime"))


def find_recordings(spark: SparkSession, source: str) -> DataFrame:
    """``recordings`` below a folder, or the folder of one file, which has to be a recording's."""
    files = listing(spark, source)
    if not source.endswith((".db3", ".mcap")) and not files.where(F.col("path").endswith("/" + source.strip("/"))).isEmpty():
        raise ValueError(f"{source} is neither a folder nor a .db3 or .mcap file")
    return recordings(files)


def episodes(files: DataFrame) -> DataFrame:
    """Episode files by suffix, each once."""
    return files.where(F.col("path").endswith(".hdf5") | F.col("path").endswith(".h5")).dropDuplicates(["path"])


def ordered(found: DataFrame, n: int = 0, by: str = "name") -> DataFrame:
    """Ordered by name, or by time from the oldest on (ties by name); the first ``n``, or all for 0 and less."""
    if by not in ("name", "mtime"):
        raise ValueError("by must be name or mtime")
    key = "bag" if "bag" in found.columns else "path"
    out = found.orderBy(*([by, key] if by == "mtime" else [key]))
    return out.limit(n) if n > 0 else out


def newest(found: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` latest by time, ties by name."""
    return found.orderBy(F.desc("mtime"), "bag" if "bag" in found.columns else "path").limit(n)


def datasets(spark: SparkSession, root: str) -> DataFrame:
    """root, repo_id, origin, frames, fps of the datasets below a folder: those with a meta/info.json.

    The id is that of the conversion manifest, else of the info file, else the folder's path.
    """
    kind = "repo_id string, total_frames long, fps double"

    def documents(name: str) -> DataFrame:
        df = spark.read.schema(kind).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", name).json(root)
        return df.select(F.regexp_replace(F.col("_metadata.file_path"), f"/meta/{name}$", "").alias("root"), "repo_id", "total_frames", "fps")

    info = documents("info.json")
    manifest = documents("conversion_manifest.json").select("root", F.col("repo_id").alias("_m"))
    df = info.join(manifest, "root", "left")
    origin = F.when(F.col("_m").isNotNull(), "manifest").when(F.col("repo_id").isNotNull(), "info").otherwise("path")
    path = F.concat_ws("/", F.slice(F.split("root", "/"), -2, 2))
    return df.select("root", F.coalesce("_m", "repo_id", path).alias("repo_id"), origin.alias("origin"), F.col("total_frames").alias("frames"), "fps")
