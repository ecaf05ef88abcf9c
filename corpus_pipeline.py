"""A corpus pipeline of five operators: quality rules, line dedup, near-dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
returns a DataFrame; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.lines import deduped_rows, quality_rules
from rillflow.llm.mixing import mixed_rows
from rillflow.llm.neardup import near_duplicates
from rillflow.llm.pieces import piece_digests
from rillflow.llm.queries import model_path
from rillflow.llm.tables import cut, drop, maybe_in, read


def _without(docs: DataFrame, gone: DataFrame, key: list[str]) -> DataFrame:
    """``docs`` without the rows whose id and hash of the columns ``key`` are in ``gone`` (doc_id, tkey).

    Rows that can't be in ``gone`` stay where they are; only the others are joined, with their texts.
    """
    gone = cut(gone.select(F.col("doc_id").alias("_id"), F.col("tkey").alias("_t")).distinct())
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col("doc_id").cast("long").alias("_i"), F.xxhash64(*[F.col(c).cast("string") for c in key]).alias("_k"))
    rows = maybe_in(rows, gone.select(F.xxhash64("_id", "_t").alias("slot")), F.col("_i"), F.col("_k"))
    # not an anti join: Spark would do that before the filter, with all rows
    asked = rows.where("_maybe").join(gone, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_t")), "left").where("_t IS NULL")
    return rows.where("NOT _maybe").select("row.*").unionByName(asked.select("row.*"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are depleted of lines of their own go."""
    return _without(docs, quality_rules(docs).where("NOT kept"), ["text", "source"])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines go from the texts; documents that consist of them only go with them."""
    out = deduped_rows(docs).where(~((F.col("_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars")).cast("long")}
    return out.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (similarity of word shingles 0.8 or more) the document with the least id stays.

    68 bands: a link at 0.8 shares none of them with probability 1e-9.
    """
    return _without(docs, near_duplicates(docs, percent=80).where("NOT kept"), ["text"])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics have their target weights; where one is due more than once it repeats."""
    out = mixed_rows(docs, keep=0.8).where("_kept").select("row", F.explode(F.expr("array_repeat(0, int(_copies))")))
    return out.select("row.*")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded texts."""
    return piece_digests(docs, model_path())


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near-dedup", near_dup_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: Similarity components and raked sampling aren't SQL; tests/llm/test_stages.py compares each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; a table goes once the next one is written."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, sf_dir))
        drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
