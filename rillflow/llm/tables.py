"""Shared Spark helpers: row keys, lineage cuts, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cuts import cut, drop

#: Words are maximal runs of characters outside this class.
SPACES = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, tkey (hash of the text), text.  Rows that agree in both keys are the same row repeated."""
    text = F.col("text").cast("string").alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"), text)


def text_words(text: Column) -> Column:
    """The words of a text as an array; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def word_count(text: Column) -> Column:
    """The number of words; only the pieces at the ends of a split can be empty."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    n = F.size(parts)
    return n - (F.get(parts, F.lit(0)) == "").cast("int") - ((n > 1) & (F.get(parts, n - 1) == "")).cast("int")


def without(text: Column, marks: str) -> Column:
    """``text`` without some characters; several times as fast as ``translate``, which looks up each character."""
    for c in marks:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def least_hashes(rows: DataFrame, total: int, limit: int, *key: str) -> DataFrame:
    """At most ``limit`` of the ``total`` rows, those whose keys have the least hashes.

    A threshold on the hash leaves about ``limit`` rows in all before they are ordered,
    so no task gets more than about that, however many partitions there are.
    """
    place = F.pmod(F.xxhash64(*key), F.lit(1 << 40))
    if total > limit:
        rows = rows.where(place < F.lit(int((1 << 40) * min(1.0, 1.05 * limit / total + 20 / total))))
    return rows.orderBy(place, *key).limit(limit)


#: A key with this part of the rows or more is hot: there are no more hot keys than this.
HOT_KEYS = 4096


def spread_join(rows: DataFrame, table: DataFrame, key: str | list[str], total: int) -> DataFrame:
    """``rows`` joined with ``table``, which has each key once and the number ``n`` of its rows; ``total``: all rows.

    Keys with a 4096th of the rows or more, 4096 of them at most, are broadcast, and their
    rows are spread over all tasks.  The others meet in one shuffle, so no task gets a
    4096th of the rows for one key.  ``n`` isn't passed on.
    """
    keys = [key] if isinstance(key, str) else key
    hot = F.col("n") * HOT_KEYS >= F.lit(total)
    more = [c for c in table.columns if c not in (*keys, "n")]
    few = table.where(hot).select(*keys, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in more])
    others = table.where(~hot).select(*keys, F.lit(0).cast("long").alias("_salt"), F.lit(True).alias("_cold"), *[F.col(c).alias(f"_cold_{c}") for c in more])
    both = rows.join(F.broadcast(few), keys, "left")
    both = both.withColumn("_salt", F.when(F.col("_hot"), F.xxhash64(*rows.columns)).otherwise(F.lit(0).cast("long")))
    both = both.join(others.hint("merge"), [*keys, "_salt"], "left").where("_hot OR _cold")
    return both.select(*rows.columns, *[F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c) for c in more])


#: ``maybe_in`` broadcasts 2**CELLS longs of 64 slots each at most.
CELLS = 18


def maybe_in(rows: DataFrame, keys: DataFrame, *key: Column) -> DataFrame:
    """``rows`` with a boolean _maybe: false where the hash ``key`` of the row isn't in the long column ``slot`` of ``keys``.

    True where it is, and for a few others: keys share 2**24 slots, so a million keys make
    true about one in 17 rows without a key.  What is broadcast is bounded, whatever ``keys`` holds; with
    very many of them all rows are true, and a join has to tell them as it would have.
    """
    cell, bit = (lambda h: F.pmod(F.shiftrightunsigned(h, 6), F.lit(1 << CELLS))), (lambda h: F.pmod(h, F.lit(64)).cast("int"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col("slot")))
    taken = keys.groupBy(cell(F.col("slot")).alias("_cell")).agg(F.bit_or(one).alias("_bits"))
    both = rows.withColumn("_slot", F.xxhash64(*key)).withColumn("_cell", cell(F.col("_slot"))).join(F.broadcast(taken), "_cell", "left")
    maybe = F.col("_bits").isNotNull() & (F.getbit("_bits", bit(F.col("_slot"))) == 1)
    return both.select(*[F.col(f"`{c}`") for c in rows.columns], maybe.alias("_maybe"))


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a, b): root is the least node reachable.

    Alternates large-star and small-star joins; each round is cut to a table, and
    the rounds stop once a round changes nothing.  A hub's partners are spread over all
    tasks (``spread_join``), never gathered in one.  Empty links give no rows.
    """
    edges = cut(links.select("a", "b").where("a <> b").distinct())
    total, before = edges.count(), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        # large star: partners above a point to the least node around a
        large = spread_join(both.where("b > a"), least, "a", 2 * total).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: a and its lesser partners point to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        pairs = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = spread_join(large, low, "a", total).select(F.explode(pairs).alias("e")).select("e.*").where("a <> b").distinct()
        after = cut(small)
        drop(edges)
        edges = after
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        total, before = seen[0], seen
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
