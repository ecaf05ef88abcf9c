"""Line operators in DataFrame functions only: cross-site line dedup and quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import HOT_KEYS, SPACES, cut, drop, spread_join, text_words, without, word_count

#: A line with a word in it.
WORDED = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _normal(line: Column) -> Column:
    """Lower case, single spaces, no spaces at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), SPACES, " "))


def _row_key() -> Column:
    return F.xxhash64("text", F.col("source").cast("string"))


def seen_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, tkey, site, at, line, w: every line of ``min_words`` words or more, as its place and the hash of its normal form.

    Written once, about a twentieth of the texts, so that the texts are split and
    normalised in one pass.
    """
    doc = F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("tkey"), F.col("source").cast("string").alias("site")
    # normalised before the explode: a filter on the exploded line would compute it again
    each = docs.select(*doc, F.posexplode(F.transform(_lines(F.col("text")), _normal)).alias("at", "x"))
    words = F.length("x") - F.length(without(F.col("x"), " ")) + 1
    return cut(each.where((words >= min_words) & (F.col("x") != "")).select("doc_id", "tkey", "site", "at", F.xxhash64("x").alias("line"), words.alias("w")))


def _first() -> Column:
    """The row with the least id; null ids last, equal ones by text and source."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey"))


def _not_first() -> Column:
    return ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tkey") == F.col("first.tkey")))


def boilerplate(docs: DataFrame, min_sites: int = 10, min_words: int = 3, rsd: float = 0.13, slack: int = 4) -> DataFrame:
    """doc_id, tkey, at, line: the places of lines that are on ``min_sites`` sites or more, but for those in a line's first row.

    Each line hash aggregates a HyperLogLog sketch of its sites (rsd 0.13: 64 registers,
    56 bytes), merged by Spark's partial aggregation.  Lines with an estimate under
    min_sites / slack are out, those over slack * min_sites in, and those between are
    counted exactly.  An estimate of 10 sites is off by a factor of 4 with probability
    2e-12, one of many sites (5.8 deviations) with 1e-8.
    """
    seen = seen_lines(docs, min_words)
    total = seen.count()
    about = seen.groupBy("line").agg(F.approx_count_distinct("site", rsd).alias("about"), F.count("*").alias("n"))
    # hot lines stay in the table, so that their rows aren't shuffled by line
    about = cut(about.where((F.col("about") * slack >= min_sites) | (F.col("n") * HOT_KEYS >= total)))
    rows = cut(spread_join(seen, about, "line", total).where(F.col("about") * slack >= min_sites))
    near = F.when(F.col("about") <= slack * min_sites, F.col("site"))
    once = rows.groupBy("line", "about", near.alias("site")).agg(_first().alias("first"), F.count("*").alias("n"))
    found = once.groupBy("line", "about").agg(F.count("site").alias("sites"), F.min("first").alias("first"), F.sum("n").alias("n"))
    found = cut(found.where((F.col("about") > slack * min_sites) | (F.col("sites") >= min_sites)).select("line", "first", "n"))
    gone = cut(spread_join(rows, found, "line", rows.count()).where(_not_first()).select("doc_id", "tkey", "at", "line"))
    drop(seen, about, rows, found)
    return gone


def line_dedup(docs: DataFrame, min_sites: int = 10, min_words: int = 3) -> DataFrame:
    """The rows of ``docs`` with boilerplate lines removed from ``text``, and _lines, _removed (long).

    Lines are the pieces between newlines, compared in lower case with single spaces; a
    site is the value of ``source`` (null is no site).  A line of ``min_words`` words
    or more that is on ``min_sites`` sites or more stays in the row with the least id
    that has it (null ids last; there, at every place) and goes everywhere else.  Rows
    that share id, text and source are one row repeated and keep the same lines; of
    other rows with one id the first is told by a hash of text and source.  Null
    text stays null.  All columns of ``docs`` stay as they are, but for ones named _lines or
    _removed, which give way.
    """
    out = deduped_rows(docs, min_sites, min_words)
    columns = [F.col("text").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns if c not in ("_lines", "_removed")]
    return out.select(*columns, "_lines", "_removed")


def deduped_rows(docs: DataFrame, min_sites: int = 10, min_words: int = 3) -> DataFrame:
    """``line_dedup`` with each row of ``docs`` as a struct ``row``, so that no names clash: row, text, _lines, _removed."""
    gone = boilerplate(docs, min_sites, min_words).groupBy(F.col("doc_id").alias("_id"), F.col("tkey").alias("_t")).agg(F.collect_set("at").alias("_gone"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col("doc_id").cast("long").alias("_i"), _row_key().alias("_k"))
    rows = rows.join(gone, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_t")), "left")
    lines, null = _lines(F.col("row.text")), F.col("row.text").isNull()
    rows = rows.select("row", "_gone", lines.alias("_all"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), "_gone")
    rows = rows.select("row", F.size("_all").alias("_lines"), F.when(F.col("_gone").isNotNull(), F.size("_gone")).otherwise(0).alias("_removed"), "_all", "_gone", left.alias("_left"))
    kept = F.concat_ws("\n", F.transform("_left", lambda i: F.get("_all", i)))
    text = F.when(~null, F.when(F.col("_gone").isNull(), F.col("row.text")).otherwise(kept))
    counts = [F.when(null, F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in ("_lines", "_removed")]
    return rows.select("row", text.alias("text"), *counts)


def base_rules(text: Column) -> dict[str, Column]:
    """The counts of one text that need no windows; null text has none of anything."""
    text = F.coalesce(text, F.lit(""))
    worded = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORDED))
    return {
        "n_words": word_count(text).cast("long"),
        "word_chars": F.length(without(text, " \t\n\x0b\x0c\r")).cast("long"),
        "n_symbols": (F.length(text) - F.length(without(text, "#*$%&|<>"))).cast("long"),
        "n_dup_lines": (F.size(worded) - F.size(F.array_distinct(worded))).cast("long"),
    }


def with_repeat_words(rows: DataFrame) -> DataFrame:
    """``rows`` with n_repeat_words: words in 3-word windows that the array ``_w`` has twice or more.

    Most texts repeat no window and end at a hash set.  For the others (hash, place)
    pairs are sorted, and the places of equal neighbours give the words they cover: no
    step is quadratic in the text.
    """
    grams = "CASE WHEN size(_w) > 2 THEN transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])) ELSE CAST(array() AS array<bigint>) END"
    pairs = "CASE WHEN size(array_distinct(_g)) < size(_g) THEN sort_array(transform(_g, (h, i) -> named_struct('h', h, 'i', i))) END"
    twice = "filter(_p, (p, i) -> coalesce(get(_p, i - 1).h = p.h, false) OR coalesce(get(_p, i + 1).h = p.h, false))"
    covered = f"size(array_distinct(flatten(transform({twice}, p -> array(p.i, p.i + 1, p.i + 2)))))"
    rows = rows.withColumn("_g", F.expr(grams)).withColumn("_p", F.expr(pairs))
    return rows.withColumn("n_repeat_words", F.expr(f"CASE WHEN _p IS NULL THEN 0 ELSE {covered} END").cast("long")).drop("_g", "_p")


def depleting_lines(docs: DataFrame, min_docs: int, max_share: float, max_docs: int, min_words: int) -> DataFrame:
    """_id, _t, _removed: the words that a document loses to lines above its host's limits."""
    host = F.coalesce(F.concat(F.lit("="), F.col("site")), F.lit("null"))
    seen = seen_lines(docs, min_words)
    lines = seen.select("doc_id", "tkey", "at", "w", host.alias("host"), F.xxhash64(host, "line").alias("line"))
    total = seen.count()
    # a line in so many documents has as many rows at least; only such lines are counted by document
    often = cut(lines.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs))
    rows = cut(spread_join(lines, often, "line", total))
    once = rows.groupBy("host", "line", "doc_id", "tkey").agg(F.count("*").alias("n"))
    each = once.groupBy("host", "line").agg(F.count("*").alias("docs"), _first().alias("first"), F.sum("n").alias("n"))
    site = F.col("source").cast("string").alias("site")
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("tkey"), site).distinct().groupBy(host.alias("host")).agg(F.count("*").alias("all"))
    above = (F.col("docs") >= min_docs) & ((F.col("docs") > max_share * F.col("all")) | (F.col("docs") >= max_docs))
    above = cut(each.join(sizes, "host").select("line", "n", F.when(above, F.col("first")).alias("first")))
    hits = spread_join(rows, above, "line", rows.count()).where(F.col("first").isNotNull() & _not_first())
    hits = hits.groupBy(F.col("doc_id").alias("_id"), F.col("tkey").alias("_t"), "at").agg(F.max("w").alias("w"))
    lost = cut(hits.groupBy("_id", "_t").agg(F.sum("w").alias("_removed")))
    drop(seen, often, rows, above)
    return lost


def quality_rules(docs: DataFrame, min_docs: int = 10, max_share: float = 0.05, max_docs: int = 1000, min_line_words: int = 3, min_left: float = 0.5) -> DataFrame:
    """doc_id, counts, base_failed, kept and tkey (hash of text and source), one row for each row of ``docs``.

    ``kept`` is false if the base rules fail, or if the document is depleted: lines
    (lower case, single spaces, ``min_line_words`` words or more) that are above their
    host's limits are removed from all documents of the host but the first (least id),
    and what is left is under ``min_left`` of the document's words.  Above the limits is a
    line in ``min_docs`` documents or more that are more than ``max_share`` of the host's, or
    in ``max_docs`` documents at least, however large the host.  The host is ``source``; null is
    a host.  Null text has no words and fails.  Rows that share id, text and source
    are one document repeated, count once and get the same verdict.
    """
    counts = base_rules(F.col("text"))
    words = counts.pop("n_words")
    row = F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("tkey")
    base = docs.select(*row, words.alias("n_words"), *[c.alias(k) for k, c in counts.items()], text_words(F.col("text")).alias("_w"))
    base = with_repeat_words(base).drop("_w")
    base = base.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    gone = depleting_lines(docs, min_docs, max_share, max_docs, min_line_words)
    out = base.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tkey") == F.col("_t")), "left")
    left = F.col("n_words") - F.coalesce("_removed", F.lit(0))
    kept = ~F.col("base_failed") & (left >= min_left * F.col("n_words"))
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return out.select(*shown, kept.alias("kept"), "tkey")
