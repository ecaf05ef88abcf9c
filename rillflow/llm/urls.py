"""URL filters: host and path rules, then boosted trees on lexical features, in DataFrame functions only."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import cut, least_hashes

#: (verdict, host, path): a rule fits its host and all subdomains if the path starts with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Host words that label a URL as unwanted, for training.
UNWANTED = ("casino", "pills", "bets", "adult", "spam", "ads")
#: Suffixes up to which all statistics are broadcast.
BROADCAST_SUFFIXES = 100_000
#: Beyond that, suffixes with this share of the URLs or more are broadcast (1000 at most), and the others are shuffled.
HOT_SHARE = 0.001
#: Labelled URLs that the trees are fitted on, at most.
TRAINING_URLS = 20_000
FEATURES = ["f_length", "f_host", "f_depth", "f_digits", "f_entropy", "f_params", "f_hyphens", "f_labels", "f_suffix_share", "f_suffix_rate"]


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text and verdict; null if none does.  For rule lists that fit in one expression."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _shares(text: str) -> str:
    """Entropy of a column's characters, in bits."""
    p = f"(length({text}) - length(replace({text}, c, ''))) / length({text})"
    return f"CASE WHEN length({text}) > 0 THEN aggregate(array_distinct(split({text}, '')), 0D, (s, c) -> s + CASE WHEN c = '' THEN 0D ELSE -({p}) * log2({p}) END) ELSE 0D END"


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (with url, host, path) and the features that need no other rows."""
    url = F.coalesce("url", F.lit(""))
    return (
        pages.withColumn("f_length", F.length(url).cast("double"))
        .withColumn("f_host", F.length("host").cast("double"))
        .withColumn("f_depth", F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"))
        .withColumn("f_digits", (F.length(url) - F.length(F.translate(url, "0123456789", ""))) / F.greatest(F.length(url), F.lit(1)))
        .withColumn("f_entropy", F.expr(_shares("host")))
        .withColumn("f_params", F.when(url.contains("?"), F.size(F.split(F.substring_index(F.substring_index(url, "?", -1), "#", 1), "&"))).otherwise(0).cast("double"))
        .withColumn("f_hyphens", (F.length("host") - F.length(F.translate("host", "-", ""))).cast("double"))
        .withColumn("f_labels", F.size(F.split("host", r"\.")).cast("double"))
        .withColumn("suffix", F.substring_index("host", ".", -2))
    )


def labelled(rows: DataFrame, unwanted=UNWANTED) -> DataFrame:
    """The URLs with a host and their ``label``: 1 if a host word is unwanted."""
    words = F.split("host", "[.-]")
    bad = F.lit(False)
    for w in unwanted:
        bad = bad | F.array_contains(words, w)
    return rows.where(F.col("host") != "").withColumn("label", bad.cast("double"))


def suffix_counts(rows: DataFrame) -> DataFrame:
    """suffix, n, bad, n0, bad0: URLs and unwanted URLs of each suffix, of all labelled ``rows``, and of those in fold 0."""
    none = F.col("fold") == 0
    return cut(rows.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("label").alias("bad"), F.count_if(none).alias("n0"), F.sum(F.when(none, F.col("label")).otherwise(0.0)).alias("bad0")))


def with_suffixes(rows: DataFrame, counts: DataFrame, most: int = BROADCAST_SUFFIXES) -> DataFrame:
    """``rows`` with f_suffix_share and f_suffix_rate: the suffix's share of all URLs, and its smoothed rate of unwanted ones.

    The rate is that of the other fold's URLs, so no row's own label is in it.  More than
    ``most`` suffixes are joined by a shuffle.  Hot ones are then broadcast, and
    their rows are spread over keys that no suffix has.
    """
    total, bad, k = counts.agg(F.sum("n"), F.sum("bad"), F.count("*")).first()
    total, base = total or 0, (bad / total if total else 0.0)
    rate = lambda n, bad: (bad + F.lit(10 * base)) / (n + 10)
    rates = rate(F.col("n") - F.col("n0"), F.col("bad") - F.col("bad0")).alias("_rate0"), rate(F.col("n0"), F.col("bad0")).alias("_rate1")
    stats = counts.select("suffix", (F.col("n") / F.lit(max(total, 1))).alias("f_suffix_share"), *rates)
    if k <= most:
        rows = rows.join(F.broadcast(stats), "suffix", "left")
    else:
        hot, own = F.col("f_suffix_share") >= HOT_SHARE, ("f_suffix_share", "_rate0", "_rate1")
        few = stats.where(hot).select("suffix", *[F.col(c).alias(f"_hot{c}") for c in own])
        rows = rows.join(F.broadcast(few), "suffix", "left")
        spread = F.concat(F.lit("/"), F.xxhash64("url", "page_id").cast("string"))
        key = F.when(F.col("_hotf_suffix_share").isNotNull() | (F.col("suffix") == ""), spread).otherwise(F.col("suffix"))
        others = stats.where(~hot).withColumnRenamed("suffix", "_key")
        rows = rows.withColumn("_key", key).join(others.hint("merge"), "_key", "left")
        rows = rows.withColumns({c: F.coalesce(f"_hot{c}", c) for c in own}).drop("_key", *[f"_hot{c}" for c in own])
    rows = rows.withColumn("f_suffix_rate", F.when(F.col("fold") == 0, F.col("_rate0")).otherwise(F.col("_rate1"))).drop("_rate0", "_rate1")
    return rows.fillna({"f_suffix_share": 0.0, "f_suffix_rate": base})


class UrlModel:
    """Boosted trees fitted on a part of the labelled URLs, and all rows with their features.

    At most ``training_urls`` labelled URLs, those with the least hashes, are taken; a
    fifth of them, ``held``, isn't fitted on.  The suffix statistics are those of all URLs.
    """

    def __init__(self, pages: DataFrame, unwanted=UNWANTED, training_urls: int = TRAINING_URLS, trees: int = 10):
        rows = pages.select(F.col("page_id").alias("page_id"), F.col("url").cast("string").alias("url"))
        rows = lexical(rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))))
        self.rows = rows.withColumn("fold", F.pmod(F.xxhash64(F.lit(1), "url"), F.lit(2)).cast("int"))
        known = labelled(self.rows, unwanted)
        self.counts = suffix_counts(known)
        total = self.counts.agg(F.sum("n")).first()[0] or 0
        sample = cut(least_hashes(known, total, training_urls, "url", "page_id"))
        self.base = sample.agg(F.avg("label")).first()[0] or 0.0
        self.vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
        self.model, held = None, F.pmod(F.xxhash64(F.lit(2), "url"), F.lit(5)) == 0
        self.held = sample.where(held)
        if 0 < self.base < 1:
            some = sample.where(~held)
            some = some if some.agg(F.count_distinct("label")).first()[0] == 2 else sample
            boosted = GBTClassifier(maxIter=trees, maxDepth=3, stepSize=0.3, seed=7, cacheNodeIds=False)
            self.model = boosted.fit(self.vector.transform(with_suffixes(some, self.counts)).select("features", "label"))

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``score``; without a model, the one label there is."""
        if self.model is None:
            return rows.withColumn("score", F.lit(float(self.base)))
        return self.model.transform(self.vector.transform(with_suffixes(rows, self.counts))).withColumn("score", vector_to_array("probability")[1])

    def held_out(self) -> DataFrame:
        """label, n, blocked: how many of the held URLs of each label the trees block."""
        blocked = F.count_if(F.col("score") >= 0.5).alias("blocked")
        return self.scored(self.held).groupBy("label").agg(F.count("*").alias("n"), blocked)


def judge_urls(pages: DataFrame, rules=RULES, unwanted=UNWANTED, training_urls: int = TRAINING_URLS, trees: int = 10) -> DataFrame:
    """page_id, host, path, rule, verdict, score, one row for each row of ``pages``.

    A URL that no rule fits gets the trees' verdict: block from a score of 0.5 on.
    Null, or no ``://``: host and path are empty and only the trees judge.  If the
    labelled URLs are all of one kind (or none), that kind is every URL's score.  Of
    rules of one length that fit, the later one counts.  Repeated rows are judged alike;
    all other columns of ``pages`` are left out, whatever their names.
    """
    model = UrlModel(pages, unwanted, training_urls, trees)
    scored = model.scored(model.rows)
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, own).alias("verdict"), F.round("score", 6).alias("score"))
