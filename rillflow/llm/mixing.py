"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .tables import cut, drop, without, word_count


#: Shares are tokens to this power.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.7}


def topic_of(text: Column) -> Column:
    """A topic for corpora without one, by form: empty, table, noise, short, long or prose."""
    n, text = word_count(text), F.coalesce(text, F.lit(""))

    def share(marks: str) -> Column:
        return F.length(text) - F.length(without(text, marks))

    topic = F.when(n == 0, "empty").when(share("|") * 10 >= n, "table").when(share("#*$%&<>") * 10 >= n, "noise")
    return topic.when(n < 100, "short").when(n >= 1000, "long").otherwise("prose")


def _name(c: Column) -> Column:
    """A dimension's value as a key without nulls."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))


#: A round whose scales come no nearer to 1 than this part of the round before has stalled; so many in a row tell targets that can't be met together.
STALLED, PATIENCE = 0.97, 2
#: The largest change of a weight that ends balancing, and the power of all scales together: 1 can't diverge, 2 could.
SETTLED, RELAXED = 1e-4, 1.5


def _scales(cells: DataFrame, d: str, target: DataFrame, total: float) -> DataFrame:
    """d, _s_d: the scale that gives each value of ``d`` its share."""
    sums = cells.groupBy(d).agg(F.sum("w").alias("_have")).join(target, d)
    scale = F.when(F.col("_have") > 0, F.col("share") * total / F.col("_have")).otherwise(F.lit(1.0))
    return sums.select(d, scale.alias(f"_s_{d}"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-9, rounds: int = 100) -> DataFrame:
    """``cells`` (dimensions, tokens) with ``w``: tokens scaled until each marginal has its target share.

    ``targets[d]`` has (d, share); shares sum to 1 over the values present.  A round
    scales to each dimension in turn; each scaling is one aggregation joined back, and one job.  The cells are as many as combinations of values; they stay
    distributed.

    Targets may exclude each other: where each source has one language, the sources' shares
    tell the languages'.  Then the scales stop coming nearer to 1, or ``rounds`` end first, and balancing follows:
    all dimensions are scaled at once, each by a root of its scale, which lowers the
    sum of the marginals' divergences from their targets down to the least that
    there is.  ``marginals`` tells what is left of it.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    cells, far, slow = cells.withColumn("w", F.col("tokens").cast("double")), [], 0
    if not total:
        return cells
    scales = [f"_s_{d}" for d in targets]
    while len(far) < rounds and slow < PATIENCE:
        off = []
        for d, target in targets.items():
            seen, scale = Observation(), F.col(f"_s_{d}")
            before, cells = cells, cells.join(_scales(cells, d, target, total), d)
            cells = cut(cells.withColumn("w", F.col("w") * scale).observe(seen, F.max(F.abs(scale - 1)).alias("far")).drop(f"_s_{d}"))
            drop(before)
            off.append(seen.get["far"] or 0.0)
        far.append(max(off))
        if far[-1] < tolerance:
            return cells
        slow = slow + 1 if len(far) > 1 and far[-1] > STALLED * far[-2] else 0
    for _ in range(rounds):
        before, step = cells, F.lit(1.0)
        for d, target in targets.items():
            cells, step = cells.join(_scales(before, d, target, total), d), step * F.col(f"_s_{d}")
        seen, step = Observation(), F.pow(step, RELAXED / len(targets))
        cells = cut(cells.withColumn("w", F.col("w") * step).observe(seen, F.max(F.abs(step - 1)).alias("step")).drop(*scales))
        drop(before)
        if (seen.get["step"] or 0.0) < SETTLED:
            break
    return cells


def marginals(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """dimension, value, target, share, residual (share - target) of each marginal of raked ``cells``."""
    total = cells.agg(F.sum("w").alias("_all"))
    parts = [cells.groupBy(F.col(d).alias("value")).agg(F.sum("w").alias("_w")).join(t.select(F.col(d).alias("value"), F.col("share").alias("target")), "value").select(F.lit(d).alias("dimension"), "*") for d, t in targets.items()]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    share = F.col("_w") / F.col("_all")
    return both.join(F.broadcast(total)).select("dimension", "value", "target", share.alias("share"), (share - F.col("target")).alias("residual"))


def tempered(cells: DataFrame, d: str, power: float) -> DataFrame:
    """Target shares of a dimension's values: their tokens to a power, normalised."""
    sums = cells.groupBy(d).agg(F.pow(F.sum("tokens").cast("double"), power).alias("_p")).where("_p > 0")
    total = sums.agg(F.sum("_p")).first()[0] or 1.0
    return cut(sums.select(d, (F.col("_p") / F.lit(total)).alias("share")))


def mix(docs: DataFrame, powers: dict[str, float] | None = None, keep: float = 0.5, seed: int = 17, topic: Column | None = None) -> DataFrame:
    """The rows of ``docs`` with _topic, _tokens, _weight, _chance, _kept and _copies.

    Tokens are words.  Marginals of source, lang and topic are raked to shares
    proportional to tokens ** power; _weight is a cell's raked tokens over its tokens,
    and a document is kept with probability _chance = min(1, keep * weight), decided by a
    hash of its id, text and ``seed``, so the same rows are kept at any partitioning and
    rows that repeat are decided alike.  Where keep * weight is over 1 a document is due
    more than once: _copies is floor(keep * weight), and one more with the rest as
    probability.  So _copies has the mean keep * weight, and the tokens of the copies
    meet the targets however skewed the cells are; _kept is _copies > 0.  Null values are values of their own.  Documents
    without words have weight 0 and are not kept.  Columns of ``docs`` with the names of
    the new ones give way.

    Where the targets can't all be met (a source of one language each), weights are the ones
    whose marginals are nearest to them (``rake``); ``mixed_marginals`` shows what is left.
    """
    new = ["_topic", "_tokens", "_weight", "_chance", "_kept", "_copies"]
    out = mixed_rows(docs, powers, keep, seed, topic)
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in new], *new)


def mixed_rows(docs: DataFrame, powers: dict[str, float] | None = None, keep: float = 0.5, seed: int = 17, topic: Column | None = None) -> DataFrame:
    """``mix`` with each row of ``docs`` as a struct ``row``, so that no names clash."""
    powers = powers or POWERS
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")

    def dims(df: DataFrame, *more: Column) -> DataFrame:
        return _dims(df, topic, *more)

    keys = ["_source", "_lang", "_topic"]
    raked, _ = _raked(dims(docs), powers)
    chances = raked.select(*keys, (F.col("w") / F.col("tokens")).alias("_weight"))
    out = dims(docs, row).join(chances, keys, "left").withColumn("_weight", F.coalesce("_weight", F.lit(0.0)))
    out = out.withColumn("_weight", F.when(F.col("_tokens") > 0, F.col("_weight")).otherwise(F.lit(0.0)))
    due = F.lit(float(keep)) * F.col("_weight")
    out = out.withColumn("_chance", F.least(F.lit(1.0), due))
    more = draw(F.col("row.doc_id"), F.col("row.text"), seed) < due - F.floor(due)
    out = out.withColumn("_copies", F.floor(due).cast("long") + more.cast("long"))
    return out.withColumn("_kept", F.col("_copies") > 0).drop("_source", "_lang")


def _dims(docs: DataFrame, topic: Column | None, *more: Column) -> DataFrame:
    form, tokens = topic if topic is not None else topic_of(F.col("text")), word_count(F.col("text")).cast("long")
    return docs.select(*more, _name(F.col("source")).alias("_source"), _name(F.col("lang")).alias("_lang"), form.alias("_topic"), tokens.alias("_tokens"))


def _raked(rows: DataFrame, powers: dict[str, float]) -> tuple[DataFrame, dict[str, DataFrame]]:
    # filtered after the sum: before it the words would be split twice
    cells = cut(rows.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("tokens")).where("tokens > 0"))
    targets = {f"_{d}": tempered(cells, f"_{d}", p) for d, p in powers.items()}
    return rake(cells, targets), targets


def mixed_marginals(docs: DataFrame, powers: dict[str, float] | None = None, topic: Column | None = None) -> DataFrame:
    """``marginals`` of the weights that ``mix`` gives; values as text after ``=``, or null."""
    return marginals(*_raked(_dims(docs, topic), powers or POWERS))


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from md5 of id, text and seed."""
    key = F.concat_ws("/", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
