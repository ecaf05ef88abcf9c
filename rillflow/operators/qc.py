"""Quality control of recordings: timing, drops, latency, synchronisation, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import nearest
from .quantiles import grouped
from .sequence import bursts, previous

#: Verdicts by severity.
SEVERITY = {"PASS": 0, "WARN": 1, "FAIL": 2}


def half_up(c: Column, digits: int) -> Column:
    """Rounded in binary, halves away from zero: x * 10**digits, to the next whole number, and back."""
    scale = float(10**digits)
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale


def r6(c: Column) -> Column:
    return half_up(c, 6)


def worst(status: Column) -> Column:
    """The worst verdict of a group; others than WARN and FAIL don't count."""
    level = F.max(F.when(status == "FAIL", 2).when(status == "WARN", 1).otherwise(0))
    return F.when(level == 2, "FAIL").when(level == 1, "WARN").otherwise("PASS")


#: Streams whose messages have no header: the receive time is their only clock.
HEADERLESS = ("error",)
KEY = ["bag_id", "topic"]


def stamped(msgs: DataFrame) -> DataFrame:
    """``msgs`` with ``ok``, whether the header stamp is valid; null where the stream has none."""
    return msgs.withColumn("ok", F.when(~F.col("topic").isin(*HEADERLESS), F.coalesce(F.col("h") > 0, F.lit(False))))


def stepped(msgs: DataFrame) -> DataFrame:
    """``msgs`` with ok, dt and dh: steps of receive times, and of valid headers in the order of receipt."""
    df = previous(stamped(msgs), KEY, ["t", "h"], {"_p": None, "_h": F.col("ok")})
    return df.withColumn("dt", F.col("t") - F.col("_p.t")).withColumn("dh", F.when(F.col("ok"), F.col("h") - F.col("_h.h"))).drop("_p", "_h")


def timelines(steps: DataFrame) -> DataFrame:
    """One row a stream: counts, spans and steps of its timeline, which is its valid headers if it has any, else its receive times.

    Recorders write in bursts, so headers tell a stream's continuity better.
    """
    header, place = F.count_if("ok") > 0, F.struct("t", "seq")
    own = F.when(F.col("ok"), F.col("h"))

    def pick(of_header: Column, of_receive: Column) -> Column:
        return F.when(header, of_header).otherwise(of_receive)

    spans = F.max_by(own, F.when(F.col("ok"), place)) - F.min_by(own, F.when(F.col("ok"), place)), F.max("t") - F.min("t")
    return steps.groupBy(*KEY).agg(
        F.count("*").alias("n"),
        F.min("t").alias("t0"),
        F.max("t").alias("t1"),
        F.when(header, "header").otherwise("receive").alias("source"),
        pick(F.count_if("ok"), F.count("*")).alias("m"),
        pick(*spans).alias("active"),
        pick(F.median("dh"), F.median("dt")).alias("mid"),
        pick(F.percentile("dh", 0.95), F.percentile("dt", 0.95)).alias("p95"),
        pick(F.max("dh"), F.max("dt")).alias("most"),
        F.max("dt").alias("receive_most"),
        F.count_if(F.col("dt") == 0).alias("duplicate_receive"),
        F.count_if(~F.col("ok")).alias("invalid_headers"),
        F.count_if(F.col("dh") < 0).alias("header_regressions"),
        F.count_if(F.col("dh") == 0).alias("duplicate_headers"),
        F.percentile(F.when(F.col("ok"), F.abs(F.col("t") - F.col("h"))) / 1000, 0.95).alias("l95"),
    )


def timing(msgs: DataFrame) -> DataFrame:
    """Rates, steps, offsets and coverage of each stream; offsets and coverage are of receive times."""
    span = msgs.groupBy("bag_id").agg(F.min("t").alias("b0"), F.max("t").alias("b1"))
    df = timelines(stepped(msgs)).join(span, "bag_id")
    active = F.col("active") / 1e6
    return df.select(
        "bag_id",
        "topic",
        "n",
        "source",
        r6(active).alias("span_s"),
        r6(F.when(F.col("active") > 0, (F.col("m") - 1) / active)).alias("hz"),
        half_up(F.col("mid") / 1e6, 8).alias("median_dt_s"),
        half_up(F.col("p95") / 1e6, 8).alias("p95_dt_s"),
        r6(F.col("most") / 1e6).alias("max_dt_s"),
        r6(F.col("receive_most") / 1e6).alias("receive_max_dt_s"),
        r6((F.col("t0") - F.col("b0")) / 1e6).alias("start_offset_s"),
        r6((F.col("b1") - F.col("t1")) / 1e6).alias("end_offset_s"),
        r6(F.when(F.col("b1") > F.col("b0"), (F.col("t1") - F.col("t0")) / (F.col("b1") - F.col("b0")))).alias("coverage"),
    )


def drops(msgs: DataFrame, topics, gap_factor: float = 1.5) -> DataFrame:
    """Estimated lost messages of continuous streams: steps of the timeline in medians, rounded half even."""
    steps = stepped(msgs.where(F.col("topic").isin(*topics)))
    df = steps.join(timelines(steps).select(*KEY, "m", "mid", "source"), KEY)
    step = F.when(F.col("source") == "header", F.col("dh")).otherwise(F.col("dt"))
    lost = F.when((F.col("mid") > 0) & step.isNotNull(), F.greatest(F.rint(step / F.col("mid")) - 1, F.lit(0.0))).otherwise(0.0)
    gaps = F.count_if((F.col("mid") > 0) & (step > gap_factor * F.col("mid"))).alias("gap_count")
    out = df.groupBy(*KEY, "m").agg(gaps, F.sum(lost).cast("long").alias("est_drops"))
    return out.select(*KEY, "gap_count", "est_drops", r6(F.col("est_drops") / (F.col("m") + F.col("est_drops"))).alias("drop_ratio"))


def quality(msgs: DataFrame) -> DataFrame:
    """Duplicate, regressing and invalid stamps; header steps are over valid headers only."""
    return timelines(stepped(msgs)).select(*KEY, "duplicate_receive", "invalid_headers", "header_regressions", "duplicate_headers")


def latency(msgs: DataFrame, by: list[str], warn_ms: float, fail_ms: float) -> DataFrame:
    """Time from valid header to receipt."""
    ms = (F.col("t") - F.col("h")) / 1000
    late = F.abs(ms)
    df = grouped(stamped(msgs).where("ok"), by, [F.count("*").alias("n"), r6(F.max(late)).alias("abs_max")], {"p50": (ms, 0.5), "abs_p95": (late, 0.95)})
    df = df.select(*by, "n", r6(F.col("p50")).alias("p50"), r6(F.col("abs_p95")).alias("abs_p95"), "abs_max")
    return df.withColumn("status", F.when(F.col("abs_p95") >= fail_ms, "FAIL").when(F.col("abs_p95") >= warn_ms, "WARN").otherwise("PASS"))


def stream_status(msgs: DataFrame, claims: DataFrame, continuous, warn_drop: float, fail_drop: float, warn_ms: float = 100, fail_ms: float = 500) -> DataFrame:
    """bag_id, topic, status of each claimed stream (bag_id, topic, required).

    Missing is FAIL, or SKIP if optional.  Lost messages of an optional stream are a
    warning at most.  Invalid or falling headers fail; repeated stamps warn.
    """
    df = claims.join(timelines(stepped(msgs)), KEY, "left").join(drops(msgs, continuous), KEY, "left")
    ratio, late = F.col("drop_ratio"), F.col("l95")
    bad = ((ratio >= fail_drop) & F.col("required")) | (F.col("invalid_headers") > 0) | (F.col("header_regressions") > 0) | (late >= fail_ms)
    odd = (ratio >= warn_drop) | (F.col("duplicate_receive") > 0) | (F.col("duplicate_headers") > 0) | (late >= warn_ms)
    status = F.when(F.col("n").isNull(), F.when(F.col("required"), "FAIL").otherwise("SKIP")).when(bad, "FAIL").when(odd, "WARN").otherwise("PASS")
    return df.select(*KEY, status.alias("status"))


def offsets(msgs: DataFrame, anchor: str, target: str) -> DataFrame:
    """bag_id, target, tick, offset_us: distance of each anchor message's header stamp to the nearest one of the target."""
    rows = stamped(msgs).where("ok").select("bag_id", "topic", "seq", F.col("h").alias("t"))
    ticks = rows.where(F.col("topic") == anchor).select("bag_id", F.col("seq").alias("tick"), "t")
    df = nearest(ticks, rows.where(F.col("topic") == target).select("bag_id", "t", "seq"), ["bag_id"], [])
    return df.select("bag_id", F.lit(target).alias("target"), "tick", F.abs(F.col("src.t") - F.col("t")).alias("offset_us"))


def sync_report(msgs: DataFrame, anchor: str, targets, warn_ms: float) -> DataFrame:
    """One row for each recording and target; SKIP where either stream has no valid stamps."""
    offs = offsets(msgs, anchor, targets[0])
    for target in targets[1:]:
        offs = offs.unionByName(offsets(msgs, anchor, target))
    ms = F.col("offset_us") / 1000
    offs = grouped(offs, ["bag_id", "target"], [F.max(ms).alias("x")], {"m": (ms, 0.5), "p": (ms, 0.95)})
    pairs = msgs.select("bag_id").distinct().select("bag_id", F.explode(F.array(*map(F.lit, targets))).alias("target"))
    df = pairs.join(offs, ["bag_id", "target"], "left")
    status = F.when(F.col("p").isNull(), "SKIP").when(F.col("p") > warn_ms, "WARN").otherwise("PASS")
    return df.select("bag_id", "target", r6(F.col("m")).alias("median_ms"), r6(F.col("p")).alias("p95_ms"), r6(F.col("x")).alias("max_ms"), status.alias("status"))


def teleop_report(msgs: DataFrame, commands, gap_us: int, policy: str) -> DataFrame:
    """bag_id, overlap_us, max_gap_us, bursts, status, issue of the command streams.

    They have to be there (two messages at least) and to overlap.  A hole as wide as
    the overlap leaves no tick where both are real: a failure, or a warning if the
    policy fills from the measured state.  A hole over ``gap_us`` is a warning.
    """
    own = msgs.where(F.col("topic").isin(*commands))
    steps = previous(own, KEY, ["t"], {"_p": None}).withColumn("dt", F.col("t") - F.col("_p.t"))
    one = steps.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("b"), F.max("dt").alias("gap"), (F.count_if(F.col("dt") > gap_us) + 1).alias("bursts"))
    live = F.col("n") >= 2
    df = one.groupBy("bag_id").agg(
        F.count_if(live).alias("live"), F.max(F.when(live, F.col("a"))).alias("a"), F.min(F.when(live, F.col("b"))).alias("b"),
        F.max(F.when(live, F.col("gap"))).alias("gap"), F.sum(F.when(live, F.col("bursts")).otherwise(0)).alias("bursts"),
    )
    df = msgs.select("bag_id").distinct().join(df, "bag_id", "left")
    overlap = F.when(F.col("live") == len(commands), F.col("b") - F.col("a"))
    issue = F.when(overlap.isNull(), "command_stream_missing").when(overlap <= 0, "spans_do_not_overlap").when(F.col("gap") >= overlap, "silent_across_overlap").when(F.col("gap") > gap_us, "command_gap")
    fill = policy == "joint-state-fill"
    status = F.when(issue.isNull(), "PASS").when(issue == "command_gap", "WARN").when((issue == "silent_across_overlap") & F.lit(fill), "WARN").otherwise("FAIL")
    zero = F.lit(0).cast("long")
    return df.select("bag_id", overlap.alias("overlap_us"), F.col("gap").alias("max_gap_us"), F.coalesce("bursts", zero).alias("bursts"), status.alias("status"), issue.alias("issue"))


def command_bursts(msgs: DataFrame, gap_us: int) -> DataFrame:
    """Bursts of streams with two messages at least."""
    some = msgs.groupBy(*KEY).agg(F.count("*").alias("_c")).where("_c > 1").select(*KEY)
    return bursts(msgs.join(some, KEY, "left_semi"), KEY, gap_us)
