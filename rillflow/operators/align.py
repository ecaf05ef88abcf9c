"""Temporal alignment of recordings: windows, ticks, held commands, observations, masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .asof import asof, asof_many, between
from .cuts import cut, drop
from .sequence import islands, numbered, previous

HOUR = 3_600_000_000
ANCHOR = "view"
COMMANDS = ("purchase", "signup")
#: Streams that a recording can't do without, and one that it can.
ESSENTIAL, OPTIONAL = ("view", "click"), ("error",)
#: The parts of a row's validity, in order.
PARTS = ("ok_image", "ok_depth", "ok_state", "ok_effector", "ok_command", "ok_pair", "ok_action")


def window_bounds(msgs: DataFrame, policy: str = "joint-state-fill", anchored: bool = True) -> DataFrame:
    """bag_id, cmd_start, cmd_end, anchor_us, start_us, end_us of recordings with a usable window.

    joint-state-fill unites the spans of the command streams that spoke at all; other
    policies need all of them and cut the spans.  The window starts at the newest anchor
    frame at or before the first command (at the command if there is none, or not
    ``anchored``), and stays inside every observed stream.  An optional stream counts where
    it was recorded.  Recordings without an essential stream, or with an empty window, are left out.
    """
    topic = F.col("topic")
    command, observed = topic.isin(*COMMANDS), topic.isin(*ESSENTIAL, *OPTIONAL)
    ends = msgs.groupBy("bag_id", "topic").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    fill = policy == "joint-state-fill"
    first, last = (F.min, F.max) if fill else (F.max, F.min)
    df = ends.groupBy("bag_id").agg(
        first(F.when(command, F.col("a"))).alias("cmd_start"),
        last(F.when(command, F.col("b"))).alias("cmd_end"),
        F.max(F.when(observed, F.col("a"))).alias("o0"),
        F.min(F.when(observed, F.col("b"))).alias("o1"),
        F.count_if(command).alias("nc"),
        F.count_if(topic.isin(*ESSENTIAL)).alias("no"),
    )
    df = df.where((F.col("nc") >= (1 if fill else len(COMMANDS))) & (F.col("no") == len(ESSENTIAL)) & (F.col("cmd_start") < F.col("cmd_end")))
    df = df.withColumn("t", F.col("cmd_start"))
    if anchored:
        df = asof(df, msgs.where(topic == ANCHOR).select("bag_id", "t", "seq"), ["bag_id"], [], prefix="anchor")
        df = df.withColumn("anchor_us", F.coalesce("anchor.t", "cmd_start"))
    else:
        df = df.withColumn("anchor_us", F.col("cmd_start"))
    start, end = F.greatest("anchor_us", "o0").alias("start_us"), F.least("cmd_end", "o1").alias("end_us")
    return df.select("bag_id", "cmd_start", "cmd_end", "anchor_us", start, end).where("start_us < end_us")


def anchor_ticks(msgs: DataFrame, windows: DataFrame) -> DataFrame:
    """bag_id, k, t, tick: anchor messages in the window, both ends included."""
    df = msgs.where(F.col("topic") == ANCHOR).join(windows.select("bag_id", "start_us", "end_us"), "bag_id").where("t BETWEEN start_us AND end_us")
    return numbered(df, ["bag_id"], "k").select("bag_id", "k", "t", F.col("seq").alias("tick"))


def fixed_grid(windows: DataFrame, period_us: float) -> DataFrame:
    """bag_id, k, t: start + k periods, rounded half even, up to the end."""
    n = F.floor((F.col("end_us") - F.col("start_us")) / period_us)
    df = windows.select("bag_id", "start_us", F.explode(F.sequence(F.lit(0), n.cast("int"))).alias("k"))
    return df.select("bag_id", "k", (F.col("start_us") + F.rint(F.col("k") * F.lit(float(period_us))).cast("long")).alias("t"))


def held_commands(ticks: DataFrame, msgs: DataFrame, topic: str, tolerance: int, policy: str = "joint-state-fill") -> DataFrame:
    """``ticks`` with cmd (t, seq, value), lead_us, real: the next command within tolerance, else the last before, else the first.

    Policy ``fail`` takes only the next command; then cmd is null where it is too far.
    """
    source = msgs.where(F.col("topic") == topic).select("bag_id", "t", "seq", "value")
    df = asof_many(ticks, source, ["bag_id"], ["value"], {"_n": (None, "forward"), "_p": (None, "backward")})
    first = source.groupBy("bag_id").agg(F.min(F.struct("t", "seq", "value")).alias("_f"))
    df = choose(df.join(first, "bag_id", "left"), tolerance, policy)
    return df.select(*ticks.columns, "cmd", (F.col("_n.t") - F.col("t")).alias("lead_us"), "real")


def choose(df: DataFrame, tolerance: int, policy: str, i: str = "") -> DataFrame:
    """cmd and real from the next (_n), previous (_p) and first (_f) command."""
    real = F.coalesce(F.col(f"_n{i}.t") - F.col("t") <= tolerance, F.lit(False))
    held = F.when(real, F.col(f"_n{i}"))
    if policy != "fail":
        held = F.coalesce(held, f"_p{i}", f"_f{i}")
    return df.withColumn(f"real{i}", real).withColumn(f"cmd{i}", held)


def bound(df: DataFrame, name: str, tolerance: int, mode: str):
    """The image of a tick and whether it is near enough: the nearer of the neighbours (capture), or the one before (lerobot-loop)."""
    before, after = F.col(f"_b{name}"), F.col(f"_a{name}")
    gap_before, gap_after = F.col("t") - before["t"], after["t"] - F.col("t")
    image = before
    if mode == "capture":
        image = F.when(after.isNotNull() & (before.isNull() | (gap_after < gap_before)), after).otherwise(before)
    return image["seq"], F.coalesce(F.abs(F.col("t") - image["t"]) <= tolerance, F.lit(False))


def aligned(
    msgs: DataFrame,
    policy: str = "joint-state-fill",
    mode: str = "capture",
    grid_us: float | None = None,
    state_tol: int = 96 * HOUR,
    action_tol: int = 24 * HOUR,
    pair_tol: int = 12 * HOUR,
    effector_tol: int = 48 * HOUR,
    image_tol: int = 120 * HOUR,
    windows: DataFrame | None = None,
) -> DataFrame:
    """Control rows: ticks with state, images, commands of both topics, effector, hold mask and the parts of their validity.

    Ticks are the anchor's frames, or with ``grid_us`` a fixed grid.  The wrist image is
    the click stream's, the depth image the signup stream's.  Mode capture takes the
    nearest image and the interpolated state, lerobot-loop the last ones before the tick.
    A silent command takes the measured state under ``joint-state-fill``; ``hold`` is
    no real command at all (fill) or not both real and close (others).  The effector's
    action is the last one at or before the latest selected command.  Policy ``fail`` makes
    commands that aren't real, and pairs too far apart, invalid.  A stream that never
    spoke makes no command part invalid under ``joint-state-fill``.

    Joins in time read their rows twice, so windows, ticks and rows are written in
    between; what is returned is a written table too.
    """
    windows = cut(windows if windows is not None else window_bounds(msgs, policy))
    if grid_us is None:
        ticks = cut(anchor_ticks(msgs, windows))
    else:
        ticks = cut(fixed_grid(windows, grid_us).withColumn("tick", F.lit(None).cast("long")))
    topic = F.col("topic")
    picks = {"_p": (topic == "click", "backward"), "_n": (topic == "click", "forward"), "ee": (topic == "error", "backward")}
    for name, source in (("wrist", "click"), ("depth", "signup")):
        picks |= {f"_b{name}": (topic == source, "before" if mode == "capture" else "backward"), f"_a{name}": (topic == source, "forward")}
    for i, command in enumerate(COMMANDS):
        picks |= {f"_p{i}": (topic == command, "backward"), f"_n{i}": (topic == command, "forward")}
    df = asof_many(ticks, msgs.where(topic != ANCHOR), ["bag_id"], ["value"], picks)
    if mode == "capture":
        df = between(df, "value", state_tol, "qpos")
    else:
        df = df.withColumn("qpos", F.when(F.col("t") - F.col("_p.t") <= state_tol, F.col("_p.value")))
    first = [F.min(F.when(topic == c, F.struct("t", "seq", "value"))).alias(f"_f{i}") for i, c in enumerate(COMMANDS)]
    df = df.join(msgs.groupBy("bag_id").agg(*first), "bag_id", "left")
    for i in range(len(COMMANDS)):
        df = choose(df, action_tol, policy, str(i))
    fill, strict = policy == "joint-state-fill", policy == "fail"
    actions = [F.when(F.col(f"real{i}"), F.col(f"cmd{i}.value")).otherwise(F.col("qpos") if fill else F.col(f"cmd{i}.value")) for i in range(2)]
    skew = F.greatest("cmd0.t", "cmd1.t") - F.least("cmd0.t", "cmd1.t")
    both, close = F.col("real0") & F.col("real1"), F.coalesce(skew <= pair_tol, F.lit(False))
    hold = ~(F.col("real0") | F.col("real1")) if fill else ~(both & close)
    wrist, ok_image = bound(df, "wrist", image_tol, mode)
    depth, ok_depth = bound(df, "depth", image_tol, mode)
    ok_ee = F.coalesce(F.col("t") - F.col("ee.t") <= effector_tol, F.lit(False))
    rows = cut(df.select(
        "bag_id", "k", "t", "tick", "qpos", actions[0].alias("action0"), actions[1].alias("action1"), F.when(ok_ee, F.col("ee.value")).alias("effector"),
        "real0", "real1", skew.alias("skew_us"), hold.alias("hold"), F.greatest("cmd0.t", "cmd1.t").alias("ref_t"),
        wrist.alias("wrist"), depth.alias("depth"), F.col("cmd0.seq").alias("cmd0"), F.col("cmd1.seq").alias("cmd1"), F.col("ee.seq").alias("ee"),
        ok_image.alias("ok_image"), ok_depth.alias("ok_depth"), F.col("qpos").isNotNull().alias("ok_state"), ok_ee.alias("ok_effector"),
        (both if strict else F.lit(True)).alias("ok_command"), (~both | close if strict else F.lit(True)).alias("ok_pair"),
    ))
    out = cut(effector_actions(rows, msgs, effector_tol))
    drop(windows, ticks, rows)
    return out


def effector_actions(rows: DataFrame, msgs: DataFrame, tolerance: int) -> DataFrame:
    """``rows`` with ee_action, ee_src, ee_age_us and ok_action: the effector's command at the row's reference time."""
    source = msgs.where("topic = 'error'").select("bag_id", "t", "seq", "value")
    at = rows.withColumnRenamed("t", "_t").withColumn("t", F.col("ref_t"))
    df = asof(at, source, ["bag_id"], ["value"], prefix="_src").drop("t").withColumnRenamed("_t", "t")
    age = F.col("ref_t") - F.col("_src.t")
    ok = F.coalesce(age <= tolerance, F.lit(False))
    return df.select(*rows.columns, F.when(ok, F.col("_src.value")).alias("ee_action"), F.col("_src.seq").alias("ee_src"), age.alias("ee_age_us"), ok.alias("ok_action"))


def valid():
    """Whether all parts of a row hold."""
    ok = F.col(PARTS[0])
    for part in PARTS[1:]:
        ok = ok & F.col(part)
    return ok


def hold_runs(rows: DataFrame) -> DataFrame:
    """Runs of held rows among the valid ones."""
    return islands(rows.where(valid()), ["bag_id"], "hold", "k")


def conversion_status(rows: DataFrame, policy: str, invalid: str = "drop", max_hold: float = 0.5, max_run_us: int = 240 * HOUR) -> DataFrame:
    """bag_id, rows, invalid, kept, status, error: which recordings convert, and what keeps the others from it.

    ``invalid`` says what invalid rows do: ``fail`` refuses the recording, ``drop`` leaves
    them out.  The first reason that holds is the error; its recording has no kept rows.
    """
    ok, real = valid(), F.col("real0") | F.col("real1") if policy == "joint-state-fill" else F.col("real0") & F.col("real1")
    same = F.col("action0").eqNullSafe(F.col("qpos")) & F.col("action1").eqNullSafe(F.col("qpos")) & F.col("ee_action").eqNullSafe(F.col("effector"))
    one = rows.groupBy("bag_id").agg(
        F.count("*").alias("rows"), F.count_if(~ok).alias("invalid"), F.count_if(real).alias("real"),
        F.count_if(ok & ~same).alias("own"), F.count_if(ok & F.col("hold")).alias("held"),
    )
    runs = hold_runs(rows).groupBy("bag_id").agg(F.max(F.col("end_us") - F.col("start_us")).alias("longest"))
    df = one.join(runs, "bag_id", "left").withColumn("good", F.col("rows") - F.col("invalid"))
    error = F.when(F.col("rows") < 2, "too_few_frames")
    if policy != "fail":
        error = error.when(F.col("real") == 0, "no_real_command")
    if invalid == "fail":
        error = error.when(F.col("invalid") > 0, "invalid_rows")
    error = error.when(F.col("good") == 0, "no_valid_rows").when(F.col("own") == 0, "action_is_state")
    error = error.when(F.col("held") > max_hold * F.col("good"), "too_much_hold").when(F.coalesce("longest", F.lit(0)) > max_run_us, "hold_too_long")
    status = F.when(error.isNull(), "converted").otherwise("failed")
    kept = F.when(error.isNull(), F.col("good")).otherwise(F.lit(0).cast("long"))
    return df.select("bag_id", "rows", "invalid", kept.alias("kept"), status.alias("status"), error.alias("error"))


def tick_rates(ticks: DataFrame) -> DataFrame:
    """bag_id and ``mid``, the median step of the ticks."""
    steps = previous(ticks.withColumn("seq", F.col("k")), ["bag_id"], ["t"], {"_p": None})
    return steps.groupBy("bag_id").agg(F.median(F.col("t") - F.col("_p.t")).alias("mid")).where("mid IS NOT NULL")
