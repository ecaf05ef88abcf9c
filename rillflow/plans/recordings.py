"""Alignment and quality control of recordings, over ``events``: a user is a recording, an event type a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.frames import colour_image
from ..operators import align as al
from ..operators import qc
from ..operators.asof import asof, interpolated, nearest
from ..operators.quantiles import grouped
from ..operators.sequence import numbered, previous, segments
from ..sources.streams import CONTINUOUS, ROLES, literal, messages
from .registry import query, values

H = al.HOUR
HOLD, FILL_POLICY = "hold-last-command", "joint-state-fill"
M = """m AS (SELECT user_id AS bag_id, event_type AS topic, event_id AS seq, epoch_us(ts) AS t,
  CASE WHEN event_id % 1009 = 0 THEN 0 ELSE epoch_us(ts) - CAST(trunc(value * 1000) AS BIGINT) END AS h,
  value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""


def win_sql(policy: str) -> str:
    """CTE w: the window of each recording."""
    fill = policy == FILL_POLICY
    a, b = ("min", "max") if fill else ("max", "min")
    command, observed = "topic IN ('purchase', 'signup')", "topic IN ('view', 'click', 'error')"
    return f"""ends AS (SELECT bag_id, topic, min(t) AS a, max(t) AS b FROM m GROUP BY ALL),
spans AS (SELECT bag_id, {a}(a) FILTER (WHERE {command}) AS cmd_start, {b}(b) FILTER (WHERE {command}) AS cmd_end,
  max(a) FILTER (WHERE {observed}) AS o0, min(b) FILTER (WHERE {observed}) AS o1
  FROM ends GROUP BY bag_id
  HAVING count(*) FILTER (WHERE {command}) >= {1 if fill else 2} AND count(*) FILTER (WHERE topic IN ('view', 'click')) = 2),
anchors AS (SELECT s.*, coalesce((SELECT max(t) FROM m WHERE m.bag_id = s.bag_id AND topic = 'view' AND t <= cmd_start), cmd_start) AS anchor_us
  FROM spans s WHERE cmd_start < cmd_end),
w AS (SELECT bag_id, cmd_start, cmd_end, anchor_us, greatest(anchor_us, o0) AS start_us, least(cmd_end, o1) AS end_us
  FROM anchors WHERE greatest(anchor_us, o0) < least(cmd_end, o1))"""


TICKS = """tk AS (SELECT m.bag_id, row_number() OVER (PARTITION BY m.bag_id ORDER BY t, seq) - 1 AS k, t, seq AS tick
  FROM m JOIN w USING (bag_id) WHERE topic = 'view' AND t BETWEEN start_us AND end_us)"""
GRID = f"""tk AS (SELECT bag_id, k, start_us + CAST(round_even(k * {24 * H}.0, 0) AS BIGINT) AS t, CAST(NULL AS BIGINT) AS tick
  FROM (SELECT bag_id, start_us, unnest(range(0, CAST(floor((end_us - start_us) / {24 * H}) AS BIGINT) + 1)) AS k FROM w))"""
VIEWS = "v AS (SELECT bag_id, seq AS tick, t FROM m WHERE topic = 'view')"


def cmd_sql(name: str, topic: str, tol: int, policy: str = FILL_POLICY) -> str:
    """CTE ``name``: the command of each tick."""

    def held(c: str) -> str:
        other = "NULL" if policy == "fail" else f"CASE WHEN pt IS NOT NULL THEN p{c} ELSE f{c} END"
        return f"CASE WHEN coalesce(nt - p.t <= {tol}, false) THEN n{c} ELSE {other} END AS c{c}"

    return f"""{name}s AS (SELECT bag_id, t, seq, value FROM m WHERE topic = '{topic}'),
{name}n AS (SELECT tk.*, s.t AS nt, s.seq AS ns, s.value AS nv FROM tk ASOF LEFT JOIN {name}s s ON tk.bag_id = s.bag_id AND tk.t <= s.t),
{name}p AS (SELECT n.*, s.t AS pt, s.seq AS ps, s.value AS pv FROM {name}n n ASOF LEFT JOIN {name}s s ON n.bag_id = s.bag_id AND n.t >= s.t),
{name}f AS (SELECT bag_id, min(t) AS ft, arg_min(seq, t) AS fs, arg_min(value, t) AS fv FROM {name}s GROUP BY bag_id),
{name} AS (SELECT p.bag_id, k, p.t, tick, coalesce(nt - p.t <= {tol}, false) AS real, nt - p.t AS lead_us, {held("t")}, {held("s")}, {held("v")}
  FROM {name}p p LEFT JOIN {name}f USING (bag_id))"""


def image_sql(name: str, topic: str, mode: str, tol: int = 120 * H) -> str:
    """CTE ``name``: the image of each tick."""
    before = ">" if mode == "capture" else ">="
    after = "nt IS NOT NULL AND (pt IS NULL OR nt - t < t - pt)" if mode == "capture" else "false"
    return f"""{name}s AS (SELECT bag_id, t, seq FROM m WHERE topic = '{topic}'),
{name}p AS (SELECT tk.*, s.t AS pt, s.seq AS ps FROM tk ASOF LEFT JOIN {name}s s ON tk.bag_id = s.bag_id AND tk.t {before} s.t),
{name}n AS (SELECT p.*, s.t AS nt, s.seq AS ns FROM {name}p p ASOF LEFT JOIN {name}s s ON p.bag_id = s.bag_id AND p.t <= s.t),
{name} AS (SELECT bag_id, k, CASE WHEN {after} THEN ns ELSE ps END AS src, coalesce(abs(t - CASE WHEN {after} THEN nt ELSE pt END) <= {tol}, false) AS ok FROM {name}n)"""


def rows_sql(policy: str, mode: str = "capture", grid: bool = False) -> str:
    """CTEs up to ``r``: the control rows; ``d`` has the valid ones."""
    fill, strict = policy == FILL_POLICY, policy == "fail"
    fallback = "qpos" if fill else "{c}.cv"
    skew = "greatest(c0.ct, c1.ct) - least(c0.ct, c1.ct)"
    close = f"coalesce({skew} <= {12 * H}, false)"
    hold = "NOT (c0.real OR c1.real)" if fill else f"NOT (c0.real AND c1.real AND {close})"
    line = f"CASE WHEN pt = t THEN pv WHEN t - pt <= {96 * H} AND nt - t <= {96 * H} THEN pv + (t - pt) / (nt - pt) * (nv - pv) END"
    state = line if mode == "capture" else f"CASE WHEN t - pt <= {96 * H} THEN pv END"
    command = "c0.real AND c1.real" if strict else "true"
    pair = f"NOT (c0.real AND c1.real) OR {close}" if strict else "true"
    return f"""WITH {M}, {win_sql(policy)}, {GRID if grid else TICKS},
{cmd_sql("c0", "purchase", 24 * H, policy)}, {cmd_sql("c1", "signup", 24 * H, policy)},
{image_sql("wr", "click", mode)}, {image_sql("dp", "signup", mode)},
st AS (SELECT bag_id, t, value FROM m WHERE topic = 'click'),
q0 AS (SELECT tk.*, s.t AS pt, s.value AS pv FROM tk ASOF LEFT JOIN st s ON tk.bag_id = s.bag_id AND tk.t >= s.t),
q1 AS (SELECT q0.*, s.t AS nt, s.value AS nv FROM q0 ASOF LEFT JOIN st s ON q0.bag_id = s.bag_id AND q0.t <= s.t),
q AS (SELECT bag_id, k, t, tick, {state} AS qpos FROM q1),
es AS (SELECT bag_id, t, seq, value FROM m WHERE topic = 'error'),
e AS (SELECT tk.*, s.t AS et, s.seq AS es, s.value AS ev FROM tk ASOF LEFT JOIN es s ON tk.bag_id = s.bag_id AND tk.t >= s.t),
r0 AS (SELECT q.bag_id, q.k, q.t, q.tick, qpos,
  CASE WHEN c0.real THEN c0.cv ELSE {fallback.format(c="c0")} END AS action0, CASE WHEN c1.real THEN c1.cv ELSE {fallback.format(c="c1")} END AS action1,
  CASE WHEN q.t - et <= {48 * H} THEN ev END AS effector, c0.real AS real0, c1.real AS real1, {skew} AS skew_us, {hold} AS hold,
  greatest(c0.ct, c1.ct) AS ref_t, wr.src AS wrist, dp.src AS depth, c0.cs AS cmd0, c1.cs AS cmd1, e.es AS ee,
  wr.ok AS ok_image, dp.ok AS ok_depth, qpos IS NOT NULL AS ok_state, coalesce(q.t - et <= {48 * H}, false) AS ok_effector,
  {command} AS ok_command, {pair} AS ok_pair
  FROM q JOIN c0 USING (bag_id, k) JOIN c1 USING (bag_id, k) JOIN e USING (bag_id, k) JOIN wr USING (bag_id, k) JOIN dp USING (bag_id, k)),
r AS (SELECT r0.*, CASE WHEN ref_t - s.t <= {48 * H} THEN s.value END AS ee_action, s.seq AS ee_src, ref_t - s.t AS ee_age_us,
  coalesce(ref_t - s.t <= {48 * H}, false) AS ok_action FROM r0 ASOF LEFT JOIN es s ON r0.bag_id = s.bag_id AND r0.ref_t >= s.t),
d AS (SELECT * FROM r WHERE ok_image AND ok_depth AND ok_state AND ok_effector AND ok_command AND ok_pair AND ok_action)"""


FILL, HELD = rows_sql(FILL_POLICY), rows_sql(HOLD)
SIX = ("qpos", "action0", "action1", "effector", "ee_action")
COLS = "bag_id, k, t, tick, " + ", ".join(f"round({c}, 6) AS {c}" for c in SIX) + ", hold, wrist, depth"


def rows(spark, sf_dir, policy=FILL_POLICY, **more):
    return al.aligned(messages(spark, sf_dir), policy, **more)


def shown(df):
    six = [qc.r6(F.col(c)).alias(c) for c in SIX]
    return df.select("bag_id", "k", "t", "tick", *six, "hold", "wrist", "depth")


@query(f"{FILL} SELECT {COLS} FROM d")
def align_rows(spark, sf_dir):
    """The flagship: control rows of all recordings, invalid rows dropped."""
    return shown(rows(spark, sf_dir).where(al.valid()))


@query(f"{HELD} SELECT {COLS} FROM d")
def align_drop(spark, sf_dir):
    return shown(rows(spark, sf_dir, HOLD).where(al.valid()))


@query(f"{rows_sql('fail')} SELECT bag_id, k, real0, real1, skew_us, ok_command, ok_pair, cmd0, cmd1 FROM r")
def align_strict(spark, sf_dir):
    """Policy fail: only next commands count, and pairs have to be close."""
    return rows(spark, sf_dir, "fail").select("bag_id", "k", "real0", "real1", "skew_us", "ok_command", "ok_pair", "cmd0", "cmd1")


@query(f"{rows_sql(FILL_POLICY, 'lerobot-loop', True)} SELECT {COLS} FROM d")
def align_grid(spark, sf_dir):
    """A fixed grid from the window's start, with what a control loop would have seen."""
    return shown(rows(spark, sf_dir, mode="lerobot-loop", grid_us=24 * H).where(al.valid()))


BAD = {p: f"bad_{p[3:]}" for p in al.PARTS}


@query(f"""{FILL} SELECT bag_id, count(*) AS n, {', '.join(f'count(*) FILTER (WHERE NOT {p}) AS {b}' for p, b in BAD.items())},
  count(*) FILTER (WHERE NOT ({' AND '.join(BAD)})) AS bad FROM r GROUP BY bag_id""")
def invalid_counts(spark, sf_dir):
    """Rows that each part makes invalid, and all of them."""
    each = [F.count_if(~F.col(p)).alias(b) for p, b in BAD.items()]
    return rows(spark, sf_dir).groupBy("bag_id").agg(F.count("*").alias("n"), *each, F.count_if(~al.valid()).alias("bad"))


@query(f"{FILL} SELECT bag_id, k, round(action0, 6) AS action0, round(action1, 6) AS action1, real0, real1 FROM r WHERE ok_state")
def joint_state_fill(spark, sf_dir):
    return rows(spark, sf_dir).where("ok_state").select("bag_id", "k", qc.r6(F.col("action0")).alias("action0"), qc.r6(F.col("action1")).alias("action1"), "real0", "real1")


@query(f"{HELD} SELECT bag_id, k, hold, skew_us FROM r")
def hold_mask(spark, sf_dir):
    return rows(spark, sf_dir, HOLD).select("bag_id", "k", "hold", "skew_us")


ISLES = """i AS (SELECT *, row_number() OVER (PARTITION BY bag_id ORDER BY k) AS i FROM d),
g AS (SELECT *, i - row_number() OVER (PARTITION BY bag_id ORDER BY k) AS grp FROM i WHERE hold),
runs AS (SELECT bag_id, grp, min(k) AS start_k, max(k) AS end_k, count(*) AS rows, max(t) - min(t) AS dur_us FROM g GROUP BY ALL)"""


@query(f"{HELD}, {ISLES} SELECT bag_id, row_number() OVER (PARTITION BY bag_id ORDER BY start_k) - 1 AS seg, start_k, end_k, dur_us, rows FROM runs")
def hold_segments(spark, sf_dir):
    df = segments(al.hold_runs(rows(spark, sf_dir, HOLD)), ["bag_id"])
    return df.select("bag_id", "seg", F.col("first").alias("start_k"), F.col("last").alias("end_k"), (F.col("end_us") - F.col("start_us")).alias("dur_us"), "rows")


HOLDS = """tot AS (SELECT bag_id, count(*) AS n, count(*) FILTER (WHERE hold) AS held, count(*) FILTER (WHERE real0 OR real1) AS any_real,
  count(*) FILTER (WHERE NOT real0) AS fill0, count(*) FILTER (WHERE NOT real1) AS fill1 FROM d GROUP BY bag_id),
seg AS (SELECT bag_id, count(*) AS segments, max(dur_us) AS longest_us FROM runs GROUP BY bag_id),
hs AS (SELECT bag_id, n, held, round(held / n, 6) AS fraction, coalesce(segments, 0) AS segments, coalesce(longest_us, 0) AS longest_us,
  any_real, fill0, fill1 FROM tot LEFT JOIN seg USING (bag_id))"""


def hold_stats(df):
    one = df.where(al.valid()).groupBy("bag_id").agg(
        F.count("*").alias("n"), F.count_if("hold").alias("held"), F.count_if(F.col("real0") | F.col("real1")).alias("any_real"),
        F.count_if(~F.col("real0")).alias("fill0"), F.count_if(~F.col("real1")).alias("fill1"),
    )
    seg = al.hold_runs(df).groupBy("bag_id").agg(F.count("*").alias("segments"), F.max(F.col("end_us") - F.col("start_us")).alias("longest_us"))
    zero = F.lit(0).cast("long")
    seg_columns = [F.coalesce(c, zero).alias(c) for c in ("segments", "longest_us")]
    return one.join(seg, "bag_id", "left").select("bag_id", "n", "held", qc.r6(F.col("held") / F.col("n")).alias("fraction"), *seg_columns, "any_real", "fill0", "fill1")


@query(f"{HELD}, {ISLES}, {HOLDS} SELECT * FROM hs")
def hold_summary(spark, sf_dir):
    return hold_stats(rows(spark, sf_dir, HOLD))


VERDICT = f"CASE WHEN fraction > 0.5 THEN 'too_much_hold' WHEN longest_us > {240 * H} THEN 'hold_too_long' ELSE 'ok' END"


@query(f"{HELD}, {ISLES}, {HOLDS} SELECT bag_id, {VERDICT} AS verdict FROM hs")
def hold_gate(spark, sf_dir):
    verdict = F.when(F.col("fraction") > 0.5, "too_much_hold").when(F.col("longest_us") > 240 * H, "hold_too_long").otherwise("ok")
    return hold_stats(rows(spark, sf_dir, HOLD)).select("bag_id", verdict.alias("verdict"))


def status_sql(policy: str, invalid: str) -> str:
    real = "real0 OR real1" if policy == FILL_POLICY else "real0 AND real1"
    same = " AND ".join(f"{a} IS NOT DISTINCT FROM {b}" for a, b in (("action0", "qpos"), ("action1", "qpos"), ("ee_action", "effector")))
    cases = ["WHEN rows < 2 THEN 'too_few_frames'"]
    cases += [] if policy == "fail" else ["WHEN reals = 0 THEN 'no_real_command'"]
    cases += ["WHEN rows > good THEN 'invalid_rows'"] if invalid == "fail" else []
    cases += ["WHEN good = 0 THEN 'no_valid_rows'", "WHEN own = 0 THEN 'action_is_state'", "WHEN held > 0.5 * good THEN 'too_much_hold'"]
    cases += [f"WHEN coalesce(longest, 0) > {240 * H} THEN 'hold_too_long'"]
    return f"""{rows_sql(policy)}, {ISLES},
x AS (SELECT bag_id, count(*) AS rows, count(*) FILTER (WHERE {real}) AS reals FROM r GROUP BY bag_id),
y AS (SELECT bag_id, count(*) AS good, count(*) FILTER (WHERE NOT ({same})) AS own, count(*) FILTER (WHERE hold) AS held FROM d GROUP BY bag_id),
z AS (SELECT bag_id, max(dur_us) AS longest FROM runs GROUP BY bag_id),
u AS (SELECT bag_id, rows, reals, coalesce(good, 0) AS good, coalesce(own, 0) AS own, coalesce(held, 0) AS held, longest
  FROM x LEFT JOIN y USING (bag_id) LEFT JOIN z USING (bag_id)),
c AS (SELECT *, CASE {" ".join(cases)} END AS error FROM u)
SELECT bag_id, rows, rows - good AS invalid, CASE WHEN error IS NULL THEN good ELSE 0 END AS kept,
  CASE WHEN error IS NULL THEN 'converted' ELSE 'failed' END AS status, error FROM c"""


@query(status_sql(FILL_POLICY, "drop"))
def conversion_status(spark, sf_dir):
    """A batch conversion's outcome by recording: rows kept, or why it failed; others go on."""
    return al.conversion_status(rows(spark, sf_dir), FILL_POLICY)


@query(status_sql(HOLD, "fail"))
def conversion_status_strict(spark, sf_dir):
    """The same where any invalid row refuses its recording."""
    return al.conversion_status(rows(spark, sf_dir, HOLD), HOLD, invalid="fail")


@query(f"""{FILL} SELECT bag_id, count(*) AS n, bool_and(action0 IS NOT DISTINCT FROM qpos AND action1 IS NOT DISTINCT FROM qpos) AS refused FROM r
  WHERE ok_state GROUP BY bag_id""")
def action_is_state(spark, sf_dir):
    same = F.col("action0").eqNullSafe(F.col("qpos")) & F.col("action1").eqNullSafe(F.col("qpos"))
    return rows(spark, sf_dir).where("ok_state").groupBy("bag_id").agg(F.count("*").alias("n"), F.bool_and(same).alias("refused"))


@query(f"""{FILL} SELECT bag_id, k, [qpos, coalesce(effector, 0.0)] AS state, [action0, action1, coalesce(ee_action, 0.0)] AS action,
  len([action0, action1, ee_action]) = 3 AS width_ok
FROM (SELECT bag_id, k, {', '.join(f'round({c}, 4) AS {c}' for c in SIX)} FROM r WHERE ok_state)""")
def assemble_vectors(spark, sf_dir):
    """Arm block, then effectors; the width is checked against the declared one."""
    df = rows(spark, sf_dir).where("ok_state").select("bag_id", "k", *[F.round(c, 4).alias(c) for c in SIX])
    action = F.array("action0", "action1", F.coalesce("ee_action", F.lit(0.0)))
    return df.select("bag_id", "k", F.array("qpos", F.coalesce("effector", F.lit(0.0))).alias("state"), action.alias("action"), (F.size(action) == 3).alias("width_ok"))


@query(f"{FILL} SELECT bag_id, k, ee_src AS src, ee_age_us AS age_us, ok_action AS valid FROM r")
def effector_action(spark, sf_dir):
    """The effector's command is bound to the latest selected command time, not to the tick."""
    return rows(spark, sf_dir).select("bag_id", "k", F.col("ee_src").alias("src"), F.col("ee_age_us").alias("age_us"), F.col("ok_action").alias("valid"))


STREAMS = ("tick", "wrist", "depth", "cmd0", "cmd1", "ee")


@query(f"{FILL} SELECT bag_id, count(*) AS n, {', '.join(f'round(count(DISTINCT {c}) / count(*), 6) AS {c}' for c in STREAMS)} FROM d GROUP BY bag_id")
def unique_ratio(spark, sf_dir):
    """Distinct selected messages of each stream over rows."""
    each = [qc.r6(F.col(c) / F.col("n")).alias(c) for c in STREAMS]
    df = rows(spark, sf_dir).where(al.valid()).groupBy("bag_id").agg(F.count("*").alias("n"), *[F.count_distinct(c).alias(c) for c in STREAMS])
    return df.select("bag_id", "n", *each)


MS = "round(avg(skew_us) / 1000, 6) AS mean_ms, round(median(skew_us) / 1000, 6) AS p50_ms, round(quantile_cont(skew_us, 0.95) / 1000, 6) AS p95_ms, max(skew_us) / 1000 AS max_ms"


@query(f"{HELD} SELECT bag_id, count(*) AS n, {MS} FROM r GROUP BY bag_id")
def stats_ms(spark, sf_dir):
    u = F.col("skew_us")
    one = [F.count("*").alias("n"), qc.r6(F.avg(u) / 1000).alias("mean_ms"), (F.max(u) / 1000).alias("max_ms")]
    df = grouped(rows(spark, sf_dir, HOLD), ["bag_id"], one, {"p50_ms": (u, 0.5), "p95_ms": (u, 0.95)})
    return df.withColumns({c: qc.r6(F.col(c) / 1000) for c in ("p50_ms", "p95_ms")})


@query(f"""WITH {M}, hw AS (SELECT * FROM (WITH {win_sql(HOLD)} SELECT *, '{HOLD}' AS policy FROM w)),
fw AS (SELECT * FROM (WITH {win_sql(FILL_POLICY)} SELECT *, '{FILL_POLICY}' AS policy FROM w)) SELECT * FROM hw UNION ALL SELECT * FROM fw""")
def episode_window(spark, sf_dir):
    """From the newest anchor frame at the first command to the last command, inside all observed streams."""
    m = messages(spark, sf_dir)
    return al.window_bounds(m, HOLD).withColumn("policy", F.lit(HOLD)).unionByName(al.window_bounds(m).withColumn("policy", F.lit(FILL_POLICY)))


@query(f"WITH {M}, {win_sql(FILL_POLICY)}, {TICKS} SELECT bag_id, k, t FROM tk")
def anchor_ticks(spark, sf_dir):
    m = messages(spark, sf_dir)
    return al.anchor_ticks(m, al.window_bounds(m)).select("bag_id", "k", "t")


@query(f"WITH {M}, {win_sql(FILL_POLICY)}, {GRID} SELECT bag_id, CAST(k AS INTEGER) AS k, t FROM tk")
def fixed_grid(spark, sf_dir):
    return al.fixed_grid(al.window_bounds(messages(spark, sf_dir)), 24 * H)


@query(f"""WITH {M}, {win_sql(FILL_POLICY)}, {TICKS}, s AS (SELECT bag_id, t - lag(t) OVER (PARTITION BY bag_id ORDER BY t, tick) AS dt FROM tk)
SELECT bag_id, round(median(dt) / {H}, 6) AS median_h, abs({24 * H} / median(dt) - 1) > 0.1 AS off_rate FROM s GROUP BY bag_id HAVING count(dt) > 0""")
def tick_rate_gate(spark, sf_dir):
    m = messages(spark, sf_dir)
    df = al.tick_rates(al.anchor_ticks(m, al.window_bounds(m)))
    return df.select("bag_id", qc.r6(F.col("mid") / H).alias("median_h"), (F.abs(24 * H / F.col("mid") - 1) > 0.1).alias("off_rate"))


@query(f"""WITH {M}, {win_sql(FILL_POLICY)}, {TICKS}, {cmd_sql("c0", "purchase", 24 * H)}, {cmd_sql("c1", "signup", 24 * H)}
SELECT bag_id, k, 'purchase' AS topic, cs AS cmd_event_id, lead_us, real FROM c0 UNION ALL SELECT bag_id, k, 'signup', cs, lead_us, real FROM c1""")
def command_zoh(spark, sf_dir):
    m = messages(spark, sf_dir)
    ticks = al.anchor_ticks(m, al.window_bounds(m))
    shown = "bag_id", "k", "topic", F.col("cmd.seq").alias("cmd_event_id"), "lead_us", "real"
    parts = [al.held_commands(ticks, m, c, 24 * H).withColumn("topic", F.lit(c)).select(*shown) for c in al.COMMANDS]
    return parts[0].unionByName(parts[1])


def views(m):
    return m.where("topic = 'view'").select("bag_id", F.col("seq").alias("tick_event_id"), "t")


def of(m, topic):
    return m.where(F.col("topic") == topic).select("bag_id", "t", "seq", "value")


def asof_sql(topic: str, op: str, gap: str, name: str, tol: int) -> str:
    return f"WITH {M}, {VIEWS}, s AS (SELECT bag_id, t, seq FROM m WHERE topic = '{topic}') SELECT v.bag_id, v.tick AS tick_event_id, s.seq AS src_event_id, {gap} AS {name}, coalesce({gap} <= {tol}, false) AS valid FROM v ASOF LEFT JOIN s ON v.bag_id = s.bag_id AND v.t {op} s.t"


def bound(df, gap, name, tol):
    return df.select("bag_id", "tick_event_id", F.col("src.seq").alias("src_event_id"), gap.alias(name), F.coalesce(gap <= tol, F.lit(False)).alias("valid"))


@query(asof_sql("click", ">=", "v.t - s.t", "age_us", 48 * H))
def asof_previous(spark, sf_dir):
    m = messages(spark, sf_dir)
    return bound(asof(views(m), of(m, "click"), ["bag_id"], []), F.col("t") - F.col("src.t"), "age_us", 48 * H)


@query(asof_sql("purchase", "<=", "s.t - v.t", "lead_us", 48 * H))
def asof_next(spark, sf_dir):
    m = messages(spark, sf_dir)
    return bound(asof(views(m), of(m, "purchase"), ["bag_id"], [], direction="forward"), F.col("src.t") - F.col("t"), "lead_us", 48 * H)


NEAR = """p AS (SELECT v.*, s.t AS pt, s.seq AS ps FROM v ASOF LEFT JOIN s ON v.bag_id = s.bag_id AND v.t > s.t),
n AS (SELECT p.*, s.t AS nt, s.seq AS ns FROM p ASOF LEFT JOIN s ON p.bag_id = s.bag_id AND p.t <= s.t),
x AS (SELECT bag_id, tick, t, CASE WHEN nt IS NOT NULL AND (pt IS NULL OR nt - t < t - pt) THEN nt ELSE pt END AS st, CASE WHEN nt IS NOT NULL AND (pt IS NULL OR nt - t < t - pt) THEN ns ELSE ps END AS ss FROM n)"""
CLICKS = "s AS (SELECT bag_id, t, seq, value FROM m WHERE topic = 'click')"


@query(f"""WITH {M}, {VIEWS}, {CLICKS}, {NEAR} SELECT bag_id, tick AS tick_event_id, ss AS src_event_id, abs(st - t) AS offset_us,
  coalesce(abs(st - t) <= {48 * H}, false) AS valid FROM x""")
def asof_nearest(spark, sf_dir):
    m = messages(spark, sf_dir)
    return bound(nearest(views(m), of(m, "click"), ["bag_id"], []), F.abs(F.col("src.t") - F.col("t")), "offset_us", 48 * H)


@query(f"""WITH {M}, {VIEWS}, {CLICKS}, p AS (SELECT v.*, s.t AS pt, s.value AS pv FROM v ASOF LEFT JOIN s ON v.bag_id = s.bag_id AND v.t >= s.t),
  n AS (SELECT p.*, s.t AS nt, s.value AS nv FROM p ASOF LEFT JOIN s ON p.bag_id = s.bag_id AND p.t <= s.t), x AS (SELECT *, CASE WHEN pt = t THEN pv
  WHEN t - pt <= {96 * H} AND nt - t <= {96 * H} THEN pv + (t - pt) / (nt - pt) * (nv - pv) END AS y FROM n) SELECT bag_id, tick AS tick_event_id,
  round(y, 6) AS v, y IS NOT NULL AS valid FROM x""")
def asof_interpolate(spark, sf_dir):
    m = messages(spark, sf_dir)
    df = interpolated(views(m), of(m, "click"), ["bag_id"], "value", 96 * H)
    return df.select("bag_id", "tick_event_id", qc.r6(F.col("v")).alias("v"), F.col("v").isNotNull().alias("valid"))


@query(f"""WITH {M}, tol AS (SELECT topic, CASE topic WHEN 'click' THEN {36 * H} ELSE {60 * H} END AS tol FROM (VALUES ('click'), ('error')) AS c(topic)),
  {VIEWS}, z AS (SELECT v.*, topic, tol FROM v CROSS JOIN tol), s AS (SELECT bag_id, topic, t, seq FROM m) SELECT z.bag_id, z.topic, z.tick,
  s.seq AS src, coalesce(z.t - s.t <= z.tol, false) AS ok FROM z ASOF LEFT JOIN s ON z.bag_id = s.bag_id AND z.topic = s.topic AND z.t >= s.t""")
def bind_images(spark, sf_dir):
    """Two cameras bound in one pass: the camera is part of the key, each with its tolerance."""
    m = messages(spark, sf_dir)
    ticks = m.where("topic = 'view'").select("bag_id", F.explode(F.array(F.lit("click"), F.lit("error"))).alias("topic"), F.col("seq").alias("tick"), "t")
    df = asof(ticks, m.where("topic IN ('click', 'error')").select("bag_id", "topic", "t", "seq"), ["bag_id", "topic"], [])
    tol = F.when(F.col("topic") == "click", 36 * H).otherwise(60 * H)
    return df.select("bag_id", "topic", "tick", F.col("src.seq").alias("src"), F.coalesce(F.col("t") - F.col("src.t") <= tol, F.lit(False)).alias("ok"))


@query(f"""WITH {M}, {VIEWS}, {CLICKS} SELECT v.bag_id, v.tick, round(s.value, 6) AS position, s.seq AS src, coalesce(v.t - s.t <= {96 * H}, false) AS ok
  FROM v ASOF LEFT JOIN s ON v.bag_id = s.bag_id AND v.t >= s.t""")
def bind_state(spark, sf_dir):
    """The loop mode: the last state at the tick."""
    m = messages(spark, sf_dir)
    df = asof(m.where("topic = 'view'").select("bag_id", F.col("seq").alias("tick"), "t"), of(m, "click"), ["bag_id"], ["value"])
    return df.select("bag_id", "tick", qc.r6(F.col("src.value")).alias("position"), F.col("src.seq").alias("src"), F.coalesce(F.col("t") - F.col("src.t") <= 96 * H, F.lit(False)).alias("ok"))


@query(f"""WITH {M}, g AS (SELECT bag_id, count(*) FILTER (WHERE topic = 'error' AND value > 50) AS measured,
  count(*) FILTER (WHERE topic = 'purchase') AS commanded FROM m GROUP BY bag_id) SELECT bag_id, CASE WHEN measured > 0 THEN 'measured'
  WHEN commanded > 0 THEN 'command_echo' ELSE 'error' END AS source FROM g""")
def effector_source(spark, sf_dir):
    """Measured feedback if it was delivered, else the command's echo, else an error."""
    g = messages(spark, sf_dir).groupBy("bag_id").agg(F.count_if((F.col("topic") == "error") & (F.col("value") > 50)).alias("m"), F.count_if(F.col("topic") == "purchase").alias("c"))
    return g.select("bag_id", F.when(F.col("m") > 0, "measured").when(F.col("c") > 0, "command_echo").otherwise("error").alias("source"))


STEPS = """st AS (SELECT *, topic <> 'error' AND h > 0 AS ok, t - lag(t) OVER (PARTITION BY bag_id, topic ORDER BY t, seq) AS dt FROM m),
hh AS (SELECT bag_id, topic, seq, h - lag(h) OVER (PARTITION BY bag_id, topic ORDER BY t, seq) AS dh FROM st WHERE ok),
sd AS (SELECT st.*, dh FROM st LEFT JOIN hh USING (bag_id, topic, seq)),
tl AS (SELECT bag_id, topic, count(*) AS n, min(t) AS t0, max(t) AS t1, count(*) FILTER (WHERE ok) AS oks, median(dt) AS mid_t, median(dh) AS mid_h,
  quantile_cont(dt, 0.95) AS p95_t, quantile_cont(dh, 0.95) AS p95_h, max(dt) AS most_t, max(dh) AS most_h,
  arg_max(h, (t, seq)) FILTER (WHERE ok) - arg_min(h, (t, seq)) FILTER (WHERE ok) AS active_h,
  count(*) FILTER (WHERE dt = 0) AS duplicate_receive, count(*) FILTER (WHERE topic <> 'error' AND NOT ok) AS invalid_headers,
  count(*) FILTER (WHERE dh < 0) AS header_regressions, count(*) FILTER (WHERE dh = 0) AS duplicate_headers,
  quantile_cont(abs(t - h) / 1000, 0.95) FILTER (WHERE ok) AS l95 FROM sd GROUP BY bag_id, topic),
tm AS (SELECT *, CASE WHEN oks > 0 THEN 'header' ELSE 'receive' END AS source, CASE WHEN oks > 0 THEN oks ELSE n END AS ms,
  CASE WHEN oks > 0 THEN active_h ELSE t1 - t0 END AS active, CASE WHEN oks > 0 THEN mid_h ELSE mid_t END AS mid,
  CASE WHEN oks > 0 THEN p95_h ELSE p95_t END AS p95, CASE WHEN oks > 0 THEN most_h ELSE most_t END AS most FROM tl)"""


@query(f"""WITH {M}, {STEPS}, b AS (SELECT bag_id, min(t) AS b0, max(t) AS b1 FROM m GROUP BY bag_id)
SELECT bag_id, topic, n, source, round(active / 1e6, 6) AS span_s, round(CASE WHEN active > 0 THEN (ms - 1) / (active / 1e6) END, 6) AS hz,
  round(mid / 1e6, 8) AS median_dt_s, round(p95 / 1e6, 8) AS p95_dt_s, round(most / 1e6, 6) AS max_dt_s, round(most_t / 1e6, 6) AS receive_max_dt_s,
  round((t0 - b0) / 1e6, 6) AS start_offset_s, round((b1 - t1) / 1e6, 6) AS end_offset_s,
  round(CASE WHEN b1 > b0 THEN (t1 - t0) / (b1 - b0) END, 6) AS coverage FROM tm JOIN b USING (bag_id)""")
def topic_timing(spark, sf_dir):
    """Rates and steps on the header timeline where there is one."""
    return qc.timing(messages(spark, sf_dir))


DROPS = """ds AS (SELECT sd.*, ms, mid, CASE WHEN source = 'header' THEN dh ELSE dt END AS step FROM sd JOIN tm USING (bag_id, topic) WHERE topic IN ('view', 'click', 'error')),
dr AS (SELECT bag_id, topic, ms, count(*) FILTER (WHERE mid > 0 AND step > 1.5 * mid) AS gap_count,
  CAST(sum(CASE WHEN mid > 0 AND step IS NOT NULL THEN greatest(round_even(step / mid, 0) - 1, 0) ELSE 0 END) AS BIGINT) AS est_drops FROM ds GROUP BY ALL)"""


@query(f"WITH {M}, {STEPS}, {DROPS} SELECT bag_id, topic, gap_count, est_drops, round(est_drops / (ms + est_drops), 6) AS drop_ratio FROM dr")
def topic_drops(spark, sf_dir):
    return qc.drops(messages(spark, sf_dir), CONTINUOUS)


@query(f"WITH {M}, {STEPS} SELECT bag_id, topic, duplicate_receive, invalid_headers, header_regressions, duplicate_headers FROM tl")
def topic_quality(spark, sf_dir):
    return qc.quality(messages(spark, sf_dir))


@query(f"""WITH {M}, x AS (SELECT topic, (t - h) / 1000 AS ms FROM m WHERE h > 0 AND topic <> 'error'),
y AS (SELECT topic, count(*) AS n, round(median(ms), 6) AS p50, round(quantile_cont(abs(ms), 0.95), 6) AS abs_p95, round(max(abs(ms)), 6) AS abs_max FROM x GROUP BY topic)
SELECT *, CASE WHEN abs_p95 >= 500 THEN 'FAIL' WHEN abs_p95 >= 100 THEN 'WARN' ELSE 'PASS' END AS status FROM y""")
def topic_latency(spark, sf_dir):
    return qc.latency(messages(spark, sf_dir), ["topic"], 100, 500)


#: Targets of the anchor's synchronisation: another camera and the anchor's depth; and what is late, in hours.
SYNC_TARGETS, SYNC_WARN = ("click", "signup"), 48


def sync_sql(target: str) -> str:
    """Rows (bag_id, target, tick, offset_us)."""
    return f"""SELECT bag_id, '{target}' AS target, tick, CASE WHEN nt IS NOT NULL AND (pt IS NULL OR nt - t < t - pt) THEN nt - t ELSE t - pt END AS offset_us FROM (
  SELECT p.*, s.t AS nt FROM (SELECT v.*, s.t AS pt FROM hs0 v ASOF LEFT JOIN hs_{target} s ON v.bag_id = s.bag_id AND v.t > s.t) p
  ASOF LEFT JOIN hs_{target} s ON p.bag_id = s.bag_id AND p.t <= s.t)"""


SYNC = "hs0 AS (SELECT bag_id, seq AS tick, h AS t FROM m WHERE topic = 'view' AND h > 0), "
SYNC += ", ".join(f"hs_{x} AS (SELECT bag_id, h AS t FROM m WHERE topic = '{x}' AND h > 0)" for x in SYNC_TARGETS)
SYNC += f", so AS ({' UNION ALL '.join(map(sync_sql, SYNC_TARGETS))}), "
SYNC += f"""sg AS (SELECT bag_id, target, median(offset_us / 1000) AS m, quantile_cont(offset_us / 1000, 0.95) AS p, max(offset_us / 1000) AS x FROM so GROUP BY ALL),
sr AS (SELECT bag_id, target, round(m, 6) AS median_ms, round(p, 6) AS p95_ms, round(x, 6) AS max_ms,
  CASE WHEN p IS NULL THEN 'SKIP' WHEN p > {SYNC_WARN * H // 1000} THEN 'WARN' ELSE 'PASS' END AS status
  FROM (SELECT DISTINCT bag_id FROM m) CROSS JOIN {values([(x,) for x in SYNC_TARGETS], "target")} LEFT JOIN sg USING (bag_id, target))"""


@query(f"WITH {M}, {SYNC} SELECT * FROM so WHERE target = 'click'")
def sync_offsets(spark, sf_dir):
    return qc.offsets(messages(spark, sf_dir), "view", "click")


@query(f"WITH {M}, {SYNC} SELECT * FROM sr")
def sync_report(spark, sf_dir):
    """Each camera and the depth stream against the anchor, by header stamps."""
    return qc.sync_report(messages(spark, sf_dir), "view", SYNC_TARGETS, SYNC_WARN * H / 1000)


@query(f"""WITH {M}, n AS (SELECT *, count(*) OVER (PARTITION BY bag_id, topic) AS c,
  coalesce(CAST(t - lag(t) OVER (PARTITION BY bag_id, topic ORDER BY t, seq) > {48 * H} AS INT), 0) AS new FROM m),
g AS (SELECT *, CAST(sum(new) OVER (PARTITION BY bag_id, topic ORDER BY t, seq) AS BIGINT) AS burst FROM n WHERE c > 1)
SELECT bag_id, topic, burst, min(t) AS start_us, max(t) AS end_us, count(*) AS n FROM g GROUP BY ALL""")
def teleop_bursts(spark, sf_dir):
    return qc.command_bursts(messages(spark, sf_dir), 48 * H)


TELEOP_GAP = 96 * H


def teleop_sql(policy: str) -> str:
    """CTE te."""
    silent = "WARN" if policy == FILL_POLICY else "FAIL"
    return f"""cs AS (SELECT *, t - lag(t) OVER (PARTITION BY bag_id, topic ORDER BY t, seq) AS dt FROM m WHERE topic IN ('purchase', 'signup')),
co AS (SELECT bag_id, topic, count(*) AS n, min(t) AS a, max(t) AS b, max(dt) AS gap, count(*) FILTER (WHERE dt > {TELEOP_GAP}) + 1 AS bursts FROM cs GROUP BY ALL),
cg AS (SELECT bag_id, CASE WHEN count(*) = 2 THEN min(b) - max(a) END AS overlap_us, max(gap) AS max_gap_us, CAST(sum(bursts) AS BIGINT) AS bursts FROM co WHERE n >= 2 GROUP BY bag_id),
ci AS (SELECT bag_id, overlap_us, max_gap_us, coalesce(bursts, 0) AS bursts, CASE WHEN overlap_us IS NULL THEN 'command_stream_missing'
  WHEN overlap_us <= 0 THEN 'spans_do_not_overlap' WHEN max_gap_us >= overlap_us THEN 'silent_across_overlap' WHEN max_gap_us > {TELEOP_GAP} THEN 'command_gap' END AS issue
  FROM (SELECT DISTINCT bag_id FROM m) LEFT JOIN cg USING (bag_id)),
te AS (SELECT bag_id, overlap_us, max_gap_us, bursts, CASE WHEN issue IS NULL THEN 'PASS' WHEN issue = 'command_gap' THEN 'WARN'
  WHEN issue = 'silent_across_overlap' THEN '{silent}' ELSE 'FAIL' END AS status, issue FROM ci)"""


@query(f"WITH {M}, {teleop_sql(HOLD)} SELECT * FROM te")
def teleop_overlap(spark, sf_dir):
    """Whether the command streams overlap, and whether one is silent all through the overlap."""
    return qc.teleop_report(messages(spark, sf_dir), al.COMMANDS, TELEOP_GAP, HOLD)


@query(f"WITH {M}, {teleop_sql(FILL_POLICY)} SELECT * FROM te")
def teleop_overlap_fill(spark, sf_dir):
    return qc.teleop_report(messages(spark, sf_dir), al.COMMANDS, TELEOP_GAP, FILL_POLICY)


#: What a recording should hold, and whether it has to; drop ratios of this irregular data are high.
CLAIMED = [("view", True), ("click", True), ("purchase", True), ("signup", True), ("error", False)]
WARN_DROP, FAIL_DROP = 0.1, 0.3
STATUS = f"""WITH {M}, {STEPS}, {DROPS}, cl AS (SELECT * FROM (SELECT DISTINCT bag_id FROM m) CROSS JOIN {values(CLAIMED, "topic, required")}),
j AS (SELECT cl.*, n, duplicate_receive, invalid_headers, header_regressions, duplicate_headers, l95, round(est_drops / (dr.ms + est_drops), 6) AS ratio
  FROM cl LEFT JOIN tl USING (bag_id, topic) LEFT JOIN dr USING (bag_id, topic)),
ts AS (SELECT bag_id, topic, CASE WHEN n IS NULL THEN CASE WHEN required THEN 'FAIL' ELSE 'SKIP' END
  WHEN (ratio >= {FAIL_DROP} AND required) OR invalid_headers > 0 OR header_regressions > 0 OR l95 >= 500 THEN 'FAIL'
  WHEN ratio >= {WARN_DROP} OR duplicate_receive > 0 OR duplicate_headers > 0 OR l95 >= 100 THEN 'WARN' ELSE 'PASS' END AS status FROM j)"""
WORST = "CASE max(CASE status WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END"
BAGS = f"""{STATUS}, {SYNC}, {teleop_sql(HOLD)}, al AS (SELECT bag_id, status FROM ts UNION ALL SELECT bag_id, status FROM sr UNION ALL SELECT bag_id, status FROM te),
b AS (SELECT bag_id, {WORST} AS status FROM al GROUP BY bag_id)"""


def claims_of(m, rows, names):
    """bag_id and ``rows`` for every recording."""
    each = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows])
    return m.select("bag_id").distinct().select("bag_id", F.inline(each))


def statuses(m):
    return qc.stream_status(m, claims_of(m, CLAIMED, ("topic", "required")), CONTINUOUS, WARN_DROP, FAIL_DROP)


def verdicts(m):
    """The worst of a recording's streams, synchronisation and teleoperation."""
    parts = statuses(m), qc.sync_report(m, "view", SYNC_TARGETS, SYNC_WARN * H / 1000), qc.teleop_report(m, al.COMMANDS, TELEOP_GAP, HOLD)
    df = parts[0].select("bag_id", "status")
    for p in parts[1:]:
        df = df.unionByName(p.select("bag_id", "status"))
    return df.groupBy("bag_id").agg(qc.worst(F.col("status")).alias("status"))


@query(STATUS + " SELECT * FROM ts")
def topic_status(spark, sf_dir):
    return statuses(messages(spark, sf_dir))


@query(BAGS + " SELECT * FROM b")
def bag_status(spark, sf_dir):
    return verdicts(messages(spark, sf_dir))


@query(BAGS + " SELECT status, count(*) AS bags FROM b GROUP BY status")
def status_counts(spark, sf_dir):
    return verdicts(messages(spark, sf_dir)).groupBy("status").agg(F.count("*").alias("bags"))


@query(f"""WITH {M} SELECT bag_id, count(*) AS messages, count(*) FILTER (WHERE topic <> 'signup') AS claimed, count(DISTINCT topic) AS topics,
  CAST(sum(k) AS BIGINT) AS payload, round(sum(k) / 1073741824, 12) AS gib FROM m GROUP BY bag_id""")
def bag_report(spark, sf_dir):
    return messages(spark, sf_dir).groupBy("bag_id").agg(F.count("*").alias("messages"), F.count_if(F.col("topic") != "signup").alias("claimed"), F.countDistinct("topic").alias("topics"), F.sum("k").alias("payload"), F.round(F.sum("k") / 1073741824, 12).alias("gib"))


#: What the profile asks of a recording: topic, role, cameras cut from it, and whether it is optional.
PROFILE = [
    ("view", "camera", "head", False), ("mosaic", "camera", "left, right", False), ("click", "arm_state", None, False),
    ("purchase", "arm_command", None, False), ("signup", "arm_command", None, False), ("depth", "depth", "head", True),
]
#: Message types; a recording in three advertises a depth stream, one in four a mosaic, that never spoke.
TYPES = [("view", "Image"), ("click", "JointState"), ("purchase", "JointCommand"), ("signup", "JointCommand"), ("error", "Image"), ("depth", "Image"), ("mosaic", "Image")]
SILENT = [("depth", 3), ("mosaic", 4)]
INVENTORY = f"""p AS {values(PROFILE, "topic, role, cameras, optional")}, ty AS {values(TYPES, "topic, msgtype")}, bags AS (SELECT DISTINCT bag_id FROM m),
seen AS (SELECT bag_id, topic, count(*) AS n, min(t) AS a, max(t) AS b FROM m GROUP BY ALL
  UNION ALL SELECT bag_id, topic, 0, NULL, NULL FROM bags CROSS JOIN {values(SILENT, "topic, every")} WHERE bag_id % every = 0),
claims AS (SELECT * FROM bags CROSS JOIN p),
inv AS (SELECT bag_id, topic, CASE WHEN seen.n IS NULL THEN 'claimed_absent' WHEN role IS NULL THEN 'unclaimed' WHEN seen.n = 0 THEN 'claimed_empty' ELSE 'claimed' END AS status,
  coalesce(role, '-') AS role, CASE WHEN seen.n IS NULL THEN '-' ELSE msgtype END AS msgtype, coalesce(n, 0) AS n,
  round(CASE WHEN n >= 2 AND b > a THEN (n - 1) / ((b - a) / 1e6) END, 6) AS hz, cameras, coalesce(optional, true) AS optional
  FROM claims FULL JOIN seen USING (bag_id, topic) LEFT JOIN ty USING (topic))"""


def inventory(spark, m):
    """One row for each topic that a recording advertises or the profile claims."""
    claims = claims_of(m, PROFILE, ("topic", "role", "cameras", "optional"))
    silent = claims_of(m, SILENT, ("topic", "every")).where(F.col("bag_id") % F.col("every") == 0).select("bag_id", "topic", F.lit(0).cast("long").alias("n"), *[F.lit(None).cast("long").alias(c) for c in "ab"])
    seen = m.groupBy("bag_id", "topic").agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("b")).unionByName(silent)
    types = F.broadcast(literal(spark, "topic string, msgtype string", TYPES))
    df = claims.join(seen, ["bag_id", "topic"], "full").join(types, "topic", "left")
    status = F.when(F.col("n").isNull(), "claimed_absent").when(F.col("role").isNull(), "unclaimed").when(F.col("n") == 0, "claimed_empty").otherwise("claimed")
    hz = F.when((F.col("n") >= 2) & (F.col("b") > F.col("a")), (F.col("n") - 1) / ((F.col("b") - F.col("a")) / 1e6))
    kind = F.when(F.col("n").isNull(), "-").otherwise(F.col("msgtype"))
    shown = F.coalesce("role", F.lit("-")).alias("role"), kind.alias("msgtype"), F.coalesce("n", F.lit(0).cast("long")).alias("n")
    return df.select("bag_id", "topic", status.alias("status"), *shown, qc.r6(hz).alias("hz"), "cameras", F.coalesce("optional", F.lit(True)).alias("optional"))


@query(f"WITH {M}, {INVENTORY} SELECT bag_id, topic, status, role, msgtype, n, hz, cameras FROM inv")
def topic_inventory(spark, sf_dir):
    return inventory(spark, messages(spark, sf_dir)).drop("optional")


@query(f"""WITH {M}, {INVENTORY}, broken AS (SELECT * FROM inv WHERE status IN ('claimed_absent', 'claimed_empty') AND NOT optional),
spare AS (SELECT bag_id, string_agg(topic || ' (' || n || ')', ', ' ORDER BY topic) AS spare FROM inv WHERE status = 'unclaimed' AND msgtype = 'Image' GROUP BY bag_id)
SELECT bag_id, topic, role || ' topic ' || topic || CASE status WHEN 'claimed_absent' THEN ' is not in the recording' ELSE ' has no messages' END || coalesce(' (cameras ' || cameras || ')', '') AS problem,
  CASE WHEN role = 'camera' THEN 'image topics that the profile leaves out: ' || spare WHEN role = 'arm_command' THEN 'missing_topic_policy fill takes it from the measured state' END AS suggestion
FROM broken LEFT JOIN spare USING (bag_id)""")
def inventory_problems(spark, sf_dir):
    """What is wrong with a recording's topics, and what would help."""
    inv = inventory(spark, messages(spark, sf_dir))
    broken = inv.where("status IN ('claimed_absent', 'claimed_empty') AND NOT optional")
    spare = inv.where("status = 'unclaimed' AND msgtype = 'Image'").groupBy("bag_id").agg(F.array_join(F.sort_array(F.collect_list(F.format_string("%s (%d)", "topic", "n"))), ", ").alias("spare"))
    what = F.when(F.col("status") == "claimed_absent", " is not in the recording").otherwise(" has no messages")
    problem = F.concat("role", F.lit(" topic "), "topic", what, F.coalesce(F.concat(F.lit(" (cameras "), "cameras", F.lit(")")), F.lit("")))
    help_ = F.when(F.col("role") == "camera", F.concat(F.lit("image topics that the profile leaves out: "), "spare"))
    help_ = help_.when(F.col("role") == "arm_command", "missing_topic_policy fill takes it from the measured state")
    return broken.join(spare, "bag_id", "left").select("bag_id", "topic", problem.alias("problem"), help_.alias("suggestion"))


FATAL = "role IN ('camera', 'arm_state')"


@query(f"""WITH {M}, {INVENTORY} SELECT bag_id, topic, CASE WHEN {FATAL} OR (role = 'arm_command') THEN 'fatal' ELSE 'absent' END AS under_fail, CASE WHEN {FATAL} THEN 'fatal' ELSE 'absent' END AS under_fill
FROM inv WHERE status IN ('claimed_absent', 'claimed_empty')""")
def missing_topics(spark, sf_dir):
    """Missing essential topics are fatal; missing commands are, unless the policy fills them; optional ones are recorded as absent."""
    gone = inventory(spark, messages(spark, sf_dir)).where("status IN ('claimed_absent', 'claimed_empty')")
    fatal = F.expr(FATAL)
    under_fail = F.when(fatal | (F.col("role") == "arm_command"), "fatal").otherwise("absent")
    return gone.select("bag_id", "topic", under_fail.alias("under_fail"), F.when(fatal, "fatal").otherwise("absent").alias("under_fill"))


@query(f"""WITH {M}, r AS {values([(k, v) for k, v in ROLES.items()], 'topic, role')} SELECT bag_id, role, count(*) AS n, bool_or(role IN ('camera', 'arm_state', 'ee_state')) AS continuous FROM m JOIN r USING (topic) GROUP BY ALL""")
def topic_roles(spark, sf_dir):
    roles = F.broadcast(literal(spark, "topic string, role string", list(ROLES.items())))
    df = messages(spark, sf_dir).join(roles, "topic").groupBy("bag_id", "role").agg(F.count("*").alias("n"))
    return df.withColumn("continuous", F.col("role").isin("camera", "arm_state", "ee_state"))


@query(f"""WITH {M} SELECT bag_id, topic, seq, t AS receive_us, CASE WHEN topic <> 'error' THEN h END AS header_us,
  row_number() OVER (PARTITION BY bag_id, topic ORDER BY t, seq) - 1 AS place FROM m WHERE topic IN ('view', 'error')""")
def scan_topic_times(spark, sf_dir):
    """Stamps of the wanted topics in order; headers only where the role has one."""
    m = numbered(messages(spark, sf_dir).where("topic IN ('view', 'error')"), qc.KEY, "place")
    return m.select("bag_id", "topic", "seq", F.col("t").alias("receive_us"), F.when(F.col("topic") != "error", F.col("h")).alias("header_us"), "place")


@query(f"""WITH {M}, e AS (SELECT bag_id, topic, value IS NULL OR isnan(value) OR k IS NULL OR (topic <> 'error' AND h <= 0) AS bad FROM m)
SELECT bag_id, topic, count(*) AS n, count(*) FILTER (WHERE bad) AS errors,
  CASE WHEN count(*) FILTER (WHERE bad) > (CASE topic WHEN 'view' THEN 0 ELSE 1 END) THEN 'over_budget' ELSE 'ok' END AS budget FROM e GROUP BY bag_id, topic""")
def scan_stream_summary(spark, sf_dir):
    """Messages that can't be used (no finite value, no payload, a header never set) against the stream's budget; media have none to spare."""
    bad = F.col("value").isNull() | F.isnan("value") | F.col("k").isNull() | ((F.col("topic") != "error") & (F.col("h") <= 0))
    df = messages(spark, sf_dir).groupBy("bag_id", "topic").agg(F.count("*").alias("n"), F.count_if(bad).alias("errors"))
    return df.withColumn("budget", F.when(F.col("errors") > F.when(F.col("topic") == "view", 0).otherwise(1), "over_budget").otherwise("ok"))


@query(f"""WITH {M}, d AS (SELECT bag_id, topic, h - lag(h) OVER (PARTITION BY bag_id, topic ORDER BY seq) AS dh FROM m) SELECT bag_id, topic,
  count(*) FILTER (WHERE dh < 0) AS violations FROM d GROUP BY ALL""")
def monotonic_violations(spark, sf_dir):
    d = previous(messages(spark, sf_dir).withColumn("t", F.col("seq")), qc.KEY, ["h"], {"_p": None})
    return d.groupBy("bag_id", "topic").agg(F.count_if(F.col("h") < F.col("_p.h")).alias("violations"))


@query(f"""WITH {M}, {win_sql(FILL_POLICY)}, {TICKS}
SELECT m.bag_id, m.seq, printf('%02X%02X%02X', 7, k % 256, m.seq % 256) AS pixel FROM m WHERE topic = 'view' AND EXISTS (SELECT 1 FROM tk WHERE tk.bag_id = m.bag_id AND tk.tick = m.seq)""")
def media_semijoin(spark, sf_dir):
    """Only messages that a row selected are decoded: here images of one pixel, blue first."""
    m = messages(spark, sf_dir)
    chosen = al.anchor_ticks(m, al.window_bounds(m)).select("bag_id", F.col("tick").alias("seq")).distinct()
    byte = lambda c: F.lpad(F.hex(c % 256), 2, "0")
    raw = F.unhex(F.concat(byte(F.col("seq")), byte(F.col("k")), F.lit("07")))
    some = m.where("topic = 'view'").select("bag_id", "seq", raw.alias("raw")).join(chosen, ["bag_id", "seq"], "left_semi")
    return some.select("bag_id", "seq", F.hex(colour_image("raw", F.lit("bgr8"), F.lit(1), F.lit(1), F.lit(0))).alias("pixel"))


@query(f"""WITH {M}, d AS (SELECT bag_id, t - lag(t) OVER (PARTITION BY bag_id ORDER BY t, seq) AS dt FROM m WHERE topic = 'click') SELECT bag_id,
  round(greatest(3 * median(dt) / 1000, 500 / 30, 1.0), 6) AS tol_ms FROM d GROUP BY bag_id HAVING count(dt) > 0""")
def state_tolerance(spark, sf_dir):
    d = previous(messages(spark, sf_dir).where("topic = 'click'"), ["bag_id"], ["t"], {"_p": None})
    d = d.groupBy("bag_id").agg(F.median(F.col("t") - F.col("_p.t")).alias("mid")).where("mid IS NOT NULL")
    return d.select("bag_id", qc.r6(F.greatest(3 * F.col("mid") / 1000, F.lit(500 / 30), F.lit(1.0))).alias("tol_ms"))


@query(f"WITH {M} SELECT bag_id, floor(t / {6 * H}) AS bucket, min(seq) AS seq FROM m GROUP BY ALL".replace("floor(t /", "CAST(floor(t /").replace(") AS bucket", ") AS BIGINT) AS bucket"))
def throttled(spark, sf_dir):
    """The first message of each time bucket: a broadcast held to a rate."""
    return messages(spark, sf_dir).groupBy("bag_id", F.floor(F.col("t") / (6 * H)).alias("bucket")).agg(F.min("seq").alias("seq"))
