"""Alignment from profiles over ``events``: a user is a recording, an event type a topic; values are made from an event's value."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.profiled import Alignment, align
from ..operators.qc import half_up
from ..sources.config import layered
from ..sources.profiles import load_profile
from ..sources.streams import messages
from .registry import query

HOUR_MS = 3_600_000
#: Ticks of time a millisecond.
PER_MS = 1000
#: A loop recorder's arm of four joints under two command topics, with a gripper that has no header and no feedback.
WIDE = {
    "name": "wide",
    "arm": {"joint_states_topic": "/click", "joint_names": ["a1", "a2", "b1", "b2"], "command_topics": ["/purchase", "/signup"], "command_dim": 2},
    "end_effectors": [{"name": "L", "kind": "gripper", "dim": 1, "command_topic": "/error", "command_kind": "float32multiarray", "command_indices": [1]}],
    "cameras": {"head": "/view"},
}
#: A capture of two joints under one command topic, with a hand that is measured.
NARROW = {
    "name": "narrow",
    "arm": {"joint_states_topic": "/click", "joint_names": ["x", "y"], "command_topics": ["/purchase"], "command_dim": 2},
    "end_effectors": [{"name": "hand", "kind": "dexhand", "dim": 2, "command_topic": "/signup", "state_topic": "/error"}],
    "cameras": {"head": "/view"},
}
COMMON = {
    "fps": 1 / 86400, "image_tolerance_ms": 120 * HOUR_MS, "state_tolerance_ms": 96 * HOUR_MS, "action_tolerance_ms": 24 * HOUR_MS, "action_pair_tolerance_ms": 12 * HOUR_MS,
    "end_effector_tolerance_ms": 48 * HOUR_MS, "invalid_frame_policy": "drop", "max_tick_rate_deviation": 1000.0,
}
LOOP = COMMON | {"mode": "lerobot-loop", "action_gap_policy": "joint-state-fill", "missing_topic_policy": "fill"}
CAPTURE = COMMON | {"mode": "capture", "action_gap_policy": "hold-last-command", "grid_anchor": "anchor-camera", "max_decode_errors": 1, "max_hold_fraction": 0.9}

#: Values of a message by topic, in both SQL dialects but for the brackets.
VALUES = {"wide": {"/click": "value, -value, value + 1, value * 2", "/purchase": "value, value / 2", "/signup": "value / 4, value", "/error": "0.0, value"},
          "narrow": {"/click": "value, value + 3", "/purchase": "value, -value", "/signup": "value, value * 2", "/error": "value / 2, 1.0"}}


def recorded(spark, sf_dir, name: str) -> DataFrame:
    """Messages with arrays of values; images have none, and no arm measures its velocity."""
    m = messages(spark, sf_dir).withColumn("topic", F.concat(F.lit("/"), F.col("topic")))
    cases = " ".join(f"WHEN '{t}' THEN array({v})" for t, v in VALUES[name].items())
    return m.select("bag_id", "topic", "seq", "t", "h", F.expr(f"CASE topic {cases} END").alias("values"), F.lit(None).cast("array<double>").alias("velocities"))


H = 3_600_000_000
STREAMS = {"im": "/view", "arm": "/click", "c0": "/purchase", "c1": "/signup", "ee": "/error"}


def _messages_sql(name: str, capture: bool, headerless: str) -> str:
    cases = " ".join(f"WHEN '{t}' THEN [{v}]" for t, v in VALUES[name].items())
    clock = f"CASE WHEN topic = '{headerless}' THEN t WHEN topic = '/view' THEN nullif(h, 0) ELSE h END" if capture else "t"
    own = "".join(f", {n} AS (SELECT bag_id, t, seq, v FROM s WHERE topic = '{topic}' AND NOT bad)" for n, topic in STREAMS.items())
    return f"""m0 AS (SELECT user_id AS bag_id, '/' || event_type AS topic, event_id AS seq, epoch_us(ts) AS t, CASE WHEN event_id % 1009 = 0 THEN 0 ELSE epoch_us(ts) - CAST(trunc(value * 1000) AS BIGINT) END AS h, value FROM events),
s AS (SELECT bag_id, topic, seq, t AS "at", {clock} AS t, CASE topic {cases} END AS v, ({clock}) IS NULL OR (topic <> '/view' AND (value IS NULL OR NOT isfinite(value))) AS bad FROM m0){own}"""


def _asof(at: str, stream: str, op: str, t: str = "t") -> str:
    """CTE body: ``at`` with x_t, x_seq, x_v of the message that ``op`` picks."""
    return f"SELECT a.*, s.t AS x_t, s.seq AS x_seq, s.v AS x_v FROM {at} a ASOF LEFT JOIN {stream} s ON a.bag_id = s.bag_id AND a.{t} {op} s.t"


def _chain(picks: list[tuple[str, str, str]], start: str) -> tuple[str, str]:
    """CTEs that add name_t, name_seq and name_v of each pick (name, stream, op); and the last CTE's name."""
    out, at = "", start
    for i, (name, stream, op) in enumerate(picks):
        out += f", z{i} AS (SELECT * RENAME (x_t AS {name}_t, x_seq AS {name}_seq, x_v AS {name}_v) FROM ({_asof(at, stream, op)}))"
        at = f"z{i}"
    return out, at


def _ends(streams: str) -> str:
    return ", ".join(f"min(t) FILTER (WHERE topic = '{STREAMS[n]}' AND NOT bad) AS a_{n}, max(t) FILTER (WHERE topic = '{STREAMS[n]}' AND NOT bad) AS b_{n}" for n in streams.split())


def _shown(last: str, same: str, more: str = "true") -> str:
    return f"""g AS (SELECT bag_id, count(*) FILTER (WHERE NOT ({same})) AS own, count(*) AS n, count(*) FILTER (WHERE hold) AS held FROM {last} WHERE valid GROUP BY bag_id),
y AS (SELECT bag_id FROM (SELECT bag_id, count(*) AS rows, bool_or(spoken) AS spoken FROM {last} GROUP BY bag_id) JOIN g USING (bag_id) WHERE rows > 1 AND spoken AND own > 0 AND {more})
SELECT bag_id, row_number() OVER (PARTITION BY bag_id ORDER BY k) - 1 AS frame, t, list_transform(state, lambda x: round(CAST(CAST(x AS FLOAT) AS DOUBLE), 4)) AS state, list_transform(action, lambda x: round(CAST(CAST(x AS FLOAT) AS DOUBLE), 4)) AS action, hold
FROM {last} JOIN y USING (bag_id) WHERE valid"""


def loop_sql() -> str:
    chain, at = _chain([("img", "im", ">="), ("p", "arm", ">="), ("e", "ee", ">="), ("p0", "c0", ">="), ("n0", "c0", "<="), ("p1", "c1", ">="), ("n1", "c1", "<=")], "tk")
    real = {i: f"coalesce(n{i}_t - t <= {24 * H}, false)" for i in (0, 1)}
    time = {i: f"CASE WHEN {real[i]} THEN n{i}_t ELSE coalesce(p{i}_t, a_c{i}) END" for i in (0, 1)}
    act = {i: f"CASE WHEN real{i} THEN n{i}_v ELSE p_v[{2 * i + 1}:{2 * i + 2}] END" for i in (0, 1)}
    return f"""WITH {_messages_sql("wide", False, "/error")},
w0 AS (SELECT bag_id, {_ends("im arm c0 c1 ee")}, count(*) FILTER (WHERE bad) AS bad FROM s GROUP BY bag_id),
w1 AS (SELECT *, least(a_c0, a_c1) AS cs, greatest(b_c0, b_c1) AS ce FROM w0 WHERE bad = 0 AND a_im IS NOT NULL AND a_arm IS NOT NULL AND coalesce(a_c0, a_c1) IS NOT NULL AND a_ee IS NOT NULL),
w2 AS (SELECT *, coalesce((SELECT max(t) FROM im WHERE im.bag_id = w1.bag_id AND t <= cs), cs) AS anchor FROM w1 WHERE cs < ce),
w AS (SELECT *, greatest(anchor, a_im, a_arm, a_ee) AS lo, least(ce, b_im, b_arm, b_ee) AS hi FROM w2 WHERE greatest(anchor, a_im, a_arm, a_ee) < least(ce, b_im, b_arm, b_ee)),
tk AS (SELECT im.bag_id, row_number() OVER (PARTITION BY im.bag_id ORDER BY t, seq) - 1 AS k, t, a_c0, a_c1 FROM im JOIN w USING (bag_id) WHERE t BETWEEN lo AND hi){chain},
r AS (SELECT *, {real[0]} AS real0, {real[1]} AS real1, greatest({time[0]}, {time[1]}) AS ref FROM {at}),
f AS (SELECT * FROM ({_asof("r", "ee", ">=", "ref")})),
o AS (SELECT bag_id, k, t, list_concat(p_v, e_v[2:2]) AS state, list_concat(list_concat({act[0]}, {act[1]}), x_v[2:2]) AS action, NOT (real0 OR real1) AS hold, real0 OR real1 AS spoken,
  coalesce(t - img_t <= {120 * H} AND t - p_t <= {96 * H} AND t - e_t <= {48 * H} AND ref - x_t <= {48 * H}, false) AS valid FROM f),
{_shown("o", "coalesce(list_transform(state, lambda x: CAST(x AS FLOAT)) = list_transform(action, lambda x: CAST(x AS FLOAT)), false)")}"""


def capture_sql() -> str:
    chain, at = _chain([("ib", "im", ">"), ("ia", "im", "<="), ("p", "arm", ">"), ("n", "arm", "<="), ("e", "ee", ">="), ("q", "c1", ">="), ("p0", "c0", ">="), ("n0", "c0", "<=")], "tk")
    image = "CASE WHEN ia_t IS NOT NULL AND (ib_t IS NULL OR ia_t - t < t - ib_t) THEN ia_t ELSE ib_t END"
    line = "[p_v[1] + (t - p_t) / (n_t - p_t) * (n_v[1] - p_v[1]), p_v[2] + (t - p_t) / (n_t - p_t) * (n_v[2] - p_v[2])]"
    return f"""WITH {_messages_sql("narrow", True, "")},
h AS (SELECT bag_id, bool_or(back) AS back FROM (SELECT bag_id, t < lag(t) OVER (PARTITION BY bag_id, topic ORDER BY "at", seq) AS back FROM s WHERE NOT bad) GROUP BY bag_id),
w0 AS (SELECT bag_id, {_ends("im arm c0 c1 ee")}, max(bad_n) AS worst, max(bad_n) FILTER (WHERE topic = '/view') AS bad_im FROM (SELECT *, count(*) FILTER (WHERE bad) OVER (PARTITION BY bag_id, topic) AS bad_n FROM s) GROUP BY bag_id),
w1 AS (SELECT w0.*, a_c0 AS cs, b_c0 AS ce, coalesce(a_ee, a_c1) AS a_o, coalesce(b_ee, b_c1) AS b_o FROM w0 LEFT JOIN h USING (bag_id)
  WHERE worst <= 1 AND bad_im = 0 AND NOT coalesce(back, false) AND a_im IS NOT NULL AND a_arm IS NOT NULL AND a_c0 IS NOT NULL AND a_c1 IS NOT NULL),
w2 AS (SELECT *, coalesce((SELECT max(t) FROM im WHERE im.bag_id = w1.bag_id AND t <= cs), cs) AS anchor FROM w1 WHERE cs < ce),
w AS (SELECT *, greatest(anchor, a_im, a_arm, a_o) AS lo, least(ce, b_im, b_arm, b_o) AS hi FROM w2 WHERE greatest(anchor, a_im, a_arm, a_o) < least(ce, b_im, b_arm, b_o)),
tk AS (SELECT bag_id, k, lo + CAST(round_even(k * {24 * H}.0, 0) AS BIGINT) AS t, a_ee IS NOT NULL AS measured FROM (SELECT *, unnest(range(0, CAST(floor((hi - lo) / {24 * H}.0 + 1e-9) AS BIGINT) + 1)) AS k FROM w)){chain},
r AS (SELECT *, coalesce(n0_t - t <= {24 * H}, false) AS real0, CASE WHEN measured THEN e_t ELSE q_t END AS o_t, CASE WHEN measured THEN e_v ELSE q_v END AS o_v FROM {at}),
r1 AS (SELECT *, CASE WHEN real0 THEN n0_t ELSE coalesce(p0_t, (SELECT min(t) FROM c0 WHERE c0.bag_id = r.bag_id)) END AS ref FROM r),
r2 AS (SELECT r1.*, CASE WHEN real0 THEN n0_v ELSE coalesce(p0_v, (SELECT arg_min(v, t) FROM c0 WHERE c0.bag_id = r1.bag_id)) END AS act FROM r1),
f AS (SELECT * FROM ({_asof("r2", "c1", ">=", "ref")})),
o AS (SELECT bag_id, k, t, list_concat(CASE WHEN n_t = t THEN n_v ELSE {line} END, o_v) AS state, list_concat(act, x_v) AS action, NOT real0 AS hold, real0 AS spoken,
  coalesce(abs(t - {image}) <= {120 * H} AND (coalesce(n_t = t, false) OR (t - p_t <= {96 * H} AND n_t - t <= {96 * H})) AND t - o_t <= {48 * H} AND ref - x_t <= {48 * H}, false) AS valid FROM f),
{_shown("o", "coalesce(list_transform(state, lambda x: CAST(x AS FLOAT)) = list_transform(action, lambda x: CAST(x AS FLOAT)), false)", "held <= 0.9 * n")}"""


def _aligned(spark, sf_dir, profile: dict, settings: dict) -> DataFrame:
    out, _ = align(recorded(spark, sf_dir, profile["name"]), load_profile(json.dumps(profile)), layered(None, settings), PER_MS)
    four = lambda c: F.transform(c, lambda x: half_up(x.cast("double"), 4)).alias(c)
    return out.select("bag_id", "frame", "t", four("state"), four("action"), "hold")


@query(loop_sql())
def profile_loop_rows(spark, sf_dir):
    """Four joints, two arms and a gripper on the recorder's clock; a silent arm repeats its measured joints."""
    return _aligned(spark, sf_dir, WIDE, LOOP)


@query(capture_sql())
def profile_capture_rows(spark, sf_dir):
    """Two joints and a measured hand on header stamps and a fixed grid; states are interpolated."""
    return _aligned(spark, sf_dir, NARROW, CAPTURE)


@query()
def profile_status(spark, sf_dir):
    """What keeps recordings from converting under the capture profile."""
    plan = Alignment(load_profile(json.dumps(NARROW)), layered(None, CAPTURE), PER_MS)
    return plan.status(*plan.rows(recorded(spark, sf_dir, "narrow")))
