"""Training logs, over whole tables: lines of ``events`` (a user is a job), tokens, paths and configurations of others."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import logs
from ..operators.buckets import spread
from ..operators.cuts import cut
from ..operators.sequence import first_of_equal, numbered, previous
from .registry import query

#: The log line of an event, as an expression of both SQL dialects.
LINE = """CASE event_type
 WHEN 'view' THEN 'Training:  ' || CAST(event_id % 101 AS STRING) || '%|##   | ' || CAST(event_id % 9000 AS STRING) || '/' || CAST(event_id % 4 * 5000 AS STRING)
   || ' [02:02<' || CASE WHEN event_id % 5 = 0 THEN '?' ELSE '1:0' || CAST(event_id % 9 AS STRING) || ':1' || CAST(event_id % 10 AS STRING) END || ',  1.05step/s]'
 WHEN 'click' THEN 'INFO step:' || CAST(event_id % 40 * 100 AS STRING) || ' smpl:2K loss:0.' || CAST(100 + event_id % 900 AS STRING)
   || ' grdn:' || CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE '1.' || CAST(event_id % 10 AS STRING) END || ' lr:1e-0' || CAST(4 + event_id % 3 AS STRING)
 WHEN 'purchase' THEN 'INFO step:' || CAST(event_id % 6 AS STRING) || CASE WHEN event_id % 4 = 0 THEN '.5K' ELSE 'K' END || ' loss:' || CASE WHEN event_id % 11 = 0 THEN '' ELSE '0.3' END
 WHEN 'signup' THEN CASE event_id % 5 WHEN 0 THEN 'see https://wandb.ai/team/proj/runs/r' || CAST(event_id AS STRING) || ' and https://wandb.ai/team/proj/runs/zzz'
   WHEN 1 THEN 'Job submitted: ' || CAST(event_id AS STRING) WHEN 2 THEN '  Job page: https://jobs.example.org/' || CAST(event_id AS STRING)
   WHEN 3 THEN 'Model repo: https://hub.example.org/org/m' || CAST(event_id AS STRING) ELSE '   ' END
 ELSE CASE event_id % 4 WHEN 0 THEN 'RuntimeError: arm ' || CAST(event_id AS STRING) || ' lost' WHEN 1 THEN '' ELSE 'note ' || CAST(event_id AS STRING) END END"""
SQL_LINES = f"l AS (SELECT user_id AS job, event_id AS pos, {LINE} AS line FROM events)"


def lines(spark, sf_dir) -> DataFrame:
    """job, pos, line; a line is exploded from an array of one, so that what reads it doesn't repeat its expression."""
    line = F.explode(F.array(F.expr(LINE))).alias("line")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("job"), F.col("event_id").alias("pos"), line)


def placed(rows: DataFrame, order: str = "pos", back: bool = False) -> DataFrame:
    """``rows`` with t and seq for the helpers of ordered streams, forwards or backwards."""
    key = -F.col(order) if back else F.col(order)
    return rows.withColumn("t", key).withColumn("seq", -F.col("pos") if back else F.col("pos"))


NUMBER = r"'^([\d,]+(?:\.\d+)?)([KMBTQ])?$'"
NUM = f"""CAST(round_even(TRY_CAST(replace(nullif(regexp_extract(trim({{t}}), {NUMBER}, 1), ''), ',', '') AS DOUBLE)
  * CASE regexp_extract(trim({{t}}), {NUMBER}, 2) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 WHEN 'T' THEN 1e12 WHEN 'Q' THEN 1e15 ELSE 1.0 END, 0) AS BIGINT)"""


def tok(n: str) -> str:
    return f"nullif(regexp_extract(line, '{n}:\\s*(\\S+)', 1), '')"


METRIC = "line LIKE '%step:%' AND line LIKE '%loss:%'"
PARSED = f"""p AS (SELECT job, pos, line, CASE WHEN {METRIC} THEN {NUM.format(t=tok("step"))} END AS step,
 {", ".join(f"CASE WHEN {METRIC} THEN TRY_CAST({tok(n)} AS DOUBLE) END AS {k}" for n, k in (("loss", "loss"), ("lr", "lr"), ("grdn", "grad_norm")))} FROM l)"""


def parsed(rows: DataFrame) -> DataFrame:
    """job, pos, line, step, loss, lr, grad_norm; nulls where a line has no metrics."""
    return rows.select("job", "pos", "line", *[c.alias(k) for k, c in logs.metrics(F.col("line")).items()])


@query(f"WITH {SQL_LINES}, {PARSED} SELECT job, pos, step, loss, lr, grad_norm FROM p WHERE {METRIC}")
def parse_metrics(spark, sf_dir):
    return parsed(lines(spark, sf_dir)).where(logs.is_metric(F.col("line"))).drop("line")


def history(rows: DataFrame) -> DataFrame:
    """Of neighbouring points with one step the last, then a stable sort by step."""
    points = cut(parsed(rows).where("step > 0").drop("line"))
    buckets = spread(placed(points, back=True), ["job"])
    kept = first_of_equal(placed(points, back=True), ["job"], "step", buckets)
    kept = placed(cut(kept) if buckets.split else kept, "step")
    return numbered(kept, ["job"], "place", spread(kept, ["job"], buckets)).select("job", (F.col("place") + 1).alias("place"), "step", "loss", "lr", "grad_norm")


@query(f"""WITH {SQL_LINES}, {PARSED}, d AS (SELECT *, lead(step) OVER (PARTITION BY job ORDER BY pos) AS nx FROM p WHERE step > 0)
SELECT job, row_number() OVER (PARTITION BY job ORDER BY step, pos) AS place, step, loss, lr, grad_norm FROM d WHERE nx IS NULL OR nx <> step""")
def metrics_history(spark, sf_dir):
    return history(lines(spark, sf_dir))


#: Points that a chart keeps.
CHART = 2000


def chart(rows: DataFrame) -> DataFrame:
    """job, series, step, value: a live chart's loss and learning rate.

    Both are cleared where the step falls; of neighbouring points with one step the first
    stays; the last ``CHART`` points are kept.
    """
    steps = placed(cut(parsed(rows).where("step IS NOT NULL").drop("line")))
    buckets = spread(steps, ["job"])
    steps = cut(previous(steps, ["job"], ["step"], {"_p": None}, buckets))
    fell = steps.where(F.col("step") < F.col("_p.step")).groupBy("job").agg(F.max("pos").alias("_cleared"))
    now = steps.join(fell, "job", "left").where("step > 0 AND (_cleared IS NULL OR pos >= _cleared)")
    each = F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).alias("value")) for c in ("loss", "lr")])
    points = now.select("job", "pos", "step", F.inline(each)).where("value IS NOT NULL")
    key = ["job", "series"]
    if buckets.split:
        points = cut(points)
    points = first_of_equal(placed(points), key, "step", spread(placed(points), key, buckets))
    points = placed(cut(points) if buckets.split else points, back=True)
    points = numbered(points, key, "_age", spread(points, key, buckets)).where(F.col("_age") < CHART)
    return points.select("job", "series", "step", "value")


@query(f"""WITH {SQL_LINES}, {PARSED}, s AS (SELECT *, lag(step) OVER (PARTITION BY job ORDER BY pos) AS before FROM p WHERE step IS NOT NULL),
f AS (SELECT job, max(pos) FILTER (WHERE step < before) AS cleared FROM s GROUP BY job),
n AS (SELECT s.* FROM s JOIN f USING (job) WHERE step > 0 AND (cleared IS NULL OR pos >= cleared)),
v AS (SELECT job, pos, step, 'loss' AS series, loss AS value FROM n WHERE loss IS NOT NULL UNION ALL SELECT job, pos, step, 'lr', lr FROM n WHERE lr IS NOT NULL),
o AS (SELECT *, lag(step) OVER (PARTITION BY job, series ORDER BY pos) AS last FROM v),
k AS (SELECT *, row_number() OVER (PARTITION BY job, series ORDER BY pos DESC) AS age FROM o WHERE last IS NULL OR last <> step)
SELECT job, series, step, value FROM k WHERE age <= {CHART}""")
def live_series(spark, sf_dir):
    return chart(lines(spark, sf_dir))


TOKEN = """CASE l_orderkey % 8 WHEN 0 THEN CAST(l_partkey AS STRING) WHEN 1 THEN CAST(l_partkey % 999 AS STRING) || 'K' WHEN 2 THEN '1.' || CAST(l_suppkey % 100 AS STRING) || 'M'
 WHEN 3 THEN CAST(1 + l_linenumber AS STRING) || ',024' WHEN 4 THEN CAST(l_linenumber AS STRING) || '.5' WHEN 5 THEN ' ' || CAST(l_linenumber AS STRING) || 'B ' WHEN 6 THEN 'nope' ELSE CASE WHEN l_linenumber > 3 THEN '' ELSE 'K' END END"""


@query(f"SELECT DISTINCT token, {NUM.format(t='token')} AS value FROM (SELECT {TOKEN} AS token FROM lineitem)")
def parse_big_number(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.expr(TOKEN).alias("token")).distinct()
    return df.withColumn("value", logs.big_number(F.col("token")))


TIME = """CASE l_orderkey % 6 WHEN 0 THEN '0' || CAST(l_linenumber AS STRING) || ':' || CAST(10 + l_partkey % 50 AS STRING) WHEN 1 THEN '0' || CAST(l_linenumber AS STRING) || ':00:' || CAST(10 + l_suppkey % 50 AS STRING)
 WHEN 2 THEN '?' WHEN 3 THEN 'garbage' WHEN 4 THEN 'a:' || CAST(l_linenumber AS STRING) ELSE '1:2:3:' || CAST(l_linenumber AS STRING) END"""


@query(f"""WITH t AS (SELECT DISTINCT token, string_split(token, ':') AS p FROM (SELECT {TIME} AS token FROM lineitem))
SELECT token, CASE len(p) WHEN 2 THEN TRY_CAST(p[1] AS BIGINT) * 60 + TRY_CAST(p[2] AS BIGINT)
  WHEN 3 THEN TRY_CAST(p[1] AS BIGINT) * 3600 + TRY_CAST(p[2] AS BIGINT) * 60 + TRY_CAST(p[3] AS BIGINT) END AS seconds FROM t""")
def parse_duration(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.expr(TIME).alias("token")).distinct()
    return df.withColumn("seconds", logs.duration(F.col("token")))


@query(f"""WITH {SQL_LINES}, u AS (SELECT job, pos, nullif(regexp_extract(line, '{logs.RUN_URL}'), '') AS url FROM l)
SELECT job, arg_min(url, pos) AS url FROM u WHERE url IS NOT NULL GROUP BY job""")
def run_url(spark, sf_dir):
    """The first link to a run page of each job."""
    u = lines(spark, sf_dir).withColumn("url", logs.group(F.col("line"), logs.RUN_URL, 0)).where("url IS NOT NULL")
    return u.groupBy("job").agg(F.min_by("url", "pos").alias("url"))


#: What a cloud job prints when it starts.
MARKS = {"submitted": r"^Job submitted: (\S+)", "page": r"^\s*Job page: (\S+)", "repo": r"^\s*Model repo: https://[^/]+/(\S+)"}


@query(
    f"WITH {SQL_LINES} SELECT job, "
    + ", ".join(f"arg_min(nullif(regexp_extract(line, '{p}', 1), ''), pos) FILTER (WHERE regexp_matches(line, '{p}')) AS {k}" for k, p in MARKS.items())
    + " FROM l GROUP BY job"
)
def job_markers(spark, sf_dir):
    """The first value of each marker line."""
    c = F.col("line")
    firsts = [F.min_by(F.when(c.rlike(p), logs.group(c, p, 1)), F.when(c.rlike(p), F.col("pos"))).alias(k) for k, p in MARKS.items()]
    return lines(spark, sf_dir).groupBy("job").agg(*firsts)


RAW = """CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN '{broken' || CAST(event_id AS STRING) WHEN 2 THEN '   '
 ELSE '{"ts": ' || CAST(event_id AS STRING) || '.5, "message": "line ' || CAST(event_id AS STRING) || '"}' END"""


@query(f"""WITH r AS (SELECT event_id AS pos, {RAW} AS raw FROM events)
SELECT pos, CAST(json_extract_string(raw, '$.ts') AS DOUBLE) AS ts, json_extract_string(raw, '$.message') AS message FROM r WHERE json_valid(raw)""")
def log_lines(spark, sf_dir):
    """JSON lines; blank and malformed ones are skipped."""
    df = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("pos"), F.expr(RAW).alias("raw"))
    df = df.withColumn("j", F.from_json("raw", "ts double, message string"))
    return df.where("j.message IS NOT NULL").select("pos", "j.ts", "j.message")


#: Lines at the end of a log that are looked at; how an exception line begins.
TAIL = 50
ERR = r"^[A-Za-z_][\w.]*(Error|Exception|Interrupt|Timeout|Failure)\b"


def error_tails(rows: DataFrame) -> DataFrame:
    """job, error: the text from the last exception line on, else the last six lines with text, at most 500 characters."""
    last = numbered(placed(rows, back=True), ["job"], "_age").where(F.col("_age") < TAIL)
    found = last.groupBy("job").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("_s"))  # TAIL lines a job at most
    df = found.select("job", F.col("_s.line").alias("lines"))
    hits = F.expr(rf"filter(sequence(1, size(lines)), i -> lines[i - 1] RLIKE r'{ERR}')")
    full = F.filter("lines", lambda x: F.trim(x) != "")
    six = F.slice(full, F.greatest(F.size(full) - 5, F.lit(1)), F.lit(6))
    raw = F.when(F.size(hits) > 0, F.array_join(F.slice("lines", F.array_max(hits), F.size("lines")), "\n")).otherwise(F.array_join(six, "\n"))
    x = F.regexp_replace(F.regexp_replace(raw, r"^\s+|\s+$", ""), r"\n\s*\n+", "\n")
    return df.select("job", F.nullif(F.when(F.length(x) > 500, F.concat(F.regexp_replace(F.substring(x, 1, 500), r"\s+$", ""), F.lit("…"))).otherwise(x), F.lit("")).alias("error"))


@query(f"""WITH {SQL_LINES}, b AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY pos DESC) AS age FROM l),
t AS (SELECT job, list(line ORDER BY pos) AS lines FROM b WHERE age <= {TAIL} GROUP BY job),
n AS (SELECT job, lines, list_filter(range(1, len(lines) + 1), lambda i: regexp_matches(lines[i], '{ERR}')) AS hits FROM t),
s AS (SELECT job, CASE WHEN len(hits) > 0 THEN array_to_string(lines[list_max(hits):], chr(10)) ELSE array_to_string(list_filter(lines, lambda x: trim(x) <> '')[-6:], chr(10)) END AS raw FROM n),
c AS (SELECT job, regexp_replace(trim(raw, chr(10) || ' '), '\\n\\s*\\n+', chr(10), 'g') AS x FROM s)
SELECT job, nullif(CASE WHEN length(x) > 500 THEN regexp_replace(substr(x, 1, 500), '\\s+$', '') || '…' ELSE x END, '') AS error FROM c""")
def log_error_tail(spark, sf_dir):
    return error_tails(lines(spark, sf_dir))


#: What device and camera failures say.
HINTS = [
    ("motor_overload", ["overload", "torque_enable"]),
    ("motor_missing", ["missing motor ids", "motor check failed"]),
    ("no_connection", ["could not connect", "failed to connect", "not connected"]),
    ("slow_camera", ["frame is too old", "no frame", "frame timeout"]),
    ("camera_mode", ["failed to set capture_", "actual_width", "actual_height"]),
]
RUN = """o_orderkey AS id, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 3 END AS rc, o_custkey % 2 = 0 AS started,
 CASE o_orderkey % 9 WHEN 0 THEN 'Overload on motor 6' WHEN 1 THEN 'overload' WHEN 2 THEN 'arm not connected' WHEN 3 THEN 'frame timeout' WHEN 4 THEN 'Permission denied on port'
 WHEN 5 THEN 'torque_enable failed' WHEN 6 THEN 'failed to set capture_width' WHEN 7 THEN 'Missing motor IDs' END AS error"""


@query(f"""WITH o AS (SELECT *, lower(coalesce(error, '')) AS low FROM (SELECT {RUN} FROM orders))
SELECT id, CASE WHEN coalesce(rc, 0) = 0 THEN 'ok' WHEN started AND (low LIKE '%overload%' OR low LIKE '%torque_enable%') THEN 'ran_with_warning' ELSE 'failed' END AS outcome,
CASE {" ".join("WHEN " + " OR ".join(f"contains(low, '{w}')" for w in ws) + f" THEN '{h}'" for h, ws in HINTS)}
  WHEN contains(low, 'permission') AND (contains(low, 'port') OR contains(low, 'com')) THEN 'port_in_use' END AS hint FROM o""")
def outcome_class(spark, sf_dir):
    """How a run ended, and what its error text points to."""
    low = F.lower(F.coalesce("error", F.lit("")))
    has = lambda *ws: F.array_max(F.array(*[low.contains(w) for w in ws]))
    hint = F.when(has(*HINTS[0][1]), HINTS[0][0])
    for h, ws in HINTS[1:]:
        hint = hint.when(has(*ws), h)
    hint = hint.when(low.contains("permission") & has("port", "com"), "port_in_use")
    outcome = F.when(F.coalesce("rc", F.lit(0)) == 0, "ok").when(F.col("started") & has("overload", "torque_enable"), "ran_with_warning").otherwise("failed")
    runs = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(f"struct({RUN}) AS r").select("r.*")
    return runs.select("id", outcome.alias("outcome"), hint.alias("hint"))


PATH = """l_suppkey AS repo, CASE l_linenumber % 4 WHEN 0 THEN 'checkpoints/last/model.bin' WHEN 1 THEN 'checkpoints/' || lpad(CAST(l_partkey % 50 * 100 AS STRING), 6, '0') || '/model.bin'
 WHEN 2 THEN 'checkpoints/' || CAST(l_partkey % 50 * 100 AS STRING) || '/config.json' ELSE 'readme.md' END AS path"""


@query(f"""WITH p AS (SELECT repo, nullif(regexp_extract(path, '^checkpoints/(\\d+)/', 1), '') AS ref FROM (SELECT {PATH} FROM lineitem))
SELECT repo, CAST(ref AS BIGINT) AS step, max(ref) AS ref FROM p WHERE ref IS NOT NULL GROUP BY repo, CAST(ref AS BIGINT)""")
def checkpoints(spark, sf_dir):
    """Steps of a file listing with their names as written."""
    files = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(f"struct({PATH}) AS r").select("r.*")
    p = files.withColumn("ref", logs.group(F.col("path"), r"^checkpoints/(\d+)/", 1)).where("ref IS NOT NULL")
    return p.groupBy("repo", F.col("ref").cast("long").alias("step")).agg(F.max("ref").alias("ref"))


JOB = "o_orderkey AS id, o_orderkey % 3 * 400 - 400 AS total, o_custkey % 4 * 500 AS config, o_orderkey % 5 = 0 AS imported"
TOTAL = "CASE WHEN total <= 0 AND config > 0 AND NOT imported THEN config ELSE total END"


@query(f"SELECT id, {TOTAL} AS total_steps FROM (SELECT {JOB} FROM orders)")
def total_steps(spark, sf_dir):
    """A job without a total takes its configuration's."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(f"struct({JOB}) AS r").select("r.*").selectExpr("id", f"{TOTAL} AS total_steps")


DOC = """p_partkey AS name, '{"type": "' || CASE p_partkey % 3 WHEN 0 THEN 'act' WHEN 1 THEN 'pi0' ELSE 'smolvla' END || '", "input_features": {'
 || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '"observation.images.top": {"type": "VISUAL", "shape": [3, ' || CAST(100 + p_partkey % 400 AS STRING) || ', 640]}, "observation.state": {"type": "STATE", "shape": [6]}, "observation.images.flat": {"type": "VISUAL", "shape": [3, 480]}' END || '}}' AS doc"""


@query(f"""WITH c AS (SELECT {DOC} FROM part),
f AS (SELECT name, k, json_extract(doc, '$.input_features."' || k || '"') AS v FROM (SELECT name, doc, unnest(json_keys(doc, '$.input_features')) AS k FROM c)),
g AS (SELECT name, string_agg(regexp_extract(k, '([^.]+)$', 1) || ':' || json_extract_string(v, '$.shape[1]') || 'x' || json_extract_string(v, '$.shape[2]'), ',' ORDER BY k) AS images
  FROM f WHERE json_extract_string(v, '$.type') = 'VISUAL' AND json_array_length(v, '$.shape') = 3 GROUP BY name)
SELECT name, json_extract_string(doc, '$.type') AS policy_type, coalesce(images, '') AS images, json_extract_string(doc, '$.type') IN ('pi0', 'smolvla') AS requires_task
FROM c LEFT JOIN g USING (name)""")
def policy_summary(spark, sf_dir):
    """Image inputs of a policy's configuration: rank-3 visual features by the last part of their name."""
    kind = "type string, input_features map<string, struct<type: string, shape: array<int>>>"
    df = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(f"struct({DOC}) AS r").select("r.*").withColumn("j", F.from_json("doc", kind))
    visual = F.map_filter("j.input_features", lambda k, v: (v["type"] == "VISUAL") & (F.size(v["shape"]) == 3))

    def shown(e):
        last, shape = F.element_at(F.split(e["key"], r"\."), -1), e["value"]["shape"]
        return F.concat(last, F.lit(":"), shape[1].cast("string"), F.lit("x"), shape[2].cast("string"))

    names = F.transform(F.array_sort(F.map_entries(visual)), shown)
    return df.select("name", F.col("j.type").alias("policy_type"), F.array_join(names, ",").alias("images"), F.col("j.type").isin("pi0", "smolvla").alias("requires_task"))


def latest_state(rows: Iterator[tuple[int | None, int | None, int | None, int | None, float | None]], state: dict) -> dict:
    """One job's state after lines in order: a progress bar sets the step, a log line only moves it forward."""
    for bar_step, bar_total, eta, step, loss in rows:
        if bar_step is not None:
            state["step"] = bar_step
            state["total"] = bar_total or state["total"]
            state["eta"] = eta if eta is not None else state["eta"]
        if step is not None and step >= state["step"]:
            state["step"] = step
        if loss is not None:
            state["loss"] = loss
    return state


STATE = "job string, step long, total long, eta_s long, loss double"


def states(rows: DataFrame) -> DataFrame:
    """job, step, total, eta_s, loss: ``latest_state`` of whole logs by aggregation: the last bar's step, or the greatest logged after it."""
    c = F.col("line")
    df = rows.select("job", "pos", *[v.alias(k) for k, v in logs.progress(c).items()], *[v.alias(k) for k, v in logs.metrics(c).items() if k in ("step", "loss")])
    bar = F.col("bar_step").isNotNull()

    def last(value: str, when: Column) -> Column:
        return F.max_by(value, F.when(when, F.col("pos")))

    one = df.groupBy("job").agg(
        F.max(F.when(bar, F.col("pos"))).alias("_bar"), last("bar_step", bar).alias("_step"), last("bar_total", bar & (F.col("bar_total") != 0)).alias("total"),
        last("eta_s", bar & F.col("eta_s").isNotNull()).alias("eta_s"), last("loss", F.col("loss").isNotNull()).alias("loss"),
    )
    more = df.select("job", "pos", "step").where("step IS NOT NULL").join(one.select("job", "_bar"), "job").where("_bar IS NULL OR pos > _bar")
    more = more.groupBy("job").agg(F.max("step").alias("_more"))
    return one.join(more, "job", "left").select("job", F.greatest(F.coalesce("_step", F.lit(0)), F.coalesce("_more", F.lit(0))).cast("long").alias("step"), "total", "eta_s", "loss")


BAR = r"'(\d+)/(\d+) \[[\d:]+<([\d:]+)'"


@query(f"""WITH {SQL_LINES}, {PARSED}, b AS (SELECT p.*, string_split(regexp_extract(line, {BAR}, 3), ':') AS e,
  CASE WHEN line LIKE 'Training:%' THEN TRY_CAST(nullif(regexp_extract(line, {BAR}, 1), '') AS BIGINT) END AS bar, TRY_CAST(nullif(regexp_extract(line, {BAR}, 2), '') AS BIGINT) AS tot FROM p),
e AS (SELECT *, CASE WHEN bar IS NOT NULL AND len(e) = 3 THEN TRY_CAST(e[1] AS BIGINT) * 3600 + TRY_CAST(e[2] AS BIGINT) * 60 + TRY_CAST(e[3] AS BIGINT) END AS eta FROM b),
o AS (SELECT job, max(pos) FILTER (WHERE bar IS NOT NULL) AS at, arg_max(bar, pos) FILTER (WHERE bar IS NOT NULL) AS bar, arg_max(tot, pos) FILTER (WHERE bar IS NOT NULL AND tot <> 0) AS total,
  arg_max(eta, pos) FILTER (WHERE eta IS NOT NULL) AS eta_s, arg_max(loss, pos) FILTER (WHERE loss IS NOT NULL) AS loss FROM e GROUP BY job)
SELECT o.job, greatest(coalesce(o.bar, 0), coalesce((SELECT max(step) FROM e WHERE e.job = o.job AND step IS NOT NULL AND (o.at IS NULL OR e.pos > o.at)), 0)) AS step, total, eta_s, o.loss FROM o""")
def metrics_state(spark, sf_dir):
    return states(lines(spark, sf_dir))


RECORD = "o_orderkey AS job, CASE o_orderkey % 4 WHEN 0 THEN 'running' WHEN 1 THEN 'done' WHEN 2 THEN NULL ELSE 'failed' END AS state, o_custkey % 3 AS alive"


@query(f"""SELECT job, CASE WHEN state = 'running' AND alive = 0 THEN 'interrupted' ELSE state END AS state FROM (SELECT {RECORD} FROM orders)
  WHERE state IS NOT NULL""")
def job_states(spark, sf_dir):
    """Job records as loaded: malformed ones are skipped, running ones of dead processes are interrupted."""
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(f"struct({RECORD}) AS r").select("r.*").where("state IS NOT NULL")
    return df.select("job", F.when(F.expr("state = 'running' AND alive = 0"), "interrupted").otherwise(F.col("state")).alias("state"))


#: Seconds without a sign of life after which a running job counts as gone.
SILENT = 3600


def watched(jobs: DataFrame, silent: int = SILENT) -> DataFrame:
    """job, state, ended: a running job is done or failed by its exit code, and interrupted if it has none and was silent for long."""
    ended = F.when(F.col("exit_code") == 0, "done").when(F.col("exit_code").isNotNull(), "failed").when(F.col("silent_s") > silent, "interrupted").otherwise("running")
    return jobs.select("job", F.when(F.col("state") == "running", ended).otherwise(F.col("state")).alias("state"))


WATCH = "o_orderkey AS job, CASE o_orderkey % 3 WHEN 0 THEN 'done' ELSE 'running' END AS state, CASE o_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 137 END AS exit_code, o_orderkey % 7201 AS silent_s"


@query(f"""SELECT job, CASE WHEN state <> 'running' THEN state WHEN exit_code = 0 THEN 'done' WHEN exit_code IS NOT NULL THEN 'failed'
  WHEN silent_s > {SILENT} THEN 'interrupted' ELSE 'running' END AS state FROM (SELECT {WATCH} FROM orders)""")
def job_watchdog(spark, sf_dir):
    """What a look at all jobs makes of their states."""
    return watched(spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(f"struct({WATCH}) AS r").select("r.*"))
