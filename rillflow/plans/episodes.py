"""Quality control of episodes, over ``lineitem``: an order is an episode, a line a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.cuts import cut
from ..operators.qc import half_up, r6
from ..operators.sequence import numbered, running_offsets, running_sum, velocity_of
from .registry import query

ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
#: action is (quantity, price, discount, tax); the state is the same vector of the frame before.
DIMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FR = """f AS (SELECT *, row_number() OVER w - 1 AS k, lag(l_quantity) OVER w AS p0, lag(l_extendedprice) OVER w AS p1, lag(l_discount) OVER w AS p2, lag(l_tax) OVER w AS p3
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate))"""


def frames(spark, sf_dir):
    """Frames of an episode in order, with k and the vector before (p0 to p3)."""
    w = W.partitionBy("l_orderkey").orderBy(*ORDER)
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("k", (F.row_number().over(w) - 1).cast("long"))
    for i, d in enumerate(DIMS):
        df = df.withColumn(f"p{i}", F.lag(d).over(w))
    return df


@query(f"""WITH {FR}, v AS (SELECT l_orderkey, k, l_quantity, p0, lead(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY k) AS nx FROM f)
  SELECT l_orderkey AS bag_id, k, coalesce((l_quantity - p0) * 30, (nx - l_quantity) * 30, 0.0) AS v FROM v""")
def velocity(spark, sf_dir):
    return velocity_of(frames(spark, sf_dir), ["l_orderkey"], ["k"], "l_quantity", 30.0).select(F.col("l_orderkey").alias("bag_id"), "k", "v")


@query(f"""WITH {FR}, s AS (SELECT l_orderkey, l_discount AS a0, l_tax AS a1, coalesce(p2, l_discount) AS s0, coalesce(p3, l_tax) AS s1 FROM f)
SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE a0 = s0 AND a1 = s1) AS identical_rows, round(count(*) FILTER (WHERE a0 = s0 AND a1 = s1) / count(*), 6) AS identical_ratio,
  round(max(greatest(abs(a0 - s0), abs(a1 - s1))), 6) AS max_abs_diff, [round(max(abs(a0 - s0)), 6), round(max(abs(a1 - s1)), 6)] AS max_abs_diff_by_dim FROM s GROUP BY l_orderkey""")
def action_vs_state(spark, sf_dir):
    """Rows whose action is the state, and the largest difference, of all dimensions and of each."""
    df = frames(spark, sf_dir).select("l_orderkey", F.col("l_discount").alias("a0"), F.col("l_tax").alias("a1"), F.coalesce("p2", "l_discount").alias("s0"), F.coalesce("p3", "l_tax").alias("s1"))
    same, gaps = F.count_if(F.expr("a0 = s0 AND a1 = s1")), [F.abs(F.col(f"a{i}") - F.col(f"s{i}")) for i in range(2)]
    each = F.array(*[r6(F.max(g)) for g in gaps]).alias("max_abs_diff_by_dim")
    return df.groupBy("l_orderkey").agg(F.count("*").alias("n"), same.alias("identical_rows"), r6(same / F.count("*")).alias("identical_ratio"), r6(F.max(F.greatest(*gaps))).alias("max_abs_diff"), each)


@query(f"""WITH {FR} SELECT l_orderkey, count(*) AS n, list_filter([CASE WHEN min(l_quantity) = max(l_quantity) THEN 0 END, CASE
  WHEN min(l_extendedprice) = max(l_extendedprice) THEN 1 END, CASE WHEN min(l_discount) = max(l_discount) THEN 2 END, CASE
  WHEN min(l_tax) = max(l_tax) THEN 3 END], lambda x: x IS NOT NULL) AS dead FROM f GROUP BY l_orderkey""")
def dead_dims(spark, sf_dir):
    flat = [F.when(F.min(d) == F.max(d), i) for i, d in enumerate(DIMS)]
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.array(*flat).alias("dead"))
    return df.withColumn("dead", F.filter("dead", lambda x: x.isNotNull()))


@query(f"""WITH {FR}, s AS (SELECT l_orderkey, k, 0 AS dim, abs(l_quantity - p0) AS step FROM f WHERE k > 0 UNION ALL SELECT l_orderkey, k, 1, abs(l_discount * 100 - p2 * 100) FROM f WHERE k > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY step DESC, k, dim) AS i FROM s) SELECT l_orderkey, k AS frame, dim, round(step, 6) AS step, round(step * 30, 6) AS per_s, CASE WHEN step > 35 THEN 'WARN' ELSE 'PASS' END AS status FROM r WHERE i = 1""")
def max_step(spark, sf_dir):
    """The largest step of neighbours: the earliest frame, then the lowest dimension, of equal ones."""
    dims = F.array(F.abs(F.col("l_quantity") - F.col("p0")), F.abs(F.col("l_discount") * 100 - F.col("p2") * 100))
    df = frames(spark, sf_dir).where("k > 0").select("l_orderkey", "k", F.posexplode(dims).alias("dim", "step"))
    top = df.groupBy("l_orderkey").agg(F.max(F.struct("step", (-F.col("k")).alias("mk"), (-F.col("dim")).alias("md"))).alias("m"))
    step = F.col("m.step")
    return top.select("l_orderkey", (-F.col("m.mk")).alias("frame"), (-F.col("m.md")).alias("dim"), r6(step).alias("step"), r6(step * 30).alias("per_s"), F.when(step > 35, "WARN").otherwise("PASS").alias("status"))


@query(f"""WITH {FR} SELECT l_orderkey, count(*) AS n, round(count(*) FILTER (WHERE l_discount = p2 AND l_tax = p3) / count(*), 6) AS frozen_ratio FROM f
  WHERE k > 0 GROUP BY l_orderkey""")
def frozen_ratio(spark, sf_dir):
    df = frames(spark, sf_dir).where("k > 0").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.expr("l_discount = p2 AND l_tax = p3")).alias("f"))
    return df.select("l_orderkey", "n", r6(F.col("f") / F.col("n")).alias("frozen_ratio"))


@query("""SELECT l_orderkey, min(l_discount) AS lo0, max(l_discount) AS hi0, min(l_tax) AS lo1, max(l_tax) AS hi1,
  CAST(max(l_discount) <> min(l_discount) AS BIGINT) + CAST(max(l_tax) <> min(l_tax) AS BIGINT) AS moving FROM lineitem GROUP BY l_orderkey""")
def effector_range(spark, sf_dir):
    """Range of each effector value, and how many move at all."""
    d, t = F.max("l_discount") != F.min("l_discount"), F.max("l_tax") != F.min("l_tax")
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").agg(
        F.min("l_discount").alias("lo0"), F.max("l_discount").alias("hi0"), F.min("l_tax").alias("lo1"), F.max("l_tax").alias("hi1"), (d.cast("long") + t.cast("long")).alias("moving")
    )


LAGS = """e AS (SELECT user_id, event_type, event_id, value AS action, lag(value) OVER w AS state FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
l AS (SELECT user_id, event_type, lag_k, abs(action - led) AS d FROM (SELECT user_id, event_type, action, unnest([0, 1, 2, 3, 4, 5]) AS lag_k, unnest([state, lead(state, 1) OVER w, lead(state, 2) OVER w, lead(state, 3) OVER w, lead(state, 4) OVER w, lead(state, 5) OVER w]) AS led FROM e WINDOW w AS (PARTITION BY user_id, event_type ORDER BY event_id))),
m AS (SELECT user_id, event_type, CAST(lag_k AS INTEGER) AS lag, avg(d) AS mad FROM l WHERE d IS NOT NULL GROUP BY ALL)"""


@query(f"""WITH {LAGS}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY mad, lag) AS i FROM m) SELECT user_id AS bag_id,
  event_type AS topic, lag, round(mad, 6) AS mad, i = 1 AS is_best FROM r""")
def best_lag(spark, sf_dir):
    """Mean distance of action[t] and state[t + lag]; of equal ones the smallest lag is best."""
    by = W.partitionBy("user_id", "event_type")
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("state", F.lag("value").over(by.orderBy("ts", "event_id")))
    led = F.array(F.col("state"), *[F.lead("state", i).over(by.orderBy("event_id")) for i in range(1, 6)])
    df = e.select("user_id", "event_type", "value", led.alias("led")).select("user_id", "event_type", "value", F.posexplode("led").alias("lag", "s")).where("s IS NOT NULL AND value IS NOT NULL")
    m = df.groupBy("user_id", "event_type", "lag").agg(F.avg(F.abs(F.col("value") - F.col("s"))).alias("mad"))
    best = F.row_number().over(by.orderBy("mad", "lag")) == 1
    return m.select(F.col("user_id").alias("bag_id"), F.col("event_type").alias("topic"), "lag", r6(F.col("mad")).alias("mad"), best.alias("is_best"))


#: Frames sampled from an episode, and the values that stand for a frame's pixels.
SAMPLES = 4
PIXELS = "[l_quantity, l_discount * 100, l_tax * 100, CAST(l_partkey % 3 AS DOUBLE)]"


@query(f"""WITH {FR}, n AS (SELECT l_orderkey, k, count(*) OVER (PARTITION BY l_orderkey) AS n, {PIXELS} AS p FROM f),
s AS (SELECT *, list_avg(p) AS mean, list_stddev_pop(p) AS std, lag(p) OVER (PARTITION BY l_orderkey ORDER BY k) AS before
  FROM n WHERE list_contains(list_transform(range(0, {SAMPLES}), lambda i: CAST(trunc(i * (n - 1) / {SAMPLES - 1}) AS BIGINT)), k))
SELECT l_orderkey, count(*) AS sampled, round(avg(mean), 6) AS mean, round(min(std), 6) AS min_std, count(*) FILTER (WHERE std < 1) AS blank, count(*) FILTER (WHERE p = before) AS same_as_before
FROM s GROUP BY l_orderkey""")
def frame_sample_stats(spark, sf_dir):
    """Frames spread over the episode (places truncated, repeats once): means, least deviation, blank ones, repeats."""
    df = frames(spark, sf_dir).withColumn("n", F.count("*").over(W.partitionBy("l_orderkey")))
    places = F.array(*[F.floor(F.lit(i) * (F.col("n") - 1) / (SAMPLES - 1)) for i in range(SAMPLES)])
    pixels = F.array("l_quantity", F.col("l_discount") * 100, F.col("l_tax") * 100, (F.col("l_partkey") % 3).cast("double"))
    df = df.where(F.array_contains(places, F.col("k"))).select("l_orderkey", "k", pixels.alias("p"))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.size("p")
    df = df.withColumn("mean", total(F.col("p")))
    df = df.withColumn("std", F.sqrt(total(F.transform("p", lambda x: (x - F.col("mean")) * (x - F.col("mean"))))))
    df = df.withColumn("before", F.lag("p").over(W.partitionBy("l_orderkey").orderBy("k")))
    counts = F.count_if(F.col("std") < 1).alias("blank"), F.count_if(F.col("p") == F.col("before")).alias("same_as_before")
    return df.groupBy("l_orderkey").agg(F.count("*").alias("sampled"), r6(F.avg("mean")).alias("mean"), r6(F.min("std")).alias("min_std"), *counts)


IDX = """c AS (SELECT l_orderkey AS episode, count(*) AS length, list_sort(list(DISTINCT l_returnflag)) AS tasks, l_orderkey // 100 // 50 AS chunk, l_orderkey // 100 % 50 AS file
  FROM lineitem GROUP BY l_orderkey)"""
def indexed(rows: DataFrame) -> DataFrame:
    """One row an episode from frames (episode, task, chunk, file): length, tasks, shard, and frame offsets in the order of episodes.

    Many episodes are cut into buckets; only bucket totals meet in one place.
    """
    one = rows.groupBy("episode").agg(F.count("*").alias("length"), F.sort_array(F.collect_set("task")).alias("tasks"), F.min("chunk").alias("chunk"), F.min("file").alias("file"))
    one = cut(one.withColumn("t", F.col("episode").cast("long")).withColumn("seq", F.col("episode").cast("long")))
    df = running_sum(one, [], "length", "to_idx").drop("t", "seq")
    return df.withColumn("from_idx", F.col("to_idx") - F.col("length"))


def episode_frames(spark, sf_dir) -> DataFrame:
    shard = F.floor(F.col("l_orderkey") / 100)
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("episode"), F.col("l_returnflag").alias("task"), F.floor(shard / 50).alias("chunk"), (shard % 50).alias("file"))


@query(f"""WITH {IDX} SELECT episode, length, tasks, chunk, file, CAST(sum(length) OVER (ORDER BY episode) - length AS BIGINT) AS from_idx, CAST(sum(length) OVER (ORDER BY episode) AS BIGINT) AS to_idx FROM c""")
def episode_index(spark, sf_dir):
    """The index of a dataset's episodes rebuilt from their frames."""
    return indexed(episode_frames(spark, sf_dir))


STATS = ", ".join(f"round(min({d}), 6) AS {d}_min, round(max({d}), 6) AS {d}_max, round(avg({d}), 4) AS {d}_mean, round(stddev_pop({d}), 4) AS {d}_std" for d in ("l_quantity", "l_discount"))


@query(f"SELECT l_returnflag, l_linestatus, count(*) AS n, {STATS} FROM lineitem GROUP BY ALL")
def feature_stats(spark, sf_dir):
    """Per-episode moments merged to statistics of the whole dataset's parts."""
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    one = []
    for d in ("l_quantity", "l_discount"):
        one += [F.min(d).alias(f"{d}_lo"), F.max(d).alias(f"{d}_hi"), F.avg(d).alias(f"{d}_m"), F.var_pop(d).alias(f"{d}_v")]
    ep = df.groupBy("l_returnflag", "l_linestatus", "l_orderkey").agg(F.count("*").alias("c"), *one)
    out = []
    for d in ("l_quantity", "l_discount"):
        mean = F.sum(F.col("c") * F.col(f"{d}_m")) / F.sum("c")
        second = F.sum(F.col("c") * (F.col(f"{d}_v") + F.col(f"{d}_m") * F.col(f"{d}_m"))) / F.sum("c")
        out += [r6(F.min(f"{d}_lo")).alias(f"{d}_min"), r6(F.max(f"{d}_hi")).alias(f"{d}_max"), half_up(mean, 4).alias(f"{d}_mean"), half_up(F.sqrt(second - mean * mean), 4).alias(f"{d}_std")]
    return ep.groupBy("l_returnflag", "l_linestatus").agg(F.sum("c").alias("n"), *out)


@query(f"""WITH {IDX}, o AS (SELECT o_orderkey AS episode, o_orderpriority AS task, o_orderstatus AS source FROM orders)
SELECT source, episode, length, dense_rank() OVER (ORDER BY task) - 1 AS task_index, row_number() OVER (ORDER BY source, episode) - 1 AS episode_index FROM c JOIN o USING (episode)""")
def merge_datasets(spark, sf_dir):
    """Datasets concatenated: episodes numbered anew, tasks deduplicated; a row for each dataset and each task meets in one place."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("episode"), F.col("o_orderpriority").alias("task"), F.col("o_orderstatus").alias("source"))
    lengths = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(F.col("l_orderkey").alias("episode")).agg(F.count("*").alias("length"))
    df = cut(lengths.join(o, "episode").withColumn("t", F.col("episode")).withColumn("seq", F.col("episode")))
    tasks = df.select("task").distinct().withColumn("task_index", (F.row_number().over(W.orderBy("task")) - 1).cast("long"))
    base = running_offsets(df.groupBy("source").agg(F.count("*").alias("c")), [], ["source"], "c").select("source", F.col("from_idx").alias("base"))
    df = numbered(df, ["source"], "place").join(tasks, "task").join(base, "source")
    return df.select("source", "episode", "length", "task_index", (F.col("base") + F.col("place")).alias("episode_index"))


@query("""WITH c AS (SELECT o_orderstatus AS source, o_orderkey AS episode, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
SELECT source, episode, CASE WHEN i <= floor(0.8 * n) THEN 'train' WHEN i <= floor(0.9 * n) THEN 'val' ELSE 'test' END AS split FROM c""")
def split_episodes(spark, sf_dir):
    """Sequential splits by ratio: an episode's place comes from its bucket's offset."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderstatus").alias("source"), F.col("o_orderkey").alias("episode"))
    df = numbered(o.withColumn("t", F.col("episode")).withColumn("seq", F.col("episode")), ["source"], "i")
    df = df.join(o.groupBy("source").agg(F.count("*").alias("n")), "source")
    i = F.col("i") + 1
    return df.select("source", "episode", F.when(i <= F.floor(0.8 * F.col("n")), "train").when(i <= F.floor(0.9 * F.col("n")), "val").otherwise("test").alias("split"))


@query(f"""WITH {FR} SELECT l_orderkey, count(*) AS n, max(k) + 1 = count(*) AS whole, bool_and(l_discount IS NOT DISTINCT FROM l_tax) AS action_equals_state,
  count(*) FILTER (WHERE l_quantity IS NULL OR isnan(l_quantity)) AS bad_values FROM f GROUP BY l_orderkey""")
def episode_validate(spark, sf_dir):
    df = frames(spark, sf_dir)
    bad = F.count_if(F.col("l_quantity").isNull() | F.isnan("l_quantity"))
    return df.groupBy("l_orderkey").agg(F.count("*").alias("n"), (F.max("k") + 1 == F.count("*")).alias("whole"), F.bool_and(F.col("l_discount").eqNullSafe(F.col("l_tax"))).alias("action_equals_state"), bad.alias("bad_values"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, [l_quantity, l_tax] AS picked FROM lineitem")
def array_pick(spark, sf_dir):
    """A payload's values by index; a short payload is an error."""
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", F.array(*DIMS).alias("payload"))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", F.transform(F.array(F.lit(0), F.lit(3)), lambda i: F.element_at("payload", i + 1)).alias("picked"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, [l_tax, l_quantity, l_discount] AS positions FROM lineitem")
def reorder_joints(spark, sf_dir):
    """Values by name in the expected order; a missing name is an error."""
    names = F.array(*[F.lit(d) for d in DIMS])
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", F.map_from_arrays(names, F.array(*DIMS)).alias("m"))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", F.transform(F.array(F.lit("l_tax"), F.lit("l_quantity"), F.lit("l_discount")), lambda n: F.element_at("m", n)).alias("positions"))


@query(f"WITH {FR} SELECT l_orderkey, k, coalesce(lead(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY k), l_quantity) AS action FROM f")
def shift_copy(spark, sf_dir):
    """Actions are the next frame's state; the last frame keeps its own."""
    nxt = F.lead("l_quantity").over(W.partitionBy("l_orderkey").orderBy("k"))
    return frames(spark, sf_dir).select("l_orderkey", "k", F.coalesce(nxt, F.col("l_quantity")).alias("action"))


MOT = """e AS (SELECT user_id AS motor, value * 10 AS pos, lag(value * 10) OVER (PARTITION BY user_id ORDER BY ts) AS before, ts FROM events WHERE value * 10 > 0 AND value * 10 < 5000)"""


@query(f"""WITH {MOT} SELECT motor, min(pos) AS low, max(pos) AS high, arg_max(pos, ts) AS current, count(*) FILTER (WHERE abs(pos - before) > 2000) AS jumps,
  min(pos) = max(pos) OR count(*) FILTER (WHERE abs(pos - before) > 2000) > 0 AS bad FROM e GROUP BY motor""")
def range_calibration(spark, sf_dir):
    """Range of each motor over sane positions; a jump or no range at all is an error."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("motor"), (F.col("value") * 10).alias("pos"), "ts").where("pos > 0 AND pos < 5000")
    e = e.withColumn("jump", F.abs(F.col("pos") - F.lag("pos").over(W.partitionBy("motor").orderBy("ts"))) > 2000)
    jumps = F.count_if("jump")
    return e.groupBy("motor").agg(F.min("pos").alias("low"), F.max("pos").alias("high"), F.max_by("pos", "ts").alias("current"), jumps.alias("jumps"), ((F.min("pos") == F.max("pos")) | (jumps > 0)).alias("bad"))


STATUS = f"""WITH {FR}, s AS (SELECT l_orderkey, k, l_discount AS a0, l_tax AS a1, coalesce(p2, l_discount) AS s0, coalesce(p3, l_tax) AS s1, abs(l_quantity - p0) AS step,
  k > 0 AND l_discount = p2 AND l_tax = p3 AS frozen, {PIXELS} AS p FROM f),
g AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE a0 = s0 AND a1 = s1) AS same, count(*) FILTER (WHERE frozen) AS frozen, max(step) AS step,
  count(*) FILTER (WHERE p[1] IS NULL OR isnan(p[1])) AS bad, CAST(min(a0) = max(a0) AS INT) + CAST(min(a1) = max(a1) AS INT) AS dead, count(*) FILTER (WHERE list_stddev_pop(p) < 1) AS blank FROM s GROUP BY l_orderkey)"""
#: Limits of an episode: frames, share of frozen rows, step of the arm.
LEAST_FRAMES, FROZEN, STEP = 2, 0.5, 45.0


@query(f"""{STATUS} SELECT l_orderkey, n, CASE WHEN n < {LEAST_FRAMES} OR bad > 0 OR same = n THEN 'FAIL' WHEN dead > 0 OR blank > 0 OR step > {STEP} OR frozen > {FROZEN} * (n - 1) THEN 'WARN' ELSE 'PASS' END AS status,
  CASE WHEN n < {LEAST_FRAMES} THEN 'too_few_frames' WHEN bad > 0 THEN 'not_finite' WHEN same = n THEN 'action_is_state' WHEN dead > 0 THEN 'dead_dimension' WHEN blank > 0 THEN 'blank_frames'
  WHEN step > {STEP} THEN 'large_step' WHEN frozen > {FROZEN} * (n - 1) THEN 'frozen_state' END AS issue FROM g""")
def episode_status(spark, sf_dir):
    """The verdict of an episode from its arrays and images, with the gravest issue."""
    df = frames(spark, sf_dir)
    a, s = (F.col("l_discount"), F.col("l_tax")), (F.coalesce("p2", "l_discount"), F.coalesce("p3", "l_tax"))
    pixels = F.array("l_quantity", F.col("l_discount") * 100, F.col("l_tax") * 100, (F.col("l_partkey") % 3).cast("double"))
    mean = F.aggregate(pixels, F.lit(0.0), lambda t, x: t + x) / 4
    var = F.aggregate(pixels, F.lit(0.0), lambda t, x: t + (x - mean) * (x - mean)) / 4
    dead = (F.min(a[0]) == F.max(a[0])) | (F.min(a[1]) == F.max(a[1]))
    g = df.groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.count_if((a[0] == s[0]) & (a[1] == s[1])).alias("same"), F.count_if(F.expr("k > 0 AND l_discount = p2 AND l_tax = p3")).alias("frozen"),
        F.max(F.abs(F.col("l_quantity") - F.col("p0"))).alias("step"), F.count_if(F.col("l_quantity").isNull() | F.isnan("l_quantity")).alias("bad"), dead.alias("dead"), F.count_if(F.sqrt(var) < 1).alias("blank"),
    )
    fails = [(F.col("n") < LEAST_FRAMES, "too_few_frames"), (F.col("bad") > 0, "not_finite"), (F.col("same") == F.col("n"), "action_is_state")]
    warns = [(F.col("dead"), "dead_dimension"), (F.col("blank") > 0, "blank_frames"), (F.col("step") > STEP, "large_step"), (F.col("frozen") > FROZEN * (F.col("n") - 1), "frozen_state")]
    issue, status = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for level, rules in (("FAIL", fails), ("WARN", warns)):
        for rule, name in rules:
            issue, status = issue.when(rule, name), status.when(rule, level)
    return g.select("l_orderkey", "n", status.otherwise("PASS").alias("status"), issue.alias("issue"))
