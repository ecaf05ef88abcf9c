"""Dataset catalogs, nodes, files, profiles and messages: functions of tables, run over whole tables.

Each table is derived from a test table by an expression that both SQL dialects read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cdr
from ..functions.logs import group
from ..operators.packing import next_fit
from ..operators.sequence import running_sum
from ..sources.streams import literal
from .registry import query, values


def derived(spark, sf_dir, table: str, columns: str) -> DataFrame:
    """The columns of an expression list over a table; exploded, so that what reads them doesn't repeat their expressions."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(F.explode(F.array(F.expr(f"struct({columns})"))).alias("r")).select("r.*")


# --- catalogs -------------------------------------------------------------------

HUB = "'org/' || CAST(o_custkey AS STRING) AS repo_id, CAST(2000 + o_custkey % 20 AS STRING) || '-05-01T10:00:00' AS ts, o_custkey % 3 = 0 AS private"
LOCAL = "'org/' || CAST(c_custkey AS STRING) AS repo_id, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(2000 + c_nationkey AS STRING) || '-06-01T00:00:00' END AS ts"
NAS = "CASE WHEN s_suppkey % 2 = 0 THEN 'org/' ELSE 'lab/' END || CAST(s_suppkey AS STRING) AS repo_id, CAST(1998 + s_nationkey AS STRING) || '-02-02T00:00:00' AS ts"


def merged(hub: DataFrame, local: DataFrame, shared: DataFrame) -> DataFrame:
    """repo_id, source, last_modified, private: hub and local datasets are ``both`` where they meet; shared storage overrides the source.

    The newest of the times counts.  Repeated hub entries count once.
    """
    h = hub.select("repo_id", F.col("ts").alias("h"), "private").distinct()
    df = h.join(local.select("repo_id", F.col("ts").alias("l"), F.lit(True).alias("in_local")), "repo_id", "full")
    df = df.join(shared.select("repo_id", F.col("ts").alias("n"), F.lit(True).alias("in_nas")), "repo_id", "full")
    in_hub = F.col("private").isNotNull()
    source = F.when(F.col("in_nas"), "nas").when(in_hub & F.col("in_local"), "both").when(in_hub, "hub").otherwise("local")
    return df.select("repo_id", source.alias("source"), F.greatest("h", "l", "n").alias("last_modified"), F.coalesce("private", F.lit(False)).alias("private"))


@query(f"""WITH h AS (SELECT DISTINCT {HUB} FROM orders), l AS (SELECT {LOCAL} FROM customer), n AS (SELECT {NAS} FROM supplier),
m AS (SELECT repo_id, CASE WHEN h.repo_id IS NOT NULL AND l.repo_id IS NOT NULL THEN 'both' WHEN h.repo_id IS NOT NULL THEN 'hub' ELSE 'local' END AS source,
  greatest(h.ts, l.ts) AS ts, private FROM h FULL JOIN l USING (repo_id))
SELECT repo_id, CASE WHEN n.repo_id IS NOT NULL THEN 'nas' ELSE source END AS source, greatest(m.ts, n.ts) AS last_modified, coalesce(private, false) AS private
FROM m FULL JOIN n USING (repo_id)""")
def catalog_merge(spark, sf_dir):
    return merged(*(derived(spark, sf_dir, t, c) for t, c in (("orders", HUB), ("customer", LOCAL), ("supplier", NAS))))


# --- nodes ----------------------------------------------------------------------

NODE = """s_suppkey AS node, CASE s_suppkey % 6 WHEN 0 THEN 'idle*' WHEN 1 THEN 'ALLOCATED' WHEN 2 THEN NULL ELSE 'idle' END AS state,
 '24000, ' || CAST(10000 + s_suppkey * 3700 % 14000 AS STRING) || ', ' || CAST(CASE WHEN s_suppkey % 5 = 0 THEN 2 ELSE 0 END AS STRING) AS gpu"""
#: What is asked of a node: the preferred one, excluded ones, least free memory in MB.
PREFERRED, EXCLUDED, LEAST_MB = 3, (4, 9), 12000
NODE_SQL = f"""s AS (SELECT node, coalesce(rtrim(lower(state), '*'), 'unknown') AS state, CAST(trim(string_split(gpu, ',')[1]) AS BIGINT) AS total_mb,
  CAST(trim(string_split(gpu, ',')[2]) AS BIGINT) AS free_mb, CAST(trim(string_split(gpu, ',')[3]) AS BIGINT) AS procs FROM (SELECT {NODE} FROM supplier)),
e AS (SELECT *, CASE WHEN node IN {EXCLUDED} THEN 'excluded' WHEN state <> 'idle' THEN 'state ' || state WHEN procs > 0 THEN 'busy' WHEN free_mb < {LEAST_MB} THEN 'memory' ELSE '' END AS reason FROM s)"""


def node_states(rows: DataFrame) -> DataFrame:
    """node, state, total_mb, free_mb, procs of a node listing; an unknown state is ``unknown``, a trailing * is dropped."""
    p = lambda i: F.trim(F.get(F.split("gpu", ","), i)).cast("long")
    state = F.coalesce(F.rtrim(F.lower("state"), F.lit("*")), F.lit("unknown"))
    return rows.select("node", state.alias("state"), p(0).alias("total_mb"), p(1).alias("free_mb"), p(2).alias("procs"))


def eligible(nodes: DataFrame, excluded=(), least_mb: int = 0) -> DataFrame:
    """``nodes`` with eligible and the first reason against it."""
    reason = F.when(F.col("node").isin(*excluded), "excluded").when(F.col("state") != "idle", F.concat(F.lit("state "), F.col("state")))
    reason = reason.when(F.col("procs") > 0, "busy").when(F.col("free_mb") < least_mb, "memory").otherwise("")
    return nodes.withColumn("reason", reason).withColumn("eligible", F.col("reason") == "")


def nodes(spark, sf_dir) -> DataFrame:
    return eligible(node_states(derived(spark, sf_dir, "supplier", NODE)), EXCLUDED, LEAST_MB)


@query(f"WITH {NODE_SQL} SELECT node, state, total_mb, free_mb, procs FROM e")
def parse_node_states(spark, sf_dir):
    return nodes(spark, sf_dir).select("node", "state", "total_mb", "free_mb", "procs")


@query(f"WITH {NODE_SQL} SELECT node, reason = '' AS eligible, reason FROM e")
def node_eligible(spark, sf_dir):
    return nodes(spark, sf_dir).select("node", "eligible", "reason")


@query(f"WITH {NODE_SQL} SELECT node, free_mb FROM e WHERE reason = '' ORDER BY node = {PREFERRED} DESC, free_mb DESC, node LIMIT 1")
def select_node(spark, sf_dir):
    """The preferred node if it is eligible, else the one with most free memory."""
    return nodes(spark, sf_dir).where("eligible").orderBy((F.col("node") == PREFERRED).desc(), F.desc("free_mb"), "node").limit(1).select("node", "free_mb")


PROC = """l_suppkey AS node, CASE l_partkey % 9 WHEN 0 THEN '/usr/lib/xorg/Xorg' WHEN 1 THEN 'gnome-shell' WHEN 2 THEN 'python train.py' WHEN 3 THEN NULL WHEN 4 THEN '/opt/google/chrome' WHEN 5 THEN '/usr/share/code/code' WHEN 6 THEN 'RustDesk' WHEN 7 THEN 'blender' ELSE 'firefox' END AS name"""
#: Parts of the names of a desktop's processes.
DESKTOP = "xorg|x11|gnome|kde|plasma|compiz|rustdesk|teamviewer|anydesk|parsec|awesun|code|chrome|firefox|edge|safari|clash|v2ray|sunlogin"


@query(f"""SELECT node, count(*) FILTER (WHERE NOT regexp_matches(lower(coalesce(name, '')), '{DESKTOP}')) AS compute FROM (SELECT {PROC} FROM lineitem)
  GROUP BY node""")
def gpu_process_filter(spark, sf_dir):
    """Processes that aren't a desktop's; lines without a name count."""
    own = ~F.lower(F.coalesce("name", F.lit(""))).rlike(DESKTOP)
    return derived(spark, sf_dir, "lineitem", PROC).groupBy("node").agg(F.count_if(own).alias("compute"))


# --- configuration --------------------------------------------------------------

EPISODE = "'ep' || CAST(o_orderkey AS STRING) AS name, '/x/' || CAST(o_custkey AS STRING) AS path"
TASK = "CASE WHEN c_custkey % 2 = 0 THEN 'ep' ELSE '/x/' END || CAST(c_custkey AS STRING) AS k, c_mktsegment AS task"


@query(f"""WITH e AS (SELECT {EPISODE} FROM orders), m AS (SELECT {TASK} FROM customer)
SELECT name, coalesce(a.task, b.task, 'default') AS task FROM e LEFT JOIN m a ON a.k = e.name LEFT JOIN m b ON b.k = e.path""")
def task_lookup(spark, sf_dir):
    """An episode's task by its name, else by its path, else the default."""
    e, m = derived(spark, sf_dir, "orders", EPISODE), derived(spark, sf_dir, "customer", TASK)
    df = e.join(m.withColumnsRenamed({"k": "name", "task": "a"}), "name", "left").join(m.withColumnsRenamed({"k": "path", "task": "b"}), "path", "left")
    return df.select("name", F.coalesce("a", "b", F.lit("default")).alias("task"))


LAYER = """o_orderkey AS name, CASE WHEN o_orderkey % 3 = 0 THEN 'c' || CAST(o_custkey AS STRING) END AS cli, CASE WHEN o_orderkey % 2 = 0 THEN 'r' || CAST(o_custkey AS STRING) END AS recipe,
 CASE WHEN o_orderkey % 5 > 0 THEN 'd' END AS preset"""


@query(f"""SELECT name, coalesce(cli, recipe, preset) AS value, CASE WHEN cli IS NOT NULL THEN 'cli' WHEN recipe IS NOT NULL THEN 'recipe' ELSE 'default' END AS origin
FROM (SELECT {LAYER} FROM orders)""")
def config_layering(spark, sf_dir):
    """A setting that was given, else the recipe's, else the default."""
    origin = F.when(F.col("cli").isNotNull(), "cli").when(F.col("recipe").isNotNull(), "recipe").otherwise("default")
    return derived(spark, sf_dir, "orders", LAYER).select("name", F.coalesce("cli", "recipe", "preset").alias("value"), origin.alias("origin"))


# --- files ----------------------------------------------------------------------

FILE = """CASE l_linenumber % 5 WHEN 0 THEN 'meta/' WHEN 1 THEN 'videos/head/' WHEN 2 THEN 'videos/wrist/' WHEN 3 THEN 'data/' ELSE '' END || 'f' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
 || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS path, CAST(l_quantity AS BIGINT) * 1000 + l_partkey AS bytes, l_orderkey % 1000 AS mtime"""
FILES = f"f AS (SELECT path, max(bytes) AS bytes, min(mtime) AS mtime FROM (SELECT {FILE} FROM lineitem) GROUP BY path)"


def files(spark, sf_dir) -> DataFrame:
    """path, bytes, mtime of a listing; a path is there once."""
    return derived(spark, sf_dir, "lineitem", FILE).groupBy("path").agg(F.max("bytes").alias("bytes"), F.min("mtime").alias("mtime"))


@query(f"WITH {FILES} SELECT path, mtime FROM f ORDER BY mtime, path LIMIT 30")
def sort_limit(spark, sf_dir):
    return files(spark, sf_dir).orderBy("mtime", "path").limit(30).select("path", "mtime")


@query(f"""WITH {FILES} SELECT CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) ELSE '.' END AS branch, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM f GROUP BY ALL""")
def layout_summary(spark, sf_dir):
    branch = F.when(F.col("path").contains("/"), F.split_part("path", F.lit("/"), F.lit(1))).otherwise(".")
    return files(spark, sf_dir).groupBy(branch.alias("branch")).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


#: Cached entries of a node, and the bytes that have to be free.
ENTRY = "o_orderstatus AS node, o_orderkey AS entry, CAST(floor(o_totalprice) AS BIGINT) AS bytes, CASE WHEN o_orderkey % 50 > 0 THEN o_custkey % 300 END AS mtime"
NEEDED = 5_000_000


def evicted(entries: DataFrame, needed: int) -> DataFrame:
    """node, entry, bytes of each node's oldest entries until ``needed`` bytes are free; entries without a time go first."""
    rows = entries.withColumn("t", F.coalesce("mtime", F.lit(-1)).cast("long")).withColumn("seq", F.col("entry"))
    rows = running_sum(rows, ["node"], "bytes", "upto")
    return rows.where(F.col("upto") - F.col("bytes") < needed).select("node", "entry", "bytes")


@query(f"""WITH f AS (SELECT {ENTRY} FROM orders), g AS (SELECT *, sum(bytes) OVER (PARTITION BY node ORDER BY coalesce(mtime, -1), entry) AS upto FROM f)
SELECT node, entry, bytes FROM g WHERE upto - bytes < {NEEDED}""")
def lru_evict(spark, sf_dir):
    return evicted(derived(spark, sf_dir, "orders", ENTRY), NEEDED)


@query("SELECT o_orderkey AS job_id, o_orderdate AS started_at FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10")
def recent_jobs(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(10).select(F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").alias("started_at"))


SHARD = """'data/' || CASE l_linenumber % 4 WHEN 0 THEN 'other' || CAST(l_partkey AS STRING) WHEN 1 THEN 'chunk-' || lpad(CAST(l_partkey % 20 AS STRING), 3, '0') || '/file-' || lpad(CAST(l_suppkey % 90 AS STRING), 3, '0')
 ELSE 'chunk-' || CAST(l_partkey % 20 AS STRING) || '/file-' || CAST(l_suppkey % 90 AS STRING) END || '.parquet' AS path"""


@query(f"""SELECT DISTINCT path, TRY_CAST(nullif(regexp_extract(path, 'chunk-(\\d+)/file-(\\d+)', 1), '') AS BIGINT) AS chunk,
  TRY_CAST(nullif(regexp_extract(path, 'chunk-(\\d+)/file-(\\d+)', 2), '') AS BIGINT) AS file FROM (SELECT {SHARD} FROM lineitem)""")
def chunk_file(spark, sf_dir):
    p = r"chunk-(\d+)/file-(\d+)"
    shards = derived(spark, sf_dir, "lineitem", SHARD).distinct()
    return shards.select("path", group(F.col("path"), p, 1).cast("long").alias("chunk"), group(F.col("path"), p, 2).cast("long").alias("file"))


PROBE = "o_custkey AS dataset, o_orderkey AS pos, CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS broken"


def usable(shards: DataFrame) -> DataFrame:
    """``shards`` (dataset, pos, broken) with usable: those before the first broken one; later ones are unusable too."""
    first = shards.groupBy("dataset").agg(F.min(F.when(F.col("broken") == 1, F.col("pos"))).alias("first"))
    return shards.join(first, "dataset").select("dataset", "pos", (F.col("first").isNull() | (F.col("pos") < F.col("first"))).alias("usable"))


@query(f"""WITH s AS (SELECT {PROBE} FROM orders), f AS (SELECT dataset, min(pos) FILTER (WHERE broken = 1) AS first FROM s GROUP BY dataset)
SELECT dataset, pos, first IS NULL OR pos < first AS usable FROM s JOIN f USING (dataset)""")
def usable_shards(spark, sf_dir):
    return usable(derived(spark, sf_dir, "orders", PROBE))


def upload_group(path: Column) -> Column:
    """The part of a dataset that a file is uploaded with: videos and images by camera, others by top folder."""
    one, two = F.substring_index(path, "/", 1), F.substring_index(path, "/", 2)
    return F.when(one.isin("videos", "images") & (two != path), two).when(path.contains("/"), one).otherwise(".")


#: Files and bytes of an upload batch at most.
BATCH_FILES, BATCH_BYTES = 50, 2_000_000


def upload_batches(listing: DataFrame) -> DataFrame:
    """path, key, batch, last: next fit of each group's files by path; ``last`` marks metadata, which makes a dataset look complete.

    A path that is listed more than once is one file, of the most bytes.
    """
    rows = listing.select("path", "bytes", upload_group(F.col("path")).alias("grp"))
    out = next_fit(rows, ["grp"], "path", "bytes", float(BATCH_BYTES), BATCH_FILES, repeats=True, offsets=False)
    return out.select("path", F.col("grp").alias("key"), F.col("bin").alias("batch"), (F.col("grp") == "meta").alias("last"))


@query(f"""WITH RECURSIVE {FILES}, p AS (SELECT path, bytes, string_split(path, '/') AS d FROM f),
g AS (SELECT path, bytes, CASE WHEN len(d) > 2 AND d[1] IN ('videos', 'images') THEN d[1] || '/' || d[2] WHEN len(d) > 1 THEN d[1] ELSE '.' END AS key FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY path) AS i FROM g),
w AS (SELECT key, path, i, 0 AS batch, 1 AS n, CAST(bytes AS BIGINT) AS size FROM r WHERE i = 1 UNION ALL
  SELECT key, path, i, batch + CAST(opens AS INT), CASE WHEN opens THEN 1 ELSE n + 1 END, CASE WHEN opens THEN bytes ELSE size + bytes END
  FROM (SELECT r.key, r.path, r.i, r.bytes, w.batch, w.n, w.size, w.n >= {BATCH_FILES} OR w.size + r.bytes > {BATCH_BYTES} AS opens FROM w JOIN r ON r.key = w.key AND r.i = w.i + 1))
SELECT path, key, batch, key = 'meta' AS last FROM w""")
def pack_batches(spark, sf_dir):
    """Upload batches of a file listing."""
    return upload_batches(derived(spark, sf_dir, "lineitem", FILE))


#: Seconds of a video file, with a frame's tolerance.
VIDEO_S = 300.0 + 1 / 30


def video_windows(rows: DataFrame, by: str, order: str, length: str, cap: float, n_files: Column) -> DataFrame:
    """``rows`` that the key's ``n_files`` video files of ``cap`` seconds cover, with file, start and end.

    Rows are laid end to end in order; one that no longer fits opens the next file.  A row that
    fits no file uses up all of them: it and all after it are not covered.
    """
    lost = rows.where(F.col(length) > cap).groupBy(by).agg(F.min(order).alias("_lost"))
    fits = rows.join(lost, by, "left").where(F.col("_lost").isNull() | (F.col(order) < F.col("_lost"))).drop("_lost")
    out = next_fit(fits, [by], order, length, cap).where(F.col("bin") < n_files)
    return out.select(by, order, F.col("bin").alias("file"), F.round("offset", 6).alias("start_s"), F.round(F.col("offset") + F.col(length), 6).alias("end_s"))


@query(f"""WITH RECURSIVE r AS (SELECT user_id AS dataset, event_id, abs(value) AS length, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
w AS (SELECT dataset, event_id, i, length, 0 AS file, CAST(0 AS DOUBLE) AS start FROM r WHERE i = 1 AND length <= {VIDEO_S} UNION ALL
  SELECT dataset, event_id, i, length, file + CAST(opens AS INT), CASE WHEN opens THEN 0 ELSE past END
  FROM (SELECT r.*, w.file, w.start + w.length AS past, w.start + w.length + r.length > {VIDEO_S} AS opens FROM w JOIN r ON r.dataset = w.dataset AND r.i = w.i + 1) WHERE length <= {VIDEO_S})
SELECT dataset, event_id, file, round(start, 6) AS start_s, round(start + length, 6) AS end_s FROM w WHERE file < 5 + dataset % 40""")
def assign_videos(spark, sf_dir):
    """Episodes laid onto their dataset's video files of 300 s in order."""
    df = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("dataset"), "event_id", F.abs("value").alias("length"))
    return video_windows(df, "dataset", "event_id", "length", VIDEO_S, 5 + F.col("dataset") % 40)


# --- profiles -------------------------------------------------------------------

#: A profile is a small table of its own.
TIERS = [("view", "required"), ("click", "required"), ("purchase", "required"), ("purchase", "fillable"), ("error", "required"), ("error", "optional"), ("lidar", "required")]


@query(f"""WITH t AS {values(TIERS, "topic, tier")}, s AS (SELECT DISTINCT event_type AS topic FROM events),
e AS (SELECT topic FROM t WHERE tier = 'required' EXCEPT SELECT topic FROM t WHERE tier <> 'required')
SELECT topic, 'essential' AS kind FROM e UNION ALL SELECT topic, 'wanted_and_seen' FROM (SELECT DISTINCT topic FROM t INTERSECT SELECT topic FROM s)""")
def topic_tiers(spark, sf_dir):
    t = literal(spark, "topic string, tier string", TIERS)
    seen = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("topic")).distinct()
    essential = t.where("tier = 'required'").select("topic").subtract(t.where("tier <> 'required'").select("topic"))
    return essential.withColumn("kind", F.lit("essential")).unionByName(t.select("topic").intersect(seen).withColumn("kind", F.lit("wanted_and_seen")))


CAMERA = "l_orderkey AS episode, CASE WHEN l_linenumber % 2 = 0 THEN 'declared' ELSE 'recorded' END AS side, 'cam' || CAST(l_partkey % 5 AS STRING) AS camera"


@query(f"SELECT episode, camera, min(side) AS only_in FROM (SELECT {CAMERA} FROM lineitem) GROUP BY episode, camera HAVING count(DISTINCT side) = 1")
def camera_mismatch(spark, sf_dir):
    """Cameras of an episode that are only declared or only recorded."""
    one = derived(spark, sf_dir, "lineitem", CAMERA).groupBy("episode", "camera").agg(F.min("side").alias("only_in"), F.max("side").alias("other"))
    return one.where("only_in = other").drop("other")


# --- texts and numbers ----------------------------------------------------------

AMOUNT = "o_orderkey AS id, o_orderkey * 7 % 100000 AS s, o_orderkey * o_orderkey * 11 AS b"


@query(f"""SELECT id, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's'
  ELSE (s // 3600) || 'h' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm' END AS span,
  CASE WHEN b < 1024 THEN b || ' B' WHEN b < 1048576 THEN round(b / 1024, 1) || ' KiB' WHEN b < 1073741824 THEN round(b / 1048576, 1) || ' MiB' ELSE round(b / 1073741824, 1) || ' GiB' END AS size
FROM (SELECT {AMOUNT} FROM orders)""")
def format_units(spark, sf_dir):
    s, b = F.col("s"), F.col("b")
    two = lambda c: F.lpad(c.cast("long").cast("string"), 2, "0")
    whole = lambda c: F.floor(c).cast("string")
    minutes = F.concat(whole(s / 60), F.lit("m"), two(s % 60), F.lit("s"))
    hours = F.concat(whole(s / 3600), F.lit("h"), two(F.floor(s % 3600 / 60)), F.lit("m"))
    span = F.when(s < 60, F.concat(s.cast("string"), F.lit("s"))).when(s < 3600, minutes).otherwise(hours)
    size = F.when(b < 1024, F.concat(b.cast("string"), F.lit(" B")))
    for limit, unit, name in ((2**20, 2**10, "KiB"), (2**30, 2**20, "MiB"), (2**62, 2**30, "GiB")):
        size = size.when(b < limit, F.concat(F.round(b / unit, 1).cast("string"), F.lit(f" {name}")))
    return derived(spark, sf_dir, "orders", AMOUNT).select("id", span.alias("span"), size.alias("size"))


STAGE = "CASE WHEN c_custkey % 3 = 0 THEN 'org/' ELSE '' END || c_name || CASE WHEN c_custkey % 5 = 0 THEN ' (copy)/x y' ELSE '' END AS name"


@query(f"""SELECT name, regexp_replace(string_split(name, '/')[-1], '[^A-Za-z0-9_.-]', '_', 'g') || '-' || substr(sha256(name), 1, 8) AS dir FROM (SELECT {STAGE} FROM customer)""")
def stage_name(spark, sf_dir):
    base = F.regexp_replace(F.element_at(F.split("name", "/"), -1), "[^A-Za-z0-9_.-]", "_")
    return derived(spark, sf_dir, "customer", STAGE).select("name", F.concat(base, F.lit("-"), F.substring(F.sha2("name", 256), 1, 8)).alias("dir"))


TILE = """event_id AS name, CAST(event_id % 97 AS DOUBLE) / 96 AS x0, CAST(event_id % 89 AS DOUBLE) / 88 AS y0,
 CAST(event_id % 97 + event_id % 7 AS DOUBLE) / 96 AS x1, CAST(event_id % 89 + event_id % 5 AS DOUBLE) / 88 AS y1"""
PIXELS = [("left_px", "x0", 1280, 0, 1279), ("top_px", "y0", 1440, 0, 1439), ("right_px", "x1", 1280, 1, 1280), ("bottom_px", "y1", 1440, 1, 1440)]


@query(f"""SELECT name, {", ".join(f"CAST(least(greatest(round_even({c} * {size}, 0), {low}), {high}) AS INTEGER) AS {n}" for n, c, size, low, high in PIXELS)}
FROM (SELECT {TILE} FROM events)""")
def tile_bounds(spark, sf_dir):
    """Fractions of a mosaic as pixels, rounded half even, inside the picture."""
    px = [F.least(F.greatest(F.rint(F.col(c) * size), F.lit(float(low))), F.lit(float(high))).cast("int").alias(n) for n, c, size, low, high in PIXELS]
    return derived(spark, sf_dir, "events", TILE).select("name", *px)


CACHE = "o_orderkey AS id, o_orderkey % 6000 AS eps, o_custkey % 4 AS cams, CAST(o_orderkey % 129 AS DOUBLE) / 2 AS mem, o_custkey % 9 AS workers"


@query(f"""SELECT id, CASE WHEN eps <= 0 OR cams <= 0 THEN NULL ELSE least(eps * cams, greatest(CAST(floor(mem * 1024 * 0.5 / (greatest(workers, 1) * 4)) AS BIGINT), 1)) END AS decoders
FROM (SELECT {CACHE} FROM orders)""")
def cache_sizing(spark, sf_dir):
    """Decoders wanted (episodes by cameras), held to half the memory at 4 MB each and worker."""
    room = F.greatest(F.floor(F.col("mem") * 1024 * 0.5 / (F.greatest("workers", F.lit(1)) * 4)), F.lit(1))
    want = (F.col("eps") * F.col("cams")).cast("long")
    return derived(spark, sf_dir, "orders", CACHE).select("id", F.when((F.col("eps") > 0) & (F.col("cams") > 0), F.least(want, room)).alias("decoders"))


CODEC = """p_partkey AS name, CASE p_partkey % 3 WHEN 0 THEN 'h264' WHEN 1 THEN 'av1' END AS codec, CASE WHEN p_partkey % 2 = 0 THEN 'yuv420p' END AS pix,
 CASE WHEN p_partkey % 5 = 0 THEN '2' END AS g, CASE p_partkey % 4 WHEN 0 THEN '23.0' WHEN 1 THEN '0.5' WHEN 2 THEN '18' END AS crf"""


@query(f"""SELECT name, array_to_string(list_filter([codec, pix, 'g=' || g, 'crf=' || CASE WHEN CAST(crf AS DOUBLE) = floor(CAST(crf AS DOUBLE)) THEN CAST(CAST(crf AS DOUBLE) AS BIGINT)::VARCHAR ELSE crf END],
  lambda x: x IS NOT NULL), ' ') AS encoder FROM (SELECT {CODEC} FROM part)""")
def encoder_string(spark, sf_dir):
    crf = F.col("crf").cast("double")
    shown = F.when(crf == F.floor(crf), crf.cast("long").cast("string")).otherwise(F.col("crf"))
    parts = F.array("codec", "pix", F.concat(F.lit("g="), F.col("g")), F.concat(F.lit("crf="), shown))
    return derived(spark, sf_dir, "part", CODEC).select("name", F.array_join(F.filter(parts, lambda x: x.isNotNull()), " ").alias("encoder"))


# --- serialised messages ----------------------------------------------------------

STAMP = """event_id AS id, CASE event_id % 7 WHEN 0 THEN 0 ELSE 1700000000 + event_id END AS sec, CASE event_id % 11 WHEN 0 THEN 1000000000 ELSE event_id * 7919 % 1000000000 END AS nanosec,
 event_id % 2 = 0 AS little, event_id % 13 = 0 AS short"""


def raw_header(sec: Column, nanosec: Column, little: Column) -> Column:
    """The bytes of a message with a header only."""

    def word(c: Column) -> Column:
        big = F.lpad(F.hex(c.cast("long")), 8, "0")
        return F.when(little, F.concat(*[F.substring(big, i, 2) for i in (7, 5, 3, 1)])).otherwise(big)

    return F.unhex(F.concat(F.when(little, "00010000").otherwise("00000000"), word(sec), word(nanosec), word(F.lit(1)), F.lit("00")))


@query(f"SELECT id, CASE WHEN NOT short AND sec > 0 AND nanosec < 1000000000 THEN sec * 1000000000 + nanosec END AS stamp_ns FROM (SELECT {STAMP} FROM events)")
def cdr_header_stamp(spark, sf_dir):
    """Header stamps of serialised messages in nanoseconds; null where they are no stamps."""
    raw = raw_header(F.col("sec"), F.col("nanosec"), F.col("little"))
    df = derived(spark, sf_dir, "events", STAMP).select("id", F.when(F.col("short"), F.substring(raw, 1, 8)).otherwise(raw).alias("raw"))
    return df.select("id", cdr.header_stamp(F.col("raw")).alias("stamp_ns"))


@query("""SELECT vec_id AS id, CASE WHEN vec_id % 9 > 0 THEN len(embedding) END AS n, CASE WHEN vec_id % 9 > 0 THEN CAST(embedding[1] AS DOUBLE) END AS p0,
  CASE WHEN vec_id % 9 > 0 THEN CAST(embedding[3] AS DOUBLE) * 2 END AS v2 FROM embeddings""")
def joint_states(spark, sf_dir):
    """Joint messages written and decoded in Arrow batches; every ninth is broken off and null."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("p"))
    raw = cdr.write_joint_states()(F.col("p"), F.transform("p", lambda x: x * 2))
    df = e.select("id", F.when(F.col("id") % 9 == 0, F.substring(raw, 1, 21)).otherwise(raw).alias("raw"))
    df = df.select("id", cdr.parse_joint_state()(F.col("raw")).alias("j"))
    return df.select("id", F.when(F.col("j.name").isNotNull(), F.size("j.name")).alias("n"), F.get("j.position", F.lit(0)).alias("p0"), F.get("j.velocity", F.lit(2)).alias("v2"))
