"""Codec and feature studies, over ``embeddings`` and per-frame metric rows from ``lineitem``, ``documents``."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.frames import crop_resize_rows, ssim_rows
from ..operators import fidelity as fi
from ..operators.cuts import cut
from ..operators.quantiles import grouped
from ..operators.qc import half_up, r6
from ..operators.sequence import numbered
from ..sources.streams import literal
from .registry import query, values

#: Metric rows: quality as a made-up PSNR, similarity of the same frame, by camera and variant.
MET = """x AS (SELECT l_orderkey AS frame, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag AS camera, l_linestatus AS source, CASE WHEN l_discount = 0 THEN CAST('inf' AS DOUBLE) ELSE 30 + 100 * l_tax + l_quantity / 10 END AS psnr,
  1 - l_tax / (1 + l_quantity) AS cosine, CAST(l_extendedprice AS BIGINT) AS bytes FROM lineitem)"""


def metric_rows(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    psnr = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(30 + 100 * F.col("l_tax") + F.col("l_quantity") / 10)
    return df.select(
        F.col("l_orderkey").alias("frame"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", F.col("l_returnflag").alias("camera"), F.col("l_linestatus").alias("source"), psnr.alias("psnr"),
        (1 - F.col("l_tax") / (1 + F.col("l_quantity"))).alias("cosine"), F.rint("l_extendedprice").cast("long").alias("bytes"),
    )


COS = """ref AS (SELECT embedding AS r FROM embeddings WHERE vec_id = 0),
e AS (SELECT vec_id, label, list_sum(list_transform(list_zip(embedding, r), lambda z: CAST(z[1] AS DOUBLE) * z[2])) AS ab, list_sum(list_transform(embedding, lambda z: CAST(z AS DOUBLE) * z)) AS aa, list_sum(list_transform(r, lambda z: CAST(z AS DOUBLE) * z)) AS bb,
  list_sum(list_transform(list_zip(embedding, r), lambda z: (CAST(z[1] AS DOUBLE) - z[2]) * (CAST(z[1] AS DOUBLE) - z[2]))) AS dd FROM embeddings, ref),
c AS (SELECT vec_id, label, ab / greatest(sqrt(aa) * sqrt(bb), 1e-8) AS cos, sqrt(dd) / greatest(sqrt(bb), 1e-8) AS rel FROM e)"""


def reference(e):
    """The reference vector, as one row whatever the table holds."""
    return e.where("vec_id = 0").agg(F.first("embedding", True).alias("r"))


def drift_rows(spark, sf_dir):
    """Every vector against the reference vector."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    df = e.join(F.broadcast(reference(e)))
    return df.select("vec_id", "label", fi.cosine(F.col("embedding"), F.col("r")).alias("cos"), fi.relative_l2(F.col("embedding"), F.col("r")).alias("rel"))


@query(f"""WITH {COS} SELECT vec_id, label, round(cos, 5) AS cos, round(degrees(acos(least(1.0, greatest(-1.0, cos)))), 2) AS angle, round(rel, 5) AS rel_l2
  FROM c""")
def embedding_cosine(spark, sf_dir):
    return drift_rows(spark, sf_dir).select("vec_id", "label", half_up(F.col("cos"), 5).alias("cos"), half_up(fi.angle(F.col("cos")), 2).alias("angle"), half_up(F.col("rel"), 5).alias("rel_l2"))


@query(f"""WITH {COS} SELECT label AS variant, count(*) AS n, round(avg(cos), 5) AS cos_mean, round(min(cos), 5) AS cos_min, round(quantile_cont(cos, 0.05),
  5) AS cos_p05, round(avg(degrees(acos(least(1.0, greatest(-1.0, cos))))), 3) AS angle_mean, round(avg(rel), 5) AS rel_l2_mean FROM c GROUP BY label""")
def embedding_drift(spark, sf_dir):
    r5 = lambda c: half_up(c, 5)
    moments = [F.count("*").alias("n"), r5(F.avg("cos")).alias("cos_mean"), r5(F.min("cos")).alias("cos_min"), half_up(F.avg(fi.angle(F.col("cos"))), 3).alias("angle_mean"), r5(F.avg("rel")).alias("rel_l2_mean")]
    df = grouped(drift_rows(spark, sf_dir).withColumnRenamed("label", "variant"), ["variant"], moments, {"cos_p05": (F.col("cos"), 0.05)})
    return df.withColumn("cos_p05", r5(F.col("cos_p05")))


TOKENS = """t AS (SELECT vec_id, label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings), ref AS (SELECT i, v AS r FROM t WHERE vec_id = 0),
g AS (SELECT vec_id, label, CAST(floor(i / 8) AS BIGINT) AS token, sum(CAST(v AS DOUBLE) * r) / greatest(sqrt(sum(CAST(v AS DOUBLE) * v)) * sqrt(sum(CAST(r AS DOUBLE) * r)), 1e-8) AS cos,
  sqrt(sum((CAST(v AS DOUBLE) - r) * (CAST(v AS DOUBLE) - r))) / greatest(sqrt(sum(CAST(r AS DOUBLE) * r)), 1e-8) AS rel FROM t JOIN ref USING (i) GROUP BY vec_id, label, floor(i / 8)),
p AS (SELECT vec_id, label, i % 8 AS j, avg(CAST(v AS DOUBLE)) AS v, avg(CAST(r AS DOUBLE)) AS r FROM t JOIN ref USING (i) GROUP BY vec_id, label, i % 8),
q AS (SELECT vec_id, label, sum(v * r) / greatest(sqrt(sum(v * v)) * sqrt(sum(r * r)), 1e-8) AS cos FROM p GROUP BY vec_id, label),
qs AS (SELECT label, round(avg(cos), 4) AS mean_patch_cos FROM q GROUP BY label)"""


@query(f"""WITH {TOKENS} SELECT g.label AS variant, count(*) AS tokens, round(avg(cos), 4) AS cos_mean, round(quantile_cont(cos, 0.05), 4) AS cos_p05, round(min(cos), 4) AS cos_min,
  round(avg(rel), 4) AS rel_l2_mean, round(quantile_cont(rel, 0.95), 4) AS rel_l2_p95, round(max(rel), 4) AS rel_l2_max, any_value(mean_patch_cos) AS mean_patch_cos FROM g JOIN qs USING (label) GROUP BY g.label""")
def token_drift(spark, sf_dir):
    """Tokens of eight values each against the reference's token of the same place, and mean tokens against its mean token."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    token = lambda c, i: F.slice(c, i * 8 + 1, 8)
    places = F.sequence(F.lit(0), F.floor(F.size("embedding") / 8).cast("int") - 1)
    both = e.join(F.broadcast(reference(e)))
    df = both.select("label", "embedding", "r", F.explode(places).alias("i"))
    a, b = token(F.col("embedding"), F.col("i")), token(F.col("r"), F.col("i"))
    df = df.select("label", fi.cosine(a, b).alias("cos"), fi.relative_l2(a, b).alias("rel"))
    r4 = lambda c: half_up(c, 4)
    moments = [F.count("*").alias("tokens"), r4(F.avg("cos")).alias("cos_mean"), r4(F.min("cos")).alias("cos_min"), r4(F.avg("rel")).alias("rel_l2_mean"), r4(F.max("rel")).alias("rel_l2_max")]
    each = grouped(df.withColumnRenamed("label", "variant"), ["variant"], moments, {"cos_p05": (F.col("cos"), 0.05), "rel_l2_p95": (F.col("rel"), 0.95)})
    each = each.withColumns({c: r4(F.col(c)) for c in ("cos_p05", "rel_l2_p95")})

    def mean_token(c: str):
        n = F.floor(F.size(c) / 8)
        own = lambda j: F.filter(F.col(c), lambda x, i: i % 8 == j)
        return F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.aggregate(own(j), F.lit(0.0), lambda t, x: t + x.cast("double")) / n)

    means = both.select("label", fi.cosine(mean_token("embedding"), mean_token("r")).alias("cos"))
    means = means.groupBy(F.col("label").alias("variant")).agg(r4(F.avg("cos")).alias("mean_patch_cos"))
    return each.join(means, "variant")


@query(f"WITH {MET} SELECT frame, l_linenumber, l_partkey, round(psnr, 6) AS value FROM x WHERE camera = 'N' AND source = 'O' AND isfinite(psnr)")
def metric_series(spark, sf_dir):
    """One metric of one variant and camera, by frame."""
    df = metric_rows(spark, sf_dir).where((F.col("camera") == "N") & (F.col("source") == "O") & (F.col("psnr") < float("inf")))
    return df.select("frame", "l_linenumber", "l_partkey", r6(F.col("psnr")).alias("value"))


@query(f"""WITH {MET}, y AS (SELECT camera, source, CASE WHEN isfinite(psnr) THEN psnr END AS p, isfinite(psnr) AS ok FROM x) SELECT camera, source,
  count(p) AS n, count(*) FILTER (WHERE NOT ok) AS infinite_frames, round(avg(p), 6) AS mean, round(stddev_pop(p), 6) AS std, round(median(p),
  6) AS median, round(min(p), 6) AS low, round(max(p), 6) AS high, round(quantile_cont(p, 0.05), 6) AS p05, round(quantile_cont(p, 0.95), 6) AS p95
  FROM y GROUP BY ALL""")
def metric_summary(spark, sf_dir):
    return fi.summary(metric_rows(spark, sf_dir), ["camera", "source"], "psnr")


@query(f"""WITH {MET} SELECT source, camera, count(*) AS frames, CAST(sum(bytes) AS BIGINT) AS bytes, round(sum(bytes) / count(*), 6) AS bytes_per_frame,
  round(sum(bytes) * 8 / (count(*) / 30.0) / 1e6, 6) AS mbit_s, round(5529600 / avg(bytes), 6) AS ratio FROM x GROUP BY ALL""")
def codec_rollup(spark, sf_dir):
    total, n = F.sum("bytes"), F.count("*")
    return metric_rows(spark, sf_dir).groupBy("source", "camera").agg(n.alias("frames"), total.alias("bytes"), r6(total / n).alias("bytes_per_frame"), r6(total * 8 / (n / 30.0) / 1e6).alias("mbit_s"), r6(5529600 / F.avg("bytes")).alias("ratio"))


PAR = "row_number() OVER (PARTITION BY source, frame ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) - 1"


@query(f"""WITH {MET}, y AS (SELECT source, frame, cosine, {PAR} AS i FROM x) SELECT source, frame, count(*) AS n, round(avg(cosine) FILTER (WHERE i % 2 = 0),
  8) AS even_mean, round(avg(cosine) FILTER (WHERE i % 2 = 1), 8) AS odd_mean,
  round(avg(cosine) FILTER (WHERE i % 2 = 0) - avg(cosine) FILTER (WHERE i % 2 = 1), 8) AS gap FROM y GROUP BY ALL""")
def parity_split(spark, sf_dir):
    """Even against odd places of an ordered series, as of intra and predicted frames."""
    i = F.row_number().over(W.partitionBy("source", "frame").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")) - 1
    df = metric_rows(spark, sf_dir).withColumn("i", i)
    even, odd = F.avg(F.when(F.col("i") % 2 == 0, F.col("cosine"))), F.avg(F.when(F.col("i") % 2 == 1, F.col("cosine")))
    return df.groupBy("source", "frame").agg(F.count("*").alias("n"), half_up(even, 8).alias("even_mean"), half_up(odd, 8).alias("odd_mean"), half_up(even - odd, 8).alias("gap"))


@query(f"WITH {MET} SELECT camera, source, count(*) AS n, round(corr(psnr, cosine), 6) AS pearson FROM x WHERE isfinite(psnr) GROUP BY ALL")
def pearson_by_group(spark, sf_dir):
    df = metric_rows(spark, sf_dir).where(F.col("psnr") < float("inf"))
    return df.groupBy("camera", "source").agg(F.count("*").alias("n"), r6(F.corr("psnr", "cosine")).alias("pearson"))


@query("""WITH d AS (SELECT lang, doc_id, n_chars AS x, len(list_distinct(string_split(coalesce(text, ''), ' '))) AS y FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY x, doc_id) AS rx, row_number() OVER (PARTITION BY lang ORDER BY y, doc_id) AS ry FROM d)
SELECT lang, count(*) AS n, round(corr(x, y), 6) AS pearson, round(corr(rx, ry), 6) AS rho FROM r GROUP BY lang""")
def spearman(spark, sf_dir):
    """Rank correlation without averaging of ties: equal values rank by id.

    A global row number would order a whole language in one task: places come from
    counts of values instead, and only equal values are ordered among themselves.
    """
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    d = d.select("lang", "doc_id", F.col("n_chars").alias("x"), F.size(F.array_distinct(F.split(F.coalesce("text", F.lit("")), " "))).cast("long").alias("y"))
    for v in ("x", "y"):
        w = W.partitionBy("lang").orderBy(v).rowsBetween(W.unboundedPreceding, -1)
        counts = d.groupBy("lang", v).agg(F.count("*").alias("_c")).withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0))).drop("_c")
        d = d.join(counts, ["lang", v]).withColumn(f"r{v}", F.col("_before") + F.row_number().over(W.partitionBy("lang", v).orderBy("doc_id"))).drop("_before")
    return d.groupBy("lang").agg(F.count("*").alias("n"), r6(F.corr("x", "y")).alias("pearson"), r6(F.corr(F.col("rx").cast("double"), F.col("ry").cast("double"))).alias("rho"))


@query(f"""WITH {MET} SELECT camera, round(3 * regr_slope(cosine, psnr) FILTER (WHERE psnr >= 35 AND isfinite(psnr)), 6) AS high_band,
  round(3 * regr_slope(cosine, psnr) FILTER (WHERE psnr <= 34), 6) AS low_band FROM x GROUP BY camera""")
def banded_slope(spark, sf_dir):
    """Least-squares change of similarity for three decibels, inside a high and a low band."""
    df = metric_rows(spark, sf_dir).where(F.col("psnr") < float("inf"))
    band = lambda c: F.regr_slope(F.when(c, F.col("cosine")), F.when(c, F.col("psnr"))) * 3
    return df.groupBy("camera").agg(r6(band(F.col("psnr") >= 35)).alias("high_band"), r6(band(F.col("psnr") <= 34)).alias("low_band"))


@query("""SELECT user_id AS bag_id, count(*) AS frames, round(epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6, 3) AS span_s, round(CASE
  WHEN max(ts) > min(ts) THEN count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) END, 9) AS fps, round(avg(value), 6) AS mean,
  round(median(value), 6) AS median, round(sum(value), 4) AS total FROM events GROUP BY user_id""")
def size_stats(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    span = (F.max("t") - F.min("t")) / 1e6
    return e.groupBy(F.col("user_id").alias("bag_id")).agg(
        F.count("*").alias("frames"), half_up(F.max("t") / 1e6 - F.min("t") / 1e6, 3).alias("span_s"), half_up(F.when(span > 0, F.count("*") / span), 9).alias("fps"), r6(F.avg("value")).alias("mean"), r6(F.median("value")).alias("median"), half_up(F.sum("value"), 4).alias("total")
    )


@query(f"""WITH {MET}, r AS (SELECT *, row_number() OVER (PARTITION BY camera, source ORDER BY cosine, frame, l_linenumber, l_partkey) AS i FROM x)
  SELECT camera, source, frame, round(cosine, 9) AS cosine FROM r WHERE i = 1""")
def worst_frame(spark, sf_dir):
    low = F.min(F.struct("cosine", "frame", "l_linenumber", "l_partkey")).alias("m")
    return metric_rows(spark, sf_dir).groupBy("camera", "source").agg(low).select("camera", "source", "m.frame", half_up(F.col("m.cosine"), 9).alias("cosine"))


PIX = f"""{MET}, p AS (SELECT camera, source, avg(psnr) AS psnr FROM x WHERE isfinite(psnr) GROUP BY ALL), c AS (SELECT camera, source, avg(cosine) AS cosine FROM x GROUP BY ALL)"""


@query(f"WITH {PIX} SELECT camera, source, round(psnr, 6) AS mean_psnr, round(cosine, 6) AS mean_cosine FROM p JOIN c USING (camera, source)")
def pixel_feature_join(spark, sf_dir):
    x = metric_rows(spark, sf_dir)
    p = x.where(F.col("psnr") < float("inf")).groupBy("camera", "source").agg(F.avg("psnr").alias("p"))
    c = x.groupBy("camera", "source").agg(F.avg("cosine").alias("c"))
    return p.join(c, ["camera", "source"]).select("camera", "source", r6(F.col("p")).alias("mean_psnr"), r6(F.col("c")).alias("mean_cosine"))


RUNGS = [("O", "crf0", "av1_crf_0"), ("F", "crf20", "av1_crf_20")]


@query(f"""WITH {PIX}, m AS {values(RUNGS, 'source, rung, name')} SELECT camera, rung, name, round(psnr, 6) AS psnr, round(cosine, 6) AS cosine FROM p
  JOIN c USING (camera, source) JOIN m USING (source) WHERE camera <> 'N'""")
def cross_report(spark, sf_dir):
    """Two studies aligned by mapped variant names."""
    both = pixel_feature_join(spark, sf_dir).join(F.broadcast(literal(spark, "source string, rung string, name string", RUNGS)), "source")
    return both.where("camera <> 'N'").select("camera", "rung", "name", F.col("mean_psnr").alias("psnr"), F.col("mean_cosine").alias("cosine"))


@query("""WITH a AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i FROM embeddings), g AS (SELECT label, count(*) AS n FROM a GROUP BY label), n0 AS (SELECT n FROM g WHERE label = 0)
SELECT v.label, count(r.i) AS paired, v0.n AS frames, n0.n AS reference, CASE WHEN v0.n < n0.n THEN 'early_end' WHEN v0.n > n0.n THEN 'extra_frame' ELSE 'ok' END AS verdict FROM a v LEFT JOIN (SELECT i FROM a WHERE label = 0) r USING (i) JOIN g v0 ON v0.label = v.label CROSS JOIN n0 GROUP BY v.label, v0.n, n0.n""")
def frame_pairing(spark, sf_dir):
    """Variant frames paired with the reference's by place; unequal lengths are fatal."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("label", F.col("vec_id").cast("long").alias("t"), F.col("vec_id").cast("long").alias("seq"))
    a = cut(numbered(e, ["label"], "i").select("label", "i"))
    ref = a.where("label = 0").select("i", F.lit(1).alias("hit"))
    n0 = a.where("label = 0").count()
    df = a.join(ref, "i", "left").groupBy("label").agg(F.count("hit").alias("paired"), F.count("*").alias("frames")).withColumn("reference", F.lit(n0).cast("long"))
    verdict = F.when(F.col("frames") < F.col("reference"), "early_end").when(F.col("frames") > F.col("reference"), "extra_frame").otherwise("ok")
    return df.select("label", "paired", "frames", "reference", verdict.alias("verdict"))


#: A vector as a frame of 0..255 values, three channels a pixel; the other frame is coarser, with a shift in some.
FRAME = "[CAST(least(greatest(round_even(128 + 40 * CAST(x AS DOUBLE), 0), 0), 255) AS INTEGER) FOR x IN embedding[1:60]]"
COARSE = "[CASE WHEN vec_id % 5 = 0 THEN x ELSE CAST(least(x // 8 * 8 + vec_id % 4, 255) AS INTEGER) END FOR x IN a]"
CHANNELS = 3
EACH = ", ".join(f"round(list_avg(list_transform(range({c + 1}, len(d) + 1, 3), lambda i: abs(d[i]))), 6) AS mae_{c}, round(list_avg(list_transform(range({c + 1}, len(d) + 1, 3), lambda i: d[i])), 6) AS bias_{c}" for c in range(CHANNELS))


def frame_pairs(spark, sf_dir):
    """name and two frames, as arrays of values."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    level = lambda x: F.least(F.greatest(F.rint(128 + 40 * x.cast("double")), F.lit(0.0)), F.lit(255.0)).cast("int")
    df = e.select(F.col("vec_id").alias("name"), F.explode(F.array(F.transform(F.slice("embedding", 1, 60), level))).alias("a"))
    coarse = F.transform("a", lambda x: F.least(F.floor(x / 8) * 8 + F.col("name") % 4, F.lit(255)).cast("int"))
    return df.select("name", "a", F.explode(F.array(F.when(F.col("name") % 5 == 0, F.col("a")).otherwise(coarse))).alias("b"))


@query(f"""WITH p AS (SELECT vec_id, {FRAME} AS a FROM embeddings), q AS (SELECT vec_id, a, {COARSE} AS b FROM p),
g AS (SELECT vec_id AS name, list_transform(list_zip(a, b), lambda z: CAST(z[2] - z[1] AS DOUBLE)) AS d FROM q),
m AS (SELECT name, d, list_sort(list_transform(d, lambda x: abs(x))) AS s, list_sum(list_transform(d, lambda x: x * x)) / len(d) AS mse FROM g)
SELECT name, round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse, round(list_sum(s) / len(s), 6) AS mae, CASE WHEN mse = 0 THEN 1e9 ELSE round(10 * log10(65025.0 / mse), 6) END AS psnr_db,
  s[-1] AS max_abs, round(list_aggregate(s, 'quantile_cont', 0.95), 6) AS p95_abs, round(list_aggregate(s, 'quantile_cont', 0.99), 6) AS p99_abs,
  round(len(list_filter(range(1, len(d) + 1, 3), lambda i: d[i] = 0 AND d[i + 1] = 0 AND d[i + 2] = 0)) / (len(d) / 3), 6) AS unchanged, {EACH} FROM m""")
def pixel_metrics(spark, sf_dir):
    """Error metrics of frame pairs; an infinite PSNR is shown as 1e9."""
    e = fi.pixel_errors(F.col("a"), F.col("b"), CHANNELS)
    e["psnr_db"] = F.when(e["mse"] == 0, F.lit(1e9)).otherwise(e["psnr_db"])
    return frame_pairs(spark, sf_dir).select("name", *[r6(v).alias(k) for k, v in e.items()])


@query()
def ssim(spark, sf_dir):
    """Structural similarity of 16 x 16 frames cut from vectors and a shifted copy."""
    return ssim_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query()
def crop_resize(spark, sf_dir):
    """Letterboxed nearest-neighbour resize of 8 x 8 tiles."""
    return crop_resize_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
