"""The numbered queries over whole tables, and SQL that tells the same rows where there is some."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_tokenizers
from .fingerprints import fingerprint_edits
from .impacts import integers, top_k
from .licenses import scan_licenses
from .lines import line_dedup, quality_rules
from .middles import fill_in_middle, restored
from .mixing import mix
from .neardup import near_duplicates
from .pieces import piece_digests
from .substrings import substring_dedup
from .tables import read
from .toxicity import fit_toxicity, score_toxicity
from .urls import judge_urls


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(read(spark, sf_dir, "documents"), model_path())


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read(spark, sf_dir, "documents"), min_sites=10, min_words=3)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"), digest.alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, read(spark, sf_dir, "labels")))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), percent=85, bands=44).drop("tkey")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    number = [F.round(c, 6).alias(c[1:]) for c in ("_weight", "_chance")]
    return out.select("doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"), *number, F.col("_kept").alias("kept"), F.col("_copies").alias("copies"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents")).drop("tkey")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir, "documents"), k=13)


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", integers(F.col("embedding"), 256).alias("v"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(read(spark, sf_dir, "documents"), model_path("byte_bpe_50k.json"), model_path())


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(read(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    back = digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), back)


SPACE = "[\\x20\\x09-\\x0D]+"
WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '')"
NORMAL = f"trim(regexp_replace(lower(line), '{SPACE}', ' ', 'g'))"

OP3_SQL = f"""
WITH rows AS (SELECT doc_id, source, coalesce(text, '') AS t, md5(coalesce(text, '') || coalesce(source, '')) AS k FROM documents),
parts AS (SELECT doc_id, source, k, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM rows),
lines AS (SELECT *, {NORMAL} AS norm, len(list_filter(regexp_split_to_array(line, '{SPACE}'), lambda x: x <> '')) >= 3 AS counted FROM parts),
spread AS (SELECT norm, min(struct_pack(d := doc_id, k := k)) AS first FROM lines WHERE counted GROUP BY norm HAVING count(DISTINCT source) >= 10),
marked AS (SELECT l.*, counted AND first IS NOT NULL AND (doc_id <> first.d OR l.k <> first.k) AS gone FROM lines l LEFT JOIN spread USING (norm))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, k"""

OP8_SQL = f"""
WITH rows AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
grams AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM rows WHERE len(w) > 2),
hits AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM grams),
repeats AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM hits WHERE n > 1) GROUP BY doc_id),
parts AS (SELECT doc_id, source, md5(text) AS t, unnest(string_split(text, chr(10))) AS line FROM rows),
lines AS (SELECT *, {NORMAL} AS norm, len(list_filter(regexp_split_to_array(line, '{SPACE}'), lambda x: x <> '')) AS n FROM parts),
totals AS (SELECT source, count(DISTINCT (doc_id, md5(text))) AS total FROM rows GROUP BY source),
spread AS (SELECT source, norm, count(DISTINCT (doc_id, t)) AS docs, min(doc_id) AS first FROM lines WHERE n >= 3 GROUP BY source, norm),
often AS (SELECT source, norm, first FROM spread JOIN totals USING (source) WHERE docs >= 10 AND (docs > 0.05 * total OR docs >= 1000)),
lost AS (SELECT doc_id, sum(n) AS lost FROM lines JOIN often USING (source, norm) WHERE n >= 3 AND doc_id <> first GROUP BY doc_id),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE n > 0 GROUP BY doc_id),
base AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{SPACE}', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM rows LEFT JOIN repeats USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - lost >= 0.5 * n_words AS kept
FROM base"""

OP10_SQL = f"""
WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS t, {WORDS} AS w FROM documents),
g AS (SELECT doc_id, t, i, md5(array_to_string(w[i:i + 12], ' ')) AS h FROM (SELECT doc_id, t, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) > 12)),
least AS (SELECT h, min(doc_id) AS first FROM g GROUP BY h),
gone AS (SELECT DISTINCT doc_id, t, unnest(range(i, i + 13)) AS i FROM g JOIN least USING (h) WHERE first < doc_id),
cut AS (SELECT doc_id, t, count(*) AS n, list(i) AS places FROM gone GROUP BY doc_id, t)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(places, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id, t)"""

OP11_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.e, r.e) AS BIGINT) AS score FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0),
t AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM t WHERE rank <= 5"""

OP13_SQL = """
WITH u AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS h FROM documents),
d AS (SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM u),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""

QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_license_scan, op3_line_dedup, op4_toxicity, op5_minhash, op6_url_filter, op7_mixing, op8_quality_rules, op9_fingerprints, op10_substring_dedup, op11_topk, op12_token_alignment, op13_fill_in_middle)}
ORACLE_SQL: dict[str, str] = {"op3_line_dedup": OP3_SQL, "op8_quality_rules": OP8_SQL, "op10_substring_dedup": OP10_SQL, "op11_topk": OP11_SQL, "op13_fill_in_middle": OP13_SQL}
