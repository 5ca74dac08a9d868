"""The operators bound to the driver's tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (alignment, bpe, centroids, decontaminate, language, licenses, mixing, quality, simhash,
                        substrings, topk, toxicity, url_rules)
from quarry.llm.common import read
from quarry.llm.url_rules import Rule, host_rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Licence phrases (fixed values).
LICENSE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Host and path rules (fixed values).
LISTED = [host_rule("allow", "com/"), host_rule("block", "example.com/en/"), host_rule("allow", "www.example.com/en/"),
          host_rule("block", "net/es/"), host_rule("block", "net/fr/")]
#: The method's own rules, for URLs that no listed rule fits.
PATTERNS = [
    Rule("ad network", "block", r"^([^/#]*\.)?doubleclick\.", ("doubleclick",), 0, False),
    Rule("ad server", "block", r"^([^/#]*\.)?adserver\.", ("adserver",), 0, False),
    Rule("login form", "block", r"/(wp-)?login\.php(/|#)", ("login", "php"), 0, False),
    Rule("program", "block", r"\.exe#", ("exe",), 0, False),
]


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"), base=LICENSE_PHRASES)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(read(spark, sf_dir, "documents"), tokenizer_path()))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read(spark, sf_dir, "pages").select("page_id", "url"), LISTED + PATTERNS).select(
        "page_id", "host", "path", "rule", "verdict")


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


@query
def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.planned(read(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"))


ORACLE["op7_topk"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.r AS own, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.r <> c.r),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

ORACLE["op9_url_filter"] = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, instr(coalesce(url, ''), '://') AS mark FROM pages),
q AS (SELECT page_id, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM p),
h AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM q),
t AS (
  SELECT page_id,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM h),
rules(rule, rule_host, rule_path, verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
f AS (
  SELECT t.page_id, max_by(r.rule, length(r.rule)) AS rule, max_by(r.verdict, length(r.rule)) AS verdict
  FROM t JOIN rules r
    ON (t.host = r.rule_host OR ends_with(t.host, '.' || r.rule_host)) AND starts_with(t.path, r.rule_path)
  GROUP BY t.page_id)
SELECT t.page_id, t.host, t.path, f.rule,
       coalesce(f.verdict, CASE
         WHEN regexp_matches(t.host, '(^|\.)(doubleclick|adserver)\.')
           OR regexp_matches(t.path, '/(wp-)?login\.php(/|$)') OR ends_with(t.path, '.exe') THEN 'block'
         ELSE 'allow' END) AS verdict
FROM t LEFT JOIN f USING (page_id)
"""

ORACLE["op10_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (
  SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, ws FROM d WHERE len(ws) >= 20),
s AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS run FROM w),
e AS (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS k FROM s),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM e WHERE k > 1),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

def _clustering_sql(rounds: int = 5, k: int = 40, dims: int = 64, scale: int = 256) -> str:
    """One assignment and one mean a round, as a chain of common table expressions."""
    parts = [f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS HUGEINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), e) - 1 AS c, e FROM v
  WHERE vec_id IS NOT NULL ORDER BY c LIMIT {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.r, c{i}.c, list_sum([(v.e[j] - c{i}.e[j]) * (v.e[j] - c{i}.e[j]) FOR j IN range(1, {dims + 1})]) AS d
    FROM v CROSS JOIN c{i}) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(m.e, c{i}.e) AS e FROM c{i} LEFT JOIN (
    SELECT c, list(q ORDER BY j) AS e FROM (
      SELECT a.c, j, CAST((sum(v.e[j]) - ((sum(v.e[j]) % count(*)) + count(*)) % count(*)) // count(*) AS HUGEINT) AS q
      FROM v JOIN a{i} a USING (r) CROSS JOIN range(1, {dims + 1}) t(j) GROUP BY a.c, j) GROUP BY c) m USING (c))""")
    return ",".join(parts) + f"""
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.e, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a USING (r) JOIN c{rounds} USING (c)
"""


ORACLE["op12_centroids"] = _clustering_sql()

ORACLE["op13_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN doc_id IS NULL THEN coalesce(text, '') ELSE '' END AS drawn,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS s,
         [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS w
  FROM d GROUP BY source),
-- A source stands at its ceiling if all targets at its own ceiling / weight stay within the budget.
f AS (
  SELECT a.source, a.s, a.w,
         2 * sum(CASE WHEN b.s * a.w < a.s * b.w THEN 2 * b.s * a.w ELSE 2 * a.s * b.w END) <= 3 * a.w * sum(b.s) AS capped
  FROM s a CROSS JOIN s b GROUP BY a.source, a.s, a.w),
t AS (
  SELECT source, s, CASE WHEN capped THEN CAST(2 * s AS DOUBLE)
         ELSE CAST(w * (3 * sum(s) OVER () - 2 * sum(CASE WHEN capped THEN 2 * s ELSE 0 END) OVER ()) AS DOUBLE)
              / CAST(2 * sum(CASE WHEN capped THEN 0 ELSE w END) OVER () AS DOUBLE) END AS target
  FROM f),
r AS (SELECT *, CASE WHEN s > 0 THEN target / CAST(s AS DOUBLE) ELSE 0 END AS rate FROM t)
SELECT d.doc_id, d.size, CAST(r.s AS BIGINT) AS source_size, r.target,
       d.size * (CAST(floor(r.rate) AS BIGINT) + CASE WHEN
         CAST(CAST('0x' || substr(md5('0:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || drawn), 1, 13) AS BIGINT) AS DOUBLE)
           / 4503599627370496.0 < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""
