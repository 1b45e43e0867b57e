"""The registered queries of the operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglynx.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f
    return add


MIX_SQL = r"""
WITH n AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM n GROUP BY source),
w AS (
  SELECT *, [1, 2, 3][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight,
         3 * source_size AS cap FROM s),
l AS (
  SELECT *, sum(source_size) OVER () AS t, sum(weight) OVER () AS wt,
         coalesce(sum(cap) OVER before, 0) AS cb, coalesce(sum(weight) OVER before, 0) AS wb
  FROM w WINDOW before AS (ORDER BY (cap * 6) // weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (t - cb) * weight >= cap * (wt - wb) AS capped FROM l),
e AS (
  SELECT *, coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0) AS cs,
         coalesce(sum(weight) FILTER (WHERE NOT capped) OVER (), 0) AS fw FROM c),
g AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE CAST((t - cs) * weight AS DOUBLE) / CAST(fw AS DOUBLE) END AS target
  FROM e),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 17592186044416.0) AS BIGINT) ELSE 0 END AS rate,
         CAST('0x' || substr(md5(coalesce(source, '') || CASE WHEN source IS NULL THEN '|null' ELSE '|' END || '42'), 1, 11) AS BIGINT) AS u
  FROM g),
p AS (
  SELECT n.doc_id, n.size, r.source_size, r.target, r.rate, r.u,
         CAST(sum(r.rate) OVER (PARTITION BY n.source ORDER BY n.size DESC, n.key ROWS UNBOUNDED PRECEDING) AS HUGEINT) AS upto
  FROM n JOIN r ON n.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       CAST(((upto + u) // CAST(17592186044416 AS HUGEINT) - (upto - rate + u) // CAST(17592186044416 AS HUGEINT)) * size AS BIGINT) AS taken
FROM p
"""


@query("op1_mix_sources", MIX_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import mixing

    plan = mixing.plan_mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_repeat=3, seed=42)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


@query("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import quality

    return quality.assess(table(spark, sf_dir, "documents"))


@query("op7_simhash_near_dedup")
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import simhash

    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@query("op6_benchmark_decontamination")
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import decontam

    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=8, min_windows=3)
    return found.drop("text_hash")


@query("op10_secret_scans")
def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import secretscan

    found = secretscan.scan(table(spark, sf_dir, "documents"))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(said(F.filter("spans", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
                        said("spans").alias("spans"), count("novel"))


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
             ("block", "net", "/fr/")]
URL_SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                                    ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (
  SELECT rid, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY rid ORDER BY length(rhost) DESC, length(rpath) DESC, verdict DESC) AS nth
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM f WHERE nth = 1) g ON p.rid = g.rid
"""


@query("op2_url_filters", URL_SQL)
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import urlfilter

    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op5_warc_round_trip")
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import warc

    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def license_sql() -> str:
    """The sentence table and the rules as literals, the rest as list functions."""
    from loglynx.llm import licenses as L

    ids, rules = L.tables(L.SENTENCES, L.RULES)
    known = ", ".join(f"'{s}': '{i}'" for s, i in ids.items())
    values = ", ".join(f"('{r}', '{lic}', '{p}', {n})" for r, lic, p, n in rules)

    def sequence(end: str) -> str:
        plain = ("trim(regexp_replace(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                 "'[^a-z0-9]+', ' ', 'g'), ' ')")
        return (f"',' || array_to_string(list_filter(list_transform(regexp_split_to_array(text, '{end}'), "
                f"lambda s: map_extract(MAP {{{known}}}, {plain})[1]), lambda i: i IS NOT NULL), ',') || ','")

    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {sequence(L.BY_LINE)} AS a, {sequence(L.BY_PARAGRAPH)} AS b
  FROM documents WHERE regexp_matches(text, '(?i){L.KEYWORDS}')),
r(rule, license, seq, n) AS (VALUES {values}),
f AS (SELECT d.rid, d.doc_id, r.* FROM d JOIN r ON contains(d.a, r.seq) OR contains(d.b, r.seq))
SELECT doc_id, rule, license, CAST(n AS INTEGER) AS n_sentences FROM f
WHERE NOT EXISTS (SELECT 1 FROM f q WHERE q.rid = f.rid AND q.seq <> f.seq AND contains(q.seq, f.seq))
"""


@query("op8_license_scans", license_sql())
def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import licenses

    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import runindex

    return runindex.remove_repeats(table(spark, sf_dir, "documents"), length=400).drop("spans")


@query("op4_lm_scores")
def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import lm

    return lm.train_and_score(table(spark, sf_dir, "documents"), modulus=7, rest=2)


def centroid_sql(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2) -> str:
    """Assignment and update written out for each round."""
    ctes = [f"""k AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""", f"""c0 AS MATERIALIZED (
  SELECT CAST(nth - 1 AS INTEGER) AS cluster, x
  FROM (SELECT x, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, x) AS nth FROM k) WHERE nth <= {k})"""]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, vec_id, x, best.c AS cluster, best.d AS distance
  FROM (SELECT k.rid, any_value(k.vec_id) AS vec_id, any_value(k.x) AS x, min({{'d': d, 'c': cluster}}) AS best
        FROM (SELECT k.rid, k.vec_id, k.x, c.cluster,
                     CAST(list_sum(list_transform(list_zip(k.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
              FROM k, c{i} c) k GROUP BY k.rid))""")
        if i < rounds:
            ctes.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.x, c.x) AS x
  FROM c{i} c LEFT JOIN (
    SELECT cluster, list(v ORDER BY j) AS x
    FROM (SELECT cluster, j, CAST((sum(x[j]) - ((sum(x[j]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
          FROM a{i}, range(1, {dim} + 1) r(j) GROUP BY cluster, j) GROUP BY cluster) m USING (cluster))""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, a.cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.cluster
"""


@query("op11_centroid_clusters", centroid_sql())
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import centroids

    found = centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, scale=256, seed=2)
    return found.withColumn("centroid_sha256", F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256)).drop("centroid")


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import whitening

    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32, scale=64, offset=1_000_000)


@query("op13_minhash_near_dedup")
def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loglynx.llm import chosenpath

    return chosenpath.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80, trees=10)
