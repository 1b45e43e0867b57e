"""Registered alert-side queries: descriptions, chains, reputation, geo."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chain as CH
from ..operators import correlate as C
from ..operators import geo as G
from ..operators import reputation as R
from ..schema import iso_text
from ..sources import testbed as tb
from . import sqlparts as S
from .correlation import correlate_replay
from .registry import query

CAT = tb.catalogue()


def replay_alert_table(spark, sf_dir, with_chains=True, with_event_ids=False):
    ev = tb.event_view(spark, sf_dir)
    geo = G.geo_latest(tb.geo_log(spark, sf_dir))
    return correlate_replay(ev, CAT, geo, with_event_ids=with_event_ids, with_chains=with_chains)


def tags_text(col) -> F.Column:
    return F.concat(F.lit("["), F.array_join(F.transform(col, lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ","),
                    F.lit("]"))


FULL = S.full_head(CAT) + S.replay_alerts(CAT) + S.described_alerts(CAT)


@query("alert_description", FULL + f"""
SELECT rule_name, kind, group_value, {S.iso("created_at")} AS created_at, prior_score, description FROM ald""")
def alert_description(spark, sf_dir):
    """Replayed alerts with the full description text (count, geo, prior reputation)."""
    a = replay_alert_table(spark, sf_dir, with_chains=False)
    return a.select("rule_name", "kind", "group_value", iso_text("created_at").alias("created_at"),
                    "prior_score", "description")


@query("reputation_prior_score", FULL + f"""
SELECT rule_name, group_value, {S.iso("created_at")} AS created_at, prior_score FROM ald
WHERE group_by = 'src_ip'""")
def reputation_prior_score(spark, sf_dir):
    """Score of the address just before each of its alerts (catalogue order breaks ties)."""
    a = replay_alert_table(spark, sf_dir, with_chains=False)
    return a.filter(F.col("group_by") == "src_ip").select(
        "rule_name", "group_value", iso_text("created_at").alias("created_at"), "prior_score")


REP_SQL = FULL + f""",
feed AS (SELECT src_ip AS ip, created_at, rule_idx, {S.DELTA} AS delta, tag FROM al
         WHERE group_by = 'src_ip' AND src_ip <> ''),
tfirst AS (SELECT ip, tag, created_at AS t, rule_idx AS r FROM (
             SELECT *, row_number() OVER (PARTITION BY ip, tag ORDER BY created_at, rule_idx) AS rn
             FROM feed WHERE tag IS NOT NULL) WHERE rn = 1),
tagl AS (SELECT ip, '[' || string_agg('"' || tag || '"', ',' ORDER BY t, r) || ']' AS tags FROM tfirst GROUP BY ip),
rep AS (SELECT f.ip, CAST(LEAST(100, sum(delta)) AS INTEGER) AS score, count(*) AS alert_count,
               min(created_at) AS first_seen, max(created_at) AS last_seen, coalesce(min(tl.tags), '[]') AS tags
        FROM feed f LEFT JOIN tagl tl ON tl.ip = f.ip GROUP BY f.ip)"""


def _rep(spark, sf_dir):
    a = replay_alert_table(spark, sf_dir, with_chains=True)
    return R.reputation_table(a, CAT.tags)


@query("reputation_table", REP_SQL + f"""
SELECT ip, score, {S.label("score")} AS label, alert_count, {S.iso("first_seen")} AS first_seen,
       {S.iso("last_seen")} AS last_seen, tags FROM rep""")
def reputation_table(spark, sf_dir):
    """Score (clamped sum of severity deltas), count, first/last seen and ordered tags per address."""
    r = _rep(spark, sf_dir)
    return r.select("ip", "score", "label", "alert_count", iso_text("first_seen").alias("first_seen"),
                    iso_text("last_seen").alias("last_seen"), tags_text(F.col("tags")).alias("tags"))


@query("top_offenders", REP_SQL + f"""
SELECT ip, score, {S.label("score")} AS label, alert_count, tags FROM rep ORDER BY score DESC, ip LIMIT 10""")
def top_offenders(spark, sf_dir):
    """Ten highest-scoring addresses (address breaks ties)."""
    t = R.top_offenders(_rep(spark, sf_dir), 10)
    return t.select("ip", "score", "label", "alert_count", tags_text(F.col("tags")).alias("tags"))


@query("reputation_lookup_default", REP_SQL + f""",
ips AS (SELECT DISTINCT src_ip AS ip FROM ev WHERE src_ip IS NOT NULL)
SELECT i.ip, coalesce(r.score, 0) AS score, {S.label("coalesce(r.score, 0)")} AS label,
       coalesce(r.alert_count, 0) AS alert_count
FROM ips i LEFT JOIN rep r ON r.ip = i.ip""")
def reputation_lookup_default(spark, sf_dir):
    """Reputation of every address seen in events; addresses without alerts get 0 / CLEAN."""
    ips = tb.event_view(spark, sf_dir).select(F.col("src_ip").alias("ip")).filter(
        F.col("ip").isNotNull()).distinct()
    j = R.reputation_lookup(ips, _rep(spark, sf_dir))
    return j.select("ip", "score", "label", "alert_count")


@query("geo_enrich", f"WITH {tb.SQL_EVENT_VIEW}, {tb.SQL_GEO}," + f"""
ips AS (SELECT DISTINCT src_ip AS ip FROM ev WHERE src_ip IS NOT NULL),
j AS (SELECT i.ip, {S.is_private("i.ip")} AS priv, g.country, g.country_code, g.city, g.org
      FROM ips i LEFT JOIN geo g ON g.ip = i.ip AND {S.AS_OF} - INTERVAL 7 DAY < g.cached_at)
SELECT ip,
  CASE WHEN priv THEN 'Private' ELSE coalesce(country, 'Unknown') END AS country,
  CASE WHEN priv THEN 'LAN' ELSE coalesce(country_code, '??') END AS country_code,
  CASE WHEN priv THEN 'LAN' ELSE coalesce(city, 'Unknown') END AS city,
  CASE WHEN priv THEN 'Private Network' ELSE coalesce(org, 'Unknown') END AS org,
  priv AS is_private,
  CASE WHEN priv THEN '[LAN]' ELSE '[' || coalesce(country_code, '??') || ' / ' || coalesce(city, 'Unknown')
       || ' / ' || coalesce(org, 'Unknown') || ']' END AS geo_label
FROM j""")
def geo_enrich(spark, sf_dir):
    """Geo attributes of every event address at as_of (cache rows older than 7 days are stale)."""
    ips = tb.event_view(spark, sf_dir).select(F.col("src_ip").alias("ip")).filter(
        F.col("ip").isNotNull()).distinct()
    geo = G.geo_latest(tb.geo_log(spark, sf_dir))
    e = G.geo_enrich(ips, geo, "ip", tb.AS_OF)
    return e.select("ip", "country", "country_code", "city", "org", "is_private",
                    G.geo_label(F.col("ip"), F.col("is_private"), F.col("country_code"), F.col("city"),
                                F.col("org")).alias("geo_label"))


@query("geo_cache_misses", f"WITH {tb.SQL_EVENT_VIEW}, {tb.SQL_GEO}" + f"""
SELECT DISTINCT src_ip AS ip FROM ev e
WHERE src_ip IS NOT NULL AND src_ip <> '' AND NOT {S.is_private("src_ip")}
  AND NOT EXISTS (SELECT 1 FROM geo g WHERE g.ip = e.src_ip AND {S.AS_OF} - INTERVAL 7 DAY < g.cached_at)""")
def geo_cache_misses(spark, sf_dir):
    """External event addresses without a fresh cache row at as_of (work list for a loader)."""
    ips = tb.event_view(spark, sf_dir).select(F.col("src_ip").alias("ip"))
    geo = G.geo_latest(tb.geo_log(spark, sf_dir))
    return G.geo_misses(ips, geo, tb.AS_OF)


@query("geo_cache_latest", f"WITH {tb.SQL_GEO}" + f"""
SELECT ip, country, country_code, city, org, {S.iso("cached_at")} AS cached_at FROM geo""")
def geo_cache_latest(spark, sf_dir):
    """Geo cache table from the lookup log: newest lookup per address wins."""
    g = G.geo_latest(tb.geo_log(spark, sf_dir))
    return g.select("ip", "country", "country_code", "city", "org", iso_text("cached_at").alias("cached_at"))


@query("chain_replay_candidates", FULL + f"""
SELECT chain_name, ip, {S.iso("TIMESTAMP '1970-01-01 00:00:00' + to_seconds(sec)")} AS at FROM chc""")
def chain_replay_candidates(spark, sf_dir):
    """Trigger alerts whose 'then' rule alerted for the same address within the chain window."""
    a = replay_alert_table(spark, sf_dir, with_chains=False)
    c = CH.chain_candidates_replay(a, CAT)
    return c.select("chain_name", "ip", iso_text(F.timestamp_seconds("sec")).alias("at"))


@query("chain_replay_fired", FULL + f"""
SELECT rule_name, severity, group_value, {S.iso("created_at")} AS created_at, description
FROM alc WHERE kind = 'chain'""")
def chain_replay_fired(spark, sf_dir):
    """Chain alerts after repeat suppression per (chain, address)."""
    a = replay_alert_table(spark, sf_dir, with_chains=True)
    return a.filter(F.col("kind") == "chain").select(
        "rule_name", "severity", "group_value", iso_text("created_at").alias("created_at"), "description")


@query("alert_table_replay", FULL + f"""
SELECT rule_name, severity, kind, src_ip, "user", group_value, {S.iso("created_at")} AS created_at,
       event_count FROM alc""")
def alert_table_replay(spark, sf_dir):
    """The whole alert table (rules, cross-source, chains) of a full replay."""
    a = replay_alert_table(spark, sf_dir, with_chains=True)
    return a.select("rule_name", "severity", "kind", "src_ip", "user", "group_value",
                    iso_text("created_at").alias("created_at"), "event_count")


@query("alert_window_event_ids", S.head(tb.catalogue()) + S.replay_alerts(tb.catalogue()) + f""",
wi AS (SELECT f.rule_idx, f.key, f.sec, m.event_id,
              row_number() OVER (PARTITION BY f.rule_idx, f.key, f.sec
                                 ORDER BY m.cond_idx, m.ts DESC, m.event_id DESC) AS rn
       FROM rf f JOIN m ON m.rule_idx = f.rule_idx AND m.key = f.key
        AND CAST(epoch(m.ts) AS BIGINT) BETWEEN f.sec - f.window_secs AND f.sec)
SELECT r.rule_name, w.key AS group_value, {S.iso("TIMESTAMP '1970-01-01 00:00:00' + to_seconds(w.sec)")} AS created_at,
       '[' || array_to_string(list(w.event_id ORDER BY w.rn), ', ') || ']' AS event_ids
FROM wi w JOIN rdim r USING (rule_idx) WHERE w.rn <= 50 GROUP BY r.rule_name, w.key, w.sec""")
def alert_window_event_ids(spark, sf_dir):
    """Newest 50 event ids inside the look-back window of every replayed alert."""
    ev = tb.event_view(spark, sf_dir)
    m = C.match_events(ev, CAT)
    fired = C.suppress_refires(C.replay_candidates(ev, CAT, matched=m), ["rule_idx", "key"])
    ids = C.window_event_ids(fired, m, 50)
    names = CAT.rules_df(spark).select("rule_idx", "rule_name")
    from .rule_queries import ids_text
    return ids.join(names, "rule_idx").select(
        "rule_name", F.col("key").alias("group_value"),
        iso_text(F.timestamp_seconds("sec")).alias("created_at"), ids_text(F.col("event_ids")).alias("event_ids"))



FULL_SKEW = S.full_head(CAT, skew=True) + S.replay_alerts(CAT) + S.described_alerts(CAT)


@query("skew_alert_table", FULL_SKEW + f"""
SELECT rule_name, kind, group_value, {S.iso("created_at")} AS created_at, event_count, description FROM alc""")
def skew_alert_table(spark, sf_dir):
    """Full replay (suppression, ids, prior score, geo, chains) on a skewed derivation of
    the events: 90 % of all rows belong to one user, i.e. one hot address and key."""
    ev = tb.event_view(spark, sf_dir, skew=True)
    geo = G.geo_latest(tb.geo_log(spark, sf_dir))
    a = correlate_replay(ev, CAT, geo, with_event_ids=True, with_chains=True)
    return a.select("rule_name", "kind", "group_value", iso_text("created_at").alias("created_at"),
                    "event_count", "description")


@query("skew_reputation", FULL_SKEW + f""",
feed AS (SELECT src_ip AS ip, {S.DELTA} AS delta FROM al WHERE group_by = 'src_ip' AND src_ip <> '')
SELECT ip, CAST(LEAST(100, sum(delta)) AS INTEGER) AS score, count(*) AS alert_count FROM feed GROUP BY ip""")
def skew_reputation(spark, sf_dir):
    """Reputation on the skewed derivation (the hot address holds most alerts)."""
    ev = tb.event_view(spark, sf_dir, skew=True)
    a = correlate_replay(ev, CAT, None, with_event_ids=False, with_chains=False)
    return R.reputation_table(a, CAT.tags).select("ip", "score", "alert_count")
