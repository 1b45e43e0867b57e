"""DuckDB SQL building blocks for the oracle side of the test-bed queries.

These are plain SQL texts (CTEs) assembled from the same catalogue data the
Spark side uses; nothing here runs in Spark.
"""

from __future__ import annotations

from ..sources import testbed as tb
from ..sources.catalogue import Catalogue

AS_OF = f"TIMESTAMP '{tb.AS_OF}'"


def head(cat: Catalogue, skew: bool = False) -> str:
    """WITH-prefix: event view, rule conditions and matched events (m)."""
    return f"""WITH {tb.SQL_EVENT_VIEW_SKEW if skew else tb.SQL_EVENT_VIEW},
rules AS ({tb.sql_rules_values(cat)}),
m AS (
  SELECT r.rule_idx, r.rule_name, r.description, r.severity, r.window_secs, r.threshold, r.n_conds,
         r.cond_idx, r.group_by, r.tag, e.event_id, e.ts,
         CASE r.group_by WHEN 'src_ip' THEN e.src_ip WHEN 'user' THEN e."user" END AS key
  FROM ev e JOIN rules r ON e.event_type = r.event_type AND (r.source IS NULL OR r.source = e.source)
  WHERE CASE r.group_by WHEN 'src_ip' THEN e.src_ip WHEN 'user' THEN e."user" END <> ''),
rdim AS (
  SELECT rule_idx, min(rule_name) AS rule_name, min(description) AS description, min(severity) AS severity,
         min(window_secs) AS window_secs, min(n_conds) AS n_conds, min(tag) AS tag,
         CASE WHEN min(n_conds) > 1 THEN 'src_ip' ELSE min(CASE WHEN cond_idx = 0 THEN group_by END) END AS group_by
  FROM rules GROUP BY rule_idx)"""


def point_cands(as_of: str = AS_OF) -> str:
    """CTE pc: point-mode candidates at as_of."""
    return f""",
pw AS (SELECT * FROM m WHERE ts >= {as_of} - to_seconds(window_secs) AND ts <= {as_of}),
pg AS (SELECT rule_idx, rule_name, n_conds, threshold, window_secs, key, count(*) AS event_count,
              count(DISTINCT cond_idx) AS nc FROM pw GROUP BY ALL),
pc AS (SELECT g.rule_idx, g.rule_name, g.window_secs, g.key, g.event_count, d.group_by
       FROM pg g JOIN rdim d USING (rule_idx)
       WHERE (g.n_conds = 1 AND g.event_count >= g.threshold) OR (g.n_conds > 1 AND g.nc = g.n_conds))"""


def _windows(cat: Catalogue) -> list[int]:
    return sorted({int(r[4]) for r in cat.condition_rows()})


def replay_cands(cat: Catalogue) -> str:
    """CTEs ps (per-second counts), rc (replay candidates: rule_idx, key, sec, window_secs, window_count).
    One RANGE-frame window per distinct look-back length of the catalogue."""
    frames = []
    for w in _windows(cat):
        spec = f"OVER (PARTITION BY rule_idx, key ORDER BY sec RANGE BETWEEN {w} PRECEDING AND CURRENT ROW)"
        frames.append(f"SELECT rule_idx, n_conds, threshold, window_secs, key, sec, sum(c0) {spec} AS w0, "
                      f"sum(c1) {spec} AS w1 FROM ps WHERE window_secs = {w}")
    return f""",
ps AS (SELECT rule_idx, n_conds, threshold, window_secs, key, CAST(epoch(ts) AS BIGINT) AS sec,
              sum(CASE WHEN cond_idx = 0 THEN 1 ELSE 0 END) AS c0,
              sum(CASE WHEN cond_idx = 1 THEN 1 ELSE 0 END) AS c1
       FROM m GROUP BY ALL),
lb AS ({" UNION ALL ".join(frames)}),
rc AS (SELECT rule_idx, key, sec, window_secs,
              CAST(CASE WHEN n_conds > 1 THEN w0 + w1 ELSE w0 END AS BIGINT) AS window_count
       FROM lb WHERE (n_conds = 1 AND w0 >= threshold) OR (n_conds > 1 AND w0 >= 1 AND w1 >= 1))"""


def greedy(src: str, keys: str, out: str, windows: list[int], win: str = "window_secs") -> str:
    """CTEs <out>: greedy re-fire suppression of rows of <src> (keys..., sec, <win>).
    next(c) = first candidate > c + W (a RANGE frame per distinct W), then a
    recursive walk from each key's first candidate along next()."""
    k = [x.strip() for x in keys.split(",")]
    on2 = " AND ".join(f"n.{x} = f.{x}" for x in k)
    nx = " UNION ALL ".join(
        f"SELECT {keys}, sec, min(sec) OVER (PARTITION BY {keys} ORDER BY sec "
        f"RANGE BETWEEN {w + 1} FOLLOWING AND UNBOUNDED FOLLOWING) AS next_sec FROM {src} WHERE {win} = {w}"
        for w in windows)
    return f""",
{out}_nx AS ({nx}),
{out}_f AS (SELECT {keys}, min(sec) AS sec FROM {src} GROUP BY {keys}),
{out}_r({keys}, sec) AS (
  WITH RECURSIVE walk({keys}, sec) AS (
    SELECT {keys}, sec FROM {out}_f
    UNION ALL
    SELECT {", ".join("n." + x for x in k)}, n.next_sec FROM walk f JOIN {out}_nx n ON {on2} AND n.sec = f.sec
    WHERE n.next_sec IS NOT NULL)
  SELECT * FROM walk),
{out} AS (SELECT c.* FROM {src} c JOIN {out}_r r USING ({keys}, sec))"""


def replay_alerts(cat: Catalogue) -> str:
    """CTE al: replay-mode alerts (rule_idx, rule_name, severity, base, group_by, group_value,
    event_count, kind, created_at, src_ip, user, window_secs, tag)."""
    return replay_cands(cat) + greedy("rc", "rule_idx, key", "rf", _windows(cat)) + """,
al AS (SELECT f.rule_idx, d.rule_name, d.severity, d.description AS base, d.group_by, f.key AS group_value,
              f.window_count AS event_count,
              CASE WHEN d.n_conds > 1 THEN 'cross_source' ELSE 'single' END AS kind,
              (TIMESTAMP '1970-01-01 00:00:00' + to_seconds(f.sec)) AS created_at,
              CASE WHEN d.group_by = 'src_ip' THEN f.key END AS src_ip,
              CASE WHEN d.group_by = 'user' THEN f.key END AS "user",
              f.window_secs, d.tag
       FROM rf f JOIN rdim d USING (rule_idx))"""


def iso(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%S')"


def label(col: str) -> str:
    return (f"CASE WHEN {col} >= 85 THEN 'KNOWN_BAD' WHEN {col} >= 60 THEN 'MALICIOUS' "
            f"WHEN {col} >= 30 THEN 'SUSPICIOUS' ELSE 'CLEAN' END")


DELTA = ("CASE severity WHEN 'CRITICAL' THEN 25 WHEN 'HIGH' THEN 15 WHEN 'MEDIUM' THEN 8 "
         "WHEN 'LOW' THEN 3 ELSE 5 END")

PRIVATE = ("(regexp_matches({c}, '^(10\\.|172\\.(1[6-9]|2[0-9]|3[01])\\.|192\\.168\\.|127\\.|::1)'))")


def is_private(col: str) -> str:
    return "coalesce(" + PRIVATE.format(c=col) + ", false)"


def described_alerts(cat: Catalogue) -> str:
    """CTEs after ``al``: ald (alerts with prior score, geo text, description) and
    alc (ald + replay chains).  Needs SQL_GEO and a chains CTE."""
    return f""",
alp AS (SELECT al.*,
          CASE WHEN group_by = 'src_ip' AND src_ip <> '' THEN CAST(LEAST(100, COALESCE(
            sum(CASE WHEN group_by = 'src_ip' AND src_ip <> '' THEN {DELTA} END)
              OVER (PARTITION BY src_ip ORDER BY created_at, rule_idx
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS INTEGER) ELSE 0 END AS prior_score
        FROM al),
alg AS (SELECT a.*,
          CASE WHEN a.group_by = 'src_ip' AND a.src_ip <> '' AND NOT {is_private("a.src_ip")}
               THEN ' [' || coalesce(g.country_code, '??') || ' / ' || coalesce(g.city, 'Unknown') || ' / '
                    || coalesce(g.org, 'Unknown') || ']' ELSE '' END AS geo_text
        FROM alp a LEFT JOIN geo g ON g.ip = a.src_ip AND a.created_at - INTERVAL 7 DAY < g.cached_at),
ald AS (SELECT *,
          CASE WHEN kind = 'cross_source'
               THEN '[CROSS-SOURCE] ' || base || ' [src_ip=' || group_value || ']'
               ELSE base || ' [' || group_by || '=' || group_value || ', count=' || CAST(event_count AS VARCHAR) || ']'
          END || geo_text ||
          CASE WHEN prior_score > 0 THEN ' [rep:' || CAST(prior_score AS VARCHAR) || '/' || {label("prior_score")} || ']'
               ELSE '' END AS description
        FROM alg),
chc AS (SELECT c.chain_idx, c.chain_name, c.severity, c.description, c.window_secs, t.group_value AS ip,
               CAST(epoch(t.created_at) AS BIGINT) AS sec
        FROM al t JOIN chains c ON t.rule_name = c.trig
        WHERE t.group_value <> '' AND EXISTS (
          SELECT 1 FROM al n WHERE n.rule_name = c.then_rule AND n.group_value = t.group_value
            AND n.created_at BETWEEN t.created_at - to_seconds(c.window_secs) AND t.created_at
            AND (n.group_by = 'src_ip' OR n.created_at = t.created_at)))""" + greedy(
        "chc", "chain_idx, ip", "chf", sorted({int(r[5]) for r in cat.chain_rows()}) or [0]) + """,
alc AS (
  SELECT rule_idx, rule_name, severity, description, src_ip, "user", group_by, group_value, event_count, kind,
         created_at, prior_score FROM ald
  UNION ALL
  SELECT NULL, chain_name, severity, '[CHAIN] ' || description || ' [src_ip=' || ip || ']', ip, NULL,
         'src_ip', ip, NULL, 'chain', TIMESTAMP '1970-01-01 00:00:00' + to_seconds(sec), 0 FROM chf)"""


def full_head(cat: Catalogue, skew: bool = False) -> str:
    """head + geo + chains dims."""
    return head(cat, skew) + "," + tb.SQL_GEO + f",\nchains AS ({tb.sql_chains_values(cat)})"
