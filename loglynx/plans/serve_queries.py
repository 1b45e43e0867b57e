"""Registered read-side queries: lists, stats, acks, outbox, point-mode run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geo as G
from ..operators import notify as NT
from ..schema import iso_text
from ..session import materialize, work_dir
from ..sinks import tables as TB
from ..sources import testbed as tb
from . import serve as SV
from . import sqlparts as S
from .alert_queries import FULL, replay_alert_table
from .correlation import correlate_point
from .registry import query
from .rule_queries import ids_text

CAT = tb.catalogue()
APP = "loglynx"


def testbed_acks(alerts):
    """Acknowledgements of the test bed: alerts whose epoch second is divisible by 3
    (those divisible by 6 are acknowledged twice)."""
    sec = F.unix_seconds("created_at")
    once = alerts.filter(sec % 3 == 0)
    twice = alerts.filter(sec % 6 == 0)
    return once.unionByName(twice).select("alert_id", (F.col("created_at") + F.expr("INTERVAL 1 HOUR"))
                                          .alias("acked_at"))


ACKED = "(CAST(epoch(created_at) AS BIGINT) % 3 = 0)"


@query("events_filtered_latest", f"WITH {tb.SQL_EVENT_VIEW}" + f"""
SELECT event_id, {S.iso("ts")} AS ts, source, event_type, src_ip, message FROM ev
WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND source = 'auth_log' AND event_type = 'auth_failure'
ORDER BY ts DESC, event_id DESC LIMIT 100""")
def events_filtered_latest(spark, sf_dir):
    """Event list with filters (since, source, type), newest 100 (the API default)."""
    ev = tb.event_view(spark, sf_dir)
    q = SV.events_query(ev, since="2024-01-20 00:00:00", source="auth_log", event_type="auth_failure",
                        src_ip="", limit=100)
    return q.select("event_id", iso_text("ts").alias("ts"), "source", "event_type", "src_ip", "message")


@query("stored_events_latest", f"WITH {tb.SQL_EVENT_VIEW}" + f"""
SELECT event_id, {S.iso("ts")} AS ts, source, event_type, src_ip, message FROM ev
WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND source = 'auth_log' AND event_type = 'auth_failure'
ORDER BY ts DESC, event_id DESC LIMIT 100""")
def stored_events_latest(spark, sf_dir):
    """The event list served from a stored event table: events appended through the
    event sink (date partitions), read back with partition pruning and pushed filters."""
    path = work_dir(spark, "events-table")
    TB.append_events(tb.event_view(spark, sf_dir), path)
    stored = TB.read_events(spark, path)
    q = SV.events_query(stored, since="2024-01-20 00:00:00", source="auth_log", event_type="auth_failure",
                        limit=100)
    return q.select("event_id", iso_text("ts").alias("ts"), "source", "event_type", "src_ip", "message")


@query("count_events_since", f"WITH {tb.SQL_EVENT_VIEW}" + """
SELECT src_ip, count(*) AS n_events FROM ev
WHERE event_type = 'auth_failure' AND ts >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY src_ip""")
def count_events_since(spark, sf_dir):
    """Failed logins per address since a moment (the count used by correlation)."""
    return SV.count_events(tb.event_view(spark, sf_dir), "auth_failure", "2024-01-24 00:00:00")


def _alerts(spark, sf_dir):
    return replay_alert_table(spark, sf_dir, with_chains=True)


@query("stats_summary", FULL + f""",
evs AS (SELECT count(*) AS total_events, count(DISTINCT source) AS active_sources FROM ev),
als AS (SELECT count(*) AS total_alerts, count(*) FILTER (WHERE NOT {ACKED}) AS unacknowledged_alerts FROM alc)
SELECT total_events, total_alerts, unacknowledged_alerts, active_sources FROM evs, als""")
def stats_summary(spark, sf_dir):
    """Totals: events, alerts, unacknowledged alerts, active sources."""
    a = _alerts(spark, sf_dir)
    st = SV.stats(tb.event_view(spark, sf_dir), a, testbed_acks(a))
    return st.select("total_events", "total_alerts", "unacknowledged_alerts", "active_sources")


@query("alerts_by_severity", FULL + """
SELECT severity, count(*) AS n,
       CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 1 ELSE 0 END AS severity_level
FROM alc GROUP BY severity""")
def alerts_by_severity(spark, sf_dir):
    """Alert count per severity in display order (CRITICAL first; empty severities absent)."""
    return SV.severity_breakdown(_alerts(spark, sf_dir))


@query("events_by_source_share", f"WITH {tb.SQL_EVENT_VIEW}" + """,
g AS (SELECT source, count(*) AS n FROM ev GROUP BY source)
SELECT source, n, CAST(round(n * 100.0 / max(n) OVER ()) AS BIGINT) AS pct_of_max FROM g""")
def events_by_source_share(spark, sf_dir):
    """Events per source and the share of the largest source (bar width)."""
    return SV.source_shares(tb.event_view(spark, sf_dir))


@query("stats_maps", FULL + """,
es AS (SELECT source, count(*) AS n FROM ev GROUP BY source),
ss AS (SELECT severity, count(*) AS n FROM alc GROUP BY severity)
SELECT 'source' AS kind, source AS name, n FROM es UNION ALL SELECT 'severity', severity, n FROM ss""")
def stats_maps(spark, sf_dir):
    """The two maps of the stats endpoint (events by source, alerts by severity) as rows."""
    a = _alerts(spark, sf_dir)
    st = SV.stats(tb.event_view(spark, sf_dir), a, testbed_acks(a))
    es = st.select(F.explode("events_by_source").alias("name", "n")).select(F.lit("source").alias("kind"), "name", "n")
    ss = st.select(F.explode("alerts_by_severity").alias("name", "n")).select(F.lit("severity").alias("kind"), "name",
                                                                               "n")
    return es.unionByName(ss)


@query("unacked_alerts_latest", FULL + f"""
SELECT rule_name, severity, group_value, {S.iso("created_at")} AS created_at, description FROM alc
WHERE NOT {ACKED} ORDER BY created_at DESC, rule_name, group_value LIMIT 200""")
def unacked_alerts_latest(spark, sf_dir):
    """Newest 200 alerts without an acknowledgement."""
    a = _alerts(spark, sf_dir)
    q = SV.alerts_query(a, testbed_acks(a), limit=200, unacked_only=True)
    return q.select("rule_name", "severity", "group_value", iso_text("created_at").alias("created_at"), "description")


@query("alerts_latest_acked_flag", FULL + f"""
SELECT rule_name, group_value, {S.iso("created_at")} AS created_at, {ACKED} AS acknowledged FROM alc
ORDER BY created_at DESC, rule_name, group_value LIMIT 100""")
def alerts_latest_acked_flag(spark, sf_dir):
    """Newest 100 alerts with the acknowledged flag (repeat acks are harmless)."""
    a = _alerts(spark, sf_dir)
    q = SV.alerts_query(a, testbed_acks(a), limit=100)
    return q.select("rule_name", "group_value", iso_text("created_at").alias("created_at"), "acknowledged")


_TITLE = ("array_to_string(list_transform(string_split(replace(rule_name, '_', ' '), ' '), "
          "lambda w: upper(w[1]) || lower(w[2:])), ' ')")


@query("notification_outbox", FULL + f"""
SELECT rule_name, severity, {S.iso("created_at")} AS created_at,
       '[' || severity || '] {APP} — ' || {_TITLE} AS title,
       'Rule   : ' || rule_name || chr(10) || 'IP     : ' || coalesce(src_ip, 'None') || chr(10)
         || 'Detail : ' || description AS body,
       CASE severity WHEN 'LOW' THEN 'low' WHEN 'CRITICAL' THEN 'critical' ELSE 'normal' END AS urgency,
       CASE WHEN severity IN ('HIGH', 'CRITICAL') THEN 'dialog-warning' ELSE 'dialog-information' END AS icon
FROM alc WHERE (CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 1 ELSE 0 END) >= 2""")
def notification_outbox(spark, sf_dir):
    """Alerts at or above HIGH with notification title, body, urgency and icon."""
    box = NT.outbox(_alerts(spark, sf_dir), "HIGH", APP)
    return box.select("rule_name", "severity", iso_text("created_at").alias("created_at"), "title", "body",
                      "urgency", "icon")


@query("notification_sent_count", FULL + """
SELECT count(*) FILTER (WHERE (CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 1
                                ELSE 0 END) >= 1) AS n_sent FROM alc""")
def notification_sent_count(spark, sf_dir):
    """Notifications a batch would send at minimum MEDIUM."""
    return NT.sent_count(NT.outbox(_alerts(spark, sf_dir), "MEDIUM", APP, keep_skipped=True))


HIST_CUT = "2024-01-30 00:00:00"


def point_run(spark, sf_dir):
    """History = the replayed alert table before HIST_CUT, materialised once (it is
    read three times: dedup, prior reputation, chains) as a stored table would be."""
    ev = tb.event_view(spark, sf_dir)
    hist = materialize(replay_alert_table(spark, sf_dir, with_chains=True).filter(
        F.col("created_at") < F.lit(HIST_CUT).cast("timestamp")))
    geo = G.geo_latest(tb.geo_log(spark, sf_dir))
    return correlate_point(ev, CAT, tb.AS_OF, history=hist, geo=geo)


POINT_RUN_SQL = FULL + S.point_cands() + f""",
hist AS (SELECT * FROM alc WHERE created_at < TIMESTAMP '{HIST_CUT}'),
pcd AS (SELECT pc.* FROM pc WHERE NOT EXISTS (
          SELECT 1 FROM hist h WHERE h.rule_name = pc.rule_name AND h.group_value = pc.key
            AND h.created_at >= {S.AS_OF} - to_seconds(pc.window_secs))),
ranked AS (SELECT rule_idx, key, event_id,
                  row_number() OVER (PARTITION BY rule_idx, key ORDER BY cond_idx, ts DESC, event_id DESC) AS rn
           FROM pw),
ids AS (SELECT rule_idx, key, '[' || array_to_string(list(event_id ORDER BY rn), ', ') || ']' AS event_ids
        FROM ranked WHERE rn <= 50 GROUP BY rule_idx, key),
hrep AS (SELECT src_ip AS ip, LEAST(100, sum({S.DELTA})) AS hscore FROM hist
         WHERE group_by = 'src_ip' AND kind <> 'chain' AND src_ip <> '' GROUP BY src_ip),
pa AS (SELECT p.rule_idx, d.rule_name, d.severity, d.description AS base, d.group_by, p.key AS group_value,
              p.event_count, CASE WHEN d.n_conds > 1 THEN 'cross_source' ELSE 'single' END AS kind,
              CASE WHEN d.group_by = 'src_ip' THEN p.key END AS src_ip, ids.event_ids
       FROM pcd p JOIN rdim d USING (rule_idx) LEFT JOIN ids USING (rule_idx, key)),
pp AS (SELECT pa.*, CASE WHEN group_by = 'src_ip' AND src_ip <> '' THEN CAST(LEAST(100,
          coalesce(h.hscore, 0) + coalesce(sum(CASE WHEN group_by = 'src_ip' AND src_ip <> '' THEN {S.DELTA} END)
            OVER (PARTITION BY src_ip ORDER BY rule_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          AS INTEGER) ELSE 0 END AS prior_score
       FROM pa LEFT JOIN hrep h ON h.ip = pa.src_ip),
pgeo AS (SELECT a.*,
          CASE WHEN a.group_by = 'src_ip' AND a.src_ip <> '' AND NOT {S.is_private("a.src_ip")}
               THEN ' [' || coalesce(g.country_code, '??') || ' / ' || coalesce(g.city, 'Unknown') || ' / '
                    || coalesce(g.org, 'Unknown') || ']' ELSE '' END AS geo_text
       FROM pp a LEFT JOIN geo g ON g.ip = a.src_ip AND {S.AS_OF} - INTERVAL 7 DAY < g.cached_at),
pd AS (SELECT *,
          CASE WHEN kind = 'cross_source' THEN '[CROSS-SOURCE] ' || base || ' [src_ip=' || group_value || ']'
               ELSE base || ' [' || group_by || '=' || group_value || ', count=' || CAST(event_count AS VARCHAR) || ']'
          END || geo_text ||
          CASE WHEN prior_score > 0 THEN ' [rep:' || CAST(prior_score AS VARCHAR) || '/' || {S.label("prior_score")}
               || ']' ELSE '' END AS description
       FROM pgeo),
ptrig AS (SELECT c.*, p.group_value AS ip FROM pd p JOIN chains c ON p.rule_name = c.trig
          WHERE p.group_value <> '' AND p.kind <> 'chain'),
pch AS (SELECT * FROM ptrig t
        WHERE (EXISTS (SELECT 1 FROM pd n WHERE n.rule_name = t.then_rule AND n.group_value = t.ip)
               OR EXISTS (SELECT 1 FROM hist h WHERE h.rule_name = t.then_rule AND h.src_ip = t.ip
                            AND h.created_at >= {S.AS_OF} - to_seconds(t.window_secs)))
          AND NOT EXISTS (SELECT 1 FROM hist h WHERE h.kind = 'chain' AND h.rule_name = t.chain_name
                            AND h.src_ip = t.ip AND h.created_at >= {S.AS_OF} - to_seconds(t.window_secs))),
prun AS (
  SELECT rule_name, kind, group_value, event_count, prior_score, description, event_ids FROM pd
  UNION ALL
  SELECT chain_name, 'chain', ip, NULL, 0, '[CHAIN] ' || description || ' [src_ip=' || ip || ']', '[]' FROM pch)"""


@query("correlation_point_run", POINT_RUN_SQL + """
SELECT * FROM prun""")
def correlation_point_run(spark, sf_dir):
    """One evaluation of the catalogue at as_of against the alert history (replay alerts
    before 2024-01-30): dedup, newest-50 ids, prior score incl. earlier rules of the run,
    geo, description, and chains (same-run and history 'then', chain dedup)."""
    a = point_run(spark, sf_dir)
    return a.select("rule_name", "kind", "group_value", "event_count", "prior_score", "description",
                    ids_text(F.col("event_ids")).alias("event_ids"))


@query("run_and_report", POINT_RUN_SQL + """
SELECT count(*) AS n_fired FROM prun""")
def run_and_report(spark, sf_dir):
    """How many alerts (incl. chains) one evaluation run fires."""
    return point_run(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_fired"))


@query("flagship_alert_reputation", FULL + f""",
feed AS (SELECT src_ip AS ip, {S.DELTA} AS delta FROM al WHERE group_by = 'src_ip' AND src_ip <> ''),
rep AS (SELECT ip, CAST(LEAST(100, sum(delta)) AS INTEGER) AS score FROM feed GROUP BY ip)
SELECT a.rule_name, a.kind, a.severity, a.group_value, {S.iso("a.created_at")} AS created_at, a.event_count,
       coalesce(r.score, 0) AS ip_score, {S.label("coalesce(r.score, 0)")} AS ip_label
FROM alc a LEFT JOIN rep r ON r.ip = a.src_ip""")
def flagship_alert_reputation(spark, sf_dir):
    """Flagship: replay the whole catalogue over the full history (suppression, chains),
    build address reputation and label every alert with its address's final score."""
    from ..operators import reputation as R
    a = _alerts(spark, sf_dir)
    rep = R.reputation_table(a, CAT.tags).select(F.col("ip").alias("_ip"), "score")
    j = a.join(rep, a["src_ip"] == rep["_ip"], "left")
    score = F.coalesce(F.col("score"), F.lit(0))
    from ..functions.normalize import score_label
    return j.select("rule_name", "kind", "severity", "group_value", iso_text("created_at").alias("created_at"),
                    "event_count", score.alias("ip_score"), score_label(score).alias("ip_label"))


@query("chain_same_run", POINT_RUN_SQL + """
SELECT rule_name, group_value, description FROM prun WHERE kind = 'chain'""")
def chain_same_run(spark, sf_dir):
    """Chains of one evaluation run: triggers fired in this run, 'then' fired in this run
    or in the history window, minus chains already raised for the address in the window."""
    a = point_run(spark, sf_dir)
    return a.filter(F.col("kind") == "chain").select("rule_name", "group_value", "description")
