"""Registered ingest queries: rendered log text -> parsers -> normalised rows.

The oracle side states the ground truth directly from the table columns
(the same rows the text was rendered from).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import sequences as SQ
from ..schema import iso_text, severity_level
from ..sources import logs as L
from ..sources import render as RD
from ..sources import testbed as tb
from . import sqlparts as S
from .registry import query

OPTS = L.ParseOptions(default_year=tb.DEFAULT_YEAR, web_scan_threshold=tb.SCAN_THRESHOLD)
B = f"WITH {tb.SQL_EVENT_VIEW}"


def _out(df, *cols):
    return df.select("event_type", "severity", iso_text("ts").alias("ts"), *cols)


def parsed_auth(spark, sf_dir):
    return L.parse_auth(RD.auth_lines(spark, sf_dir), OPTS)


AUTH_TRUTH = B + """,
au AS (
  SELECT event_id, ts, kind, uname, ip,
    CASE WHEN kind = 'error' THEN 'auth_failure' WHEN kind = 'view' THEN 'sudo_command'
         WHEN kind = 'signup' THEN 'auth_success'
         WHEN kind = 'purchase' AND event_id % 2 = 0 THEN 'user_created'
         WHEN kind = 'purchase' THEN 'user_deleted' END AS event_type
  FROM b WHERE kind <> 'click')
"""


@query("parse_auth_failure", AUTH_TRUTH + f"""
SELECT event_type, 'LOW' AS severity, {S.iso("ts")} AS ts, uname AS "user", ip AS src_ip,
       'Failed login for user ''' || uname || ''' from ' || ip AS message
FROM au WHERE event_type = 'auth_failure'""")
def parse_auth_failure(spark, sf_dir):
    """Failed logins (with and without 'invalid user') parsed from auth-log text."""
    p = parsed_auth(spark, sf_dir).filter(F.col("event_type") == "auth_failure")
    return _out(p, "user", "src_ip", "message")


@query("parse_auth_success", AUTH_TRUTH + f"""
SELECT event_type, 'LOW' AS severity, {S.iso("ts")} AS ts, uname AS "user", ip AS src_ip,
       'Successful login for user ''' || uname || ''' from ' || ip AS message
FROM au WHERE event_type = 'auth_success'""")
def parse_auth_success(spark, sf_dir):
    """Accepted logins parsed from auth-log text."""
    p = parsed_auth(spark, sf_dir).filter(F.col("event_type") == "auth_success")
    return _out(p, "user", "src_ip", "message")


@query("parse_sudo", AUTH_TRUTH + f"""
SELECT event_type, 'MEDIUM' AS severity, {S.iso("ts")} AS ts, uname AS "user", CAST(NULL AS VARCHAR) AS src_ip,
       'User ''' || uname || ''' ran sudo command: /usr/bin/id -u' AS message,
       '{{"command":"/usr/bin/id -u"}}' AS extra
FROM au WHERE event_type = 'sudo_command'""")
def parse_sudo(spark, sf_dir):
    """sudo command lines: user, command (extra) and MEDIUM severity."""
    p = parsed_auth(spark, sf_dir).filter(F.col("event_type") == "sudo_command")
    return _out(p, "user", "src_ip", "message", "extra")


@query("parse_user_admin", AUTH_TRUTH + f"""
SELECT event_type, CASE WHEN event_type = 'user_created' THEN 'MEDIUM' ELSE 'HIGH' END AS severity,
       {S.iso("ts")} AS ts, uname AS "user",
       CASE WHEN event_type = 'user_created' THEN 'New user created: ''' || uname || ''''
            ELSE 'User deleted: ''' || uname || '''' END AS message
FROM au WHERE event_type IN ('user_created', 'user_deleted')""")
def parse_user_admin(spark, sf_dir):
    """useradd / userdel lines (trailing comma of 'name=x,' removed)."""
    p = parsed_auth(spark, sf_dir).filter(F.col("event_type").isin("user_created", "user_deleted"))
    return _out(p, "user", "message")


@query("parse_auth_rejects", B + """
SELECT count(*) AS n_lines, count(*) FILTER (WHERE kind <> 'click') AS n_events FROM b""")
def parse_auth_rejects(spark, sf_dir):
    """Lines no auth pattern accepts are dropped (rendered junk lines)."""
    lines = RD.auth_lines(spark, sf_dir)
    ev = L.parse_auth(lines, OPTS)
    both = lines.select(F.lit(1).alias("is_line")).unionByName(ev.select(F.lit(0).alias("is_line")))
    return both.agg(F.count_if(F.col("is_line") == 1).alias("n_lines"),
                    F.count_if(F.col("is_line") == 0).alias("n_events"))


SYSLOG_TRUTH = B + """,
sl AS (
  SELECT event_id, ts, user_id, uname, event_id % 6 AS r,
    'svc' || CAST(user_id % 40 AS VARCHAR) AS svc, 'host' || CAST(user_id % 9 AS VARCHAR) AS host,
    CASE WHEN (event_id // 6) % 2 = 0 THEN 'Stopped' ELSE 'Stopping' END AS stop_word
  FROM b)
"""


@query("parse_syslog", SYSLOG_TRUTH + f"""
SELECT
  CASE WHEN r = 0 THEN 'service_start' WHEN r IN (1, 2) THEN 'service_stop' WHEN r = 5 THEN 'auth_failure'
       ELSE 'system_error' END AS event_type,
  CASE WHEN r = 0 THEN 'LOW' WHEN r = 1 THEN 'LOW' WHEN r = 2 THEN 'HIGH' WHEN r = 3 THEN 'HIGH'
       WHEN r = 4 AND event_id % 12 = 4 THEN 'MEDIUM' WHEN r = 4 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
  {S.iso("ts")} AS ts, CAST(NULL AS VARCHAR) AS "user",
  CASE WHEN r = 0 THEN 'Service started: ' || svc
       WHEN r = 1 THEN 'Service ' || lower(stop_word) || ': ' || svc
       WHEN r = 2 THEN 'Service failed to start: ' || svc
       WHEN r = 3 THEN 'OOM killer invoked — killed process: proc' || CAST(user_id % 13 AS VARCHAR)
       WHEN r = 4 AND event_id % 12 = 4 THEN 'Kernel segfault detected'
       WHEN r = 4 THEN 'Disk I/O error detected'
       ELSE 'PAM authentication failure' END AS message,
  '{{"host":"' || host || '"' ||
  CASE WHEN r = 0 THEN ',"service":"' || svc || '"}}'
       WHEN r = 1 THEN ',"service":"' || svc || '","action":"' || stop_word || '"}}'
       WHEN r = 2 THEN ',"service":"' || svc || '","action":"Failed to start"}}'
       WHEN r = 3 THEN ',"process":"proc' || CAST(user_id % 13 AS VARCHAR) || '"}}'
       ELSE '}}' END AS extra
FROM sl""")
def parse_syslog(spark, sf_dir):
    """Service start/stop, OOM, segfault, disk error and PAM failure lines."""
    p = L.parse_syslog(RD.syslog_lines(spark, sf_dir), OPTS)
    return _out(p, "user", "message", "extra")


@query("parse_web_access", B + f"""
SELECT source, event_type, severity, {S.iso("ts")} AS ts, src_ip, "user", message,
       '{{"method":"GET","path":"/p/' || CAST(event_id AS VARCHAR) || '","status":' || CAST(
         CAST(regexp_extract(message, '→ ([0-9]+)', 1) AS INTEGER) AS VARCHAR) || '}}' AS extra
FROM ev WHERE source IN ('apache', 'nginx')""")
def parse_web_access(spark, sf_dir):
    """Combined access-log lines of both web servers (offsets converted to UTC), with the
    per-file scanner relabel (>= 5 404s -> web_error becomes web_scan / HIGH)."""
    lines = RD.web_lines(spark, sf_dir)
    parts = [L.parse_web(lines.filter(F.col("file_path") == f"{s}_access.log"), s, OPTS) for s in ("apache", "nginx")]
    p = reduce(lambda a, b: a.unionByName(b), parts)
    return p.select("source", "event_type", "severity", iso_text("ts").alias("ts"), "src_ip", "user",
                    "message", "extra")


@query("web_scan_relabel", B + """
SELECT source, src_ip, event_type, count(*) AS n FROM ev WHERE source IN ('apache', 'nginx')
GROUP BY source, src_ip, event_type""")
def web_scan_relabel(spark, sf_dir):
    """Rows per (server, address, type) after the scanner relabel."""
    lines = RD.web_lines(spark, sf_dir)
    parts = [L.parse_web(lines.filter(F.col("file_path") == f"{s}_access.log"), s, OPTS) for s in ("apache", "nginx")]
    p = reduce(lambda a, b: a.unionByName(b), parts)
    return p.groupBy("source", "src_ip", "event_type").agg(F.count(F.lit(1)).alias("n"))


_SIGS = ", ".join("'" + s + "'" for s, _ in RD.IDS_SIGNATURES)
_CATS = ", ".join("'" + c + "'" for _, c in RD.IDS_SIGNATURES)


@query("parse_ids_json", B + f""",
ids AS (SELECT event_id, ts, ip, ([{_SIGS}])[event_id % 5 + 1] AS sig, ([{_CATS}])[event_id % 5 + 1] AS cat,
               event_id % 4 AS sev, event_id % 5 AS s
        FROM b WHERE kind = 'purchase')
SELECT CASE s WHEN 0 THEN 'port_scan' WHEN 1 THEN 'dns_anomaly' WHEN 2 THEN 'web_scan' WHEN 3 THEN 'unknown'
              ELSE 'system_error' END AS event_type,
       CASE sev WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'LOW' ELSE 'MEDIUM' END AS severity,
       {S.iso("ts")} AS ts, ip AS src_ip, '10.0.0.1' AS dst_ip, '[Suricata] ' || sig AS message,
       '{{"signature":"' || sig || '","category":"' || cat || '","sid":' || CAST(2000000 + event_id % 1000 AS VARCHAR)
         || ',"proto":"TCP","src_port":' || CAST(40000 + event_id % 20000 AS VARCHAR) || ',"dest_port":22}}' AS extra
FROM ids""")
def parse_ids_json(spark, sf_dir):
    """IDS EVE lines: alerts only (flow records and malformed text dropped), severity and
    type mapping, timestamps with fraction and offset."""
    p = L.parse_ids(RD.ids_lines(spark, sf_dir), OPTS)
    return p.select("event_type", "severity", iso_text("ts").alias("ts"), "src_ip", "dst_ip", "message", "extra")


@query("parse_json_alerts", B + f"""
SELECT 'netwatch' AS source,
       CASE event_id % 3 WHEN 0 THEN 'port_scan' WHEN 1 THEN 'dns_anomaly' ELSE 'unknown' END AS event_type,
       CASE WHEN value >= 100 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, {S.iso("ts")} AS ts, ip AS src_ip,
       CASE WHEN event_id % 2 = 0 THEN 'scan from ' || ip
            ELSE '{L.NETWATCH_DEFAULT_DETAILS}' || CASE event_id % 3 WHEN 0 THEN 'PORT_SCAN' WHEN 1 THEN 'DNS_ANOMALY'
                                             ELSE 'BEACON' END END AS message
FROM b WHERE kind = 'purchase'
UNION ALL
SELECT 'homeguard', 'unknown_device', 'HIGH', {S.iso("ts")}, ip,
       'Unknown device detected — MAC: 02:00:00:00:' || format('{{:02X}}', user_id % 256) || ':01 | Vendor: '
         || CASE WHEN event_id % 2 = 0 THEN 'Acme' ELSE 'Unknown' END || ' | IP: ' || ip
FROM b WHERE kind = 'signup'""")
def parse_json_alerts(spark, sf_dir):
    """Network-monitor and device-monitor records: type map, severity default, message defaults."""
    nw = L.json_lines_records(RD.netwatch_lines(spark, sf_dir), "netwatch", OPTS)
    hg = L.json_lines_records(RD.homeguard_lines(spark, sf_dir), "homeguard", OPTS)
    p = nw.unionByName(hg)
    return p.select("source", "event_type", "severity", iso_text("ts").alias("ts"), "src_ip", "message")


@query("normalize_timestamps", f"""
SELECT event_id, {S.iso("date_trunc('second', ts)")} AS ts FROM events""")
def normalize_timestamps(spark, sf_dir):
    """Six timestamp shapes (syslog without year, web with offset, ISO, space-separated,
    fraction, fraction + offset) normalised to whole-second UTC."""
    t = RD.timestamp_texts(spark, sf_dir)
    return t.select("event_id", iso_text(N.parse_timestamp(F.col("raw_ts"), tb.DEFAULT_YEAR)).alias("ts"))


_SRC = ["auth_log", "syslog", "apache", "nginx", "netwatch", "homeguard", "suricata", "manual", "bad_source",
        "Auth_Log"]
_TYP = ["auth_failure", "port_scan", "web_scan", "bogus", "service_stop", "unknown", "WEB_SCAN"]
_SEV = ["low", "High", "MEDIUM", "CRITICAL", "EXTREME", ""]


def _lst(xs):
    return "[" + ", ".join("'" + x + "'" for x in xs) + "]"


@query("normalize_coercion", f"""
WITH raw AS (SELECT event_id, {_lst(_SRC)}[event_id % {len(_SRC)} + 1] AS s,
                    {_lst(_TYP)}[event_id % {len(_TYP)} + 1] AS t, {_lst(_SEV)}[event_id % {len(_SEV)} + 1] AS v
             FROM events),
c AS (SELECT event_id,
        CASE WHEN s IN ('auth_log','syslog','apache','nginx','netwatch','homeguard','suricata','manual')
             THEN s ELSE 'manual' END AS source,
        CASE WHEN t IN ('auth_failure','auth_success','sudo_command','user_created','user_deleted','port_scan',
                        'dns_anomaly','unknown_device','bandwidth_spike','web_scan','web_error','web_access',
                        'service_start','service_stop','system_error','unknown') THEN t ELSE 'unknown' END AS event_type,
        CASE WHEN upper(v) IN ('LOW','MEDIUM','HIGH','CRITICAL') THEN upper(v) ELSE 'LOW' END AS severity
      FROM raw)
SELECT event_id, source, event_type, severity,
       CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 1 ELSE 0 END AS severity_level
FROM c""")
def normalize_coercion(spark, sf_dir):
    """Unknown source -> manual, unknown type -> unknown, severity upper-cased (unknown -> LOW), ordinal."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id")
    i = F.col("event_id")

    def pick(xs):
        return F.element_at(F.array(*[F.lit(x) for x in xs]), (i % len(xs) + 1).cast("int"))
    c = e.select("event_id", N.coerce_source(pick(_SRC)).alias("source"),
                 N.coerce_event_type(pick(_TYP)).alias("event_type"),
                 N.coerce_severity(pick(_SEV)).alias("severity"))
    return c.withColumn("severity_level", severity_level("severity"))


@query("auth_severity_consecutive", B + """,
a AS (SELECT event_id, ts, ip, kind = 'signup' AS ok FROM b WHERE kind IN ('error', 'signup')),
g AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY ip ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM a),
n AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY ip, grp ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS consecutive FROM g)
SELECT event_id, ip AS src_ip, CAST(consecutive AS BIGINT) AS consecutive,
       CASE WHEN consecutive >= 10 THEN 'HIGH' WHEN consecutive >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM n WHERE NOT ok""")
def auth_severity_consecutive(spark, sf_dir):
    """Failed-login severity by the run of failures since the address's last successful login."""
    b = tb.base_rows(spark, sf_dir).filter(F.col("kind").isin("error", "signup"))
    ev = b.select("event_id", "ts", F.col("ip").alias("src_ip"),
                  F.when(F.col("kind") == "signup", "auth_success").otherwise("auth_failure").alias("event_type"))
    return SQ.consecutive_failures(ev).select("event_id", "src_ip", "consecutive", "severity")


def all_parsed(spark, sf_dir):
    """Every rendered source through its parser, as one event table."""
    return reduce(lambda a, b: a.unionByName(b), [
        L.parse_auth(RD.auth_lines(spark, sf_dir), OPTS),
        L.parse_syslog(RD.syslog_lines(spark, sf_dir), OPTS),
        L.parse_web(RD.web_lines(spark, sf_dir).filter(F.col("file_path") == "apache_access.log"), "apache", OPTS),
        L.parse_web(RD.web_lines(spark, sf_dir).filter(F.col("file_path") == "nginx_access.log"), "nginx", OPTS),
        L.parse_ids(RD.ids_lines(spark, sf_dir), OPTS),
        L.json_lines_records(RD.netwatch_lines(spark, sf_dir), "netwatch", OPTS),
        L.json_lines_records(RD.homeguard_lines(spark, sf_dir), "homeguard", OPTS),
    ])


@query("ingest_union_counts", B + """
SELECT 'auth_log' AS source, 'auth.log' AS file_path, count(*) AS n_events FROM b WHERE kind <> 'click'
UNION ALL SELECT 'syslog', 'syslog', count(*) FROM b
UNION ALL SELECT 'apache', 'apache_access.log', count(*) FROM b WHERE kind = 'click' AND user_id % 2 = 0
UNION ALL SELECT 'nginx', 'nginx_access.log', count(*) FROM b WHERE kind = 'click' AND user_id % 2 = 1
UNION ALL SELECT 'suricata', 'eve.json', count(*) FROM b WHERE kind = 'purchase'
UNION ALL SELECT 'netwatch', 'netwatch.json', count(*) FROM b WHERE kind = 'purchase'
UNION ALL SELECT 'homeguard', 'homeguard.json', count(*) FROM b WHERE kind = 'signup'
UNION ALL SELECT NULL, NULL, (SELECT count(*) FROM b) * 2 + (SELECT count(*) FROM b WHERE kind = 'purchase') * 2
                             + (SELECT count(*) FROM b WHERE kind = 'signup')""")
def ingest_union_counts(spark, sf_dir):
    """All seven sources ingested into one table: rows per (source, file) and the total."""
    return L.ingest_counts(all_parsed(spark, sf_dir))
