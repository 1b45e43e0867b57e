"""Test bed: the driver's tables seen as security data.

``events(event_id, ts, user_id, event_type, value, props)`` becomes the
normalised event table: each user is one host (one IP; a third of them
public), and each generic event type is one security event kind:

  error    -> auth_log / auth_failure          (key src_ip, user)
  view     -> auth_log / sudo_command          (key user, no IP)
  click    -> apache (even users) or nginx (odd users) access log line,
              status from ``value``; web_access / web_error / web_scan
  purchase -> netwatch / port_scan
  signup   -> homeguard / unknown_device

``customer`` + ``nation`` + ``orders`` give the geo cache.  Log *text* in the
seven source formats is rendered from the same rows, so the parsers are run
on data whose size grows with the tables, and checked against the columns.

Every expression here has a twin in ``SQL_*`` (DuckDB dialect) used by the
oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_session
from .catalogue import Catalogue
from .logs import WEB_SCAN_PREFIX, web_scan_relabel

# Parameters of the test bed (the data is ~13 rows per user and type over
# 30 days, so rule windows are days instead of seconds).
SCAN_THRESHOLD = 5          # 404s per (file, ip) that mark a scanner
AS_OF = "2024-01-31 00:00:00"
DEFAULT_YEAR = 2024

TESTBED_CATALOGUE = """
rules:
  - name: ssh_brute_force
    description: "3+ failed logins from the same IP within a day"
    severity: HIGH
    window_secs: 86400
    threshold: 3
    conditions: [{event_type: auth_failure, source: auth_log, group_by: src_ip}]
  - name: ssh_brute_force_slow
    description: "10+ failed logins from the same IP within a week (slow brute force)"
    severity: HIGH
    window_secs: 604800
    threshold: 10
    conditions: [{event_type: auth_failure, source: auth_log, group_by: src_ip}]
  - name: web_scanner
    description: "3+ scan requests from the same IP within a week (directory scan)"
    severity: HIGH
    window_secs: 604800
    threshold: 3
    conditions: [{event_type: web_scan, source: apache, group_by: src_ip}]
  - name: repeated_sudo
    description: "3+ sudo commands by the same user within a day"
    severity: MEDIUM
    window_secs: 86400
    threshold: 3
    conditions: [{event_type: sudo_command, source: auth_log, group_by: user}]
  - name: netwatch_port_scan
    description: "Port scan reported by the network monitor"
    severity: HIGH
    window_secs: 86400
    threshold: 1
    conditions: [{event_type: port_scan, source: netwatch, group_by: src_ip}]
  - name: homeguard_unknown_device
    description: "Unknown device reported by the device monitor"
    severity: HIGH
    window_secs: 86400
    threshold: 1
    conditions: [{event_type: unknown_device, source: homeguard, group_by: src_ip}]
  - name: suricata_port_scan
    description: "Port scan detected by the IDS"
    severity: HIGH
    window_secs: 86400
    threshold: 1
    conditions: [{event_type: port_scan, source: suricata, group_by: src_ip}]
  - name: nginx_web_scanner
    description: "3+ scan requests from same IP on nginx within a week"
    severity: HIGH
    window_secs: 604800
    threshold: 3
    conditions: [{event_type: web_scan, source: nginx, group_by: src_ip}]
  - name: unknown_device_then_portscan
    description: "Cross-source: unknown device AND port scan from same IP within a day"
    severity: CRITICAL
    window_secs: 86400
    threshold: 1
    conditions:
      - {event_type: unknown_device, source: homeguard, group_by: src_ip}
      - {event_type: port_scan, source: netwatch, group_by: src_ip}
chains:
  - {trigger: ssh_brute_force, then: netwatch_port_scan, severity: CRITICAL, window_secs: 172800,
     description: "Brute force + port scan from same IP"}
  - {trigger: nginx_web_scanner, then: ssh_brute_force, severity: CRITICAL, window_secs: 172800,
     description: "Web scan + brute force from same IP"}
  - {trigger: homeguard_unknown_device, then: ssh_brute_force, severity: CRITICAL, window_secs: 86400,
     description: "Unknown device attempting brute force"}
"""


def catalogue() -> Catalogue:
    return Catalogue.from_yaml(TESTBED_CATALOGUE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ip_of(user_id: Column) -> Column:
    """One address per user; users divisible by 3 are public (198.51.x.y)."""
    return F.concat(
        F.when(user_id % 3 == 0, F.lit("198.51.")).otherwise(F.lit("10.1.")),
        F.floor(user_id / 250).cast("string"), F.lit("."), (user_id % 250).cast("string"))


def status_of(value: Column) -> Column:
    return (F.when(value < 10, 200).when(value < 20, 301).when(value < 30, 401)
            .when(value < 60, 404).otherwise(500))


HOT_SHARE_MOD = 10  # skewed variant: every row with event_id % 10 <> 0 belongs to user 0 (90 %)


def base_rows(spark: SparkSession, sf_dir: str, skew: bool = False) -> DataFrame:
    """events with second-resolution UTC ``ts`` and the derived host columns.
    ``skew``: 90 % of all rows are moved to one user (one hot address / key)."""
    ensure_session(spark)
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    if skew:
        e = e.withColumn("user_id", F.when(F.col("event_id") % HOT_SHARE_MOD != 0, F.lit(0).cast("bigint"))
                         .otherwise(F.col("user_id")))
    uid = F.col("user_id")
    return e.select(
        "event_id",
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"),
        "user_id",
        F.col("event_type").alias("kind"),
        "value",
        ip_of(uid).alias("ip"),
        F.concat(F.lit("u"), uid.cast("string")).alias("uname"),
        status_of(F.col("value")).alias("status"),
    )


def event_view(spark: SparkSession, sf_dir: str, scan_threshold: int = SCAN_THRESHOLD,
               skew: bool = False) -> DataFrame:
    """Normalised events of the test bed (ground truth of the parsers).

    Columns: event_id, ts, source, event_type, severity, message, src_ip,
    dst_ip, user, raw, extra, file_path.
    """
    b = base_rows(spark, sf_dir, skew)
    k, uid, ip, st = F.col("kind"), F.col("user_id"), F.col("ip"), F.col("status")
    web_src = F.when(uid % 2 == 0, "apache").otherwise("nginx")
    source = (F.when(k.isin("error", "view"), "auth_log").when(k == "click", web_src)
              .when(k == "purchase", "netwatch").when(k == "signup", "homeguard"))
    etype = (F.when(k == "error", "auth_failure").when(k == "view", "sudo_command")
             .when(k == "click", F.when(st < 400, "web_access").otherwise("web_error"))
             .when(k == "purchase", "port_scan").when(k == "signup", "unknown_device"))
    sev = (F.when(k == "error", "LOW").when(k == "view", "MEDIUM")
           .when(k == "click", F.when(st.isin(200, 301, 404), "LOW").otherwise("MEDIUM"))
           .when(k == "purchase", F.when(F.col("value") >= 100, "HIGH").otherwise("MEDIUM"))
           .otherwise("HIGH"))
    web_user = F.when(F.col("event_id") % 2 == 0, F.col("uname"))
    user = F.when(k.isin("error", "view"), F.col("uname")).when(k == "click", web_user)
    src_ip = F.when(k != "view", ip)
    msg = (F.when(k == "error", F.format_string("Failed login for user '%s' from %s", F.col("uname"), ip))
           .when(k == "view", F.format_string("User '%s' ran sudo command: /usr/bin/id -u", F.col("uname")))
           .when(k == "click", F.format_string("GET /p/%d → %d from %s", F.col("event_id"), st, ip))
           .when(k == "purchase", F.format_string("port scan seen from %s", ip))
           .otherwise(F.format_string("Unknown device detected — MAC: %s | Vendor: Unknown | IP: %s",
                                      F.col("uname"), ip)))
    file_path = (F.when(k.isin("error", "view"), "auth.log")
                 .when(k == "click", F.concat(web_src, F.lit("_access.log")))
                 .when(k == "purchase", "netwatch.json").otherwise("homeguard.json"))
    ev = b.select(
        "event_id", "ts", source.alias("source"), etype.alias("event_type"), sev.alias("severity"),
        msg.alias("message"), src_ip.alias("src_ip"), F.lit(None).cast("string").alias("dst_ip"),
        user.alias("user"), F.lit(None).cast("string").alias("raw"), F.lit("{}").alias("extra"),
        file_path.alias("file_path"), st.alias("status"),
    )
    web = web_scan_relabel(ev.filter(F.col("source").isin("apache", "nginx")), scan_threshold)
    rest = ev.filter(~F.col("source").isin("apache", "nginx"))
    return rest.unionByName(web).drop("status")


SQL_EVENT_VIEW_T = f"""
b AS (
  SELECT event_id, date_trunc('second', ts) AS ts, user_id, event_type AS kind, value,
         CASE WHEN user_id % 3 = 0 THEN '198.51.' ELSE '10.1.' END
           || CAST(user_id // 250 AS VARCHAR) || '.' || CAST(user_id % 250 AS VARCHAR) AS ip,
         'u' || CAST(user_id AS VARCHAR) AS uname,
         CASE WHEN value < 10 THEN 200 WHEN value < 20 THEN 301 WHEN value < 30 THEN 401
              WHEN value < 60 THEN 404 ELSE 500 END AS status
  FROM {{events}}),
ev0 AS (
  SELECT event_id, ts, kind, status, user_id,
    CASE WHEN kind IN ('error','view') THEN 'auth_log'
         WHEN kind = 'click' THEN CASE WHEN user_id % 2 = 0 THEN 'apache' ELSE 'nginx' END
         WHEN kind = 'purchase' THEN 'netwatch' WHEN kind = 'signup' THEN 'homeguard' END AS source,
    CASE WHEN kind = 'error' THEN 'auth_failure' WHEN kind = 'view' THEN 'sudo_command'
         WHEN kind = 'click' THEN CASE WHEN status < 400 THEN 'web_access' ELSE 'web_error' END
         WHEN kind = 'purchase' THEN 'port_scan' WHEN kind = 'signup' THEN 'unknown_device' END AS event_type,
    CASE WHEN kind = 'error' THEN 'LOW' WHEN kind = 'view' THEN 'MEDIUM'
         WHEN kind = 'click' THEN CASE WHEN status IN (200, 301, 404) THEN 'LOW' ELSE 'MEDIUM' END
         WHEN kind = 'purchase' THEN CASE WHEN value >= 100 THEN 'HIGH' ELSE 'MEDIUM' END
         ELSE 'HIGH' END AS severity,
    CASE WHEN kind = 'error' THEN 'Failed login for user ''' || uname || ''' from ' || ip
         WHEN kind = 'view' THEN 'User ''' || uname || ''' ran sudo command: /usr/bin/id -u'
         WHEN kind = 'click' THEN 'GET /p/' || CAST(event_id AS VARCHAR) || ' → ' || CAST(status AS VARCHAR) || ' from ' || ip
         WHEN kind = 'purchase' THEN 'port scan seen from ' || ip
         ELSE 'Unknown device detected — MAC: ' || uname || ' | Vendor: Unknown | IP: ' || ip END AS message,
    CASE WHEN kind <> 'view' THEN ip END AS src_ip,
    CASE WHEN kind IN ('error','view') THEN uname
         WHEN kind = 'click' AND event_id % 2 = 0 THEN uname END AS "user"
  FROM b),
scanners AS (
  SELECT source, src_ip FROM ev0 WHERE kind = 'click' AND status = 404
  GROUP BY source, src_ip HAVING count(*) >= {SCAN_THRESHOLD}),
ev AS (
  SELECT e.event_id, e.ts, e.source,
    CASE WHEN s.src_ip IS NOT NULL AND e.event_type = 'web_error' THEN 'web_scan' ELSE e.event_type END AS event_type,
    CASE WHEN s.src_ip IS NOT NULL AND e.event_type = 'web_error' THEN 'HIGH' ELSE e.severity END AS severity,
    CASE WHEN s.src_ip IS NOT NULL AND e.event_type = 'web_error' THEN '{WEB_SCAN_PREFIX}' || e.message
         ELSE e.message END AS message,
    e.src_ip, e."user"
  FROM ev0 e LEFT JOIN scanners s ON e.source = s.source AND e.src_ip = s.src_ip AND e.kind = 'click')
"""
SQL_EVENT_VIEW = SQL_EVENT_VIEW_T.replace("{events}", "events")
SQL_EVENT_VIEW_SKEW = SQL_EVENT_VIEW_T.replace(
    "{events}", f"(SELECT event_id, ts, CASE WHEN event_id % {HOT_SHARE_MOD} <> 0 THEN CAST(0 AS BIGINT) "
                "ELSE user_id END AS user_id, event_type, value FROM events)")


def sql_rules_values(cat: Catalogue) -> str:
    """Catalogue as a DuckDB VALUES list (rule_idx, rule_name, description,
    severity, window_secs, threshold, n_conds, cond_idx, event_type, source, group_by, tag)."""
    def q(v):
        if v is None:
            return "NULL"
        if isinstance(v, (int,)):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"
    rows = [
        "(" + ", ".join(q(v) for v in r) + ")" for r in cat.condition_rows()
    ]
    return ("SELECT * FROM (VALUES " + ", ".join(rows) + ") AS t(rule_idx, rule_name, description, "
            "severity, window_secs, threshold, n_conds, cond_idx, event_type, source, group_by, tag)")


def sql_chains_values(cat: Catalogue) -> str:
    def q(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    rows = ["(" + ", ".join(q(v) for v in r) + ")" for r in cat.chain_rows()]
    return ("SELECT * FROM (VALUES " + ", ".join(rows) + ") AS t(chain_idx, chain_name, trig, then_rule, "
            "severity, window_secs, description)")


def geo_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geo lookup log derived from orders x customer x nation: one lookup per
    order for the customer's address (same address rule as the users)."""
    ensure_session(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    from ..functions.normalize import is_private
    ip = ip_of(F.col("o_custkey"))
    return j.select(
        ip.alias("ip"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("country_code"),
        F.col("c_mktsegment").alias("city"),
        F.concat(F.lit("AS"), (F.col("o_orderkey") % 1000).cast("string")).alias("org"),
        is_private(ip).alias("is_private"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp")
         + F.make_dt_interval(days=(F.col("o_orderkey") % 31).cast("int"))).alias("cached_at"),
    )


SQL_GEO = """
geo_log AS (
  SELECT CASE WHEN o.o_custkey % 3 = 0 THEN '198.51.' ELSE '10.1.' END
           || CAST(o.o_custkey // 250 AS VARCHAR) || '.' || CAST(o.o_custkey % 250 AS VARCHAR) AS ip,
         n.n_name AS country, 'N' || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS country_code,
         c.c_mktsegment AS city, 'AS' || CAST(o.o_orderkey % 1000 AS VARCHAR) AS org,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(o.o_orderkey % 31 AS INTEGER)) AS cached_at
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
geo AS (
  SELECT ip, country, country_code, city, org, cached_at FROM (
    SELECT *, row_number() OVER (PARTITION BY ip ORDER BY cached_at DESC, org DESC, country DESC,
                                 country_code DESC, city DESC) AS rn FROM geo_log) WHERE rn = 1)
"""
