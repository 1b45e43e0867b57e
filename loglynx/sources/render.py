"""Render test-bed rows as raw log text in the seven source formats.

The output is a line table ``(file_path, value)`` exactly like
``spark.read.text`` gives, so the parsers under test see real log text.
Which line kind a row becomes is a function of its kind and event_id, and
the ground truth of every field is a column of the row (see the SQL twins
in ``plans.parse_queries``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .testbed import base_rows


def syslog_stamp(ts: Column) -> Column:
    """'Jan  5 07:08:09' (day padded with a space, no year)."""
    return F.concat(F.date_format(ts, "MMM"), F.lit(" "), F.lpad(F.dayofmonth(ts).cast("string"), 2, " "),
                    F.lit(" "), F.date_format(ts, "HH:mm:ss"))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_rows(spark, sf_dir)


def auth_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """error -> failed login (every 4th as 'invalid user'), view -> sudo,
    signup -> accepted login, purchase -> useradd (even id) / userdel (odd id),
    click -> a line no pattern accepts."""
    b = _rows(spark, sf_dir)
    k, i, u, ip = F.col("kind"), F.col("event_id"), F.col("uname"), F.col("ip")
    head = F.concat(syslog_stamp(F.col("ts")), F.lit(" node"), (F.col("user_id") % 7).cast("string"), F.lit(" "))
    invalid = F.when(i % 4 == 0, F.lit("invalid user ")).otherwise(F.lit(""))
    body = (
        F.when(k == "error", F.format_string("sshd[%d]: Failed password for %s%s from %s port %d ssh2",
                                             i, invalid, u, ip, 40000 + i % 20000))
        .when(k == "view", F.format_string("sudo: %s : TTY=pts/1 ; PWD=/home/%s ; USER=root ; COMMAND=/usr/bin/id -u",
                                           u, u))
        .when(k == "signup", F.format_string("sshd[%d]: Accepted publickey for %s from %s port 22 ssh2", i, u, ip))
        .when((k == "purchase") & (i % 2 == 0),
              F.format_string("useradd[%d]: new user: name=%s, UID=%d, GID=%d", i, u, 1000 + i, 1000 + i))
        .when(k == "purchase", F.format_string("userdel[%d]: delete user '%s'", i, u))
        .otherwise(F.format_string("cron[%d]: session opened for job %d", i, i))
    )
    return b.select(F.lit("auth.log").alias("file_path"), F.concat(head, body).alias("value"), "ts")


def syslog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind by event_id % 6: start / stop / failed start / OOM / segfault or disk / PAM."""
    b = _rows(spark, sf_dir)
    i, u, ip = F.col("event_id"), F.col("uname"), F.col("ip")
    svc = F.concat(F.lit("svc"), (F.col("user_id") % 40).cast("string"))
    head = F.concat(syslog_stamp(F.col("ts")), F.lit(" host"), (F.col("user_id") % 9).cast("string"), F.lit(" "))
    stop_word = F.when(F.floor(i / 6) % 2 == 0, F.lit("Stopped")).otherwise(F.lit("Stopping"))
    r = i % 6
    body = (
        F.when(r == 0, F.concat(F.lit("systemd[1]: Started "), svc, F.lit(".")))
        .when(r == 1, F.concat(F.lit("systemd[1]: "), stop_word, F.lit(" "), svc, F.lit(".")))
        .when(r == 2, F.concat(F.lit("systemd[1]: Failed to start "), svc, F.lit(".")))
        .when(r == 3, F.format_string("kernel: [%d.5] Out of memory: Kill process %d (proc%d) score 900",
                                      i, i, F.col("user_id") % 13))
        .when((r == 4) & (i % 12 == 4), F.format_string("kernel: [%d.2] segfault at 10 ip 00 sp 00 error 6", i))
        .when(r == 4, F.format_string("kernel: [%d.3] Buffer I/O error on device sdb%d, logical block %d",
                                      i, F.col("user_id") % 4, i))
        .otherwise(F.format_string("pam_unix(sshd:auth)[%d]: authentication failure; logname= uid=0 euid=0 "
                                   "tty=ssh ruser= rhost=%s user=%s", i, ip, u))
    )
    return b.select(F.lit("syslog").alias("file_path"), F.concat(head, body).alias("value"), "ts")


def web_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """click rows as combined access-log lines (apache for even users, nginx for odd);
    every 3rd line carries a +0100 offset (local time one hour ahead)."""
    b = _rows(spark, sf_dir).filter(F.col("kind") == "click")
    i, st = F.col("event_id"), F.col("status")
    off = i % 3 == 0
    local = F.when(off, F.col("ts") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts"))
    stamp = F.concat(F.date_format(local, "dd/MMM/yyyy:HH:mm:ss"),
                     F.when(off, F.lit(" +0100")).otherwise(F.lit(" +0000")))
    user = F.when(i % 2 == 0, F.col("uname")).otherwise(F.lit("-"))
    line = F.format_string('%s - %s [%s] "GET /p/%d HTTP/1.1" %d %d "-" "agent/1.0"',
                           F.col("ip"), user, stamp, i, st, 100 + i % 900)
    path = F.when(F.col("user_id") % 2 == 0, F.lit("apache_access.log")).otherwise(F.lit("nginx_access.log"))
    return b.select(path.alias("file_path"), line.alias("value"), "ts")


# ---------------------------------------------------------------------------
# IDS signatures used by the renderer (event_id % 5 picks one)
# ---------------------------------------------------------------------------
IDS_SIGNATURES = [
    ("ET SCAN Nmap Scripting Engine User-Agent", "Attempted Information Leak"),
    ("ET DNS Query for a suspicious domain", "Potentially Bad Traffic"),
    ("ET WEB_SERVER SQL injection attempt", "Web Application Attack"),
    ("GPL ATTACK_RESPONSE id check returned root", "Potentially Bad Traffic"),
    ("ET POLICY outbound connection", "Denial of Service Attack"),
]


def ids_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """purchase -> IDS alert record; signup -> non-alert flow record;
    every 10th view -> malformed text; other rows -> nothing."""
    b = _rows(spark, sf_dir).filter(
        F.col("kind").isin("purchase", "signup") | ((F.col("kind") == "view") & (F.col("event_id") % 10 == 0)))
    i = F.col("event_id")
    sig = F.element_at(F.array(*[F.lit(s) for s, _ in IDS_SIGNATURES]), (i % 5 + 1).cast("int"))
    cat = F.element_at(F.array(*[F.lit(c) for _, c in IDS_SIGNATURES]), (i % 5 + 1).cast("int"))
    stamp = F.concat(F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000000+0000"))
    alert = F.struct(F.lit("allowed").alias("action"), F.lit(1).alias("gid"),
                     (2000000 + i % 1000).alias("signature_id"), F.lit(1).alias("rev"),
                     sig.alias("signature"), cat.alias("category"),
                     F.when(i % 4 > 0, i % 4).alias("severity"))
    rec = F.struct(stamp.alias("timestamp"), i.alias("flow_id"),
                   F.when(F.col("kind") == "purchase", "alert").otherwise("flow").alias("event_type"),
                   F.col("ip").alias("src_ip"), (40000 + i % 20000).alias("src_port"),
                   F.lit("10.0.0.1").alias("dest_ip"), F.lit(22).alias("dest_port"), F.lit("TCP").alias("proto"),
                   F.when(F.col("kind") == "purchase", alert).alias("alert"))
    line = F.when(F.col("kind") == "view", F.concat(F.lit("{not json "), i.cast("string"))).otherwise(F.to_json(rec))
    return b.select(F.lit("eve.json").alias("file_path"), line.alias("value"), "ts")


def netwatch_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """purchase rows as network-monitor records (NDJSON).  Type by id % 3
    (PORT_SCAN, dns_anomaly, BEACON); severity only for value >= 100
    (lower case); details only for even ids."""
    b = _rows(spark, sf_dir).filter(F.col("kind") == "purchase")
    i = F.col("event_id")
    typ = F.element_at(F.array(F.lit("PORT_SCAN"), F.lit("dns_anomaly"), F.lit("BEACON")), (i % 3 + 1).cast("int"))
    rec = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        typ.alias("type"),
        F.when(F.col("value") >= 100, F.lit("high")).alias("severity"),
        F.col("ip").alias("src_ip"),
        F.when(i % 2 == 0, F.format_string("scan from %s", F.col("ip"))).alias("details"),
    )
    return b.select(F.lit("netwatch.json").alias("file_path"), F.to_json(rec).alias("value"), "ts")


def homeguard_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """signup rows as device-monitor records (NDJSON); vendor only for even ids."""
    b = _rows(spark, sf_dir).filter(F.col("kind") == "signup")
    i = F.col("event_id")
    mac = F.concat(F.lit("02:00:00:00:"), F.lpad(F.hex(F.col("user_id") % 256), 2, "0"), F.lit(":01"))
    rec = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        mac.alias("mac"),
        F.col("ip").alias("ip"),
        F.when(i % 2 == 0, F.lit("Acme")).alias("vendor"),
        F.lit("UNKNOWN_DEVICE").alias("alert"),
    )
    return b.select(F.lit("homeguard.json").alias("file_path"), F.to_json(rec).alias("value"), "ts")


TS_FORMATS = 6


def timestamp_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event time written in one of six shapes (event_id % 6): syslog,
    web with offset, ISO, space-separated, ISO with fraction, ISO with
    fraction and offset.  -> event_id, raw_ts."""
    e = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select("event_id", "ts")
    ts = F.col("ts").cast("timestamp")
    r = F.col("event_id") % TS_FORMATS
    txt = (
        F.when(r == 0, syslog_stamp(ts))
        .when(r == 1, F.concat(F.date_format(ts + F.expr("INTERVAL 2 HOURS"), "dd/MMM/yyyy:HH:mm:ss"),
                               F.lit(" +0200")))
        .when(r == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(r == 3, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(r == 4, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .otherwise(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+0000")))
    )
    return e.select("event_id", F.concat(F.lit("  "), txt, F.lit(" ")).alias("raw_ts"))
