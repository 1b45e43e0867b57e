"""Registered streaming queries: rendered log files arrive in four time-ordered
chunks; each chunk triggers an ``availableNow`` run on the same checkpoint.
The oracle is the batch SQL of the same semantics (batch = stream)."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..operators import correlate as C
from ..schema import iso_text
from ..session import work_dir
from ..sinks import alert_log as AL
from ..sinks import tables as TB
from ..sources import logs as L
from ..sources import render as RD
from ..sources import tail as TL
from ..sources import testbed as tb
from ..sources.catalogue import Catalogue
from ..streaming import rules as SR
from ..streaming import runner as RN
from ..streaming import sinks as SS
from . import sqlparts as S
from .parse_queries import OPTS
from .registry import query
from .rule_queries import _fired_sql

AUTH_CAT = Catalogue.from_yaml("""
rules:
  - name: ssh_brute_force
    description: "3+ failed logins from the same IP within a day"
    severity: HIGH
    window_secs: 86400
    threshold: 3
    conditions: [{event_type: auth_failure, source: auth_log, group_by: src_ip}]
  - name: ssh_brute_force_slow
    description: "10+ failed logins from the same IP within a week"
    severity: HIGH
    window_secs: 604800
    threshold: 10
    conditions: [{event_type: auth_failure, source: auth_log, group_by: src_ip}]
  - name: repeated_sudo
    description: "3+ sudo commands by the same user within a day"
    severity: MEDIUM
    window_secs: 86400
    threshold: 3
    conditions: [{event_type: sudo_command, source: auth_log, group_by: user}]
chains:
  - {trigger: ssh_brute_force_slow, then: ssh_brute_force, severity: CRITICAL, window_secs: 172800,
     description: "Slow and fast brute force from the same IP"}
""")
BRUTE_ONLY = Catalogue(rules=[AUTH_CAT.rules[0]], chains=[], tags=AUTH_CAT.tags)
N_CHUNKS = 4


def chunk_of(ts):
    """Four time-ordered chunks of January."""
    return (F.when(ts < F.lit("2024-01-08").cast("timestamp"), 0)
            .when(ts < F.lit("2024-01-16").cast("timestamp"), 1)
            .when(ts < F.lit("2024-01-24").cast("timestamp"), 2).otherwise(3))


def _fires_stream(cat):
    def build(stream):
        return SR.exact_rule_alerts(L.parse_auth(stream, OPTS), cat, watermark="1 day")
    return build


@query("stream_exact_alerts", _fired_sql(AUTH_CAT))
def stream_exact_alerts(spark, sf_dir):
    """Auth-log files streamed in four chunks; keyed state gives the same alerts as the
    batch replay (look-back counts + re-fire suppression)."""
    lines = RD.auth_lines(spark, sf_dir)
    work = RN.run_chunks(spark, lines, chunk_of(F.col("ts")), N_CHUNKS, _fires_stream(AUTH_CAT),
                         RN.parquet_sink, "stream-exact")
    fires = spark.read.parquet(f"{work}/out").withColumnRenamed("window_count", "event_count")
    a = C.alert_frame(fires, AUTH_CAT, F.timestamp_seconds("sec"))
    return a.select("rule_name", "kind", "group_by", "group_value", iso_text("created_at").alias("created_at"),
                    "event_count")


def _keep_batches(b, i, work):
    TB.write_batch(b, f"{work}/out", i)


@query("stream_sliding_counts", f"WITH {tb.SQL_EVENT_VIEW}" + f""",
f AS (SELECT ip, CAST(epoch(ts) AS BIGINT) AS s FROM b WHERE kind = 'error'),
w AS (SELECT ip, s // 21600 * 21600 - i * 21600 AS ws FROM f, range(0, 4) AS r(i)),
g AS (SELECT ip, ws, count(*) AS n FROM w GROUP BY ip, ws HAVING count(*) >= 3)
SELECT 'ssh_brute_force' AS rule_name, ip AS key,
       {S.iso("TIMESTAMP '1970-01-01 00:00:00' + to_seconds(ws)")} AS window_start,
       {S.iso("TIMESTAMP '1970-01-01 00:00:00' + to_seconds(ws + 86400)")} AS window_end, n FROM g""")
def stream_sliding_counts(spark, sf_dir):
    """Sliding 1-day windows every 6 hours of failed logins per address, >= 3, with a
    watermark; updates are kept per batch and the last (largest) count wins."""
    lines = RD.auth_lines(spark, sf_dir)

    def build(stream):
        return SR.sliding_counts(L.parse_auth(stream, OPTS), BRUTE_ONLY, 86400, 21600, watermark="1 day")
    work = RN.run_chunks(spark, lines, chunk_of(F.col("ts")), N_CHUNKS, build, RN.batch_sink(_keep_batches),
                         "stream-sliding")
    out = spark.read.parquet(f"{work}/out")
    g = out.groupBy("rule_name", "key", "window_start", "window_end").agg(F.max("n").alias("n"))
    return g.select("rule_name", "key", iso_text("window_start").alias("window_start"),
                    iso_text("window_end").alias("window_end"), "n")


@query("stream_web_scan", f"WITH {tb.SQL_EVENT_VIEW}" + f"""
SELECT CASE WHEN user_id % 2 = 0 THEN 'apache' ELSE 'nginx' END AS source, ip AS src_ip,
       {S.iso("date_trunc('day', ts)")} AS window_start, count(*) AS n404
FROM b WHERE kind = 'click' AND status = 404
GROUP BY user_id % 2, ip, date_trunc('day', ts) HAVING count(*) >= 2""")
def stream_web_scan(spark, sf_dir):
    """Streaming scanner detection: 404s per (server, address, day) >= 2 from the access-log
    files of both servers."""
    lines = RD.web_lines(spark, sf_dir)

    def build(stream):
        # one folder holds both servers' lines; the rendered path says whose a line is
        return SR.web_scan_windows(_by_server(stream), 2, 86400, watermark="1 day", opts=OPTS)
    work = RN.run_chunks(spark, lines.withColumn("value", _tagged()), chunk_of(F.col("ts")), N_CHUNKS, build, RN.batch_sink(_keep_batches),
                         "stream-webscan")
    out = spark.read.parquet(f"{work}/out")
    g = out.groupBy("source", "src_ip", "window_start").agg(F.max("n404").alias("n404"))
    return g.select("source", "src_ip", iso_text("window_start").alias("window_start"), "n404")


def _tagged():
    """The line behind its server's name (chunk files carry no server)."""
    return F.concat(F.substring_index("file_path", "_", 1), F.lit("\t"), F.col("value"))


def _by_server(stream):
    server, line = F.substring_index("value", "\t", 1), F.substring_index("value", "\t", -1)
    return {k: stream.filter(server == k).select(F.concat(F.lit(k), F.lit("_access.log")).alias("file_path"), line.alias("value"))
            for k in ("apache", "nginx")}


SCAN_CAT = Catalogue(rules=[r for r in tb.catalogue().rules if r["name"] == "nginx_web_scanner"] + [
    dict(next(r for r in tb.catalogue().rules if r["name"] == "nginx_web_scanner"), name="web_scanner",
         conditions=[{"event_type": "web_scan", "source": "apache", "group_by": "src_ip"}])],
    chains=[], tags=tb.catalogue().tags)


@query("stream_scanner_alerts", _fired_sql(SCAN_CAT))
def stream_scanner_alerts(spark, sf_dir):
    """Both scanner rules on streams: a first query relabels scanners' web errors and writes the event
    table, a second evaluates the rules on that table; equal to the batch replay."""
    lines = RD.web_lines(spark, sf_dir)

    def events(stream):
        w = SR.stream_events(spark, _by_server(stream), OPTS, relabel=True, hold_secs=366 * 86400)
        return w.select("event_id", "ts", "source", "event_type", "src_ip")
    work = RN.run_chunks(spark, lines.withColumn("value", _tagged()), chunk_of(F.col("ts")), N_CHUNKS, events, RN.parquet_sink, "stream-relabel")
    table = spark.read.parquet(f"{work}/out").filter(F.col("event_type") == "web_scan")
    again = RN.run_table(spark, table, lambda s: SR.exact_rule_alerts(s, SCAN_CAT, watermark="31 days", order="arrival"), "stream-scan-rules")
    fires = spark.read.parquet(f"{again}/out").withColumnRenamed("window_count", "event_count")
    a = C.alert_frame(fires, SCAN_CAT, F.timestamp_seconds("sec"))
    return a.select("rule_name", "kind", "group_by", "group_value", iso_text("created_at").alias("created_at"),
                    "event_count")


def _measured(lines) -> tuple[int, str]:
    """(lines, the watermark delay their chunks need): the running query may see one log file grown and another not
    yet, so a line can come as late as its chunk is long; a day at least."""
    chunks = lines.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), (F.max(F.unix_seconds("ts")) - F.min(F.unix_seconds("ts"))).alias("secs")).collect()
    return sum(c.n for c in chunks), f"{max([86400, *(c.secs + 1 for c in chunks if c.secs is not None)])} seconds"


def _log_of(value, logs: int):
    """The log file of a line: an address's lines share one, which keeps them in order; lines without an address
    are dealt by their text."""
    address = F.regexp_extract(value, r"from (\S+)", 1)
    return F.pmod(F.xxhash64(F.when(address == "", value).otherwise(address)), F.lit(logs))


def _grow_logs(lines, folder: str, upto: int) -> None:
    """The log files as they are once ``upto`` chunks were written: a task gets its files' lines in order (Spark sorts
    and spills them), writes them batch by batch and puts each file in place whole, so a file only ever grows, also if
    a task runs twice.  Lines without a time belong to the last chunk and stay behind the others."""
    rows = lines.filter(F.col("chunk") <= upto).select("log", "ts", "value")
    dealt = rows.repartition("log").sortWithinPartitions("log", F.asc_nulls_last("ts"), F.asc_nulls_last("value")).select("log", "value")

    def write(batches):
        os.makedirs(folder, exist_ok=True)
        log, f, n, new = None, None, 0, f"{folder}/.{uuid.uuid4().hex}"

        def done():
            f.close()
            os.replace(new, f"{folder}/auth-{log}.log")
            return pa.RecordBatch.from_arrays([pa.array([log], pa.int64()), pa.array([n], pa.int64())], names=["log", "n"])
        try:
            for batch in batches:
                keys = batch.column(0).to_numpy()
                at = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
                for a, b in zip(at[:-1], at[1:]):
                    if a == b:
                        continue
                    if keys[a] != log:
                        if f is not None:
                            yield done()
                        log, n, f = int(keys[a]), 0, open(new, "w", encoding="utf-8")
                    f.writelines(f"{v}\n" for v in batch.column(1).slice(a, b - a).to_pylist())
                    n += b - a
            if f is not None:
                yield done()
        finally:
            if f is not None:
                f.close()
    dealt.mapInArrow(write, "log long, n long").write.format("noop").mode("overwrite").save()


@query("stream_tail_alerts", _fired_sql(BRUTE_ONLY))
def stream_tail_alerts(spark, sf_dir):
    """Growing log files followed by one running query with a processing-time trigger (``run_continuous``):
    every chunk is appended to the same files, by address, while the query runs."""
    lines = RD.auth_lines(spark, sf_dir).withColumn("chunk", chunk_of(F.col("ts")))
    rows, delay = _measured(lines)
    logs = max(1, rows // 20_000)  # the number of log files follows the rows
    lines = lines.withColumn("log", _log_of(F.col("value"), logs))
    work = work_dir(spark, "stream-tail")
    folder = f"{work}/logs"
    events = L.parse_auth(TL.tail_lines(spark, f"{folder}/*.log", start="start"), OPTS)
    q = SR.run_continuous(SR.exact_rule_alerts(events, BRUTE_ONLY, watermark=delay),
                          lambda b, i: TB.write_batch(b, f"{work}/out", i), f"{work}/ckpt", trigger_secs=0)
    try:
        for i in range(N_CHUNKS):
            _grow_logs(lines, folder.replace("file:", ""), i)
            q.processAllAvailable()
    finally:
        q.stop()
    fires = spark.read.parquet(f"{work}/out").withColumnRenamed("window_count", "event_count")
    a = C.alert_frame(fires, BRUTE_ONLY, F.timestamp_seconds("sec"))
    return a.select("rule_name", "kind", "group_by", "group_value", iso_text("created_at").alias("created_at"),
                    "event_count")


CROSS_CAT = Catalogue(rules=[r for r in tb.catalogue().rules if r["name"] == "unknown_device_then_portscan"], chains=[], tags=tb.catalogue().tags)


@query("stream_cross_source", f"WITH {tb.SQL_EVENT_VIEW}" + f""",
f AS (SELECT ip, kind, CAST(epoch(ts) AS BIGINT) AS s FROM b
      WHERE kind = 'signup' OR (kind = 'purchase' AND event_id % 3 = 0)),  -- every third record is a port scan
w AS (SELECT ip, kind, s // 21600 * 21600 - i * 21600 AS ws FROM f, range(0, 4) AS r(i)),
g AS (SELECT ip, ws, count(*) AS n FROM w GROUP BY ip, ws HAVING count(DISTINCT kind) = 2)
SELECT 'unknown_device_then_portscan' AS rule_name, ip AS key,
       {S.iso("TIMESTAMP '1970-01-01 00:00:00' + to_seconds(ws)")} AS window_start, n FROM g""")
def stream_cross_source(spark, sf_dir):
    """A cross-source rule in sliding windows: both conditions must be seen in the window."""
    sources = {"netwatch": RD.netwatch_lines(spark, sf_dir), "homeguard": RD.homeguard_lines(spark, sf_dir)}

    def build(dirs):
        return SR.sliding_counts(SR.stream_events(spark, dirs, OPTS), CROSS_CAT, 86400, 21600, watermark="1 day")
    work = RN.run_chunks_multi(spark, sources, lambda df: chunk_of(F.col("ts")), N_CHUNKS, build, RN.batch_sink(_keep_batches), "stream-cross")
    g = spark.read.parquet(f"{work}/out").groupBy("rule_name", "key", "window_start").agg(F.max("n").alias("n"))
    return g.select("rule_name", "key", iso_text("window_start").alias("window_start"), "n")


def _alert_tables(spark, sf_dir):
    lines = RD.auth_lines(spark, sf_dir)
    handle = {}

    def sink(b, i, work):
        if "fn" not in handle:
            handle["fn"] = SS.alert_sink(AUTH_CAT, f"{work}/tables")
        handle["fn"](b, i)
    work = RN.run_chunks(spark, lines, chunk_of(F.col("ts")), N_CHUNKS, _fires_stream(AUTH_CAT),
                         RN.batch_sink(sink, "append"), "stream-alerts")
    return f"{work}/tables"


_AUTH_FULL = S.full_head(AUTH_CAT) + S.replay_alerts(AUTH_CAT) + S.described_alerts(AUTH_CAT)


@query("stream_chain_alerts", _AUTH_FULL + f"""
SELECT rule_name, group_value, {S.iso("created_at")} AS created_at, description FROM alc WHERE kind = 'chain'""")
def stream_chain_alerts(spark, sf_dir):
    """Chains raised per micro-batch against the alert table (foreachBatch), with repeat
    suppression seeded from earlier batches — equal to the batch replay."""
    t = _alert_tables(spark, sf_dir)
    ch = AL.read(spark, f"{t}/chains")
    return ch.select("rule_name", "group_value", iso_text("created_at").alias("created_at"), "description")


@query("stream_reputation", _AUTH_FULL + f""",
feed AS (SELECT src_ip AS ip, created_at, rule_idx, {S.DELTA} AS delta, tag FROM al
         WHERE group_by = 'src_ip' AND src_ip <> '')
SELECT ip, CAST(LEAST(100, sum(delta)) AS INTEGER) AS score, {S.label("LEAST(100, sum(delta))")} AS label,
       count(*) AS alert_count, {S.iso("min(created_at)")} AS first_seen, {S.iso("max(created_at)")} AS last_seen
FROM feed GROUP BY ip""")
def stream_reputation(spark, sf_dir):
    """Reputation snapshot merged batch by batch (full outer join of snapshot and batch
    aggregate) — equal to the batch reputation table."""
    t = _alert_tables(spark, sf_dir)
    rep = SS.latest_reputation(spark, t)
    return rep.select("ip", "score", "label", "alert_count", iso_text("first_seen").alias("first_seen"),
                      iso_text("last_seen").alias("last_seen"))


@query("stream_ingest_parse", f"WITH {tb.SQL_EVENT_VIEW}" + """
SELECT 'auth_log' AS source, count(*) AS n_events FROM b WHERE kind <> 'click'
UNION ALL SELECT 'syslog', count(*) FROM b
UNION ALL SELECT 'apache', count(*) FROM b WHERE kind = 'click' AND user_id % 2 = 0
UNION ALL SELECT 'nginx', count(*) FROM b WHERE kind = 'click' AND user_id % 2 = 1
UNION ALL SELECT 'suricata', count(*) FROM b WHERE kind = 'purchase'
UNION ALL SELECT 'netwatch', count(*) FROM b WHERE kind = 'purchase'
UNION ALL SELECT 'homeguard', count(*) FROM b WHERE kind = 'signup'""")
def stream_ingest_parse(spark, sf_dir):
    """All seven sources as file streams (one folder per kind, four time-ordered chunks),
    parsed by the batch parsers and unioned into one event stream; rows per source."""
    web = RD.web_lines(spark, sf_dir)
    sources = {
        "auth": RD.auth_lines(spark, sf_dir), "syslog": RD.syslog_lines(spark, sf_dir),
        "apache": web.filter(F.col("file_path") == "apache_access.log"),
        "nginx": web.filter(F.col("file_path") == "nginx_access.log"),
        "suricata": RD.ids_lines(spark, sf_dir), "netwatch": RD.netwatch_lines(spark, sf_dir),
        "homeguard": RD.homeguard_lines(spark, sf_dir),
    }

    def build(dirs):
        return SR.stream_events(spark, dirs, OPTS).select("event_id", "ts", "source", "event_type")
    work = RN.run_chunks_multi(spark, sources, lambda df: chunk_of(F.col("ts")), N_CHUNKS, build,
                               RN.parquet_sink, "stream-ingest")
    ev = spark.read.parquet(f"{work}/out")
    return ev.groupBy("source").agg(F.count(F.lit(1)).alias("n_events"))


@query("stream_outbox", _AUTH_FULL + f"""
SELECT rule_name, severity, {S.iso("created_at")} AS created_at, urgency FROM (
  SELECT *, CASE severity WHEN 'LOW' THEN 'low' WHEN 'CRITICAL' THEN 'critical' ELSE 'normal' END AS urgency
  FROM alc) WHERE severity IN ('HIGH', 'CRITICAL')""")
def stream_outbox(spark, sf_dir):
    """Notification outbox appended per micro-batch (alerts and chains at or above HIGH)."""
    t = _alert_tables(spark, sf_dir)
    box = spark.read.parquet(f"{t}/outbox")
    return box.select("rule_name", "severity", iso_text("created_at").alias("created_at"), "urgency")
