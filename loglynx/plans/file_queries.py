"""Registered queries on files, single lookups, display helpers and late rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import geo as G
from ..operators import reputation as R
from ..schema import iso_text
from ..session import work_dir
from ..sources import logs as L
from ..sources import render as RD
from ..sources import testbed as tb
from ..streaming import rules as SR
from ..streaming import runner as RN
from . import serve as SV
from . import sqlparts as S
from .alert_queries import REP_SQL, _rep
from .parse_queries import B, OPTS
from .registry import query
from .robust_queries import record_lines
from .stream_queries import BRUTE_ONLY, N_CHUNKS, chunk_of


@query("ingest_web_and_ids_files", B + f"""
SELECT 'apache' AS source, count(*) AS n_events, {S.iso("min(ts)")} AS first_ts, {S.iso("max(ts)")} AS last_ts, count(*) AS n_ids
FROM b WHERE kind = 'click' AND user_id % 2 = 0
UNION ALL SELECT 'nginx', count(*), {S.iso("min(ts)")}, {S.iso("max(ts)")}, count(*) FROM b WHERE kind = 'click' AND user_id % 2 = 1
UNION ALL SELECT 'suricata', count(*), {S.iso("min(ts)")}, {S.iso("max(ts)")}, count(*) FROM b WHERE kind = 'purchase'""")
def ingest_web_and_ids_files(spark, sf_dir):
    """Access logs of both servers and the intrusion detector's file, read from files in the shared folder."""
    root = work_dir(spark, "ingest-web-ids")
    web = RD.web_lines(spark, sf_dir)
    for kind in ("apache", "nginx"):
        web.filter(F.col("file_path") == f"{kind}_access.log").select("value").write.text(f"{root}/{kind}")
    RD.ids_lines(spark, sf_dir).select("value").write.text(f"{root}/suricata")
    ev = L.ingest(spark, {k: f"{root}/{k}" for k in ("apache", "nginx", "suricata")}, OPTS)
    return ev.groupBy("source").agg(F.count(F.lit(1)).alias("n_events"), iso_text(F.min("ts")).alias("first_ts"),
                                    iso_text(F.max("ts")).alias("last_ts"), F.count_distinct("event_id").alias("n_ids"))


@query("ingest_equal_lines", B + """,
n AS (SELECT CASE kind WHEN 'error' THEN 'auth_failure' WHEN 'view' THEN 'sudo_command' WHEN 'signup' THEN 'auth_success' END AS event_type,
             CASE WHEN event_id % 5 = 0 AND kind <> 'view' THEN 3 ELSE 1 END AS times FROM b WHERE kind IN ('error', 'view', 'signup'))
SELECT event_type, CAST(sum(times) AS BIGINT) AS n_events, CAST(sum(times) AS BIGINT) AS n_ids, TRUE AS same_again FROM n GROUP BY event_type""")
def ingest_equal_lines(spark, sf_dir):
    """Every fifth login line stands three times in its file: each is an event with an id of its own, the same when read again."""
    root = work_dir(spark, "ingest-equal")
    lines = RD.auth_lines(spark, sf_dir).filter(~F.col("value").rlike(r"(useradd|userdel)\["))
    lines = lines.join(tb.base_rows(spark, sf_dir).filter(F.col("event_id") % 5 == 0).select(F.col("event_id").cast("string").alias("of")),
                       F.regexp_extract("value", r"sshd\[(\d+)\]", 1) == F.col("of"), "left")
    lines = lines.select("value", F.explode(F.sequence(F.lit(1), F.when(F.col("of").isNotNull(), 3).otherwise(1))))
    lines.select("value").write.text(f"{root}/auth")
    once, again = (L.ingest(spark, {"auth": f"{root}/auth"}, OPTS).select("event_id", "event_type") for _ in range(2))
    same = again.groupBy("event_type").agg(F.sum(F.col("event_id").cast("decimal(38,0)")).alias("ids_again"))
    told = once.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_id").alias("n_ids"),
                                          F.sum(F.col("event_id").cast("decimal(38,0)")).alias("ids"))
    return told.join(same, "event_type").select("event_type", "n_events", "n_ids", (F.col("ids") == F.col("ids_again")).alias("same_again"))


@query("ingest_json_ranges", B + f"""
SELECT shape, count(*) AS n_events, count(*) AS n_ids, {S.iso("min(ts)")} AS first_ts, {S.iso("max(ts)")} AS last_ts, TRUE AS as_lines
FROM b, (SELECT unnest(['list', 'member']) AS shape)
WHERE kind = 'purchase' AND event_id % 7 <> 0 AND event_id % 11 <> 0 GROUP BY shape""")
def ingest_json_ranges(spark, sf_dir):
    """Monitor files of both shapes, each cut into ranges of 64 KB: the same events as from the records as lines.  Elements
    that are no records stand between them; a file has up to 200,000 records, so the number of files follows the rows."""
    root = work_dir(spark, "json-ranges")
    recs = record_lines(spark, sf_dir).filter(L._is_record(F.col("value"))).select("value")
    n_files = max(1, recs.count() // 200_000)
    recs = recs.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(n_files))).withColumn("place", F.lit(1))
    lines = L.json_lines_records(recs.select(F.lit("lines").alias("file_path"), "value"), "netwatch", OPTS)
    digest = F.sum(F.xxhash64("ts", "event_type", "src_ip", "raw", "extra").cast("decimal(38,0)"))
    want = lines.agg(digest.alias("want"))
    out = []
    for shape, head, tail in (("list", '[7, "[{", ', "[{}], null]"), ("member", '{"alerts": 1, "of": [{"a": "\\""}], "alerts": [', '0], "rest": [{}]}')):
        ends = spark.range(n_files).select(F.explode(F.array(F.struct(F.lit(head).alias("value"), F.col("id").alias("part"), F.lit(0).alias("place")), F.struct(
            F.lit(tail).alias("value"), F.col("id").alias("part"), F.lit(2).alias("place")))).alias("x")).select("x.*")
        rows = recs.withColumn("value", F.concat("value", F.lit(","))).unionByName(ends)
        rows.repartition(n_files, "part").sortWithinPartitions("part", "place").select("value", "part").write.partitionBy("part").text(f"{root}/{shape}")
        ev = L.read_json_alerts(spark, f"{root}/{shape}/*", "netwatch", OPTS, split_bytes=64 << 10)
        got = ev.agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_id").alias("n_ids"), iso_text(F.min("ts")).alias("first_ts"),
                     iso_text(F.max("ts")).alias("last_ts"), digest.alias("got"))
        out.append(got.select(F.lit(shape).alias("shape"), "*"))
    both = reduce(lambda a, b: a.unionByName(b), out)
    same = both.join(F.broadcast(want), both["got"] == want["want"], "left")
    return same.select("shape", "n_events", "n_ids", "first_ts", "last_ts", F.col("want").isNotNull().alias("as_lines"))


@query("json_kinds_accepted", B + """
SELECT kind, FALSE AS accepted, CAST(0 AS BIGINT) AS n_events FROM b GROUP BY kind
UNION ALL SELECT 'netwatch', TRUE, count(*) FROM b WHERE kind = 'purchase'
UNION ALL SELECT 'homeguard', TRUE, count(*) FROM b WHERE kind = 'signup'""")
def json_kinds_accepted(spark, sf_dir):
    """Which names are JSON sources, of the monitors and the table's own kinds; a name that is none is refused
    before anything is read."""
    root = work_dir(spark, "json-kinds")
    lines = {"netwatch": RD.netwatch_lines(spark, sf_dir), "homeguard": RD.homeguard_lines(spark, sf_dir)}
    kinds = [r.kind for r in tb.base_rows(spark, sf_dir).select("kind").distinct().collect()]  # the closed set of kinds
    out = []
    for kind in [*kinds, *lines]:
        path = f"{root}/{kind}"
        if kind in lines:
            lines[kind].select("value").write.text(path)
        try:
            ev = L.json_lines_records(L.read_lines(spark, path) if kind in lines else lines["netwatch"], kind, OPTS)
        except ValueError:
            out.append(spark.range(1).select(F.lit(kind).alias("kind"), F.lit(False).alias("accepted"), F.lit(0).cast("long").alias("n_events")))
            continue
        out.append(ev.agg(F.count(F.lit(1)).alias("n_events")).select(F.lit(kind).alias("kind"), F.lit(True).alias("accepted"), "n_events"))
    return reduce(lambda a, b: a.unionByName(b), out)


@query("lookup_geo_address", f"WITH {tb.SQL_EVENT_VIEW}, {tb.SQL_GEO}," + f"""
ips AS (SELECT min(ip) AS ip FROM geo UNION SELECT max(ip) FROM geo UNION SELECT '9.9.9.9'),
j AS (SELECT i.ip, {S.is_private("i.ip")} AS priv, g.country_code, g.city, g.org
      FROM ips i LEFT JOIN geo g ON g.ip = i.ip AND {S.AS_OF} - INTERVAL 7 DAY < g.cached_at)
SELECT ip, CASE WHEN priv THEN 'LAN' ELSE coalesce(country_code, '??') END AS country_code,
       CASE WHEN priv THEN 'LAN' ELSE coalesce(city, 'Unknown') END AS city,
       CASE WHEN priv THEN 'Private Network' ELSE coalesce(org, 'Unknown') END AS org FROM j""")
def lookup_geo_address(spark, sf_dir):
    """Single-address geo lookups: the first and last cached address and one that is not cached."""
    geo = G.geo_latest(tb.geo_log(spark, sf_dir))
    ends = geo.agg(F.min("ip").alias("a"), F.max("ip").alias("b")).first()
    found = [G.geo_of(geo, ip, tb.AS_OF) for ip in (ends["a"], ends["b"], "9.9.9.9")]
    return reduce(lambda a, b: a.unionByName(b), found).select("ip", "country_code", "city", "org")


@query("lookup_reputation_address", REP_SQL + f""",
ips AS (SELECT min(ip) AS ip FROM rep UNION SELECT max(ip) FROM rep UNION SELECT '9.9.9.9')
SELECT i.ip, coalesce(r.score, 0) AS score, {S.label("coalesce(r.score, 0)")} AS label, coalesce(r.alert_count, 0) AS alert_count
FROM ips i LEFT JOIN rep r ON r.ip = i.ip""")
def lookup_reputation_address(spark, sf_dir):
    """Single-address reputation lookups on the stored table: the first and last address and one without alerts."""
    path = f"{work_dir(spark, 'reputation')}/rep"
    _rep(spark, sf_dir).write.parquet(path)
    rep = spark.read.parquet(path)
    ends = rep.agg(F.min("ip").alias("a"), F.max("ip").alias("b")).first()
    found = [R.reputation_of(rep, ip) for ip in (ends["a"], ends["b"], "9.9.9.9")]
    return reduce(lambda a, b: a.unionByName(b), found).select("ip", "score", "label", "alert_count")


@query("events_display_columns", f"WITH {tb.SQL_EVENT_VIEW}" + """
SELECT replace(event_type, '_', ' ') AS shown_type, strftime(ts, '%H:%M:%S') AS shown_time, count(*) AS n_events
FROM ev GROUP BY ALL""")
def events_display_columns(spark, sf_dir):
    """The lists' columns: type names with spaces, time of day."""
    ev = tb.event_view(spark, sf_dir)
    return ev.groupBy(SV.display_name(F.col("event_type")).alias("shown_type"), SV.display_time(F.col("ts")).alias("shown_time")).agg(
        F.count(F.lit(1)).alias("n_events"))


@query("stream_late_rows", B + """
SELECT count(*) AS n_dropped FROM b WHERE kind = 'error' AND ts < TIMESTAMP '2024-01-24'""")
def stream_late_rows(spark, sf_dir):
    """The last chunk arrives first: all matched rows of the others are behind the watermark, dropped and counted."""
    lines = RD.auth_lines(spark, sf_dir)
    ran = []

    def sink(df, work):
        ran.append(RN.parquet_sink(df, work))
        return ran[-1]
    RN.run_chunks(spark, lines, F.pmod(chunk_of(F.col("ts")) + 1, F.lit(N_CHUNKS)), N_CHUNKS,
                  lambda s: SR.exact_rule_alerts(L.parse_auth(s, OPTS), BRUTE_ONLY, watermark="1 day"), sink, "stream-late")
    late = sum(op["numRowsDroppedByWatermark"] for q in ran for p in q.recentProgress for op in p["stateOperators"])
    return spark.range(1).select(F.lit(late).cast("long").alias("n_dropped"))
