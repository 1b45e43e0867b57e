"""Registered queries on stored tables that grow by batches: alert log, maintained counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..schema import iso_text
from ..session import materialize, work_dir
from ..sinks import alert_log as AL
from ..sinks import counts as CN
from ..sources import testbed as tb
from . import sqlparts as S
from .alert_queries import FULL, replay_alert_table
from .registry import query
from .serve_queries import ACKED, testbed_acks

N_BATCHES = 4


def _stored_alerts(spark, sf_dir):
    """The replayed alerts, appended in four batches that overlap in time; one batch is written twice."""
    root = work_dir(spark, "alert-log")
    alerts = materialize(replay_alert_table(spark, sf_dir, with_chains=True))
    for batch in (0, 1, 1, 2, 3):
        AL.add_batch(spark, f"{root}/alerts", alerts.filter(F.pmod("alert_id", F.lit(N_BATCHES)) == batch), batch)
    return root


@query("stored_alert_history", FULL + f"""
SELECT rule_name, kind, group_value, {S.iso("created_at")} AS created_at, severity, description FROM alc
WHERE created_at >= TIMESTAMP '2024-01-20 06:00:00'
  AND src_ip IN (SELECT src_ip FROM alc WHERE kind = 'chain' AND created_at >= TIMESTAMP '2024-01-25 00:00:00')""")
def stored_alert_history(spark, sf_dir):
    """Recent alerts of the addresses that lately raised a chain, from the alert log: only the days of the
    time bound are read, and only the addresses travel."""
    path = f"{_stored_alerts(spark, sf_dir)}/alerts"
    late = AL.read(spark, path, "2024-01-25 00:00:00").filter(F.col("kind") == "chain").select("src_ip")
    h = AL.history(spark, path, "2024-01-20 06:00:00", late)
    return h.select("rule_name", "kind", "group_value", iso_text("created_at").alias("created_at"), "severity", "description")


def _counts(spark, sf_dir):
    root = _stored_alerts(spark, sf_dir)
    events, where = tb.event_view(spark, sf_dir), f"{root}/counts"
    alerts = AL.read(spark, f"{root}/alerts")
    for batch in (0, 1, 2, 2, 3):
        CN.add_events(spark, where, events.filter(F.pmod("event_id", F.lit(N_BATCHES)) == batch), batch)
        CN.add_alerts(spark, where, alerts.filter(F.pmod("alert_id", F.lit(N_BATCHES)) == batch), batch)
    ids = testbed_acks(alerts).select("alert_id").unionByName(spark.range(3).select(F.col("id").alias("alert_id")))
    some = ids.filter(F.pmod("alert_id", F.lit(3)) != 0)
    for batch, part in ((0, some), (0, some), (1, ids)):  # the second batch repeats most of the first one's
        CN.acknowledge(spark, where, part, "2024-02-01 00:00:00", f"{root}/acks", batch, alerts)
    return where


@query("stats_from_counts", FULL + f""",
es AS (SELECT source, count(*) AS n FROM ev GROUP BY source),
ss AS (SELECT severity, count(*) AS n FROM alc GROUP BY severity),
tot AS (SELECT (SELECT count(*) FROM ev) AS e, (SELECT count(*) FROM alc) AS a,
        (SELECT count(*) FROM alc WHERE NOT {ACKED}) AS u, (SELECT count(*) FROM es) AS s)
SELECT 'source' AS kind, source AS name, n FROM es UNION ALL SELECT 'severity', severity, n FROM ss
UNION ALL SELECT 'total', 'events', e FROM tot UNION ALL SELECT 'total', 'alerts', a FROM tot
UNION ALL SELECT 'total', 'unacknowledged', u FROM tot UNION ALL SELECT 'total', 'sources', s FROM tot""")
def stats_from_counts(spark, sf_dir):
    """The statistics of the service from counts that every batch of events, alerts and acknowledgements adds to."""
    st = CN.stats(spark, _counts(spark, sf_dir))
    maps = F.explode(F.array(
        F.struct(F.lit("source").alias("kind"), F.col("events_by_source").alias("of")),
        F.struct(F.lit("severity").alias("kind"), F.col("alerts_by_severity").alias("of")),
        F.struct(F.lit("total").alias("kind"), F.create_map(
            F.lit("events"), F.col("total_events"), F.lit("alerts"), F.col("total_alerts"),
            F.lit("unacknowledged"), F.col("unacknowledged_alerts"), F.lit("sources"), F.col("active_sources")).alias("of"))))
    return st.select(maps.alias("m")).select("m.kind", F.explode("m.of").alias("name", "n"))


@query("recent_counts", f"WITH {tb.SQL_EVENT_VIEW}" + """
SELECT source, count(*) AS n FROM ev WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' GROUP BY source""")
def recent_counts(spark, sf_dir):
    """Events per source since a day, from the counts by day."""
    where, events = f"{work_dir(spark, 'counts')}/counts", tb.event_view(spark, sf_dir)
    for batch in range(N_BATCHES):
        CN.add_events(spark, where, events.filter(F.pmod("event_id", F.lit(N_BATCHES)) == batch), batch)
    return CN.counts(spark, where, "events", "2024-01-20 00:00:00").withColumnRenamed("name", "source")
