"""Read-side functions: the service endpoints as DataFrame functions
(F1, F2, T1, T2, A4, A7, A8, A15, T4, J10, V1-V8).

Filters are plain column predicates so they reach the parquet scan; the
newest-N lists are ``orderBy(...).limit(n)`` (TakeOrderedAndProject: a
per-task top-n, then one small merge).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import severity_level


def events_query(events: DataFrame, since=None, source: str | None = None, event_type: str | None = None,
                 src_ip: str | None = None, limit: int = 500) -> DataFrame:
    """F1 + T1: AND of the given filters (absent or empty = no filter), newest first."""
    preds = []
    if since:
        preds.append(F.col("ts") >= F.lit(since).cast("timestamp"))
        if "event_date" in events.columns:  # partition pruning on date-partitioned tables
            preds.append(F.col("event_date") >= F.to_date(F.lit(since).cast("timestamp")))
    if source:
        preds.append(F.col("source") == source)
    if event_type:
        preds.append(F.col("event_type") == event_type)
    if src_ip:
        preds.append(F.col("src_ip") == src_ip)
    df = events.filter(reduce(lambda a, b: a & b, preds)) if preds else events
    return df.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(limit)


def count_events(events: DataFrame, event_type: str, since, src_ip: str | None = None) -> DataFrame:
    """A4: events of a type since a moment, per address; for one address one row, 0 if it has none."""
    df = events.filter((F.col("event_type") == event_type) & (F.col("ts") >= F.lit(since).cast("timestamp")))
    if src_ip:
        one = df.filter(F.col("src_ip") == src_ip).agg(F.count(F.lit(1)).alias("n_events"))
        return one.select(F.lit(src_ip).alias("src_ip"), "n_events")
    return df.groupBy("src_ip").agg(F.count(F.lit(1)).alias("n_events"))


def display_name(x: Column) -> Column:
    """``_`` shown as a space (rule and event type names in lists)."""
    return F.replace(x, F.lit("_"), F.lit(" "))


def display_time(ts: Column) -> Column:
    """HH:mm:ss of a moment (the lists' time column)."""
    return F.date_format(ts, "HH:mm:ss")


def with_acks(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """``acknowledged`` flag from the append-only ack table (repeat acks and
    acks of unknown ids are harmless: the ack side is made distinct)."""
    a = acks.select(F.col("alert_id").alias("_ack_id")).distinct()
    j = alerts.join(a, alerts["alert_id"] == a["_ack_id"], "left")
    return j.withColumn("acknowledged", F.col("_ack_id").isNotNull()).drop("_ack_id")


def unacked(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """alerts without an ack (anti join)."""
    a = acks.select(F.col("alert_id").alias("_ack_id"))
    return alerts.join(a, alerts["alert_id"] == a["_ack_id"], "left_anti")


def alerts_query(alerts: DataFrame, acks: DataFrame, limit: int = 100, unacked_only: bool = False) -> DataFrame:
    """T2 (+F2): newest alerts first (rule and key break ties)."""
    df = unacked(alerts, acks).withColumn("acknowledged", F.lit(False)) if unacked_only else with_acks(alerts, acks)
    return df.orderBy(F.col("created_at").desc(), F.col("rule_name"), F.col("group_value")).limit(limit)


def stats(events: DataFrame, alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """A7 + A8 + V1: one row — totals, unacknowledged count, per-severity and
    per-source maps, number of active sources.  Both sides are aggregated to
    one row each and merged by a union + aggregate (no cross product)."""
    ev = events.groupBy("source").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").cast("bigint").alias("total_events"),
        F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("events_by_source"),
        F.count(F.lit(1)).alias("active_sources"))
    al = with_acks(alerts, acks).groupBy("severity").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("acknowledged")).alias("u")).agg(
        F.sum("n").cast("bigint").alias("total_alerts"),
        F.sum("u").cast("bigint").alias("unacknowledged_alerts"),
        F.map_from_entries(F.collect_list(F.struct("severity", "n"))).alias("alerts_by_severity"))
    both = ev.unionByName(al, allowMissingColumns=True)
    return both.agg(
        F.coalesce(F.max("total_events"), F.lit(0).cast("bigint")).alias("total_events"),
        F.coalesce(F.max("total_alerts"), F.lit(0).cast("bigint")).alias("total_alerts"),
        F.coalesce(F.max("unacknowledged_alerts"), F.lit(0).cast("bigint")).alias("unacknowledged_alerts"),
        F.coalesce(F.max("active_sources"), F.lit(0).cast("bigint")).alias("active_sources"),
        F.first("events_by_source", ignorenulls=True).alias("events_by_source"),
        F.first("alerts_by_severity", ignorenulls=True).alias("alerts_by_severity"))


def severity_breakdown(alerts: DataFrame) -> DataFrame:
    """T4: alert count per severity, CRITICAL first, severities with no alert absent."""
    g = alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("severity_level", severity_level("severity")).orderBy(F.col("severity_level").desc())


def source_shares(events: DataFrame) -> DataFrame:
    """Rows per source and the bar width (percent of the largest source)."""
    g = events.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    mx = F.max("n").over(Window.partitionBy())  # one row per source: a handful of rows
    return g.withColumn("pct_of_max", F.round(F.col("n") * 100.0 / F.greatest(mx, F.lit(1))).cast("bigint"))
