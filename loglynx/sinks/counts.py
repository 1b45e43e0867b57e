"""V1 / V8 / A7 / A8 / A15 / T4 from maintained counts: the totals of the service without a scan of its tables.

Each batch of events, alerts or acknowledgements adds its own counts by day and name (source or
severity) to a log of runs (``sinks.runs``, one unit per month), and a batch that is written again
replaces its counts.  A read sums a few rows per day and name, whatever the number of events.

Acknowledgements count alerts that are stored when they come: ids that no stored alert has and
repeated ids count for nothing.  Each acknowledgement batch reads the id column of the alerts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import runs as RU
from . import tables as TB

PARTS = ("events", "alerts", "acks")  # one log each: their batches are numbered on their own

COUNTS = T.StructType([T.StructField("day", T.DateType()), T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys, "day", "name").agg(F.sum("n").alias("n"))


def _add(spark: SparkSession, root: str, part: str, at: str, name: str, rows: DataFrame, batch: int) -> None:
    counted = rows.groupBy(F.to_date(at).alias("day"), F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    month = F.coalesce(F.date_format("day", "yyyy-MM"), F.lit("none"))
    RU.add_batch(spark, f"{root}/{part}", counted, batch, "month", month, COUNTS, lambda old: _summed(old, "month", "span"))


def add_events(spark: SparkSession, root: str, events: DataFrame, batch: int) -> None:
    """Count a batch of events by day and source (events without a time count under no day)."""
    _add(spark, root, "events", "ts", "source", events, batch)


def add_alerts(spark: SparkSession, root: str, alerts: DataFrame, batch: int) -> None:
    """Count a batch of alerts by day and severity."""
    _add(spark, root, "alerts", "created_at", "severity", alerts, batch)


def acknowledge(spark: SparkSession, root: str, ids: DataFrame, at, acks_path: str, batch: int, alerts: DataFrame) -> None:
    """Append acknowledgements (``ids``: alert_id) to the ack table and count the alerts among ``alerts`` (all
    that are stored) that they acknowledge first."""
    TB.append_ack_table(ids, at, acks_path, batch)
    acks = spark.read.parquet(acks_path).withColumn("batch", F.col("batch").cast("bigint")).filter(F.col("batch") <= batch)
    first = acks.groupBy("alert_id").agg(F.min("batch").alias("batch")).filter(F.col("batch") == batch).select("alert_id")
    _add(spark, root, "acks", "created_at", "severity", alerts.join(first, "alert_id", "left_semi"), batch)


def counts(spark: SparkSession, root: str, part: str, since: str | None = None) -> DataFrame:
    """name, n of the events, alerts or acknowledged alerts, of days from ``since`` on if it is given (then
    without rows that have no time)."""
    month = since[:7] if since is not None else ""
    found = RU.runs_of(spark, f"{root}/{part}", "month", lambda m: since is None or (m != "none" and m >= month))
    rows = RU.read_runs(spark, COUNTS, [r for some in found.values() for r in RU.current(some)])
    if since is not None:
        rows = rows.filter(F.col("day") >= F.lit(since[:10]).cast("date"))
    return rows.groupBy("name").agg(F.sum("n").alias("n"))


def stats(spark: SparkSession, root: str, since: str | None = None) -> DataFrame:
    """The one row of ``serve.stats``, from the counts."""
    none = F.lit(0).cast("bigint")
    each = [counts(spark, root, part, since).withColumn("part", F.lit(part)) for part in PARTS]
    rows = each[0].unionByName(each[1]).unionByName(each[2])

    def total(part):
        return F.coalesce(F.sum(F.when(F.col("part") == part, F.col("n"))), none)

    def by_name(part):  # collected lists leave out what is null: here the other parts' rows
        return F.map_from_entries(F.collect_list(F.when(F.col("part") == part, F.struct("name", "n"))))
    return rows.agg(
        total("events").alias("total_events"), total("alerts").alias("total_alerts"),
        (total("alerts") - total("acks")).alias("unacknowledged_alerts"),
        F.count_if(F.col("part") == "events").alias("active_sources"),
        by_name("events").alias("events_by_source"), by_name("alerts").alias("alerts_by_severity"))
