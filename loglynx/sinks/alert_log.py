"""K2 with a layout: the alert table as a log of runs (``sinks.runs``), one unit per day of ``created_at``.

A read bounded in time opens the folders of its days only, however many batches were ever written:
the runs of a day are merged by size, so a day has a few.  Files are sorted by address, so a lookup of
one address skips row groups.  ``history`` also keeps only rows whose address (or group value) is among
given ones; while these are measured to be small they are broadcast and the table's side is not
shuffled, beyond that the join is Spark's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import runs as RU

MAX_KEYS_BYTES = 16 << 20  # keys are broadcast up to this size

#: A stored alert: rule and chain alerts of an evaluation, with their ids.
STORED = T.StructType([
    T.StructField("alert_id", T.LongType()), T.StructField("rule_idx", T.IntegerType()), T.StructField("rule_name", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("base_description", T.StringType()), T.StructField("group_by", T.StringType()),
    T.StructField("group_value", T.StringType()), T.StructField("event_count", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("created_at", T.TimestampType()), T.StructField("src_ip", T.StringType()), T.StructField("user", T.StringType()),
    T.StructField("window_secs", T.LongType()), T.StructField("description", T.StringType()),
    T.StructField("event_ids", T.ArrayType(T.LongType()))])


def _stored(alerts: DataFrame) -> DataFrame:
    """The columns of ``STORED`` in their types; null where the alerts do not have one."""
    have = set(alerts.columns)
    return alerts.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in STORED])


def add_batch(spark: SparkSession, root: str, alerts: DataFrame, batch: int) -> None:
    """Append the alerts of one evaluation; the same batch again replaces its rows."""
    day = F.date_format("created_at", "yyyy-MM-dd")
    RU.add_batch(spark, root, _stored(alerts), batch, "day", day, STORED, order=("src_ip", "created_at"))


def batch_rows(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """The alerts that one batch wrote (the newest batches; older ones may have been merged)."""
    return spark.read.schema(STORED).parquet(f"{root}/d={batch}").select(*STORED.names)


def read(spark: SparkSession, root: str, since: str | None = None, before: int = RU.ALL) -> DataFrame:
    """All alerts of the batches before ``before``, created at or after ``since`` (text in UTC,
    like ``2024-01-20 00:00:00``).  Only folders of days from ``since`` on are listed and read."""
    first_day = since[:10] if since is not None else ""
    found = RU.runs_of(spark, root, "day", lambda day: day >= first_day)
    rows = RU.read_runs(spark, STORED, [r for some in found.values() for r in RU.current(some, before)])
    return rows if since is None else rows.filter(F.col("created_at") >= F.lit(since).cast("timestamp"))


def history(spark: SparkSession, root: str, since: str | None, keys: DataFrame, column: str = "src_ip", before: int = RU.ALL) -> DataFrame:
    """``read``, but only alerts whose ``column`` is in the one column of ``keys``."""
    wanted = keys.select(F.col(keys.columns[0]).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    size = wanted.agg(F.sum(F.octet_length("_key") + 32)).first()[0] or 0
    rows = read(spark, root, since, before)
    return rows.join(F.broadcast(wanted) if size <= MAX_KEYS_BYTES else wanted, F.col(column) == F.col("_key"), "left_semi")
