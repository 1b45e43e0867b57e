"""K3 / ST7: reputation as a log of runs that are merged by size.

Every batch adds the aggregate of its own alerts (``tables.reputation_delta``: one row for each
address that has any), split into buckets by the address (the units of ``sinks.runs``).  Readers
merge the runs of each address (sums, first and last times, first use of each tag).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import runs as RU
from .tables import REP_SNAPSHOT

BUCKETS = 16


def _merged(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of runs -> one row per address."""
    firsts = F.array_sort(F.flatten(F.collect_list("tag_firsts")))  # a handful for each run: its tags
    each = F.aggregate(firsts, F.array().cast(REP_SNAPSHOT["tag_firsts"].dataType), lambda acc, x: F.when(
        F.exists(acc, lambda y: y["tag"] == x["tag"]), acc).otherwise(F.concat(acc, F.array(x))))
    return rows.groupBy(*keys, "ip").agg(
        F.sum("score_sum").alias("score_sum"), F.sum("alert_count").alias("alert_count"), F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"), each.alias("tag_firsts"))


def add_batch(spark: SparkSession, root: str, delta: DataFrame, batch: int) -> None:
    """Add a batch's aggregate, after merging what is due of the batches before."""
    bucket = F.pmod(F.xxhash64("ip"), F.lit(BUCKETS))
    RU.add_batch(spark, root, delta, batch, "bucket", bucket, REP_SNAPSHOT, lambda rows: _merged(rows, "bucket", "span"))


def snapshot(spark: SparkSession, root: str, before: int = RU.ALL) -> DataFrame | None:
    """The merged rows of all batches before ``before``, one per address; none if there is no run."""
    runs = [r for some in RU.runs_of(spark, root, "bucket").values() for r in RU.current(some, before)]
    return _merged(RU.read_runs(spark, REP_SNAPSHOT, runs)) if runs else None
