"""Table sinks (K1-K5): append-only parquet tables instead of row-by-row inserts.

* events    K1: append, partitioned by event_date (partition pruning for the
            look-back scans).
* alerts    K2: append; ids are deterministic, so a re-run batch overwrites
            its own ``batch`` partition instead of duplicating rows.
* reputation K3: snapshot merge — previous snapshot full-outer-joined with the
            aggregate of new alerts, written as a new snapshot version.
* geo       K4: append-only lookup log; readers take ``geo_latest``.
* acks      K5: append-only; readers overlay with ``serve.with_acks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import reputation as R


def append_events(events: DataFrame, path: str, batch: int | str = 0, files_per_date: int = 1) -> None:
    """K1: events under ``event_date=YYYY-MM-DD/batch=<id>``.  A date's rows of a batch go to
    ``files_per_date`` tasks (raise it for days that are too large for one), so a batch writes that many
    files for a date however many tasks made it; writing a batch again replaces its files."""
    dated = events.withColumn("event_date", F.to_date("ts")).withColumn("batch", F.lit(str(batch)))
    salt = F.pmod(F.xxhash64("event_id"), F.lit(files_per_date))
    (dated.repartition("event_date", salt).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date", "batch").parquet(path))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_batch(df: DataFrame, path: str, batch: int | str) -> None:
    """Idempotent append: the rows of one batch are the folder ``batch=<id>``; writing the
    same batch again replaces exactly that folder, also when it now has no rows (a file
    without rows keeps the table's schema readable)."""
    df.drop("batch").write.mode("overwrite").parquet(f"{path}/batch={batch}")


def append_alerts(alerts: DataFrame, path: str, batch: int | str) -> None:
    """K2: alert rows of one evaluation run (``created_at`` = evaluation time)."""
    write_batch(alerts, path, batch)


def append_acks(spark: SparkSession, alert_ids: list[int], acked_at, path: str, batch: int | str) -> None:
    """K5: acknowledge a few alerts by id."""
    append_ack_table(spark.createDataFrame([(int(i),) for i in alert_ids], "alert_id bigint"), acked_at, path, batch)


def append_ack_table(ids: DataFrame, acked_at, path: str, batch: int | str) -> None:
    """K5: acknowledge the alerts of ``ids`` (alert_id; unknown ids are harmless; repeats are idempotent on read)."""
    write_batch(ids.select("alert_id", F.lit(acked_at).cast("timestamp").alias("acked_at")), path, batch)


def append_geo(lookups: DataFrame, path: str, batch: int | str) -> None:
    """K4: lookup results appended; the newest per address wins on read."""
    write_batch(lookups, path, batch)


REP_SNAPSHOT = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("score_sum", T.LongType()),
    T.StructField("alert_count", T.LongType()),
    T.StructField("first_seen", T.TimestampType()),
    T.StructField("last_seen", T.TimestampType()),
    T.StructField("tag_firsts", T.ArrayType(T.StructType([
        T.StructField("t", T.TimestampType()), T.StructField("r", T.IntegerType()),
        T.StructField("tag", T.StringType())]))),
])


def reputation_delta(alerts: DataFrame, tags: dict) -> DataFrame:
    """Per-address aggregate of a batch of alerts in snapshot form (unclamped sum,
    first use of each tag) so two aggregates merge exactly."""
    feed = R.reputation_feed(alerts, tags)
    per_tag = feed.groupBy("ip", "tag").agg(
        F.sum("delta").alias("d"), F.count(F.lit(1)).alias("n"),
        F.min("created_at").alias("f"), F.max("created_at").alias("l"),
        F.min(F.struct("created_at", "rule_idx")).alias("first"))
    item = F.when(F.col("tag").isNotNull(), F.struct(F.col("first.created_at").alias("t"),
                                                      F.col("first.rule_idx").alias("r"), F.col("tag").alias("tag")))
    return per_tag.groupBy("ip").agg(
        F.sum("d").cast("bigint").alias("score_sum"), F.sum("n").cast("bigint").alias("alert_count"),
        F.min("f").alias("first_seen"), F.max("l").alias("last_seen"),
        F.filter(F.collect_list(item), lambda x: x.isNotNull()).alias("tag_firsts"))


def merge_reputation(prev: DataFrame | None, delta: DataFrame) -> DataFrame:
    """K3: previous snapshot (+) batch aggregate by full outer join on ip.
    Scores add (clamped on read, equal to step-wise clamping since deltas are
    positive), counts add, first/last seen min/max, tag first-uses union keeping
    the earliest use of each tag."""
    if prev is None:
        return delta
    p = prev.alias("p")
    d = delta.alias("d")
    j = p.join(d, F.col("p.ip") == F.col("d.ip"), "full_outer")

    def nz(c):
        return F.coalesce(c, F.lit(0).cast("bigint"))
    both = F.concat(F.coalesce(F.col("p.tag_firsts"), F.array()), F.coalesce(F.col("d.tag_firsts"), F.array()))
    firsts = F.aggregate(
        F.array_sort(both),
        F.array().cast("array<struct<t:timestamp,r:int,tag:string>>"),
        lambda acc, x: F.when(F.exists(acc, lambda y: y["tag"] == x["tag"]), acc).otherwise(
            F.concat(acc, F.array(x))))
    return j.select(
        F.coalesce(F.col("p.ip"), F.col("d.ip")).alias("ip"),
        (nz(F.col("p.score_sum")) + nz(F.col("d.score_sum"))).alias("score_sum"),
        (nz(F.col("p.alert_count")) + nz(F.col("d.alert_count"))).alias("alert_count"),
        F.least(F.col("p.first_seen"), F.col("d.first_seen")).alias("first_seen"),
        F.greatest(F.col("p.last_seen"), F.col("d.last_seen")).alias("last_seen"),
        firsts.alias("tag_firsts"),
    )


def snapshot_view(snap: DataFrame) -> DataFrame:
    """Snapshot -> reputation table shape (score clamped, tags in first-use order)."""
    from ..functions.normalize import score_label
    return snap.select(
        "ip", F.least(F.lit(R.MAX_SCORE), F.col("score_sum")).cast("int").alias("score"), "alert_count",
        "first_seen", "last_seen",
        F.transform(F.array_sort(F.col("tag_firsts")), lambda x: x["tag"]).alias("tags"),
    ).withColumn("label", score_label(F.col("score")))
