"""Address reputation derived from alerts.

The reputation table is a pure aggregate of the alert table, so it can be
rebuilt or merged incrementally (see ``sinks.tables.merge_reputation``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalize import map_lookup, score_label
from .scans import running

# ---------------------------------------------------------------------------
# Score added per alert severity (anything else adds 5), and
# the score range.
# ---------------------------------------------------------------------------
SEVERITY_DELTA = {"CRITICAL": 25, "HIGH": 15, "MEDIUM": 8, "LOW": 3}
DEFAULT_DELTA = 5
MAX_SCORE = 100
# ---------------------------------------------------------------------------


def severity_delta(sev: Column) -> Column:
    return F.coalesce(map_lookup(sev, SEVERITY_DELTA, None).cast("int"), F.lit(DEFAULT_DELTA))


def rule_tag(rule_name: Column, tags: dict) -> Column:
    clean = {k: v for k, v in tags.items() if v is not None}
    if not clean:
        return F.lit(None).cast("string")
    return map_lookup(rule_name, clean, None)


def reputation_feed(alerts: DataFrame, tags: dict) -> DataFrame:
    """Alerts that move a score — address-keyed single and cross-source
    alerts (not user-keyed, not chains).  -> ip, created_at, rule_idx, delta, tag."""
    a = alerts.filter((F.col("group_by") == "src_ip") & (F.col("kind") != "chain")
                      & F.col("src_ip").isNotNull() & (F.col("src_ip") != ""))
    return a.select(
        F.col("src_ip").alias("ip"), "created_at",
        F.coalesce(F.col("rule_idx"), F.lit(1 << 30)).alias("rule_idx"),
        severity_delta(F.col("severity")).alias("delta"),
        rule_tag(F.col("rule_name"), tags).alias("tag"),
    )


def reputation_from_feed(feed: DataFrame) -> DataFrame:
    """A9-A12 on a feed: clamp(sum deltas), alert count, first/last seen, tags in
    order of first use.  Pre-aggregated per (ip, tag) first, so the per-ip
    step sees at most one row per distinct tag (a hot address is one row per
    tag per map task, never its whole alert list)."""
    per_tag = feed.groupBy("ip", "tag").agg(
        F.sum("delta").alias("d"), F.count(F.lit(1)).alias("n"),
        F.min("created_at").alias("f"), F.max("created_at").alias("l"),
        F.min(F.struct("created_at", "rule_idx")).alias("first"),
    )
    tag_item = F.when(F.col("tag").isNotNull(),
                      F.struct(F.col("first.created_at").alias("t"), F.col("first.rule_idx").alias("r"),
                               F.col("tag").alias("tag")))
    return per_tag.groupBy("ip").agg(
        F.least(F.lit(MAX_SCORE), F.sum("d")).cast("int").alias("score"),
        F.sum("n").cast("bigint").alias("alert_count"),
        F.min("f").alias("first_seen"),
        F.max("l").alias("last_seen"),
        F.transform(F.sort_array(F.collect_list(tag_item)), lambda x: x["tag"]).alias("tags"),
    )


def reputation_table(alerts: DataFrame, tags: dict, decay_per_day: float | None = None,
                     as_of=None) -> DataFrame:
    """Reputation per address.  ``decay_per_day`` (optional) lowers the score
    by that many points per whole day since last_seen at ``as_of``."""
    rep = reputation_from_feed(reputation_feed(alerts, tags))
    if decay_per_day:
        a = F.lit(as_of).cast("timestamp")
        days = F.floor((F.unix_seconds(a) - F.unix_seconds("last_seen")) / 86400)
        rep = rep.withColumn("score", F.greatest(F.lit(0), F.col("score") - F.floor(days * decay_per_day))
                             .cast("int"))
    return rep.withColumn("label", score_label(F.col("score")))


def prior_scores(alerts: DataFrame, tags: dict) -> DataFrame:
    """The address score just before each alert (alerts ordered by
    created_at, then catalogue order).  -> ip, created_at, rule_idx, prior_score.

    A running sum per address, split by day (``scans.running``), so a busy
    address is spread over one task per day of its history.
    """
    feed = reputation_feed(alerts, tags)
    r = running(feed, ["ip"], "created_at", ["created_at", "rule_idx"], F.col("delta"), "_p", "sum",
                inclusive=False, bucket_secs=86400)
    return r.select("ip", "created_at", "rule_idx",
                    F.least(F.lit(MAX_SCORE), F.col("_p")).cast("int").alias("prior_score"))


def reputation_lookup(ips: DataFrame, rep: DataFrame, ip_col: str = "ip") -> DataFrame:
    """Reputation context for each address, default score 0 / CLEAN."""
    r = rep.select(F.col("ip").alias("_rip"), "score", "alert_count", "tags", "first_seen", "last_seen")
    j = ips.join(r, ips[ip_col] == F.col("_rip"), "left").drop("_rip")
    return j.select(
        *[c for c in ips.columns],
        F.coalesce(F.col("score"), F.lit(0)).alias("score"),
        score_label(F.coalesce(F.col("score"), F.lit(0))).alias("label"),
        F.coalesce(F.col("alert_count"), F.lit(0).cast("bigint")).alias("alert_count"),
        F.coalesce(F.col("tags"), F.array().cast(T.ArrayType(T.StringType()))).alias("tags"),
        "first_seen", "last_seen",
    )


def top_offenders(rep: DataFrame, limit: int = 10) -> DataFrame:
    """Highest scores first (address as tie-break), with label."""
    return rep.orderBy(F.col("score").desc(), F.col("ip").asc()).limit(limit).withColumn(
        "label", score_label(F.col("score")))


def reputation_of(rep: DataFrame, ip: str) -> DataFrame:
    """One address's reputation row (0 / CLEAN when absent) — a pushed-down filter."""
    one = rep.sparkSession.createDataFrame([(ip,)], "ip string")
    return reputation_lookup(one, rep.filter(F.col("ip") == ip))
