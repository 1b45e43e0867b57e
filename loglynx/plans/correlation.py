"""Correlation runs: events -> complete alert rows (and chains).

``correlate_replay`` evaluates the catalogue over the whole history, as the
periodic evaluation loop would have over time (each event arrival is an
evaluation moment), with re-fire suppression.  ``correlate_point`` is one
evaluation at ``as_of`` against an alert history.

Both return the alert table: ALERT columns + base_description, window_secs,
prior_score, geo columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import is_private, score_label
from ..operators import chain as CH
from ..operators import correlate as C
from ..operators import geo as G
from ..operators import reputation as R
from ..operators.scans import running
from ..session import materialize
from ..sources.catalogue import Catalogue

EVENT_IDS_PER_ALERT = 50


def _geo_text(a: DataFrame, geo: DataFrame | None, at: Column | str) -> DataFrame:
    """Geo text for address-keyed alerts of external addresses (' [CC / City / Org]')."""
    if geo is None:
        geo = a.sparkSession.createDataFrame([], "ip string, country string, country_code string, "
                                                 "city string, org string, is_private boolean, "
                                                 "cached_at timestamp")
    e = G.geo_enrich(a, geo, ip_col="src_ip", at=at)
    show = (F.col("group_by") == "src_ip") & F.col("src_ip").isNotNull() & (F.col("src_ip") != "") \
        & ~is_private(F.col("src_ip"))
    label = G.geo_label(F.col("src_ip"), F.col("is_private"), F.col("country_code"), F.col("city"), F.col("org"))
    return e.withColumn("geo_text", F.when(show, F.concat(F.lit(" "), label)).otherwise(F.lit("")))


def _finish(a: DataFrame) -> DataFrame:
    desc = C.describe(F.col("base_description"), F.col("kind"), F.col("group_by"), F.col("group_value"),
                      F.col("event_count"), F.col("geo_text"), F.col("prior_score"),
                      score_label(F.col("prior_score")))
    return a.withColumn("description", desc).withColumn(
        "alert_id", C.alert_id(F.col("rule_name"), F.col("group_value"), F.col("created_at")))


ALERT_OUT = ["alert_id", "created_at", "rule_name", "severity", "description", "event_ids", "src_ip", "user",
             "group_by", "group_value", "event_count", "kind", "rule_idx", "base_description", "window_secs",
             "prior_score", "geo_text"]


def correlate_replay(events: DataFrame, cat: Catalogue, geo: DataFrame | None = None,
                     with_event_ids: bool = True, with_chains: bool = True,
                     checkpoint: bool = True) -> DataFrame:
    """Replay every rule over the whole event history -> alert table (incl. chains).

    ``checkpoint``: the fired set and then the finished alert rows feed several
    branches (ids, prior score; result, triggers, partners); each is computed once
    and read back from the checkpoint folder."""
    m = C.match_events(events, cat)
    fired = C.suppress_refires(C.replay_candidates(events, cat, matched=m), ["rule_idx", "key"])
    if checkpoint:
        fired = materialize(fired)
    fired = fired.withColumnRenamed("window_count", "event_count")
    keep = ()
    if with_event_ids:
        ids = C.window_event_ids(fired, m, EVENT_IDS_PER_ALERT)
        fired = fired.join(ids, ["rule_idx", "key", "sec"], "left")
        keep = ("event_ids",)
    a = C.alert_frame(fired, cat, F.timestamp_seconds("sec"), keep=keep)
    if not with_event_ids:
        a = a.withColumn("event_ids", C.empty_ids())
    # Score before each alert = running sum of earlier deltas of the address
    # (time-bucketed scan: no window holds more than one day of one address)
    feed = (F.col("group_by") == "src_ip") & F.col("src_ip").isNotNull() & (F.col("src_ip") != "")
    scored = running(a.filter(feed), ["src_ip"], "created_at", ["created_at", "rule_idx"],
                     R.severity_delta(F.col("severity")), "_prior", "sum", inclusive=False,
                     bucket_secs=86400)
    scored = scored.withColumn("prior_score", F.least(F.lit(R.MAX_SCORE), F.col("_prior")).cast("int"))
    a = scored.drop("_prior").unionByName(a.filter(~feed).withColumn("prior_score", F.lit(0)))
    a = _geo_text(a, geo, "created_at")
    a = _finish(a)
    out = a.select(*ALERT_OUT)
    if with_chains:
        if checkpoint:  # read as the result, as triggers and as their partners
            out = materialize(out)
        ch = CH.chains_replay(out, cat).withColumn("prior_score", F.lit(0)).withColumn(
            "geo_text", F.lit("")).withColumn(
            "alert_id", C.alert_id(F.col("rule_name"), F.col("group_value"), F.col("created_at")))
        out = out.unionByName(ch.select(*ALERT_OUT))
    return out


def correlate_point(events: DataFrame, cat: Catalogue, as_of, history: DataFrame | None = None,
                    geo: DataFrame | None = None, with_chains: bool = True,
                    reputation: DataFrame | None = None) -> DataFrame:
    """One evaluation at ``as_of``: candidates, dedup against ``history`` (alert
    table), newest-50 ids, prior score (history + earlier rules of this run),
    geo text, description, chains.

    ``history`` is read no further back than the widest rule and chain window.
    The score before this run needs all of it, so frequent runs should give the
    ``reputation`` table (ip, score: the snapshot that the sink keeps); only
    without one is it summed from the whole history."""
    a_ts = F.lit(as_of).cast("timestamp")
    pre = C.prefilter_events(events, cat, as_of)
    m = C.in_window(C.match_events(pre, cat), as_of)
    cands = C.point_candidates(events, cat, as_of)
    if history is not None:
        cands = C.dedup_against_history(cands, history, as_of, cat.max_window())
    ids = C.top_event_ids(m, EVENT_IDS_PER_ALERT)
    cands = cands.join(ids, ["rule_idx", "key"], "left")
    a = C.alert_frame(cands, cat, a_ts, keep=("event_ids",))
    feed = (F.col("group_by") == "src_ip") & F.col("src_ip").isNotNull() & (F.col("src_ip") != "")
    # alerts without an address have no score: they stay out of the window and the join
    rest = a.filter(~F.coalesce(feed, F.lit(False))).withColumn("prior_score", F.lit(0))
    w = Window.partitionBy("src_ip").orderBy("rule_idx").rowsBetween(Window.unboundedPreceding, -1)
    own = a.filter(feed).withColumn("_run", F.coalesce(F.sum(R.severity_delta(F.col("severity"))).over(w), F.lit(0)))
    if reputation is None and history is not None:
        reputation = R.reputation_from_feed(R.reputation_feed(history, cat.tags))
    if reputation is not None:
        known = reputation.select(F.col("ip").alias("_hip"), F.col("score").alias("_hscore"))
        own = own.join(known, own["src_ip"] == known["_hip"], "left").drop("_hip")
    else:
        own = own.withColumn("_hscore", F.lit(0))
    own = own.withColumn("prior_score", F.least(F.lit(R.MAX_SCORE), F.coalesce("_hscore", F.lit(0)) + F.col("_run")).cast("int"))
    a = own.drop("_hscore", "_run").unionByName(rest)
    a = _geo_text(a, geo, a_ts)
    a = _finish(a)
    out = a.select(*ALERT_OUT)
    if with_chains:
        # the run's alerts are read three times below (result, triggers, same-run
        # 'then'); they are few, so compute them once instead of re-scanning events
        out = materialize(out)
        ch = CH.chains_point(out, history, cat, as_of).withColumn("prior_score", F.lit(0)).withColumn(
            "geo_text", F.lit("")).withColumn(
            "alert_id", C.alert_id(F.col("rule_name"), F.col("group_value"), F.col("created_at")))
        out = out.unionByName(ch.select(*ALERT_OUT))
    return out
