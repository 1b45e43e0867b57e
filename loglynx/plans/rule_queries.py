"""Registered rule-evaluation queries on the test bed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import correlate as C
from ..schema import iso_text
from ..sources import testbed as tb
from ..sources.catalogue import Catalogue
from . import sqlparts as S
from .registry import query

CAT = tb.catalogue()


def _one_rule(name: str, **override) -> Catalogue:
    r = next(dict(x) for x in CAT.rules if x["name"] == name)
    r.update(override)
    return Catalogue(rules=[r], chains=[], tags=CAT.tags)


BRUTE_7D = _one_rule("ssh_brute_force", window_secs=604800, threshold=5)
SUDO_ONLY = _one_rule("repeated_sudo")
CROSS_ONLY = _one_rule("unknown_device_then_portscan")
ERROR_REPLAY = _one_rule("ssh_brute_force")


def ids_text(col) -> F.Column:
    return F.concat(F.lit("["), F.array_join(F.transform(col, lambda x: x.cast("string")), ", "), F.lit("]"))


def _point(spark, sf_dir, cat):
    ev = tb.event_view(spark, sf_dir)
    c = C.point_candidates(ev, cat, tb.AS_OF)
    return c.select("rule_name", "group_by", F.col("key").alias("group_value"), "event_count")


def _point_sql(cat):
    return S.head(cat) + S.point_cands() + """
SELECT rule_name, group_by, key AS group_value, event_count FROM pc"""


@query("rule_point_threshold", _point_sql(BRUTE_7D))
def rule_point_threshold(spark, sf_dir):
    """One threshold rule at as_of (failed logins per IP, W=7 d, T=5)."""
    return _point(spark, sf_dir, BRUTE_7D)


@query("rule_point_all_rules", _point_sql(CAT))
def rule_point_all_rules(spark, sf_dir):
    """Whole catalogue at as_of in one pass (single and cross-source rules)."""
    return _point(spark, sf_dir, CAT)


@query("rule_user_grouped", _point_sql(SUDO_ONLY))
def rule_user_grouped(spark, sf_dir):
    """User-keyed rule (sudo commands per user)."""
    return _point(spark, sf_dir, SUDO_ONLY)


@query("cross_source_point", _point_sql(CROSS_ONLY))
def cross_source_point(spark, sf_dir):
    """Keys present in every condition of a multi-source rule within W."""
    return _point(spark, sf_dir, CROSS_ONLY)


@query("alert_event_ids_top50", S.head(CAT) + S.point_cands() + """,
ranked AS (SELECT rule_idx, key, event_id,
                  row_number() OVER (PARTITION BY rule_idx, key ORDER BY cond_idx, ts DESC, event_id DESC) AS rn
           FROM pw),
ids AS (SELECT rule_idx, key, '[' || array_to_string(list(event_id ORDER BY rn), ', ') || ']' AS event_ids
        FROM ranked WHERE rn <= 50 GROUP BY rule_idx, key)
SELECT pc.rule_name, pc.key AS group_value, pc.event_count, ids.event_ids
FROM pc JOIN ids USING (rule_idx, key)""")
def alert_event_ids_top50(spark, sf_dir):
    """Newest 50 event ids of every point-mode alert, as JSON-style text."""
    ev = tb.event_view(spark, sf_dir)
    m = C.in_window(C.match_events(C.prefilter_events(ev, CAT, tb.AS_OF), CAT), tb.AS_OF)
    cands = C.point_candidates(ev, CAT, tb.AS_OF)
    ids = C.top_event_ids(m, 50)
    return cands.join(ids, ["rule_idx", "key"]).select(
        "rule_name", F.col("key").alias("group_value"), "event_count",
        ids_text(F.col("event_ids")).alias("event_ids"))


@query("rule_replay_candidates", S.head(ERROR_REPLAY) + S.replay_cands(ERROR_REPLAY) + f"""
SELECT r.rule_name, rc.key AS group_value, {S.iso("TIMESTAMP '1970-01-01 00:00:00' + to_seconds(rc.sec)")} AS at,
       rc.window_count
FROM rc JOIN rdim r USING (rule_idx)""")
def rule_replay_candidates(spark, sf_dir):
    """Every second at which the look-back count reaches the threshold (W=1 d, T=3)."""
    ev = tb.event_view(spark, sf_dir)
    rc = C.replay_candidates(ev, ERROR_REPLAY)
    names = ERROR_REPLAY.rules_df(spark).select("rule_idx", "rule_name")
    return rc.join(names, "rule_idx").select(
        "rule_name", F.col("key").alias("group_value"),
        iso_text(F.timestamp_seconds("sec")).alias("at"), "window_count")


def _fired_sql(cat):
    return S.head(cat) + S.replay_alerts(cat) + f"""
SELECT rule_name, kind, group_by, group_value, {S.iso("created_at")} AS created_at, event_count FROM al"""


def _fired(spark, sf_dir, cat):
    ev = tb.event_view(spark, sf_dir)
    f = C.replay_fired(ev, cat).withColumnRenamed("window_count", "event_count")
    a = C.alert_frame(f, cat, F.timestamp_seconds("sec"))
    return a.select("rule_name", "kind", "group_by", "group_value",
                    iso_text("created_at").alias("created_at"), "event_count")


@query("rule_replay_fired", _fired_sql(ERROR_REPLAY))
def rule_replay_fired(spark, sf_dir):
    """Replay candidates after re-fire suppression (a fire silences the key for W)."""
    return _fired(spark, sf_dir, ERROR_REPLAY)


@query("replay_all_rules_fired", _fired_sql(CAT))
def replay_all_rules_fired(spark, sf_dir):
    """Whole catalogue replayed over the full history: the alert stream."""
    return _fired(spark, sf_dir, CAT)


@query("cross_source_replay", S.head(CROSS_ONLY) + S.replay_cands(CROSS_ONLY) + f"""
SELECT r.rule_name, rc.key AS group_value, {S.iso("TIMESTAMP '1970-01-01 00:00:00' + to_seconds(rc.sec)")} AS at,
       rc.window_count
FROM rc JOIN rdim r USING (rule_idx)""")
def cross_source_replay(spark, sf_dir):
    """Every second at which all conditions of the cross-source rule are seen within W."""
    ev = tb.event_view(spark, sf_dir)
    rc = C.replay_candidates(ev, CROSS_ONLY)
    names = CROSS_ONLY.rules_df(spark).select("rule_idx", "rule_name")
    return rc.join(names, "rule_idx").select(
        "rule_name", F.col("key").alias("group_value"),
        iso_text(F.timestamp_seconds("sec")).alias("at"), "window_count")


@query("dedup_against_history", S.head(CAT) + S.point_cands() + S.replay_alerts(CAT) + """,
hist AS (SELECT rule_name, group_value, created_at FROM al WHERE created_at < TIMESTAMP '2024-01-30 00:00:00')
SELECT pc.rule_name, pc.group_by, pc.key AS group_value, pc.event_count FROM pc
WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.rule_name = pc.rule_name AND h.group_value = pc.key
                  AND h.created_at >= TIMESTAMP '2024-01-31 00:00:00' - to_seconds(pc.window_secs))""")
def dedup_against_history(spark, sf_dir):
    """Point-mode candidates at as_of minus those already alerted within W (history = replay
    alerts raised before 2024-01-30)."""
    ev = tb.event_view(spark, sf_dir)
    f = C.replay_fired(ev, CAT).withColumnRenamed("window_count", "event_count")
    hist = C.alert_frame(f, CAT, F.timestamp_seconds("sec")).filter(
        F.col("created_at") < F.lit("2024-01-30 00:00:00").cast("timestamp"))
    c = C.point_candidates(ev, CAT, tb.AS_OF)
    d = C.dedup_against_history(c, hist, tb.AS_OF)
    return d.select("rule_name", "group_by", F.col("key").alias("group_value"), "event_count")
