"""Rule evaluation over event tables.

* ``match_events``      J1: events x conditions in ONE scan (broadcast hash join
                        on event_type of the small, size-checked catalogue).
* ``point_candidates``  W1/A1/A2/F3/F4/J2: all rules at one moment, one shuffle.
* ``top_event_ids``     A3: newest-k ids per group (WindowGroupLimit: the limit
                        is applied map-side before the shuffle, so a hot key
                        ships at most k rows per map task).
* ``dedup_against_history``  J3: anti join with alert history inside the window.
* ``replay_candidates`` W2/W6: every moment an event arrives, exact look-back.
* ``suppress_refires``  W7: greedy re-fire suppression (next fire > last + W).

Scale notes.  Counting is map-side combined (per-second pre-aggregation), so
a hot key costs one row per (second, map task) before the shuffle.  Look-back
windows are evaluated per (rule, key, time bucket of width W) with the
previous bucket copied in as context, so one key's history is split over
many tasks and a task holds at most 2*W seconds of one key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.catalogue import CONDITION_SCHEMA, Catalogue
from .refire import FOLD_BUCKETS, suppress_refires  # noqa: F401


def _ts(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x).cast("timestamp")


def group_key(group_keys: list[str]) -> Column:
    """Value of the condition's ``group_by`` field for the event row."""
    g = F.col("group_by")
    expr = None
    for k in group_keys:
        expr = F.when(g == k, F.col(f"e_{k}")) if expr is None else expr.when(g == k, F.col(f"e_{k}"))
    return expr


def match_events(events: DataFrame, cat: Catalogue, spark=None) -> DataFrame:
    """J1 + F3: one row per (event, matching rule condition) with its group key.

    Conditions with an event_type meet the events by a hash join on it; those
    without (any type, also types outside the closed set) are few and known, so
    they are laid beside each event as an array.  Source null = any source.
    Rows whose key is null or empty are dropped, and so are events without a
    time: no window holds them (``sources.logs`` marks them in ts_status).
    """
    spark = spark or events.sparkSession
    keys = cat.group_keys()
    types = cat.event_types()

    def key_col(k):  # an event column, else a field of the ``extra`` JSON (e.g. host)
        return F.col(k) if k in events.columns else F.get_json_object(F.col("extra"), f"$.{k}")
    ev = events.filter(F.col("ts").isNotNull())
    if types is not None:
        ev = ev.filter(F.col("event_type").isin(*types))  # pushed to the scan
    ev = ev.select("event_id", "ts", "event_type", "source", *[key_col(k).alias(f"e_{k}") for k in keys])
    typed = cat.conditions_df(spark).filter(F.col("event_type").isNotNull()).withColumnRenamed("source", "c_source")
    j = ev.join(typed, "event_type")
    if types is None:
        names = [f.name for f in CONDITION_SCHEMA.fields]
        anys = [r for r in cat.condition_rows() if r[names.index("event_type")] is None]
        rows = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias("c_source" if f.name == "source" else f.name)
                                    for f, v in zip(CONDITION_SCHEMA.fields, r) if f.name != "event_type"]) for r in anys])
        j = j.unionByName(ev.select("*", F.explode(rows).alias("c")).select(*ev.columns, "c.*"))
    j = j.filter(F.col("c_source").isNull() | (F.col("c_source") == F.col("source")))
    j = j.withColumn("key", group_key(keys))
    j = j.filter(F.col("key").isNotNull() & (F.col("key") != ""))
    return j.select("rule_idx", "rule_name", "cond_idx", "n_conds", "window_secs", "threshold",
                    "group_by", "key", "ts", "event_id")


def in_window(matched: DataFrame, as_of, open_ended: bool = False) -> DataFrame:
    """Events inside [as_of - W, as_of] (W per rule).  ``open_ended`` keeps
    rows after ``as_of`` too (lower bound only)."""
    a = _ts(as_of)
    lo = F.col("ts") >= a - F.make_dt_interval(secs=F.col("window_secs"))
    return matched.filter(lo if open_ended else lo & (F.col("ts") <= a))


def prefilter_events(events: DataFrame, cat: Catalogue, as_of, open_ended: bool = False) -> DataFrame:
    """Scan-level predicates: the widest window (pushed to parquet as a ts range,
    and as an ``event_date`` range for partition pruning when the table is
    partitioned by date, as the event sink writes it)."""
    a = _ts(as_of)
    lo = a - F.expr(f"INTERVAL {int(cat.max_window())} SECONDS")
    cond = F.col("ts") >= lo
    if not open_ended:
        cond = cond & (F.col("ts") <= a)
    if "event_date" in events.columns:
        dcond = F.col("event_date") >= F.to_date(lo)
        if not open_ended:
            dcond = dcond & (F.col("event_date") <= F.to_date(a))
        cond = cond & dcond
    return events.filter(cond)


def point_candidates(events: DataFrame, cat: Catalogue, as_of, open_ended: bool = False) -> DataFrame:
    """All rules evaluated at ``as_of`` in one pass.

    Single-condition rules: count >= threshold.  Multi-condition rules: every
    condition has >= 1 event for the key (threshold ignored); the count is
    the sum over conditions.  Output: rule_idx, rule_name, key, event_count,
    n_conds, window_secs, group_by (of the first condition).
    """
    m = in_window(match_events(prefilter_events(events, cat, as_of, open_ended), cat), as_of, open_ended)
    conds = range(cat.max_conditions())
    g = m.groupBy("rule_idx", "rule_name", "n_conds", "window_secs", "threshold", "key").agg(
        F.count(F.lit(1)).alias("event_count"),
        *[F.max(F.col("cond_idx") == i).alias(f"seen{i}") for i in conds],
        F.min(F.when(F.col("cond_idx") == 0, F.col("group_by"))).alias("group_by"),
    )
    fire = F.when(F.col("n_conds") == 1, F.col("event_count") >= F.col("threshold")).otherwise(
        reduce(lambda a, b: a & b, [(F.col("n_conds") <= i) | F.col(f"seen{i}") for i in conds]))
    return g.filter(fire).drop(*[f"seen{i}" for i in conds], "threshold")


def top_event_ids(matched: DataFrame, k: int = 50) -> DataFrame:
    """A3: newest-k event ids per (rule, key), newest first.

    Multi-condition rules: newest-first within a condition, conditions in
    rule order, then the first k.  Output: rule_idx, key, event_ids.
    """
    w = Window.partitionBy("rule_idx", "key").orderBy(
        F.col("cond_idx").asc(), F.col("ts").desc(), F.col("event_id").desc())
    top = matched.select("rule_idx", "key", "cond_idx", "ts", "event_id",
                         F.row_number().over(w).alias("rn")).filter(F.col("rn") <= k)
    return top.groupBy("rule_idx", "key").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rn", "event_id"))),
                    lambda x: x["event_id"]).alias("event_ids"))


def recent_history(history: DataFrame, as_of, window_secs: int) -> DataFrame:
    """Alerts created at or after as_of - ``window_secs``: a bound on created_at that reaches
    the scan, so an evaluation reads the last windows of a stored alert table, not all of it."""
    lo = _ts(as_of) - F.expr(f"INTERVAL {int(window_secs)} SECONDS")
    return history.filter(F.col("created_at") >= lo)


def dedup_against_history(cands: DataFrame, history: DataFrame, as_of, max_window: int | None = None) -> DataFrame:
    """Drop candidates whose (rule, group value) already alerted at or after as_of - W.

    ``history`` needs rule_name, group_value, created_at.  With ``max_window``
    (the widest W of the rules) only alerts inside it are read.
    """
    a = _ts(as_of)
    if max_window is not None:
        history = recent_history(history, as_of, max_window)
    h = history.select(F.col("rule_name").alias("h_rule"), F.col("group_value").alias("h_key"),
                       F.col("created_at").alias("h_at"))
    cond = ((F.col("rule_name") == F.col("h_rule")) & (F.col("key") == F.col("h_key"))
            & (F.col("h_at") >= a - F.make_dt_interval(secs=F.col("window_secs"))))
    return cands.join(h, cond, "left_anti")


# ---------------------------------------------------------------------------
# Replay mode
# ---------------------------------------------------------------------------

def per_second_counts(matched: DataFrame, n_cond_cols: int) -> DataFrame:
    """Map-side combined per (rule, key, second) counts, one column per condition."""
    sec = F.unix_seconds(F.col("ts"))
    return matched.groupBy(
        "rule_idx", "n_conds", "window_secs", "threshold", "key", sec.alias("sec")
    ).agg(*[F.sum(F.when(F.col("cond_idx") == i, 1).otherwise(0)).cast("bigint").alias(f"c{i}")
            for i in range(n_cond_cols)])


def bucketed_lookback(per_sec: DataFrame, value_cols: list[str]) -> DataFrame:
    """Sum each value column over [sec - W, sec] per (rule, key).

    Rows are placed in bucket floor(sec / W) and copied into the next bucket, where they
    leave the sum again once W seconds have passed; the window runs per (rule, key, bucket),
    so a key's history is split by time over many tasks.  A sum is what the copies bring
    along plus a running total of arrivals less departures: each row is met once, however
    many lie in its look-back.  Only home rows are returned.
    """
    width = F.greatest(F.col("window_secs"), F.lit(1))
    b = F.floor(F.col("sec") / width)
    rep = per_sec.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    rep = rep.withColumn("pb", b + F.col("copy")).withColumn("at", F.col("sec") + F.col("copy") * (width + 1))
    w = Window.partitionBy("rule_idx", "key", "pb").orderBy("at")
    so_far = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    home = F.col("copy") == 0
    out = rep.select("*", *[(F.sum(F.when(home, F.col(c)).otherwise(-F.col(c))).over(so_far)
                             + F.sum(F.when(home, 0).otherwise(F.col(c))).over(whole)).alias(f"w_{c}") for c in value_cols])
    return out.filter(home).drop("copy", "pb", "at")


def replay_candidates(events: DataFrame, cat: Catalogue, matched: DataFrame | None = None) -> DataFrame:
    """W2 + W6: rule state at every second an event of the rule arrives.

    Single-condition rules: count of events in [t - W, t] >= threshold.
    Multi-condition rules: each condition seen >= 1 in [t - W, t].
    Output: rule_idx, key, sec, window_secs, window_count.
    """
    k = cat.max_conditions()
    m = matched if matched is not None else match_events(events, cat)
    per_sec = per_second_counts(m, k)
    cols = [f"c{i}" for i in range(k)]
    lb = bucketed_lookback(per_sec, cols)
    n = F.col("n_conds")
    single = (n == 1) & (F.col("w_c0") >= F.col("threshold"))
    multi = reduce(lambda a, b: a & b,
                   [(n <= i) | (F.col(f"w_c{i}") >= 1) for i in range(k)], n > 1)
    count = reduce(lambda a, b: a + b,
                   [F.when(n > i, F.col(f"w_c{i}")).otherwise(0) for i in range(k)])
    return lb.filter(single | multi).select(
        "rule_idx", "key", "sec", "window_secs", count.alias("window_count"))


def replay_fired(events: DataFrame, cat: Catalogue) -> DataFrame:
    """Replay candidates after W7 suppression: rule_idx, key, sec, window_secs, window_count."""
    return suppress_refires(replay_candidates(events, cat), ["rule_idx", "key"])


def window_event_ids(fires: DataFrame, matched: DataFrame, k: int = 50) -> DataFrame:
    """Newest-k event ids in [sec - W, sec] for each fire (replay alerts).

    Range join made an equi join on (rule, key, W-bucket): each fire is
    looked up in its own bucket and the previous one, so a key's events
    are never paired with all of its fires.  Of one second of a (rule, key,
    condition) only the newest k can be among a fire's newest k, as windows end
    on whole seconds: the rest are dropped before any exchange meets a hot key
    (the limit is applied map-side, like in ``top_event_ids``).
    """
    width = F.greatest(F.col("window_secs"), F.lit(1))
    ev = matched.select("rule_idx", "key", "cond_idx", "ts", "event_id", "window_secs",
                        F.unix_seconds("ts").alias("e_sec"))
    second = Window.partitionBy("rule_idx", "key", "cond_idx", "e_sec").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    ev = ev.withColumn("nth", F.row_number().over(second)).filter(F.col("nth") <= k).drop("nth")
    ev = ev.withColumn("b", F.floor(F.col("e_sec") / width)).drop("window_secs")
    f = fires.select("rule_idx", "key", "sec", "window_secs")
    f = f.withColumn("b", F.explode(F.array(F.floor(F.col("sec") / width),
                                            F.floor(F.col("sec") / width) - 1)))
    j = f.join(ev, ["rule_idx", "key", "b"]).filter(
        (F.col("e_sec") <= F.col("sec")) & (F.col("e_sec") >= F.col("sec") - F.col("window_secs")))
    w = Window.partitionBy("rule_idx", "key", "sec").orderBy(
        F.col("cond_idx").asc(), F.col("ts").desc(), F.col("event_id").desc())
    top = j.select("rule_idx", "key", "sec", "event_id", F.row_number().over(w).alias("rn")).filter(
        F.col("rn") <= k)
    return top.groupBy("rule_idx", "key", "sec").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rn", "event_id"))),
                    lambda x: x["event_id"]).alias("event_ids"))


# ---------------------------------------------------------------------------
# Alert rows
# ---------------------------------------------------------------------------

def alert_frame(fires: DataFrame, cat: Catalogue, created_at: Column, keep: tuple = ()) -> DataFrame:
    """Attach rule attributes to fires (rule_idx, key, event_count) -> alert columns
    (plus the ``keep`` columns of ``fires`` passed through)."""
    spark = fires.sparkSession
    rules = cat.rules_df(spark).select("rule_idx", "rule_name", "description", "severity", "window_secs",
                                       F.col("n_conds").alias("r_n_conds"))
    first_gb = cat.first_keys_df(spark)
    fires = fires.drop("rule_name", "severity", "description", "group_by", "window_secs")
    j = fires.join(rules, "rule_idx").join(first_gb, "rule_idx")
    multi = F.col("r_n_conds") > 1
    gb = F.when(multi, F.lit("src_ip")).otherwise(F.col("gb0"))
    return j.select(
        F.col("rule_idx"),
        F.col("rule_name"),
        F.col("severity"),
        F.col("description").alias("base_description"),
        gb.alias("group_by"),
        F.col("key").alias("group_value"),
        F.col("event_count"),
        F.when(multi, "cross_source").otherwise("single").alias("kind"),
        created_at.alias("created_at"),
        F.when(gb == "src_ip", F.col("key")).alias("src_ip"),
        F.when(gb == "user", F.col("key")).alias("user"),
        F.col("window_secs"),
        *[F.col(c) for c in keep],
    )


def describe(base: Column, kind: Column, group_by: Column, group_value: Column,
             event_count: Column, geo_text: Column, rep_score: Column, rep_label: Column) -> Column:
    """Alert description text.

    single:        "<base> [<group_by>=<value>, count=<n>]<geo><rep>"
    cross_source:  "[CROSS-SOURCE] <base> [src_ip=<value>]<geo><rep>"
    geo is " [..]" for external IPs, rep is " [rep:<score>/<label>]" when score > 0.
    """
    geo = F.coalesce(geo_text, F.lit(""))
    rep = F.when(rep_score > 0, F.format_string(" [rep:%d/%s]", rep_score, rep_label)).otherwise(F.lit(""))
    single = F.concat(base, F.lit(" ["), group_by, F.lit("="), group_value, F.lit(", count="),
                      event_count.cast("string"), F.lit("]"), geo, rep)
    cross = F.concat(F.lit("[CROSS-SOURCE] "), base, F.lit(" [src_ip="), group_value, F.lit("]"), geo, rep)
    return F.when(kind == "cross_source", cross).otherwise(single)


def alert_id(rule_name: Column, group_value: Column, created_at: Column) -> Column:
    """Deterministic alert id (same alert -> same id on every re-run)."""
    return F.xxhash64(rule_name, group_value, created_at)


def empty_ids() -> Column:
    return F.array().cast(T.ArrayType(T.LongType()))
