"""Rule chains (J4, J5, J11, N18): a trigger alert plus a ``then`` alert for the
same address within the chain window raises a chain alert.

Replay mode pairs alerts through an equi join on (chain, address, time
bucket of the chain window) — each trigger only meets the ``then`` alerts of
its own and the previous bucket, never all alerts of a busy address — and
suppresses repeats with the same greedy rule as single rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.catalogue import Catalogue
from .correlate import empty_ids, recent_history, suppress_refires

CHAIN_PREFIX = "[CHAIN] "


def chain_description(desc: Column, ip: Column) -> Column:
    return F.concat(F.lit(CHAIN_PREFIX), desc, F.lit(" [src_ip="), ip, F.lit("]"))


def chain_alert_rows(c: DataFrame, created_at: Column) -> DataFrame:
    """Chain candidates (chain_name, severity, description, ip) -> alert columns."""
    return c.select(
        F.lit(None).cast("int").alias("rule_idx"),
        F.col("chain_name").alias("rule_name"),
        "severity",
        F.col("description").alias("base_description"),
        F.lit("src_ip").alias("group_by"),
        F.col("ip").alias("group_value"),
        F.lit(None).cast("bigint").alias("event_count"),
        F.lit("chain").alias("kind"),
        created_at.alias("created_at"),
        F.col("ip").alias("src_ip"),
        F.lit(None).cast("string").alias("user"),
        "window_secs",
        chain_description(F.col("description"), F.col("ip")).alias("description"),
        empty_ids().alias("event_ids"),
    )


def chain_candidates_replay(alerts: DataFrame, cat: Catalogue, triggers: DataFrame | None = None,
                            same_moment: bool = True) -> DataFrame:
    """Every non-chain alert that triggers a chain whose ``then`` rule alerted
    for the same address within [t - Wc, t] (at t itself any key matches).
    ``triggers`` (default: ``alerts``) limits which alerts act as triggers;
    without ``same_moment`` only earlier, address-keyed alerts are partners.

    -> chain_idx, chain_name, severity, description, window_secs, ip, sec."""
    spark = alerts.sparkSession
    ch = cat.chains_df(spark)

    def prep(df):
        return df.filter(F.col("kind") != "chain").select(
            "rule_name", "group_value", "group_by", F.unix_seconds("created_at").alias("sec"))
    base = prep(alerts)
    tbase = base if triggers is None else prep(triggers)
    width = F.greatest(F.col("window_secs"), F.lit(1))
    trig = tbase.join(ch, tbase["rule_name"] == ch["trigger"]).select(
        "chain_idx", "chain_name", "severity", "description", "window_secs",
        F.col("group_value").alias("ip"), "sec")
    trig = trig.filter(F.col("ip").isNotNull() & (F.col("ip") != "")).withColumn(
        "b", F.floor(F.col("sec") / width))
    then = base.join(ch.select("chain_idx", "then", "window_secs"), base["rule_name"] == F.col("then")).select(
        "chain_idx", F.col("group_value").alias("t_ip"), F.col("sec").alias("t_sec"),
        F.col("group_by").alias("t_gb"), F.col("window_secs").alias("t_w"))
    then = then.withColumn("t_b", F.explode(F.array(F.floor(F.col("t_sec") / F.greatest(F.col("t_w"), F.lit(1))),
                                                    F.floor(F.col("t_sec") / F.greatest(F.col("t_w"), F.lit(1))) + 1)))
    then = then.withColumnRenamed("chain_idx", "t_chain")
    cond = ((trig["chain_idx"] == then["t_chain"]) & (trig["ip"] == then["t_ip"]) & (trig["b"] == then["t_b"])
            & (then["t_sec"] <= trig["sec"]) & (then["t_sec"] >= trig["sec"] - trig["window_secs"])
            & ((then["t_gb"] == "src_ip") | (then["t_sec"] == trig["sec"])))
    if not same_moment:
        cond = cond & (then["t_sec"] < trig["sec"]) & (then["t_gb"] == "src_ip")
    return trig.join(then, cond, "left_semi").drop("b")


def chains_replay(alerts: DataFrame, cat: Catalogue) -> DataFrame:
    """Chain alerts over the whole history, with repeat suppression per (chain, address)."""
    c = chain_candidates_replay(alerts, cat)
    fired = suppress_refires(c, ["chain_idx", "ip"])
    return chain_alert_rows(fired, F.timestamp_seconds("sec"))


def chains_point(fired_now: DataFrame, history: DataFrame | None, cat: Catalogue, as_of) -> DataFrame:
    """Chains at one moment: triggers are alerts fired in this run; ``then``
    fired in this run (any key) or in history for the address within Wc;
    a chain alert for the same address within Wc suppresses a new one.  Only
    history inside the longest Wc is read."""
    if history is not None and cat.chains:
        history = recent_history(history, as_of, max(int(r[5]) for r in cat.chain_rows()))
    spark = fired_now.sparkSession
    a = F.lit(as_of).cast("timestamp")
    ch = cat.chains_df(spark)
    now = fired_now.filter(F.col("kind") != "chain").select("rule_name", "group_value")
    trig = now.join(ch, now["rule_name"] == ch["trigger"]).select(
        "chain_idx", "chain_name", "severity", "description", "window_secs", F.col("group_value").alias("ip"))
    trig = trig.filter(F.col("ip").isNotNull() & (F.col("ip") != ""))
    same_run = now.select(F.col("rule_name").alias("t_rule"), F.col("group_value").alias("t_ip"),
                          F.lit(True).alias("t_now"), a.alias("t_at"))
    if history is not None:
        hist = history.select(F.col("rule_name").alias("t_rule"), F.col("src_ip").alias("t_ip"),
                              F.lit(False).alias("t_now"), F.col("created_at").alias("t_at"))
        same_run = same_run.unionByName(hist)
    ch_then = ch.select(F.col("chain_idx").alias("c2"), "then")
    ok = trig.join(ch_then, trig["chain_idx"] == ch_then["c2"]).join(
        same_run,
        (F.col("then") == F.col("t_rule")) & (F.col("ip") == F.col("t_ip"))
        & (F.col("t_now") | (F.col("t_at") >= a - F.make_dt_interval(secs=F.col("window_secs")))),
        "left_semi").drop("c2", "then")
    if history is not None:
        prev = history.filter(F.col("kind") == "chain").select(
            F.col("rule_name").alias("p_rule"), F.col("src_ip").alias("p_ip"), F.col("created_at").alias("p_at"))
        ok = ok.join(prev, (F.col("chain_name") == F.col("p_rule")) & (F.col("ip") == F.col("p_ip"))
                     & (F.col("p_at") >= a - F.make_dt_interval(secs=F.col("window_secs"))), "left_anti")
    return chain_alert_rows(ok, a)
