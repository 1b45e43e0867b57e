"""foreachBatch sinks for streaming alerts (ST5, ST7, V9 in streaming).

Each micro-batch: append the batch's alerts to the alert log, raise chain
alerts whose trigger is in this batch (``then`` looked up among the stored alerts
of its addresses), suppress repeats against the chain log, and add the batch to
the reputation log and the counts.  Every write is keyed by the batch id, so a batch
that is re-run after a failure replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chain as CH
from ..operators import correlate as C
from ..operators import notify as NT
from ..sinks import alert_log as AL
from ..sinks import counts as CN
from ..sinks import reputation_log as RL
from ..sinks import tables as TB
from ..sources.catalogue import Catalogue


def alert_sink(cat: Catalogue, table_dir: str, min_severity: str = "HIGH", app_name: str = "loglynx"):
    """Build the foreachBatch function for a stream of fires (rule_idx, key, sec, window_count).

    Tables under ``table_dir``: alerts and chains (``sinks.alert_log``), outbox (notifications at or above
    ``min_severity`` for this batch's alerts and chains), reputation (``sinks.reputation_log``), counts
    (``sinks.counts``)."""
    alerts_path = f"{table_dir}/alerts"
    outbox_path = f"{table_dir}/outbox"
    chains_path = f"{table_dir}/chains"
    rep_root = f"{table_dir}/reputation"

    def handle(fires: DataFrame, batch_id: int) -> None:
        spark = fires.sparkSession
        a = C.alert_frame(fires.withColumnRenamed("window_count", "event_count"), cat,
                          F.timestamp_seconds("sec"))
        a = a.withColumn("alert_id", C.alert_id(F.col("rule_name"), F.col("group_value"), F.col("created_at")))
        a = a.withColumn("description", C.describe(  # addresses are looked up by the reports, not here
            F.col("base_description"), F.col("kind"), F.col("group_by"), F.col("group_value"), F.col("event_count"),
            F.lit(""), F.lit(0), F.lit("")))
        AL.add_batch(spark, alerts_path, a, batch_id)
        mine = AL.batch_rows(spark, alerts_path, batch_id)
        new = mine
        if cat.chains:
            # only alerts of this batch's addresses inside the longest chain window before its first
            # alert can pair with (or suppress) its chains: days and addresses bound the history read
            longest = F.make_dt_interval(secs=F.lit(max(int(r[5]) for r in cat.chain_rows())))
            since = mine.agg(F.date_format(F.min("created_at") - longest, "yyyy-MM-dd HH:mm:ss")).first()[0]
            fired = mine.limit(0)
            if since is not None:
                cand = CH.chain_candidates_replay(
                    AL.history(spark, alerts_path, since, mine.select("group_value"), "group_value"), cat, triggers=mine)
                cols = ["chain_idx", "chain_name", "severity", "description", "window_secs", "ip", "sec"]
                cand = cand.select(*cols).withColumn("_seed", F.lit(False))
                prev = AL.history(spark, chains_path, since, mine.select("group_value"), before=batch_id)
                ch = cat.chains_df(spark).select("chain_idx", "chain_name", "description", "window_secs")
                seed = prev.groupBy(F.col("rule_name").alias("chain_name"), F.col("src_ip").alias("ip")).agg(
                    F.max(F.unix_seconds("created_at")).alias("sec"), F.max("severity").alias("severity"))
                seed = seed.join(ch, "chain_name").select(*cols).withColumn("_seed", F.lit(True))
                kept = C.suppress_refires(cand.unionByName(seed), ["chain_idx", "ip"]).filter(~F.col("_seed"))
                fired = CH.chain_alert_rows(kept, F.timestamp_seconds("sec")).withColumn(
                    "alert_id", C.alert_id(F.col("rule_name"), F.col("group_value"), F.col("created_at")))
            AL.add_batch(spark, chains_path, fired, batch_id)
            new = mine.unionByName(AL.batch_rows(spark, chains_path, batch_id))
        TB.write_batch(NT.outbox(new, min_severity, app_name), outbox_path, batch_id)
        RL.add_batch(spark, rep_root, TB.reputation_delta(mine, cat.tags), batch_id)
        CN.add_alerts(spark, f"{table_dir}/counts", new, batch_id)

    return handle


def latest_reputation(spark, table_dir: str):
    """The reputation of all batches so far, in reputation-table shape."""
    snap = RL.snapshot(spark, f"{table_dir}/reputation")
    if snap is None:
        return None
    return TB.snapshot_view(snap)

