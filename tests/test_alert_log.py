"""The alert log and the maintained counts: equal to plain tables, days pruned, re-runs, empty batches."""

import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from loglynx.plans import serve as SV
from loglynx.session import work_dir
from loglynx.sinks import alert_log as AL
from loglynx.sinks import counts as CN
from loglynx.sinks import runs as RU

T0 = datetime(2026, 1, 1)


def alerts_of(spark, batch, n=40):
    rnd = random.Random(batch)
    rows = []
    for i in range(n):  # some come a day late; one address has a third of all
        at = T0 + timedelta(days=batch // 3 - rnd.choice([0, 0, 0, 1]), minutes=rnd.randrange(1400))
        ip = "10.0.0.1" if rnd.random() < 0.33 else f"10.0.1.{rnd.randrange(50)}"
        rows.append((batch * 1000 + i, f"rule{i % 3}", rnd.choice(["HIGH", "LOW"]), "src_ip", ip, "single", at, ip if i % 7 else None))
    return spark.createDataFrame(rows, "alert_id long, rule_name string, severity string, group_by string, group_value string, kind string, created_at timestamp, src_ip string")


def ids(df):
    return sorted(r.alert_id for r in df.collect())


def test_log_equals_the_batches(spark):
    root = f"{work_dir(spark, 'alert-log')}/alerts"
    assert AL.read(spark, root).count() == 0 and AL.read(spark, root).schema == AL.STORED
    for b in range(12):
        AL.add_batch(spark, root, alerts_of(spark, b), b)
        if b in (4, 9):  # run again after its merge was written
            AL.add_batch(spark, root, alerts_of(spark, b), b)
    AL.add_batch(spark, root, alerts_of(spark, 0).limit(0), 12)
    whole = alerts_of(spark, 0)
    for b in range(1, 12):
        whole = whole.unionByName(alerts_of(spark, b))
    assert ids(AL.read(spark, root)) == ids(whole)
    assert AL.batch_rows(spark, root, 12).count() == 0 and ids(AL.batch_rows(spark, root, 11)) == ids(alerts_of(spark, 11))
    assert ids(AL.read(spark, root, before=11)) == ids(whole.filter("alert_id < 11000"))
    since = "2026-01-03 08:00:00"
    recent = whole.filter(F.col("created_at") >= F.lit(since).cast("timestamp"))
    assert ids(AL.read(spark, root, since)) == ids(recent)
    keys = spark.createDataFrame([("10.0.0.1",), ("10.0.1.7",), (None,), ("10.0.0.1",)], "ip string")
    want = ids(recent.filter(F.col("src_ip").isin("10.0.0.1", "10.0.1.7")))
    assert want and ids(AL.history(spark, root, since, keys)) == want
    left = RU.runs_of(spark, root, "day")
    assert max(len(RU.current(r)) for r in left.values()) <= 5  # logarithmic in the batches of a day
    AL.add_batch(spark, root, alerts_of(spark, 12), 12)  # the empty batch again, now with rows
    assert ids(AL.read(spark, root)) == ids(whole.unionByName(alerts_of(spark, 12)))


def test_history_reads_its_days_and_is_not_shuffled(spark, monkeypatch):
    root = f"{work_dir(spark, 'alert-days')}/alerts"
    for b in range(9):
        AL.add_batch(spark, root, alerts_of(spark, b), b)
    keys = spark.createDataFrame([("10.0.0.1",)], "ip string")
    h = AL.history(spark, root, "2026-01-03 00:00:00", keys)
    files = h.inputFiles()
    assert files and all("/day=2026-01-03/" in f for f in files)
    plan = h._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(created_at" in plan
    whole = h._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in whole.splitlines() if "Scan parquet" in line or "FileScan" in line]
    assert "BroadcastHashJoin" in whole and "SortMergeJoin" not in whole and len(scan) == 1
    want = ids(h)
    monkeypatch.setattr(AL, "MAX_KEYS_BYTES", 0)  # too many keys: the join is left to the optimizer
    assert want and ids(AL.history(spark, root, "2026-01-03 00:00:00", keys)) == want


def test_folders_of_replaced_batches_go(spark):
    root = f"{work_dir(spark, 'alert-gone')}/alerts"
    for b in range(16):  # one day, equal batches
        AL.add_batch(spark, root, alerts_of(spark, 0).withColumn("created_at", F.lit("2026-02-01 10:00:00").cast("timestamp")), b)
    assert len([x for x in os.listdir(root) if "=" in x]) < 12
    assert AL.read(spark, root).count() == 16 * 40


def test_counts_equal_a_scan(spark):
    root = work_dir(spark, "t-counts")
    none = CN.stats(spark, f"{root}/counts").collect()[0]
    assert (none.total_events, none.total_alerts, none.unacknowledged_alerts, none.active_sources) == (0, 0, 0, 0)
    events = spark.createDataFrame(
        [(T0 + timedelta(hours=7 * i) if i % 10 else None, ["nginx", "auth_log", "syslog"][i % 7 % 3], i) for i in range(200)],
        "ts timestamp, source string, event_id long")
    alerts = alerts_of(spark, 0).unionByName(alerts_of(spark, 1)).unionByName(alerts_of(spark, 5))
    for b in (0, 1, 1, 2, 3, 4):
        CN.add_events(spark, f"{root}/counts", events.filter(F.col("event_id") % 5 == b), b)
        AL.add_batch(spark, f"{root}/alerts", alerts.filter(F.col("alert_id") % 5 == b), b)
        CN.add_alerts(spark, f"{root}/counts", alerts.filter(F.col("alert_id") % 5 == b), b)
    stored = AL.read(spark, f"{root}/alerts")
    some = alerts.filter("alert_id % 4 = 0").select("alert_id")
    more = some.unionByName(some).unionByName(alerts.filter("alert_id % 3 = 0").select("alert_id")).unionByName(spark.range(90_000, 90_003).toDF("alert_id"))
    for b, part in ((0, some), (1, more), (1, more), (2, some)):
        CN.acknowledge(spark, f"{root}/counts", part, "2026-02-01 00:00:00", f"{root}/acks", b, stored)
    assert CN.stats(spark, f"{root}/counts").collect() == SV.stats(events, stored, spark.read.parquet(f"{root}/acks")).collect()
    since = "2026-01-20 00:00:00"
    got = {r.name: r.n for r in CN.counts(spark, f"{root}/counts", "events", since).collect()}
    assert got == {r.source: r["count"] for r in events.filter(F.col("ts") >= F.lit(since).cast("timestamp")).groupBy("source").count().collect()}
