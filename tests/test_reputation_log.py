"""The reputation log: equal to one aggregate, written bytes that follow the batch, re-runs, half-written folders."""

import os
import random
import shutil


from loglynx.session import work_dir
from loglynx.sinks import reputation_log as RL
from loglynx.sinks import runs as RU
from loglynx.sinks import tables as TB

ROW = "ip string, score_sum long, alert_count long, first_seen timestamp, last_seen timestamp, tag_firsts array<struct<t:timestamp,r:int,tag:string>>"


def rows_of(spark, batch, n=600):
    rnd = random.Random(batch)
    from datetime import datetime, timedelta
    out = []
    for ip in rnd.sample(range(20000), n):
        t = datetime(2026, 1, 1) + timedelta(minutes=batch * 10 + rnd.randrange(10))
        tag = rnd.choice(["scanner", "brute", "beacon"])
        out.append((f"10.0.{ip // 256}.{ip % 256}", rnd.choice([15, 30]), 1, t, t, [(t, rnd.randrange(5), tag)]))
    return spark.createDataFrame(out, ROW)


def said(df):
    return sorted((r.ip, r.score, r.alert_count, r.first_seen, r.last_seen, list(r.tags)) for r in TB.snapshot_view(df).collect())


def size(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")) if os.path.isdir(path) else 0


def test_log_equals_one_aggregate(spark, monkeypatch):
    monkeypatch.setattr(RL, "BUCKETS", 2)
    root = f"{work_dir(spark, 'rep-log')}/rep"
    assert RL.snapshot(spark, root) is None
    batches, written = 11, []
    for b in range(batches):
        RL.add_batch(spark, root, rows_of(spark, b), b)
        if b in (2, 8):  # run again after its merge was written
            RL.add_batch(spark, root, rows_of(spark, b), b)
        written.append(size(f"{root}/d={b}") + size(f"{root}/m={b}"))
    whole = rows_of(spark, 0)
    for b in range(1, batches):
        whole = whole.unionByName(rows_of(spark, b))
    want = said(RL._merged(whole))
    assert said(RL.snapshot(spark, root)) == want
    # the last batch again, also when its first attempt left a half-written folder
    RL.add_batch(spark, root, rows_of(spark, batches - 1), batches - 1)
    assert said(RL.snapshot(spark, root)) == want
    os.makedirs(f"{root}/m={batches + 3}/bucket=0/span=0-{batches}")
    assert said(RL.snapshot(spark, root)) == want
    runs = RU.runs_of(spark, root, "bucket")
    assert set(runs) == {"0", "1"} and max(len(RU.current(r, 1 << 62)) for r in runs.values()) <= 6  # logarithmic
    whole_table = sum(r[3] for some in runs.values() for r in RU.current(some, 1 << 62))
    assert sorted(written)[batches // 2] < whole_table / 3  # most batches write little; a snapshot would write all of it each time
    shutil.rmtree(root)


def test_runs_due():
    run = lambda i, size: (i, i, i, size, "")
    assert RU.to_merge([]) == [] and RU.to_merge([run(0, 5)]) == []
    assert RU.to_merge([run(0, 100), run(1, 10)]) == []
    assert [r[0] for r in RU.to_merge([run(0, 100), run(1, 12), run(2, 10), run(3, 10)])] == [1, 2, 3]
    assert [r[0] for r in RU.to_merge([run(0, 30), run(1, 12), run(2, 10), run(3, 10)])] == [0, 1, 2, 3]
    inner, outer = (2, 2, 2, 1, "a"), (1, 3, 9, 3, "b")
    assert RU.current([inner, outer], 20) == [outer] and RU.current([inner, outer], 9) == [inner]
