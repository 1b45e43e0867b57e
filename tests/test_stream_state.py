"""Streaming rule state: many keys in one state give the batch's fires, and states do not grow with the keys."""

import random
from datetime import datetime, timedelta

from loglynx.operators import correlate as C
from loglynx.session import work_dir
from loglynx.sources.catalogue import Catalogue
from loglynx.streaming import rules as SR

from .helpers import events_df

CAT = Catalogue.from_yaml("""
rules:
  - {name: burst, description: d, severity: HIGH, window_secs: 40, threshold: 3,
     conditions: [{event_type: auth_failure, source: auth_log, group_by: src_ip}]}
  - {name: any, description: d, severity: HIGH, window_secs: 90, threshold: 1,
     conditions: [{event_type: auth_failure, source: auth_log, group_by: user}]}
  - name: both
    description: d
    severity: HIGH
    window_secs: 30
    threshold: 1
    conditions: [{event_type: auth_failure, source: auth_log, group_by: src_ip}, {event_type: port_scan, source: netwatch, group_by: src_ip}]
""")


def _events(spark, n_keys, n):
    rng, t0 = random.Random(5), datetime(2026, 3, 4, 9)
    out = []
    for i in range(n):
        k = 0 if rng.random() < 0.3 else rng.randrange(n_keys)
        t = (t0 + timedelta(seconds=i // 4)).isoformat(sep=" ")
        kind = ("netwatch", "port_scan") if rng.random() < 0.2 else ("auth_log", "auth_failure")
        out.append({"ts": t, "source": kind[0], "event_type": kind[1], "src_ip": f"10.0.{k // 200}.{k % 200}", "user": f"u{k}"})
    return out


def test_grouped_state_equals_batch_and_is_bounded(spark):
    rows = _events(spark, 300, 2400)
    want = sorted(tuple(r) for r in C.replay_fired(events_df(spark, rows), CAT).select("rule_idx", "key", "sec", "window_count").collect())
    work = work_dir(spark, "t-groups")
    schema, states = events_df(spark, rows[:1]).schema, 0
    for i in range(3):
        events_df(spark, rows[800 * i:800 * (i + 1)]).write.parquet(f"{work}/in/c{i}")
        stream = spark.readStream.schema(schema).parquet(f"{work}/in/*")
        q = (SR.exact_rule_alerts(stream, CAT, watermark="1 hour", state_groups=8).writeStream.format("parquet")
             .option("path", f"{work}/out").option("checkpointLocation", f"{work}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        states = max([states] + [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]])
    got = sorted(tuple(r) for r in spark.read.parquet(f"{work}/out").select("rule_idx", "key", "sec", "window_count").collect())
    assert got == want and len({r[0] for r in want}) == 3 and len(want) > 300
    assert 0 < states <= 8
