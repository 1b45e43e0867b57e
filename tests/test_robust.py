"""Hostile input, silent losses, hot keys, re-runs: what must not be dropped, forged or doubled."""

import json
import os
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from loglynx import session
from loglynx.operators import correlate as C
from loglynx.plans import serve as SV
from loglynx.plans.correlation import correlate_point, correlate_replay
from loglynx.session import work_dir
from loglynx.sinks import alert_log as AL
from loglynx.sinks import tables as TB
from loglynx.sources import logs as L
from loglynx.sources.catalogue import Catalogue
from loglynx.streaming import rules as SR
from loglynx.streaming import runner as RN
from loglynx.streaming import sinks as SS

from .helpers import events_df, lines_df

OPTS = L.ParseOptions(default_year=2026)
ODD = ["\u0001", "\u0002", "\u0002a", "\u0085", " ", " ", "\u0001\u0002b"]


def test_odd_characters_stay_in_their_field(spark):
    web = [f'9.9.9.9 - a{c}b [04/Mar/2026:09:00:00 +0000] "GET /x{c}y HTTP/1.1" 404 1 tail{c}' for c in ODD]
    got = L.parse_web(lines_df(spark, web), "nginx", OPTS, relabel=False).collect()
    assert sorted(r.user for r in got) == sorted(f"a{c}b" for c in ODD)
    assert {r.src_ip for r in got} == {"9.9.9.9"} and {r.event_type for r in got} == {"web_error"}
    assert sorted(r.message for r in got) == sorted(f"GET /x{c}y → 404 from 9.9.9.9" for c in ODD)
    auth = [f"Mar  4 09:00:00 n sshd[1]: Failed password for u{c}6.6.6.6 from 10.0.0.9 port 1" for c in ODD]
    got = L.parse_auth(lines_df(spark, auth), OPTS).collect()
    assert {r.src_ip for r in got} == {"10.0.0.9"} and sorted(r.user for r in got) == sorted(f"u{c}6.6.6.6" for c in ODD)
    sudo = [f"Mar  4 09:00:00 n sudo: bob : TTY=x ; COMMAND=/bin/a{c}\tb" for c in ODD]
    got = L.parse_auth(lines_df(spark, sudo), OPTS).collect()
    assert sorted(r.message for r in got) == sorted(f"User 'bob' ran sudo command: /bin/a{c}\tb" for c in ODD)
    kern = [f"Mar  4 09:00:00 n kernel: x{c} Out of memory: Kill process 1 (p{c}q) score" for c in ODD]
    assert L.parse_syslog(lines_df(spark, kern), OPTS).count() == len(ODD)


def test_monitor_records_kept_whole_and_rejected(spark):
    good = '{"timestamp": "2026-03-04T09:00:00", "type": "PORT_SCAN", "src_ip": "1.1.1.1", "ports": [1, 2], "deep": {"a": null}}'
    lines = lines_df(spark, [good, "{not json", "[1]", '"text"', "", "null"])
    got = L.json_lines_records(lines, "netwatch", OPTS).collect()
    assert [(r.raw, r.extra, r.event_type) for r in got] == [(good, good, "port_scan")]
    assert sorted(r.value for r in L.rejects("netwatch", lines).collect()) == ['"text"', "[1]", "null", "{not json"]
    assert [r.reason for r in L.rejects("suricata", lines_df(spark, ['{"event_type": "flow"}', "x", '{"event_type": "alert"}'])).collect()] == [
        "not_an_alert", "not_json"]
    assert L.rejects("auth", lines_df(spark, ["junk", "Mar  4 09:00:00 n x: Accepted a for b from c"])).count() == 1
    assert L.rejects("nginx", lines_df(spark, ["junk"])).count() == 1
    with pytest.raises(ValueError):
        L.rejects("other", lines)


def test_json_files_of_both_shapes(spark):
    root = work_dir(spark, "t-json")
    rec = '{"mac": "m", "ip": "2.2.2.2", "vendor": null, "seen": 3}'
    for name, text in (("a", f"[{rec},\n {rec}, 5]"), ("b", '{"alerts": [%s]}' % rec), ("c", "{}"), ("d", "not json"), ("e", "[]")):
        with open(f"{root}/{name}.json", "w") as f:
            f.write(text)
    got = L.read_json_alerts(spark, [f"{root}/{x}.json" for x in "abcde"], "homeguard", OPTS).collect()
    assert len(got) == 3 and all(json.loads(r.raw) == json.loads(rec) for r in got) and {r.src_ip for r in got} == {"2.2.2.2"}


def test_stamps_without_a_year_need_one(spark):
    lines = lines_df(spark, ["Mar  4 09:00:00 n x: Accepted a for b from c"])
    for parse in (L.parse_auth, L.parse_syslog):
        with pytest.raises(ValueError, match="year"):
            parse(lines)
    assert L.parse_auth(lines, L.ParseOptions(ingest_ts="2026-03-05 00:00:00")).filter("ts is null").count() == 0


def test_events_without_a_time_raise_nothing(spark):
    lines = lines_df(spark, ['{"timestamp": "", "type": "PORT_SCAN", "src_ip": "1.1.1.1"}'])
    ev = L.json_lines_records(lines, "netwatch", OPTS)
    assert [r.ts_status for r in ev.collect()] == ["unparsed"]
    assert correlate_replay(ev, Catalogue.load()).count() == 0


def _rule(conds, **kw):
    return Catalogue.from_dict({"rules": [{"name": "r", "description": "d", "severity": "HIGH", "window_secs": 60, "threshold": 1,
                                           "conditions": conds} | kw]})


def test_any_number_of_conditions(spark):
    conds = [{"event_type": "auth_failure", "source": s} for s in ("auth_log", "syslog")] + [{"event_type": "port_scan"}] * 68
    rows = [{"ts": "2026-01-01 00:00:00", "source": s, "event_type": t, "src_ip": "1.1.1.1"}
            for s, t in (("auth_log", "auth_failure"), ("syslog", "auth_failure"), ("netwatch", "port_scan"))]
    cat = _rule(conds)
    assert C.point_candidates(events_df(spark, rows), cat, "2026-01-01 00:00:10").count() == 1
    assert C.point_candidates(events_df(spark, rows[1:]), cat, "2026-01-01 00:00:10").count() == 0


def test_any_type_takes_unknown_types(spark):
    cat = _rule([{"group_by": "src_ip"}], threshold=3)
    rows = [{"ts": "2026-01-01 00:00:00", "source": "manual", "event_type": t, "src_ip": "1.1.1.1"} for t in ("never_seen", "auth_failure", "other")]
    assert [(r.key, r.event_count) for r in C.point_candidates(events_df(spark, rows), cat, "2026-01-01 00:00:10").collect()] == [("1.1.1.1", 3)]


def test_suppression_by_spans_against_a_walk(spark):
    rnd = random.Random(9)
    rows, want = [], set()
    for rule, key, w, n, top in ((1, "hot", 7, 9000, 40000), (1, "quiet", 7, 20, 90000), (2, "hot", 0, 300, 900), (2, None, 1000, 400, 200000), (3, "one", 5, 1, 10)):
        secs = sorted(rnd.sample(range(top), n))
        rows += [(rule, key, s, w) for s in secs]
        last = None
        for s in secs:
            if last is None or s > last + w:
                want.add((rule, key, s))
                last = s
    df = spark.createDataFrame(rows, "rule_idx int, key string, sec long, window_secs long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else small partitions are put together
    out = C.suppress_refires(df, ["rule_idx", "key"])
    assert out.columns == df.columns
    got = [(r.rule_idx, r.key, r.sec) for r in out.collect()]
    assert len(got) == len(want) and set(got) == want
    spans = df.filter("key = 'hot' and rule_idx = 1").select(F.floor(F.col("sec") / (7 * C.FOLD_BUCKETS))).distinct().count()
    assert spans > 50  # pieces of the hot key that separate tasks take
    tasks = out.filter("key = 'hot' and rule_idx = 1").select(F.spark_partition_id()).distinct().count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks > 1


@pytest.mark.parametrize("windows,limit", [(1, 1 << 20), (2, 1 << 20), (64, 30)])
def test_suppression_of_short_spans(spark, monkeypatch, windows, limit):
    """Fires that enter a span from several spans before it, seconds before 1970, and repeated seconds."""
    from loglynx.operators import refire

    monkeypatch.setattr(refire, "FOLD_BUCKETS", windows)
    monkeypatch.setattr(refire, "SPAN_SECONDS", limit)
    rnd = random.Random(windows)
    rows, want = [], []
    for key in range(60):
        w = rnd.choice((1, 3, 10, 40))
        secs = sorted(rnd.choices(range(-200, 400), k=rnd.choice((1, 5, 60, 400))))
        rows += [(f"k{key}", s, w, s % 3) for s in secs]
        last = None
        for s in secs:
            if last is None or s > last + w:
                want.append((f"k{key}", s, w, s % 3))
                last = s
    out = C.suppress_refires(spark.createDataFrame(rows, "key string, sec long, w int, extra int").repartition(3), ["key"], "w")
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert C.suppress_refires(out.filter("false"), ["key"], "w").count() == 0


def test_newest_ids_of_a_crowded_second(spark):
    rows = [{"ts": f"2026-01-01 00:00:{s:02d}", "source": "auth_log", "event_type": "auth_failure", "src_ip": "1.1.1.1", "event_id": 1000 * s + i}
            for s in (1, 2) for i in range(80)]
    ev, cat = events_df(spark, rows), _rule([{"event_type": "auth_failure"}], threshold=100)
    m = C.match_events(ev, cat)
    fired = C.replay_fired(ev, cat)
    ids = C.window_event_ids(fired, m, 50).collect()
    assert [list(r.event_ids) for r in ids] == [[2079 - i for i in range(50)]]


def test_history_is_read_inside_the_windows(spark):
    path = f"{work_dir(spark, 't-hist')}/alerts"
    rows = [{"ts": f"2026-01-01 00:00:{i:02d}", "source": "auth_log", "event_type": "auth_failure", "src_ip": "1.1.1.1"} for i in range(6)]
    cat = _rule([{"event_type": "auth_failure"}], threshold=5)
    a = correlate_point(events_df(spark, rows), cat, "2026-01-01 00:00:10")
    TB.append_alerts(a, path, 0)
    hist = spark.read.parquet(path)
    c = C.dedup_against_history(C.point_candidates(events_df(spark, rows), cat, "2026-01-01 00:00:20"), hist, "2026-01-01 00:00:20", cat.max_window())
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at" in plan and c.count() == 0
    rep = spark.createDataFrame([("1.1.1.1", 70)], "ip string, score int")
    later = correlate_point(events_df(spark, [dict(r, ts=r["ts"].replace("00:00:", "01:00:")) for r in rows]), cat, "2026-01-01 01:00:10", history=hist, reputation=rep)
    assert [r.prior_score for r in later.filter("kind = 'single'").collect()] == [70]


def test_streams_of_several_folders(spark):
    root = work_dir(spark, "t-two")
    for x in "ab":
        os.makedirs(f"{root}/{x}")
        with open(f"{root}/{x}/f.log", "w") as f:
            f.write(f"line {x}\n")
    q = (L.read_lines(spark, [f"{root}/a", f"{root}/b"], stream=True).writeStream.format("memory").queryName("two_t")
         .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.value for r in spark.sql("select * from two_t").collect()) == ["line a", "line b"]


def test_alert_sink_with_empty_batches(spark):
    cat = Catalogue.load()
    root = work_dir(spark, "t-empty")
    handle = SS.alert_sink(cat, root)
    none = spark.createDataFrame([], SR.FIRE_SCHEMA)
    some = spark.createDataFrame([(0, "1.1.1.1", 1000, 9)], SR.FIRE_SCHEMA)
    handle(none, 0)
    handle(some, 1)
    handle(some, 1)  # run again: replaces its own output
    handle(none, 2)
    assert AL.read(spark, f"{root}/alerts").count() == 1
    assert [(r.ip, r.score) for r in SS.latest_reputation(spark, root).collect()] == [("1.1.1.1", 15)]
    assert sorted(x for x in os.listdir(f"{root}/reputation".replace("file:", "")) if "=" in x) == ["d=0", "d=1", "d=2"]
    handle(none, 1)  # the batch now has no fire: its old rows must not stay
    assert AL.read(spark, f"{root}/alerts").count() == 0
    assert SS.latest_reputation(spark, root) is None


def test_event_table_reruns_and_file_counts(spark):
    path = f"{work_dir(spark, 't-ev')}/events"
    rows = [{"ts": f"2026-01-0{1 + i % 2} 00:00:00", "source": "auth_log", "event_type": "auth_failure", "src_ip": "1.1.1.1"} for i in range(40)]
    ev = events_df(spark, rows).repartition(8)
    for batch in (0, 1, 1):
        TB.append_events(ev, path, batch)
    assert TB.read_events(spark, path).count() == 80
    files = [f for d, _, fs in os.walk(path.replace("file:", "")) for f in fs if f.endswith(".parquet")]
    assert len(files) == 4  # one for each date and batch


def test_equal_lines_get_ids_of_their_own(spark):
    same = "Mar  4 09:00:00 n x: Accepted a for b from c"
    ev = L.parse_auth(lines_df(spark, [same, same, same, same.replace("for b", "for d")]), OPTS)
    out = L.number_occurrences(ev).collect()
    assert len({r.event_id for r in out}) == 4 and {r.event_id for r in ev.collect()} <= {r.event_id for r in out}


def test_count_of_an_address_without_events(spark):
    ev = events_df(spark, [{"ts": "2026-01-01 00:00:00", "source": "auth_log", "event_type": "auth_failure", "src_ip": "1.1.1.1"}])
    got = SV.count_events(ev, "auth_failure", "2025-01-01 00:00:00", "9.9.9.9").collect()
    assert [(r.src_ip, r.n_events) for r in got] == [("9.9.9.9", 0)]
    assert [r.d for r in ev.select(SV.display_name(F.col("event_type")).alias("d")).collect()] == ["auth failure"]
    assert [r.t for r in ev.select(SV.display_time(F.col("ts")).alias("t")).collect()] == ["00:00:00"]


def test_counts_of_no_events(spark):
    got = L.ingest_counts(L.parse_auth(lines_df(spark, ["junk"]), OPTS)).collect()
    assert [(r.source, r.file_path, r.n_events) for r in got] == [(None, None, 0)]


def test_a_cluster_must_name_its_checkpoint_folder():
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                            sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(ValueError, match="checkpoint"):
        session.checkpoint_root(spark)


def test_scanner_relabel_in_a_stream_equals_the_batch(spark):
    lines = []
    for k in range(60):
        ip = f"10.0.0.{k % 4}"
        status = (404, 200, 500, 404)[k % 4] if k % 4 != 3 or k < 24 else 200
        lines.append((f'{ip} - - [04/Mar/2026:09:{k:02d}:00 +0000] "GET /{k} HTTP/1.1" {status} 1', k // 20))
    df = spark.createDataFrame(lines, "value string, c int")
    opts = L.ParseOptions(default_year=2026, web_scan_threshold=5)
    named = F.lit("access.log").alias("file_path")
    want = sorted((r.message, r.event_type, r.severity) for r in L.parse_web(df.select(named, "value"), "nginx", opts).collect())
    flush = spark.createDataFrame([('1.1.1.1 - - [09/Apr/2026:09:00:00 +0000] "GET /z HTTP/1.1" 500 1', 3), ('1.1.1.2 - - [09/May/2026:09:00:00 +0000] "GET /z HTTP/1.1" 500 1', 4)], "value string, c int")

    def build(stream):
        return SR.stream_events(spark, {"nginx": stream.select(named, "value")}, opts, relabel=True, watermark="1 hour").select("message", "event_type", "severity", "src_ip")
    work = RN.run_chunks(spark, df.unionByName(flush), F.col("c"), 5, build, RN.parquet_sink, "t-relabel")
    got = sorted((r.message, r.event_type, r.severity) for r in spark.read.parquet(f"{work}/out").collect() if not r.src_ip.startswith("1.1.1."))
    assert got == want and any(t == "web_scan" for _, t, _ in want)


@pytest.mark.parametrize("bucket_rows", [None, 7])
def test_consecutive_failures_of_one_second(spark, bucket_rows):
    """One address with all rows in two seconds: buckets follow the rows, not the clock."""
    from loglynx.operators import sequences as SQ
    from loglynx.operators.scans import dealt

    rnd = random.Random(3)
    rows, want, run = [], {}, 0
    for i in range(200):
        ok = rnd.random() < 0.2
        run = 0 if ok else run + 1
        rows.append({"ts": f"2026-01-01 00:00:{i // 100:02d}", "source": "auth_log", "event_type": "auth_success" if ok else "auth_failure",
                     "src_ip": "1.1.1.1", "event_id": i})
        if not ok:
            want[i] = run
    rows += [dict(rows[0], src_ip=None, event_id=900), dict(rows[0], src_ip="2.2.2.2", event_type="auth_failure", event_id=901)]
    ev = events_df(spark, rows)
    got = SQ.consecutive_failures(ev, bucket_rows=bucket_rows)
    assert {r.event_id: r.consecutive for r in got.collect()} == want | {901: 1} and "_bucket" not in got.columns
    if bucket_rows:
        sizes = [r["count"] for r in dealt(ev.filter("src_ip is not null"), ["src_ip"], ["ts", "event_id"], bucket_rows).groupBy("_bucket").count().collect()]
        assert len(sizes) > 20 and max(sizes) <= 4 * bucket_rows
