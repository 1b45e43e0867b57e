"""Reputation, geo cache, notification outbox, read-side functions, sinks."""

from datetime import datetime

from pyspark.sql import functions as F

from loglynx.operators import geo as G
from loglynx.operators import notify as NT
from loglynx.operators import reputation as R
from loglynx.plans import serve as SV
from loglynx.schema import ALERT_SCHEMA
from loglynx.sinks import tables as TB
from loglynx.sources.catalogue import RULE_TAGS

IDX = {"ssh_brute_force": 0, "web_scanner": 2, "netwatch_port_scan": 4, "homeguard_unknown_device": 5,
       "unknown_device_then_portscan": 11}


def alerts(spark, rows):
    """rows: (created_at, rule_name, severity, ip, kind)."""
    out = []
    for i, (at, rule, sev, ip, kind) in enumerate(rows):
        out.append((i + 1, datetime.fromisoformat(at), rule, sev, f"d{i}", [], ip, None, "src_ip", ip, 1, kind,
                    IDX.get(rule, 99)))
    return spark.createDataFrame(out, ALERT_SCHEMA)


def test_accumulation_clamp_and_tags(spark):
    a = alerts(spark, [("2026-01-01 10:00:00", "homeguard_unknown_device", "HIGH", "1.1.1.1", "single"),
                       ("2026-01-01 10:00:00", "ssh_brute_force", "HIGH", "1.1.1.1", "single"),
                       ("2026-01-01 11:00:00", "ssh_brute_force", "HIGH", "1.1.1.1", "single"),
                       ("2026-01-01 10:00:00", "web_scanner", "HIGH", "2.2.2.2", "single"),
                       ("2026-01-01 10:30:00", "web_scanner", "HIGH", "2.2.2.2", "single"),
                       ("2026-01-01 12:00:00", "chain_x", "CRITICAL", "2.2.2.2", "chain")]
                 + [(f"2026-01-02 0{i}:00:00", "unknown_device_then_portscan", "CRITICAL", "3.3.3.3",
                     "cross_source") for i in range(7)])
    rep = {r.ip: r for r in R.reputation_table(a, RULE_TAGS).collect()}
    assert rep["2.2.2.2"].alert_count == 2 and rep["2.2.2.2"].score == 30  # chain alerts do not count
    assert rep["3.3.3.3"].score == 100 and rep["3.3.3.3"].label == "KNOWN_BAD"  # clamped
    assert list(rep["1.1.1.1"].tags) == ["brute_force", "unknown_device"]  # first use, catalogue order on ties
    top = R.top_offenders(R.reputation_table(a, RULE_TAGS), 2).collect()
    assert [r.ip for r in top] == ["3.3.3.3", "1.1.1.1"]
    prior = sorted((r.ip, str(r.created_at), r.prior_score) for r in R.prior_scores(a, RULE_TAGS).collect())
    assert prior[:3] == [("1.1.1.1", "2026-01-01 10:00:00", 0), ("1.1.1.1", "2026-01-01 10:00:00", 15),
                         ("1.1.1.1", "2026-01-01 11:00:00", 30)]
    look = R.reputation_lookup(spark.createDataFrame([("9.9.9.9",), ("2.2.2.2",)], "ip string"),
                               R.reputation_table(a, RULE_TAGS))
    assert sorted((r.ip, r.score, r.label) for r in look.collect()) == [("2.2.2.2", 30, "SUSPICIOUS"),
                                                                       ("9.9.9.9", 0, "CLEAN")]


def test_snapshot_merge_equals_batch(spark):
    rows = [("2026-01-01 10:00:00", "ssh_brute_force", "HIGH", "1.1.1.1", "single"),
            ("2026-01-01 10:05:00", "homeguard_unknown_device", "HIGH", "1.1.1.1", "single"),
            ("2026-01-02 10:00:00", "web_scanner", "HIGH", "1.1.1.1", "single"),
            ("2026-01-02 10:00:00", "ssh_brute_force", "HIGH", "2.2.2.2", "single")]
    a1, a2, a = alerts(spark, rows[:2]), alerts(spark, rows[2:]), alerts(spark, rows)
    snap = TB.merge_reputation(TB.reputation_delta(a1, RULE_TAGS), TB.reputation_delta(a2, RULE_TAGS))
    got = sorted((r.ip, r.score, r.alert_count, list(r.tags)) for r in TB.snapshot_view(snap).collect())
    exp = sorted((r.ip, r.score, r.alert_count, list(r.tags)) for r in R.reputation_table(a, RULE_TAGS).collect())
    assert got == exp


def test_geo_private_empty_and_ttl(spark):
    geo = spark.createDataFrame(
        [("8.8.8.8", "US", "US", "X", "G", False, datetime(2026, 1, 1)),
         ("8.8.8.8", "US", "US", "Y", "G2", False, datetime(2026, 1, 5)),
         ("1.1.1.1", "AU", "AU", "Z", "C", False, datetime(2026, 1, 1))],
        "ip string, country string, country_code string, city string, org string, is_private boolean, cached_at timestamp")
    latest = G.geo_latest(geo)
    assert {r.ip: r.city for r in latest.collect()} == {"8.8.8.8": "Y", "1.1.1.1": "Z"}
    ips = spark.createDataFrame([("192.168.1.1",), ("8.8.8.8",), ("1.1.1.1",), ("",)], "ip string")
    e = G.geo_enrich(ips, latest, "ip", "2026-01-08 00:00:00")  # 1.1.1.1 cached exactly 7 days ago: stale
    lab = e.select("ip", G.geo_label(F.col("ip"), F.col("is_private"), F.col("country_code"), F.col("city"),
                                     F.col("org")).alias("l"))
    assert dict((r.ip, r.l) for r in lab.collect()) == {
        "192.168.1.1": "[LAN]", "8.8.8.8": "[US / Y / G2]", "1.1.1.1": "[?? / Unknown / Unknown]", "": ""}
    miss = G.geo_misses(ips, latest, "2026-01-08 00:00:00").collect()
    assert [r.ip for r in miss] == ["1.1.1.1"]


def test_outbox_threshold(spark):
    a = alerts(spark, [("2026-01-01 10:00:00", "ssh_brute_force", s, "1.1.1.1", "single")
                       for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW")])
    box = NT.outbox(a, "HIGH", "app", keep_skipped=True).collect()
    assert sorted((r.severity, r.skipped) for r in box) == [("CRITICAL", False), ("HIGH", False), ("LOW", True),
                                                          ("MEDIUM", True)]
    r = [x for x in box if x.severity == "CRITICAL"][0]
    assert r.title == "[CRITICAL] app — Ssh Brute Force" and r.urgency == "critical" and r.icon == "dialog-warning"
    assert r.body == "Rule   : ssh_brute_force\nIP     : 1.1.1.1\nDetail : d0"
    assert NT.sent_count(NT.outbox(a, "BOGUS", "app", keep_skipped=True)).first()[0] == 2  # unknown minimum = HIGH


def test_acks_and_stats(spark):
    a = alerts(spark, [("2026-01-01 10:00:00", "ssh_brute_force", "HIGH", "1.1.1.1", "single"),
                       ("2026-01-01 11:00:00", "web_scanner", "CRITICAL", "2.2.2.2", "single")])
    acks = spark.createDataFrame([(1, datetime(2026, 1, 2)), (1, datetime(2026, 1, 3)), (999, datetime(2026, 1, 3))],
                                 "alert_id bigint, acked_at timestamp")
    flags = {r.alert_id: r.acknowledged for r in SV.with_acks(a, acks).collect()}
    assert flags == {1: True, 2: False}
    assert [r.alert_id for r in SV.alerts_query(a, acks, 10, unacked_only=True).collect()] == [2]
    ev = spark.createDataFrame([(1, "nginx"), (2, "nginx"), (3, "syslog")], "event_id long, source string")
    st = SV.stats(ev, a, acks).first()
    assert (st.total_events, st.total_alerts, st.unacknowledged_alerts, st.active_sources) == (3, 2, 1, 2)
    assert dict(st.events_by_source) == {"nginx": 2, "syslog": 1}
    assert [r.severity for r in SV.severity_breakdown(a).collect()] == ["CRITICAL", "HIGH"]
    assert {r.source: r.pct_of_max for r in SV.source_shares(ev).collect()} == {"nginx": 100, "syslog": 50}


def test_write_batch_is_idempotent(spark, tmpdir_path):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    TB.write_batch(df, f"{tmpdir_path}/t", 0)
    TB.write_batch(df, f"{tmpdir_path}/t", 0)  # re-run of the same batch replaces it
    TB.write_batch(df.limit(1), f"{tmpdir_path}/t", 1)
    assert spark.read.parquet(f"{tmpdir_path}/t").count() == 3


def test_point_lookups(spark):
    a = alerts(spark, [("2026-01-01 10:00:00", "ssh_brute_force", "HIGH", "1.1.1.1", "single")])
    rep = R.reputation_table(a, RULE_TAGS)
    assert [(r.ip, r.score, r.label) for r in R.reputation_of(rep, "1.1.1.1").collect()] == [("1.1.1.1", 15, "CLEAN")]
    assert [(r.ip, r.score, r.label) for r in R.reputation_of(rep, "9.9.9.9").collect()] == [("9.9.9.9", 0, "CLEAN")]
    geo = spark.createDataFrame([("8.8.8.8", "US", "US", "X", "G", False, datetime(2026, 1, 1))],
                                "ip string, country string, country_code string, city string, org string, "
                                "is_private boolean, cached_at timestamp")
    assert G.geo_of(geo, "192.168.0.1").first().country_code == "LAN"
    assert G.geo_of(geo, "8.8.8.8", "2026-01-02 00:00:00").first().city == "X"
