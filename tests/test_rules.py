"""Rule evaluation: thresholds, windows, keys, cross-source, dedup, chains, golden run."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from loglynx.operators import correlate as C
from loglynx.operators import reputation as R
from loglynx.plans.correlation import correlate_point, correlate_replay
from loglynx.sources.catalogue import Catalogue

from .helpers import events_df

DEFAULT = Catalogue.load()
AS_OF = "2026-06-30 22:56:59"


def _fails(ip, n, start="2026-06-30 22:56:01"):
    t0 = datetime.fromisoformat(start)
    return [{"ts": (t0 + timedelta(seconds=i)).isoformat(sep=" "), "source": "auth_log",
             "event_type": "auth_failure", "src_ip": ip, "user": "root"} for i in range(n)]


def _names(df):
    return sorted((r.rule_name, r.group_value) for r in df.collect())


def test_brute_force_fires_at_6_not_3(spark):
    ev = events_df(spark, _fails("203.0.113.9", 6) + _fails("203.0.113.10", 3))
    c = C.point_candidates(ev, DEFAULT, AS_OF)
    assert sorted((r.rule_name, r.key, r.event_count) for r in c.collect()) == [
        ("ssh_brute_force", "203.0.113.9", 6)]


def test_threshold_equality_and_window_edge(spark):
    # exactly T=5 events, the oldest exactly W=60 s before as_of: inclusive on both ends
    t0 = datetime.fromisoformat(AS_OF) - timedelta(seconds=60)
    rows = [{"ts": (t0 + timedelta(seconds=15 * i)).isoformat(sep=" "), "source": "auth_log",
             "event_type": "auth_failure", "src_ip": "198.51.100.1"} for i in range(5)]
    ev = events_df(spark, rows)
    assert _names(C.point_candidates(ev, DEFAULT, AS_OF).withColumnRenamed("key", "group_value")) == [
        ("ssh_brute_force", "198.51.100.1")]
    later = (datetime.fromisoformat(AS_OF) + timedelta(seconds=1)).isoformat(sep=" ")
    assert C.point_candidates(ev, DEFAULT, later).count() == 0  # oldest now 61 s old
    # wrong source does not count; empty and null keys are dropped
    bad = events_df(spark, [dict(r, source="syslog") for r in rows] + [dict(r, src_ip="") for r in rows])
    assert C.point_candidates(bad, DEFAULT, AS_OF).count() == 0


def test_user_grouped_rule(spark):
    rows = [{"ts": f"2026-06-30 22:56:{s}", "source": "auth_log", "event_type": "sudo_command", "user": "k"}
            for s in ("30", "40", "50")]
    c = C.point_candidates(events_df(spark, rows), DEFAULT, AS_OF)
    assert [(r.rule_name, r.key, r.group_by, r.event_count) for r in c.collect()] == [("repeated_sudo", "k", "user", 3)]


def test_cross_source_needs_every_condition(spark):
    both = [{"ts": "2026-06-30 22:55:50", "source": "homeguard", "event_type": "unknown_device", "src_ip": "X"},
            {"ts": "2026-06-30 22:56:00", "source": "netwatch", "event_type": "port_scan", "src_ip": "X"},
            {"ts": "2026-06-30 22:56:00", "source": "netwatch", "event_type": "port_scan", "src_ip": "Y"}]
    c = C.point_candidates(events_df(spark, both), DEFAULT, AS_OF).filter(F.col("n_conds") > 1)
    assert [(r.key, r.event_count) for r in c.collect()] == [("X", 2)]


def test_dedup_against_history(spark):
    ev = events_df(spark, _fails("203.0.113.9", 6))
    run1 = correlate_point(ev, DEFAULT, AS_OF, with_chains=False)
    assert _names(run1) == [("ssh_brute_force", "203.0.113.9")]
    run2 = correlate_point(ev, DEFAULT, AS_OF, history=run1, with_chains=False)
    assert run2.count() == 0
    # an alert older than the window does not suppress
    old = run1.withColumn("created_at", F.col("created_at") - F.expr("INTERVAL 61 SECONDS"))
    assert correlate_point(ev, DEFAULT, AS_OF, history=old, with_chains=False).count() == 1


def test_top_event_ids_newest_first(spark):
    ev = events_df(spark, _fails("203.0.113.9", 60))
    m = C.in_window(C.match_events(ev, DEFAULT), AS_OF)
    ids = {(r.rule_idx, r.key): r.event_ids for r in C.top_event_ids(m, 50).collect()}
    brute = ids[(0, "203.0.113.9")]
    assert len(brute) == 50 and brute[0] == 59 - 0 and brute == sorted(brute, reverse=True)


def test_golden_run(spark):
    """Hand-derived example: one private address doing recon + brute force, one sudo user."""
    x = "192.168.1.77"
    rows = ([{"ts": "2026-06-30 22:55:50", "source": "homeguard", "event_type": "unknown_device", "src_ip": x},
             {"ts": "2026-06-30 22:56:00", "source": "netwatch", "event_type": "port_scan", "src_ip": x}]
            + _fails(x, 6)
            + [{"ts": f"2026-06-30 22:56:{s}", "source": "auth_log", "event_type": "sudo_command", "user": "k"}
               for s in ("30", "40", "50")])
    ev = events_df(spark, rows)
    a = correlate_point(ev, DEFAULT, AS_OF).cache()
    got = sorted((r.rule_name, r.group_value, r.event_count, r.severity, r.kind) for r in a.collect())
    assert got == sorted([
        ("ssh_brute_force", x, 6, "HIGH", "single"),
        ("repeated_sudo", "k", 3, "MEDIUM", "single"),
        ("netwatch_port_scan", x, 1, "HIGH", "single"),
        ("homeguard_unknown_device", x, 1, "HIGH", "single"),
        ("unknown_device_then_portscan", x, 2, "CRITICAL", "cross_source"),
        ("chain_ssh_brute_force_then_netwatch_port_scan", x, None, "CRITICAL", "chain"),
        ("chain_homeguard_unknown_device_then_ssh_brute_force", x, None, "CRITICAL", "chain"),
    ])
    prior = {r.rule_name: r.prior_score for r in a.filter(F.col("kind") != "chain").collect()}
    assert prior == {"ssh_brute_force": 0, "netwatch_port_scan": 15, "homeguard_unknown_device": 30,
                     "unknown_device_then_portscan": 45, "repeated_sudo": 0}
    d = {r.rule_name: r.description for r in a.collect()}
    assert d["ssh_brute_force"].endswith(f"[src_ip={x}, count=6]")  # private: no geo text, score 0: no rep text
    assert d["homeguard_unknown_device"].endswith("[rep:30/SUSPICIOUS]")
    assert d["unknown_device_then_portscan"].startswith("[CROSS-SOURCE] ")
    assert d["chain_ssh_brute_force_then_netwatch_port_scan"].startswith("[CHAIN] ")
    rep = R.reputation_table(a, DEFAULT.tags).collect()
    assert [(r.ip, r.score, r.label, r.alert_count, list(r.tags)) for r in rep] == [
        (x, 70, "MALICIOUS", 4, ["brute_force", "port_scan", "unknown_device", "recon"])]
    again = correlate_point(ev, DEFAULT, AS_OF, history=a)
    assert again.count() == 0


def test_chain_needs_trigger_and_then(spark):
    x = "203.0.113.50"
    only_scan = [{"ts": "2026-06-30 22:56:00", "source": "netwatch", "event_type": "port_scan", "src_ip": x}]
    a = correlate_point(events_df(spark, only_scan), DEFAULT, AS_OF)
    assert [r.kind for r in a.collect()] == ["single"]  # no trigger -> no chain
    # then-alert from history within the chain window
    ev = events_df(spark, _fails(x, 6))
    hist = correlate_point(events_df(spark, only_scan), DEFAULT, "2026-06-30 22:56:10", with_chains=False)
    a2 = correlate_point(ev, DEFAULT, AS_OF, history=hist)
    assert "chain_ssh_brute_force_then_netwatch_port_scan" in {r.rule_name for r in a2.collect()}
    # history outside the 600 s window: no chain
    hist_old = hist.withColumn("created_at", F.col("created_at") - F.expr("INTERVAL 1 HOUR"))
    a3 = correlate_point(ev, DEFAULT, AS_OF, history=hist_old)
    assert {r.kind for r in a3.collect()} == {"single"}
    # chain dedup: a chain alert for the address inside the window suppresses a new one
    a4 = correlate_point(ev, DEFAULT, AS_OF, history=hist.unionByName(
        a2.filter(F.col("kind") == "chain").withColumn("created_at", F.col("created_at") - F.expr("INTERVAL 5 MINUTES"))))
    assert {r.kind for r in a4.collect()} == {"single"}


def _brute_replay(events, w, t):
    """Reference semantics by brute force: evaluate at every event second, suppress for W."""
    out = {}
    by_key = {}
    for k, s in events:
        by_key.setdefault(k, []).append(s)
    for k, secs in by_key.items():
        secs.sort()
        last = None
        for s in sorted(set(secs)):
            n = sum(1 for x in secs if s - w <= x <= s)
            if n >= t and (last is None or s > last + w):
                last = s
                out[(k, s)] = n
    return out


def test_replay_matches_brute_force_with_hot_key(spark):
    rnd = random.Random(7)
    base = int(datetime(2026, 6, 30, tzinfo=timezone.utc).timestamp())
    evs = []
    for _ in range(3000):  # one hot key holds most rows
        evs.append(("hot", base + rnd.randint(0, 20000)))
    for k in range(40):
        for _ in range(rnd.randint(1, 30)):
            evs.append((f"k{k}", base + rnd.randint(0, 20000)))
    rows = [{"ts": datetime.fromtimestamp(s, timezone.utc).replace(tzinfo=None).isoformat(sep=" "),
             "source": "auth_log", "event_type": "auth_failure", "src_ip": k} for k, s in evs]
    cat = Catalogue.from_dict({"rules": [{"name": "r", "description": "d", "severity": "HIGH", "window_secs": 120,
                                          "threshold": 4, "conditions": [{"event_type": "auth_failure"}]}]})
    ev = events_df(spark, rows)
    got = {(r.key, r.sec): r.window_count for r in C.replay_fired(ev, cat).collect()}
    exp = _brute_replay(evs, 120, 4)
    assert got == exp and len(got) > 20


def test_replay_alert_table_has_chains_and_ids(spark):
    x = "203.0.113.70"
    rows = ([{"ts": "2026-06-30 22:56:00", "source": "netwatch", "event_type": "port_scan", "src_ip": x}]
            + _fails(x, 6))
    a = correlate_replay(events_df(spark, rows), DEFAULT).collect()
    kinds = sorted((r.rule_name, r.kind) for r in a)
    assert ("chain_ssh_brute_force_then_netwatch_port_scan", "chain") in kinds
    brute = [r for r in a if r.rule_name == "ssh_brute_force"][0]
    assert brute.event_count == 5 and list(brute.event_ids) == [6, 5, 4, 3, 2]


def test_syslog_rules_keyed_by_host(spark):
    from loglynx.sources import logs as L
    from .helpers import lines_df
    lines = ["Jun 30 22:56:10 web1 systemd[1]: Failed to start Cache Server.",
             "Jun 30 22:56:20 db1 kernel: [9.1] Out of memory: Kill process 321 (java) score 900"]
    ev = L.parse_syslog(lines_df(spark, lines), L.ParseOptions(default_year=2026))
    a = correlate_point(ev, DEFAULT, AS_OF)
    got = sorted((r.rule_name, r.group_by, r.group_value, r.severity) for r in a.collect())
    assert got == [("syslog_service_failure", "host", "web1", "HIGH"),
                   ("syslog_system_critical", "host", "db1", "CRITICAL")]
