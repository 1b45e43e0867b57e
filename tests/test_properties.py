"""Property: replay candidates = point-mode evaluation at every event second."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loglynx.operators import correlate as C
from loglynx.sources.catalogue import Catalogue

from .helpers import events_df

CAT = Catalogue.from_dict({"rules": [
    {"name": "r", "description": "d", "severity": "HIGH", "window_secs": 30, "threshold": 3,
     "conditions": [{"event_type": "auth_failure", "source": "auth_log"}]},
    {"name": "x", "description": "d", "severity": "CRITICAL", "window_secs": 45,
     "conditions": [{"event_type": "unknown_device", "source": "homeguard"},
                    {"event_type": "port_scan", "source": "netwatch"}]}]})
KINDS = [("auth_log", "auth_failure"), ("homeguard", "unknown_device"), ("netwatch", "port_scan")]
T0 = datetime(2026, 6, 30, 12, 0, 0)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 120), st.sampled_from(["a", "b"])),
                min_size=1, max_size=40))
def test_replay_equals_point_at_each_second(spark, rows):
    evs = [{"ts": (T0 + timedelta(seconds=s)).isoformat(sep=" "), "source": KINDS[k][0],
            "event_type": KINDS[k][1], "src_ip": ip} for k, s, ip in rows]
    ev = events_df(spark, evs)
    replay = {(r.rule_idx, r.key, r.sec) for r in C.replay_candidates(ev, CAT).collect()}
    epoch = int(T0.replace(tzinfo=None).timestamp())
    m = C.match_events(ev, CAT).select("rule_idx", "key", "ts").distinct().collect()
    expect = set()
    for t in sorted({r.ts for r in m}):
        fired = {(r.rule_idx, r.key) for r in C.point_candidates(ev, CAT, t.isoformat(sep=" ")).collect()}
        for r in m:
            if r.ts == t and (r.rule_idx, r.key) in fired:
                expect.add((r.rule_idx, r.key, int(r.ts.timestamp())))
    assert replay == expect, (replay ^ expect, epoch)
