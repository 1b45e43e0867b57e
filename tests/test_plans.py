"""Physical-plan properties that matter at scale."""

from loglynx.operators import correlate as C
from loglynx.plans.alert_queries import replay_alert_table
from loglynx.session import work_dir
from loglynx.sinks import tables as TB
from loglynx.sources import testbed as tb
from loglynx.sources.catalogue import Catalogue

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_events_pruned_and_pushed(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # untruncated scan metadata
    path = work_dir(spark, "t-plan-events")
    TB.append_events(tb.event_view(spark, SF), path)
    stored = TB.read_events(spark, path)
    cat = tb.catalogue()
    p = plan(C.point_candidates(stored, cat, tb.AS_OF))
    assert "PartitionFilters: [isnotnull(event_date" in p or "event_date" in p.split("PartitionFilters")[1][:200]
    pushed = p.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "In(event_type" in pushed
    assert "BroadcastHashJoin" in p  # catalogue broadcast
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_top_ids_limited_before_shuffle(spark):
    ev = tb.event_view(spark, SF)
    m = C.in_window(C.match_events(ev, tb.catalogue()), tb.AS_OF)
    assert "WindowGroupLimit" in plan(C.top_event_ids(m, 50))


def test_replay_plan_has_no_row_udf_or_cross_product(spark):
    p = plan(replay_alert_table(spark, SF, with_chains=True, with_event_ids=True))
    for bad in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, bad


def test_catalogue_defaults_and_enabled():
    cat = Catalogue.from_yaml("""
rules:
  - {name: a, description: x, severity: HIGH, conditions: [{event_type: port_scan}]}
  - {name: b, description: y, severity: LOW, enabled: false, conditions: [{event_type: port_scan}]}
  - {name: c, description: z, severity: LOW, conditions: []}
chains:
  - {trigger: a, then: c}
""")
    rows = cat.condition_rows()
    assert [(r[1], r[4], r[5], r[10]) for r in rows] == [("a", 300, 1, "src_ip")]
    assert cat.chain_rows() == [(0, "chain_a_then_c", "a", "c", "HIGH", 600, "Chain: a → c")]
