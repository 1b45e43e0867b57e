"""The replay's look-back sums: exact, and linear in a hot key's rows."""

import random
import re

from loglynx.operators import correlate as C

SCHEMA = "rule_idx int, n_conds int, window_secs long, threshold int, key string, sec long, c0 long, c1 long"


def _per_sec(spark, seed=3):
    rng = random.Random(seed)
    rows = []
    for rule, w in ((0, 0), (1, 1), (2, 7), (3, 60), (4, 1000)):
        for key in ("a", "b"):
            rows += [(rule, 2, w, 1, key, s, rng.randrange(4), rng.randrange(2)) for s in sorted(rng.sample(range(-300, 900), 150))]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_lookback_sums_equal_brute_force(spark):
    rows, df = _per_sec(spark)
    got = sorted((r.rule_idx, r.key, r.sec, r.w_c0, r.w_c1) for r in C.bucketed_lookback(df, ["c0", "c1"]).collect())
    want = []
    for rule, _, w, _, key, sec, _, _ in rows:
        inside = [r for r in rows if r[0] == rule and r[4] == key and sec - max(w, 1) <= r[5] <= sec]
        want.append((rule, key, sec, sum(r[6] for r in inside), sum(r[7] for r in inside)))
    assert got == sorted(want)


def test_lookback_has_no_frame_that_slides(spark):
    """A frame with two moving ends is summed anew for each row: the square of a hot key's rows in a window."""
    _, df = _per_sec(spark)
    plan = C.bucketed_lookback(df, ["c0", "c1"])._jdf.queryExecution().executedPlan().toString()
    frames = re.findall(r"specifiedwindowframe\(\w+, ([^,]+),", plan)
    assert frames and all(f == "unboundedpreceding$()" for f in frames), frames
