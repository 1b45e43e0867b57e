"""Driver contract and test-bed sanity."""

import os
import subprocess
import sys

import __spark_entry__ as entry
from loglynx.plans.registry import QUERIES


def test_contract_keys():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 50
    assert set(sql) <= set(qs)
    for name in QUERIES:  # the names opN_ belong to the optional operators
        assert not name.startswith("op"), name


def test_entry_works_without_the_optional_package():
    """The library neither needs nor imports the optional operators and their pipeline."""
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'loglynx.llm'):\n"
            "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert len(e.queries()) >= 50 and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
            "assert set(e.oracle_sql()) <= set(e.queries())\n"
            "assert not any(m.startswith('loglynx.llm') for m in sys.modules)\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["rule_name", "kind", "severity", "group_value", "created_at", "event_count",
                          "ip_score", "ip_label"]
    assert df.count() > 0


def test_sample_queries_sf0001(spark):
    qs = entry.queries()
    for n in ("rule_point_all_rules", "parse_syslog", "geo_enrich", "stats_summary"):
        assert qs[n](spark, "/root/testdata/sf0.001").count() > 0
