"""The pipeline against a brute-force version of its stages."""

from collections import Counter

import corpus_pipeline
from loglynx.llm import mixing, quality, secretscan

from .helpers import DATA, documents
from .test_decontam_secrets import brute_base, brute_decontam
from .test_mixing_quality_simhash import brute_components, brute_fertility, brute_fingerprint, brute_quality


def survivors(spark):
    rules = quality.Rules()
    model, ranks = quality.vocabularies(rules)
    rows = []
    for r in documents(spark).collect():
        got, base = brute_fertility(r.text, rules, model, ranks), brute_quality(r.text)
        give = [rules.slack / max(1, base["n_words"])] * 2 + [0, 0]
        if got and not base["base_failed"] and all(lo - x <= g <= hi for g, (lo, hi), x in zip(got, rules.bands[r.lang], give)):
            rows.append(r)
    comp = brute_components([r.doc_id for r in rows], [brute_fingerprint(r.text) for r in rows])
    rows = [r for r, c in zip(rows, comp) if r.doc_id == c]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute_decontam([(r.doc_id, r.text) for r in rows], items)}
    out = {}
    for r in rows:
        if r.doc_id not in bad:
            spans = brute_base(r.text)
            text = secretscan.mask(r.text, spans)
            out[r.doc_id] = (text, r.lang, r.source, len(text) if spans else r.n_chars)
    return out


def test_pipeline_against_brute_force(spark):
    want = survivors(spark)
    out = corpus_pipeline.run(spark, DATA)
    assert out.columns == documents(spark).columns + ["copy"]
    rows = out.collect()
    assert rows and all(want[r.doc_id] == (r.text, r.lang, r.source, r.n_chars) for r in rows)
    kept = spark.createDataFrame([(d, *v) for d, v in want.items()], documents(spark).schema)
    plan = {r.doc_id: r.copies for r in mixing.plan_mix(kept).collect()}
    assert Counter(r.doc_id for r in rows) == Counter({d: n for d, n in plan.items() if n})
    assert all(sorted(r.copy for r in rows if r.doc_id == d) == list(range(n)) for d, n in plan.items() if n)


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = documents(spark).limit(0)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "mix_sources"]
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, DATA)
        assert got.columns[:5] == docs.columns and got.count() == 0
