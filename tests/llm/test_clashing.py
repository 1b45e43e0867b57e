"""Pipeline stages on tables whose extra columns have the names that the stages use themselves."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import DATA, odd_documents

NAMES = ["m_doc", "m_copies", "m_source", "m_tie", "d_row", "d_doc", "d_tie", "n_copies", "copy", "bad_hash", "text_hash", "c_again", "c_fp", "c_key",
         "simhash_fp", "simhash_of", "simhash_key", "root", "component_id", "n_rows", "first_id", "tie", "rate_units", "spans", "kept", "bucket", "source_size"]


@pytest.mark.parametrize("stage", range(5))
def test_stage_with_clashing_columns(spark, stage):
    docs = odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    clashing = docs.select("*", *[F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in NAMES])
    name, run = corpus_pipeline.STAGES[stage]
    plain, got = run(spark, docs, DATA), run(spark, clashing, DATA)
    assert len(set(got.columns)) == len(got.columns)
    want = [*clashing.columns] if name != "mix_sources" else [*[c for c in clashing.columns if c != "copy"], "copy"]
    assert got.columns == want
    key = lambda df: sorted(map(repr, df.select(*plain.columns).collect()))
    assert key(got) == key(plain)
    for r in got.select("doc_id", "m_doc", "bad_hash", "c_again", "bucket").collect():
        assert r.m_doc == f"m_doc of {'none' if r.doc_id is None else r.doc_id}" and r.bucket.startswith("bucket of") and r.c_again and r.bad_hash
