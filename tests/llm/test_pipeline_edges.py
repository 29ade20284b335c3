"""Every pipeline stage: null, empty and long texts, repeated rows, empty tables, columns with clashing names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
CLASHES = ["score", "of", "removed_lines", "row", "root", "fp", "hits", "ids", "n_tokens", "tokens", "decoded", "language", "gone", "flags", "first"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None), (2, ""), (None, "text of no id with a few words"), (3, "again and again some words here"), (3, "again and again some words here"), (4, "word " * 200_000), (5, "\n\n\n"), (6, "x" * 100_000)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.mark.parametrize("k", range(5))
def test_stage(spark, odd, k):
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, odd, SF)
    rows = out.collect()
    assert len(rows) <= 8
    if k < 4:
        assert out.columns == odd.columns
        whole = {(r.doc_id, r.text) for r in odd.collect()}
        assert all((r.doc_id, r.text) in whole for r in rows) or name == "line dedup"
        assert all(r[c] == c for r in rows for c in CLASHES)
    else:
        assert [c for c in odd.columns if c != "text"] == out.columns[: len(odd.columns) - 1] and len(rows) == 8
    assert stage(spark, odd.limit(0), SF).count() == 0


def test_near_dedup_keeps_one_of_each_group(spark, odd):
    rows = corpus_pipeline.near_dedup(spark, odd, SF).collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 3, 4, 6]  # null, empty and blank texts are one group
