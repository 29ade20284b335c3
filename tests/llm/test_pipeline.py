"""Each stage against what its operator says of the stage's own input; the rows that stay keep their columns."""

from __future__ import annotations

import pytest

import corpus_pipeline
from topiclake.llm import bpe, decontam, linedup, quality, simhash
from topiclake.llm.common import held
from topiclake.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name.replace(" ", "-")) / "t")
        stage(spark, docs, SF).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_columns(spark, inputs):
    want = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [a.columns for _, a, _ in inputs] == [want] * 5
    assert [name for name, _, _ in inputs] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "BPE encoding"]


def test_quality(spark, inputs):
    _, before, after = inputs[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.scored(before, quality.fit(before, labels.where(~held("doc_id", 3, 1))))
    assert sorted(r.doc_id for r in scored.where("score >= 0.5").collect()) == sorted(r.doc_id for r in after.collect())
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    kept = {r.doc_id for r in after.collect()}
    assert len(bad & kept) <= 0.2 * len(bad)


def test_lines(inputs):
    from test_linedup import brute

    _, before, after = inputs[1]
    want = brute([(r.doc_id, r.text, None, r.source) for r in before.collect()], linedup.SITES)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in after.collect()) == sorted((i, t, len(t)) for i, t, _ in want)


def test_near_duplicates(inputs):
    _, before, after = inputs[2]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    first = {rows[i].doc_id for i, (_, low) in enumerate(simhash.brute_force([r.text for r in rows])) if i == low}
    assert {r.doc_id for r in after.collect()} == first


def test_contamination(spark, inputs):
    _, before, after = inputs[3]
    rows = before.collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {r.doc_id for r, x in zip(rows, decontam.brute_force([r.text for r in rows], items), strict=True) if x[4]}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in rows} - bad


def test_tokens(inputs):
    _, before, after = inputs[4]
    own = bpe.Bpe(bpe.load(vocabulary()))
    assert {r.doc_id: (r.ids, r.n_tokens) for r in after.collect()} == {r.doc_id: (e := own.encode(r.text), len(e)) for r in before.collect()}


def test_decoded_tokens(inputs):
    _, before, after = inputs[4]
    own = bpe.Bpe(bpe.load(vocabulary()))
    assert {r.doc_id: r.decoded for r in after.collect()} == {r.doc_id: own.decode(own.encode(r.text)) for r in before.collect()}


def test_run(spark, inputs):
    assert corpus_pipeline.run(spark, SF).count() == inputs[-1][2].count()
