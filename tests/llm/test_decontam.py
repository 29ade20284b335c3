"""op3 against the contract word by word; blocks of the benchmark give what one block gives."""

from __future__ import annotations

import random

import pytest

from topiclake.llm import decontam

WORDS = ["the", "a", "Red", "fox", "jumps", "é", "42", "日本", "x1", "dog"]


def texts(rng, n, most):
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, docs_of, seed):
    rng = random.Random(seed)
    items = [(i, t) for i, t in enumerate(texts(rng, 6, 40))] + [(90, None), (91, ""), (92, "The fox"), (92, "the FOX"), (None, "dog-dog.dog")]
    long = [t for _, t in items if t]
    docs = [*texts(rng, 25, 60), None, "", "...", *(f"{rng.choice(WORDS)}, {rng.choice(long)}\n{rng.choice(WORDS)} y z" for _ in range(25)), "q " * 3000 + long[0] + " r" * 3000]
    docs += docs[:3]
    want = decontam.brute_force(docs, items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in decontam.digest(docs_of(list(enumerate(docs))), bench).collect()}
    assert [got[i] for i in range(len(docs))] == want
    blocks = decontam.decontaminate(docs_of(list(enumerate(docs))), bench, block_words=30)
    assert blocks.columns[-1] == "_hits" and "hits" in blocks.columns
    got = {r.doc_id: (r._hits.n_words, r._hits.n_hit, len(r._hits.item_ids), sorted(r._hits.item_ids)) for r in blocks.collect()}
    assert [got[i][:3] for i in range(len(docs))] == [w[:3] for w in want]


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = decontam.digest(docs_of([(1, "a b"), (None, None)]), bench).collect()
    assert sorted((r.n_words, r.n_hit, r.contaminated) for r in rows) == [(0, 0, False), (2, 0, False)]
    assert decontam.digest(docs_of([]), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0


def test_windows_of_thirteen_words_are_always_found():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(50):
        shared = rng.integers(0, 5, 13).astype(np.uint64)
        a = np.concatenate([rng.integers(0, 5, 20), shared, rng.integers(0, 5, 9)]).astype(np.uint64)
        low = decontam.winnowed(a, 13, 5)
        assert decontam.winnowed(shared, 13, 5)[0] == low[20]
