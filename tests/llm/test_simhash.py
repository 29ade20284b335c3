"""op9 against all pairs; shards and grids of any size find the same components."""

from __future__ import annotations

import random

import numpy as np
import pytest

from topiclake.llm import simhash
from topiclake.llm.graph import components


def test_equals_brute_force(spark, docs_of):
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 120))) for _ in range(40)]
    near = [t.replace(" ", "\t", 1) + " tail" for t in base[:15]]
    docs = [*base, *near, *base[:5], None, "", " \n ", "One", "ONE", "é É", "a b", "word " * 5000]
    want = simhash.brute_force(docs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.digest(docs_of(list(enumerate(docs)))).collect()}
    assert [got[i] for i in range(len(docs))] == [(f"{p:016x}", first) for p, first in want]


def test_long_text_in_blocks():
    text = b" ".join(b"w%d" % (i * i % 977) for i in range(5000))
    assert simhash.fingerprint(text) == simhash.fingerprint(text, block=37) == simhash.fingerprint(text, block=1)


@pytest.mark.parametrize("leaf,part", [(2000, 20_000), (30, 40), (1, 3)])
def test_any_depth_and_grid(spark, leaf, part):
    rng = np.random.default_rng(8)
    centres = rng.integers(0, 2**63, 60, dtype=np.uint64)
    points = {int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres for a, b in rng.integers(0, 63, (6, 2))}
    signed = sorted(points)
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {r.node: r.root for r in components(simhash.links(df, 2, leaf, part)).collect()}
    label = {p: p for p in signed}
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if (a ^ b).bit_count() <= 2]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            changed |= {label[a], label[b]} != {low}
            label[a] = label[b] = low
    assert got == {p: r for p, r in label.items() if any(p in x for x in near)}


def near_pairs(points):
    return {(a, b) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= 2}


def clouds(seed, centres=12, each=40, far=300):
    """Near copies around centres, and points of their own."""
    rng = np.random.default_rng(seed)
    c = rng.integers(0, 2**63, centres, dtype=np.uint64)
    near = [int(x) ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(e)) for x in c for a, b, e in rng.integers(0, 64, (each, 3))]
    return np.array(sorted({*near, *map(int, rng.integers(0, 2**64, far, dtype=np.uint64)), 0, 2**64 - 1}), np.uint64)


@pytest.mark.parametrize("leaves", [1, 2, 9, 64, 400])
def test_tree_covers_each_near_pair_once(leaves):
    x = clouds(2)
    tree = simhash.Tree(x[::3], leaves)
    assert tree.leaves <= leaves + 1
    at, cell, guest = tree.visits(x, 2)
    home = dict(zip(at[~guest].tolist(), cell[~guest].tolist()))
    assert sorted(home) == list(range(len(x))) and len(at[~guest]) == len(x)
    visits = set(zip(at[guest].tolist(), cell[guest].tolist()))
    assert len(visits) == guest.sum() and all(home[i] != c for i, c in visits)
    place = {int(v): i for i, v in enumerate(x)}
    for a, b in near_pairs([int(v) for v in x]):
        i, j = place[a], place[b]
        assert home[i] == home[j] or ((i, home[j]) in visits) != ((j, home[i]) in visits)


@pytest.mark.parametrize("pairs", [1, 50, 1 << 19])
def test_links_of_a_task(monkeypatch, pairs):
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    x = clouds(7)
    u, v = x[::2], x[1::2]
    want = near_pairs([int(p) for p in x])

    def sets(found):
        found.shrink()
        return {int(m): int(r) for m, r in zip(*simhash.stars(found.a[0], found.b[0]))}

    def of(links):
        a, b = (np.array([p[i] for p in links], np.uint64) for i in (0, 1))
        return {int(m): int(r) for m, r in zip(*simhash.stars(a, b))}

    whole = simhash.Links(2)
    whole.within(x)
    assert sets(whole) == of(sorted(want))
    both = simhash.Links(2)
    both.between(u, v)
    both.within(u)
    both.within(v)
    assert sets(both) == of(sorted(want))
    if pairs == 50:
        assert whole.compared < len(x) ** 2 / 2  # fewer than all pairs


def test_chain_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_one_document_of_each_group_stays(spark, docs_of):
    rows = [(3, "same text here"), (1, "same text here"), (None, "same text here"), (2, "other words now"), (2, "other words now"), (None, None), (None, "")]
    df = docs_of(rows)
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, ""), (1, "same text here"), (2, "other words now")]
    assert simhash.deduplicated(docs_of([])).count() == 0
    assert simhash.digest(docs_of([])).count() == 0
