"""op12: whitening against numpy over all distinct vectors at once; weights, exact deviations, edge rows."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from topiclake.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, x string, white int, component int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1, 2) for i, v in rows], SCHEMA)


def plain(rows, weight="one", most=16):
    """Per row id: n, deviation, whitened values, explained."""
    xs = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows]
    count = Counter(x for _, x in xs)
    fit = [x for x in count for _ in range(count[x] if weight == "count" else 1)]
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    m = np.array([[float(a - b // n) - (b % n) / n for a, b in zip(x, s)] for x in fit])
    values, vectors = np.linalg.eigh(m.T @ m / n)
    keep = [i for i in np.argsort(values)[::-1][:most] if values[i] > 1e-12 * values.max()]
    out = []
    for i, x in xs:
        centred = np.array([float(a - b // n) - (b % n) / n for a, b in zip(x, s)])
        out.append((i, n, sum((n * a - b) ** 2 for a, b in zip(x, s)), centred @ vectors[:, keep] / np.sqrt(values[keep])))
    return out, values[keep] / values.sum()


@pytest.mark.parametrize("weight", ["one", "count"])
def test_against_numpy(spark, weight):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(200, 20)) * np.linspace(0.1, 2, 20)
    rows = [(int(i), [float(c) for c in base[i % 150 if i < 250 else 7]]) for i in range(400)] + [(None, [float(c) for c in base[3]])]
    want, explained = plain(rows, weight)
    got = W.whitened(table(spark, rows), weight=weight)
    assert got.columns[:-1] == ["vec_id", "embedding", "x", "white", "component"]
    got = sorted(((r[0], r[-1]) for r in got.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert len(got) == len(want)
    signs = np.sign(np.array([g[1]["values"] for g in got][0]) * want[0][3])
    for (i, g), (j, n, dev, values) in zip(got, want):
        assert (i, g["n"], g["deviation"]) == (j, n, dev)
        assert np.allclose(g["values"], values * signs, atol=1e-8) and np.allclose(g["explained"], explained, rtol=1e-9)
        assert g["identity_error"] < 1e-9


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.1, 0.2]), (2, [0.5, -0.5]), (3, [-0.3, 0.9]), (3, [-0.3, 0.9])]
    bad = [(4, None), (5, []), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1e30, 1.0]), (10, [1.0, 2.0, 3.0])]
    out = W.digest(table(spark, good + bad)).collect()
    want, explained = plain(good)
    assert Counter(r.vec_id for r in out) == {1: 2, 2: 2, 3: 4}
    assert {(r.vec_id, r.n, r.deviation) for r in out} == {(i, n, d) for i, n, d, _ in want}
    assert {r.component for r in out} == {1, 2} and all(r.identity_error < 1e-9 for r in out)
    assert W.digest(table(spark, bad[:-1])).count() == 0 and W.digest(table(spark, good).limit(0)).count() == 0
    assert W.digest(table(spark, [(1, [0.5, 0.5])] * 3)).count() == 0  # no variance, no component
    assert [c for c in W.digest(table(spark, good)).columns] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_is_exact():
    x = np.array([[1_000_000, 1_000_032], [1 << 52, 5]], np.int64)
    n, s = 1_000_003, [1_000_000 * 1_000_003 + 17, 999_999 * 1_000_003 - 5]
    want = [sum((n * int(a) - b) ** 2 for a, b in zip(r, s)) for r in x]
    assert W._deviation(x, n, s) == [want[0], None] and want[1] >= 1 << 63
    assert W._deviation(x[:1], n, s) == want[:1]


def test_large_offsets_keep_precision(spark):
    """Entries far from zero with a small spread: centred before the product."""
    rows = [(i, [4000.0 + (i * 37 % 101) / 64, -3000.0 + (i * 53 % 97) / 64]) for i in range(300)]
    out = W.digest(table(spark, rows)).collect()
    assert max(r.identity_error for r in out) < 1e-9 and len(out) == 600
