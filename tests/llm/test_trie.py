"""op11: the trie against a plain dictionary of prefixes; blocks, a full sketch, empty tables, rebuilt openings."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from topiclake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, x int, n double"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 0.5) for r in rows], SCHEMA)


def plain(seqs: dict[int, list[tuple[str, str]]]) -> Counter:
    """Every node of the trie of whole sequences."""
    members, children = defaultdict(list), defaultdict(set)
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            members[tuple(seqs[c][:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    out = Counter()
    for p, ids in members.items():
        under = [q for q in members if q[: len(p)] == p]
        last = [c for c in ids if len(seqs[c]) == len(p)]
        out[(ids[0], len(p), members[p[:-1]][0] if p else None, len(ids), len(children[p]), sum(not children[q] for q in under),
             sum((len(members[q]) - 1) * len(q[-1][1]) for q in under if q), hashlib.sha256(",".join(map(str, last)).encode()).hexdigest())] += 1
    return out


def nodes(df) -> Counter:
    return Counter(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()))


def rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    own = defaultdict(list)
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((r or "", x or ""))
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - c % 100, [])[: h[c]] + own[c][h[c]:] for c in own}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for c in [*range(0, 60), *range(100, 160), *range(205, 260)]:  # 200 has no turns
        for t in range(rng.randrange(9)):
            out.append((c, t if rng.random() > 0.05 or t else None, rng.choice(["user", "", None, "aß"]), rng.choice(["hi", "hi", "é😀", "", None, f"t{rng.randrange(4)}"])))
    out += [(None, 0, "user", "of nobody"), (7_000_000_000, 3, "user", "x" * 300_000), (7_000_000_001, 0, None, None)]
    rng.shuffle(out)
    return out


def test_against_plain(spark, rows):
    df = conversations(spark, rows)
    want = plain(rebuilt(rows))
    assert nodes(trie.digest(df)) == want
    turns = trie.rebuilt(trie.numbered(df))
    assert nodes(trie.trie(turns, most=1024)) == want


def test_full_sketch_and_blocks(spark, monkeypatch, rows):
    """A sketch of eight counters proves nothing, blocks of two turns carry over: same nodes."""
    monkeypatch.setattr(trie, "counters", lambda n, most: 8)
    monkeypatch.setattr(trie.prefixes, "__defaults__", (2,))
    assert nodes(trie.digest(conversations(spark, rows))) == plain(rebuilt(rows))


def test_copies_ties_long(spark):
    """Many copies of one conversation (ids over several runs), a long one, repeated turns."""
    rows = [(c, t, "user", f"q{t}") for c in range(1, 1400) for t in range(3)]
    rows += [(2000 + c, t, "user", f"long {t}") for c in range(2) for t in range(130)] + [(3000, 0, "user", x) for x in "aabb"]
    df = conversations(spark, rows)
    turns = trie.numbered(df).withColumns({"from_conv": F.col("conv"), "from_pos": F.col("pos"), "len": F.count("*").over(trie.Window.partitionBy("conv"))})
    seqs = defaultdict(list)
    for c, t, r, x in rows[:-4]:
        seqs[c].append((r, x))
    order = trie.with_turns(trie.trie(turns).where("conv_id = 3000"), df).orderBy("depth").collect()
    seqs[3000] = [(r.role, r.text) for r in order if r.depth]
    assert Counter(seqs[3000]) == Counter({("user", "a"): 2, ("user", "b"): 2})
    assert nodes(trie.trie(turns)) == plain(seqs)
    assert nodes(trie.digest(df)) == plain(rebuilt(rows[:-4]) | {3000: seqs[3000]})  # its own base


def test_texts_of_nodes(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (2, 1, None, None)]
    df = conversations(spark, rows)
    turns = trie.numbered(df).withColumns({"from_conv": F.col("conv"), "from_pos": F.col("pos"), "len": F.lit(2).cast("long")})
    got = {(r.conv_id, r.depth): (r.role, r.text) for r in trie.with_turns(trie.trie(turns), df).collect()}
    assert got == {(1, 0): (None, None), (1, 1): ("user", "a"), (1, 2): ("bot", "b"), (2, 2): ("", "")}


def test_sketch_never_counts_too_little(spark):
    n = 3000
    df = spark.range(n).selectExpr("xxhash64(id % 2000) AS x", "xxhash64(id % 2000, 1) AS y", "1 AS depth", "0L AS px", "0L AS py").repartition(5)
    for width in (64, 4096, 1 << 20):
        bits = np.unpackbits(trie.sketch(df, width), axis=1).astype(bool)
        for r in df.groupBy("x", "y").count().collect():
            at = trie._places(np.array([r.x]), np.array([r.y]), width)
            assert all(bits[i, a[0]] for i, a in enumerate(at)) or r["count"] == 1
    assert trie.counters(0) == 1024 and trie.counters(1 << 40) == trie.MOST_COUNTERS


def test_empty(spark):
    assert trie.digest(conversations(spark, [(None, 1, "a", "b")]).limit(0)).count() == 0
    assert trie.digest(conversations(spark, [(None, 1, "a", "b")])).count() == 0
