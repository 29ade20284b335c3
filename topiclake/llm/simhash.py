"""SimHash near-dedup: exact pairs of fingerprints within a few bits, found with a sharded vantage-point tree.

The tree is chosen from the data: a sample of the distinct fingerprints (those of least hash, at most ``SAMPLE``) is split again
and again by the distance from a vantage point, one of themselves, at its median.  The vantage point is that of a few
candidates whose distances spread most.  A leaf of the tree is a shard.  Every distinct fingerprint lives in the one shard that its distances lead
to, and visits the others that its ball of radius r overlaps: by the triangle bound, two fingerprints within r bits lie at most r
apart in their distance from any vantage point, so a child whose side of the median is further away than r is pruned.
Of the two directions of a pair only one is visited: where two paths part for the first time, the outer one visits the inner side.  Depth
grows with the number of fingerprints; a shard too large for a task is cut into a grid of home parts and visitor parts.

Within a task the same is done on: the fingerprints at home are split by one of them, visitors follow where the bound lets them, until few
enough are left to compare them all with xor and popcount.  What lies within r of a vantage point links to it, so
such fingerprints (a group of near copies) are not compared with each other.  What leaves the task is a spanning star of each linked
set, so no link between sets is lost and no group is written as all its pairs.

Edge cases: a null or empty text has fingerprint zero, and zero links like any
other.  Equal texts share a fingerprint, hence a component.  A component's id
is its smallest doc_id, null only if all its ids are null.  Repeated rows are rows of one group.  Very long texts are hashed block
by block; an empty table gives no row; other columns pass through, whatever their names.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import cut, fresh, received, send, with_row_id
from .graph import components

SHINGLE, BITS, SEED = 3, 2, 42
# Fingerprints at home in a shard, rows of a home or visitor part of a crowded one, sampled fingerprints that the tree is chosen from at most,
# pairs compared at once in a task.
LEAF, PART, SAMPLE, PAIRS = 1000, 8000, 1 << 18, 1 << 19
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED, block: int = 1 << 20) -> int:
    """The 64 majority bits of the hashes of all word shingles, long texts block by block."""
    ones, n, left, lo = np.zeros(64, np.int64), 0, [], 0
    digest = xxhash.xxh64_intdigest
    while lo < len(text):
        cutting = _SPACE.search(text, lo + block) if lo + block < len(text) else None
        hi = cutting.start() if cutting else len(text)
        words = left + text[lo:hi].lower().split()
        lo = hi
        got = [digest(b" ".join(x), seed) for x in zip(*(words[i:] for i in range(shingle)), strict=False)]
        left = words[max(0, len(words) - shingle + 1) :]
        if got:
            bits = np.unpackbits(np.array(got, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            full = len(bits) // 255 * 255  # sums of up to 255 fit in a byte
            ones += bits[:full].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64) + bits[full:].sum(0, dtype=np.int64)
            n += len(got)
    if n == 0:
        return digest(b" ".join(left), seed) if left else 0
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > n))


def with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """All columns but the text, and the fingerprint as a signed long."""
    rest = [c for c in docs.columns if c != text_col]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(x, shingle) if x else 0 for x in pc.cast(b.column(len(rest)), pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], pa.array(prints.view(np.int64))], [*rest, name])

    return docs.select(*rest, F.col(text_col).cast("string")).mapInArrow(run, schema)


def _apart(x: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(x ^ vantage).astype(np.int16)


def _vantage(x: np.ndarray, candidates: int = 8) -> tuple[np.uint64, np.ndarray, int]:
    """Of a few points of ``x`` (spread evenly over it) the one whose distances to it vary most, these, and their median."""
    best = None
    for v in x[np.linspace(0, len(x) - 1, min(candidates, len(x))).astype(int)]:
        d = _apart(x, v)
        if best is None or d.var() > best[1].var():
            best = v, d
    return best[0], best[1], int(np.median(best[1]))


class Tree:
    """Vantage points, radii and children of the inner nodes; a child under zero is leaf -1 - child."""

    def __init__(self, sample: np.ndarray, leaves: int) -> None:
        self.vantage, self.radius, self.child = [], [], []
        self.leaves = 0
        self._grow(sample, leaves)
        self.vantage, self.radius = np.array(self.vantage, np.uint64), np.array(self.radius, np.int16)
        self.child = np.array(self.child, np.int64).reshape(-1, 2)

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, x: np.ndarray, leaves: int) -> int:
        """The node over the part ``x`` of the sample that is to have ``leaves`` leaves."""
        if leaves < 2 or len(x) < 4:
            return self._leaf()
        v, d, radius = _vantage(x)
        if (d <= radius).all():  # as many as half lie at the largest distance: they are the outer side
            radius -= 1
        inside = d <= radius
        if inside.all() or not inside.any():
            return self._leaf()
        node = len(self.child)
        self.vantage.append(v)
        self.radius.append(radius)
        self.child.append(None)
        inner = max(1, round(leaves * inside.mean()))
        self.child[node] = (self._grow(x[inside], inner), self._grow(x[~inside], max(1, leaves - inner)))
        return node

    def visits(self, x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in x, leaf, visitor) of every shard that a fingerprint lives in or visits."""
        at, node, guest = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        out = []
        if not len(self.child):
            return at, node, guest
        while len(at):
            d, r = np.bitwise_count(x[at] ^ self.vantage[node]).astype(np.int16), self.radius[node]
            near, far = d <= r + bits, d > r - bits
            home_in = d <= r
            inner = np.where(guest, near, home_in)
            outer = np.where(guest, far, ~home_in)
            also = ~guest & ~home_in & near  # a home path that turns outside visits the inner side, and from there on follows the bound
            at = np.concatenate([at[inner], at[outer], at[also]])
            child = np.concatenate([self.child[node[inner], 0], self.child[node[outer], 1], self.child[node[also], 0]])
            guest = np.concatenate([guest[inner], guest[outer], np.ones(int(also.sum()), bool)])
            done = child < 0
            out.append((at[done], -1 - child[done], guest[done]))
            at, node, guest = at[~done], child[~done], guest[~done]
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def planted(points: DataFrame, n: int, leaf: int, sample: int = SAMPLE) -> Tree:
    """The tree for ``n`` points: from at least eight of them a leaf, ``sample`` at most, taken by least hash."""
    leaves = -(-n // leaf)
    wanted = min(sample, max(1024, 8 * leaves))
    order = F.xxhash64(F.lit(5), "fp")
    share = min(1.0, 1.5 * wanted / max(n, 1) + 1e-6)  # a hash this small, then the least of them: the limit is exact, its input bounded
    taken = points.where(F.pmod(order, F.lit(1 << 30)) <= int(share * (1 << 30))).orderBy(F.pmod(order, F.lit(1 << 30)), "fp").limit(wanted)
    return Tree(np.array([r["fp"] for r in taken.collect()], np.int64).view(np.uint64), min(leaves, wanted // 8))


def _shards(points: DataFrame, tree: Tree, bits: int) -> DataFrame:
    """(cell, visitor, fp): each fingerprint at home, and in each shard it visits."""
    sent = send(points.sparkSession, tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = received(sent)
        for b in batches:
            signed = b.column(0).to_numpy()
            for part in np.array_split(signed, len(signed) // 5000 + 1):
                at, cell, guest = tree.visits(part.view(np.uint64), bits)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(guest), pa.array(part[at])], ["cell", "visitor", "fp"])

    return points.select("fp").mapInArrow(run, "cell long, visitor boolean, fp long")


class Links:
    """The links within ``bits`` found in one task, kept as spanning stars."""

    def __init__(self, bits: int) -> None:
        self.bits, self.a, self.b, self.size, self.compared = bits, [], [], 0, 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.size += len(a)
        if self.size > 1 << 20:
            self.shrink()

    def shrink(self) -> None:
        member, root = stars(np.concatenate(self.a or [_NONE]), np.concatenate(self.b or [_NONE]))
        keep = member != root
        self.a, self.b, self.size = [member[keep]], [root[keep]], 0

    def all_pairs(self, u: np.ndarray, v: np.ndarray) -> None:
        step = max(1, PAIRS // max(1, len(v)))
        for i in range(0, len(u) if len(v) else 0, step):
            p, q = np.nonzero(np.bitwise_count(u[i : i + step, None] ^ v[None, :]) <= self.bits)
            self.compared += len(u[i : i + step]) * len(v)
            self.add(u[i + p], v[q])

    def between(self, u: np.ndarray, v: np.ndarray) -> None:
        """Links between ``u`` and ``v`` (and maybe others that hold), by vantage points of u."""
        todo = [(u, v)]
        while todo:
            u, v = todo.pop()
            if len(u) < len(v) // 8:
                u, v = v, u
            if len(u) * len(v) <= PAIRS:
                self.all_pairs(u, v)
                continue
            w, d, radius = _vantage(u)
            e = _apart(v, w)
            self.compared += len(u) + len(v)
            close, near, inside = d <= self.bits, e <= self.bits, d <= radius
            # What is close to the vantage point is linked by it: it meets only what isn't, and that only within twice the bits.
            parts = [(u[close], v[~near & (e <= 2 * self.bits)]), (u[~close & (d <= 2 * self.bits)], v[near]),
                     (u[~close & inside], v[~near & (e <= radius + self.bits)]), (u[~close & ~inside], v[~near & (e > radius - self.bits)])]
            if sum(len(x) * len(y) for x, y in parts) > _WORTH * len(u) * len(v):
                self.all_pairs(u, v)  # no bound prunes enough here
                continue
            self.add(u[close], np.full(int(close.sum()), w))
            self.add(v[near], np.full(int(near.sum()), w))
            todo += [(x, y) for x, y in parts if len(x) and len(y)]

    def within(self, u: np.ndarray) -> None:
        """Links among ``u``."""
        todo = [u]
        while todo:
            u = todo.pop()
            if len(u) ** 2 <= PAIRS:
                self.all_pairs(u, u)
                continue
            w, d, radius = _vantage(u)
            self.compared += len(u)
            close, inside = d <= self.bits, d <= radius
            mixed = [(u[close], u[~close & (d <= 2 * self.bits)]),
                     (u[~close & inside & (d > radius - self.bits)], u[~close & ~inside & (d <= radius + self.bits)])]
            parts = [u[~close & inside], u[~close & ~inside]]
            if sum(len(x) * len(y) for x, y in mixed) + sum(len(x) ** 2 for x in parts) / 2 > _WORTH * len(u) ** 2 / 2:
                self.all_pairs(u, u)
                continue
            self.add(u[close], np.full(int(close.sum()), w))
            for x, y in mixed:
                if len(x) and len(y):
                    self.between(x, y)
            todo += [x for x in parts if len(x)]

    def table(self) -> pa.Table:
        self.shrink()
        return pa.table({"a": self.a[0].view(np.int64), "b": self.b[0].view(np.int64)})


_NONE = np.zeros(0, np.uint64)
# Share of the pairs that a split may leave to compare, or it is not made: so each level leaves less.
_WORTH = 0.9


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members and roots of the sets that the links (a, b) make."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    p, q = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low, old = np.minimum(label[p], label[q]), label.copy()
        np.minimum.at(label, p, low)
        np.minimum.at(label, q, low)
        label = label[label]
        if (label == old).all():
            return nodes, nodes[label]


def links(points: DataFrame, bits: int = BITS, leaf: int = LEAF, part: int = PART) -> DataFrame:
    """Edges (a, b) that connect all fingerprints of ``points`` (distinct column fp) within ``bits``."""
    rows = _shards(points, planted(points, points.count(), leaf), bits)
    size = rows.groupBy("cell").agg(F.count_if(~F.col("visitor")).alias("h"), F.count_if("visitor").alias("g"))
    hot = size.where((F.col("h") > part) | (F.col("g") > part)).select("cell", F.ceil(F.col("h") / part).cast("int").alias("hs"), F.ceil(F.col("g") / part).cast("int").alias("gs"))
    rows = rows.join(hot, "cell", "left").withColumns({"hs": F.greatest(F.coalesce("hs", F.lit(1)), F.lit(1)), "gs": F.greatest(F.coalesce("gs", F.lit(1)), F.lit(1))})
    # Home parts i against visitor parts j, and home parts i against later home parts (j under zero names the other one).
    salt = F.xxhash64("fp")
    home = F.pmod(salt, F.col("hs")).cast("int")
    homes, guests = F.sequence(F.lit(0), F.col("hs") - 1), F.sequence(F.lit(0), F.col("gs") - 1)
    pair = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    as_guest = F.transform(homes, lambda i: pair(i, F.pmod(salt, F.col("gs"))))
    as_home = F.concat(F.transform(guests, lambda j: pair(home, j)), F.transform(F.filter(homes, lambda k: k != home), lambda k: pair(F.least(home, k), -1 - F.greatest(home, k))))
    rows = rows.withColumn("at", F.explode(F.when(F.col("visitor"), as_guest).otherwise(as_home))).withColumn("home", F.when(~F.col("visitor"), home))
    rows = rows.select("cell", "at.i", "at.j", "home", "fp")

    def run(t: pa.Table) -> pa.Table:
        home, j = t.column("home"), t.column("j")[0].as_py()
        fp = t.column("fp").to_numpy().view(np.uint64)
        first = pc.fill_null(pc.equal(home, t.column("i")[0].as_py()), False).to_numpy()
        found = Links(bits)
        if j == 0:  # with the first part of visitors, each home part is compared with itself once
            found.within(fp[first])
        found.between(fp[first], fp[~first])
        return found.table()

    return rows.groupBy("cell", "i", "j").applyInArrow(run, "a long, b long")


def grouped(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """``prints`` (a column fp) with a column root: equal for fingerprints that links connect."""
    points = cut(prints.select("fp").distinct())
    root = components(links(points, bits)).select(F.col("node").alias("fp"), "root")
    return prints.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def digest(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The columns of query op9."""
    rows = grouped(cut(with_fingerprint(docs.select("doc_id", "text"), "text", "fp", shingle)), bits)
    rows = cut(rows)
    ids = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(ids, "root").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Of each group the row with the smallest id (null ids last, then the first in file order); all columns."""
    row = fresh(docs, "row")
    placed = with_row_id(docs, row)
    slim = placed.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = cut(grouped(cut(with_fingerprint(slim, "text", "fp", shingle)), bits))
    order = F.struct(F.col("id").isNull(), "id", "row")
    first = rows.groupBy("root").agg(F.min(order)["row"].alias("first"))
    gone = rows.join(first, "root").where("row <> first").select(F.col("row").alias(row))
    return placed.join(gone, row, "left_anti").select(*docs.columns)


def brute_force(texts: list[str | None], shingle: int = SHINGLE, bits: int = BITS) -> list[tuple[int, int]]:
    """Fingerprint and number of the first linked text, from all pairs, for tests."""
    prints = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        units = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), SEED) for x in units]
        prints.append(sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h)))
    label = list(range(len(prints)))
    near = [(i, j) for i, j in itertools.combinations(range(len(prints)), 2) if (prints[i] ^ prints[j]).bit_count() <= bits]
    changed = True
    while changed:
        changed = False
        for i, j in near:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return list(zip(prints, label, strict=True))
