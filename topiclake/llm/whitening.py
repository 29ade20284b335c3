"""Whitening of embeddings over distinct quantised vectors, weighted by how often each one stands.

A vector's entries become integers x = floor(scale * c) + offset.  Equal x vectors are grouped (combined before
the shuffle), so a vector that a third of all rows share is one row from there on; its weight in the fit is its count
or one.  Count and sums per dimension are exact integers; the covariance is the sum of weighted products of the
centred entries (n * x - S) / n, one matrix product per Arrow batch, added up row by row of the matrix.  The driver sees
one d x d matrix and finds its eigenvectors; each distinct vector is projected once, and rows get theirs by an
exact join on x.  The whitened vectors' own covariance is measured, not assumed.

Edge cases: rows whose vector is null or empty, holds a null or non-finite entry, or one whose x is beyond 2**53 (no exact
double), get no whitened vector.  So do vectors of another length than the commonest one (the longest of equals).  Directions without
variance (eigenvalue under 1e-12 of the largest) are no components: one vector alone, or copies of it, give no rows.
``deviation`` is null where the exact sum is no long.  Repeated rows and null ids are kept; an empty table gives no row; other columns
pass through under their own names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fresh, received, send, shared

# Of the quantisation.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
_LEAST = 1e-12


def quantised(df: DataFrame, vector: str, name: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``df`` with x as ``name``: null where the vector has none."""
    v = F.col(vector).cast("array<double>")
    good = (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < 2.0**53))
    x = F.transform(v, lambda c: F.floor(c * scale).cast("long") + F.lit(offset).cast("long"))
    return df.withColumn(name, F.when(F.coalesce(good, F.lit(False)), x))


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _added(df: DataFrame, task, kind: str) -> np.ndarray:
    """The sum of the matrices that ``task`` gives per Arrow batch: each task adds its own, then the rows of all are added by row number."""
    dtype = np.float64 if kind == "double" else object  # integers of any size

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if len(b):
                m = task(b)
                total = m if total is None else total + m
        if total is not None:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(total)), pa.int32()), "v": [[str(int(c)) for c in r] if kind == "string" else r for r in total]}, pa.schema([("i", pa.int32()), ("v", pa.list_(pa.string() if kind == "string" else pa.float64()))]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column("i").to_pylist(), b.column("v").to_pylist()):
                v = np.array([int(c) for c in v] if kind == "string" else v, dtype)
                held[i] = held[i] + v if i in held else v
        for i, v in held.items():
            yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "v": [[str(c) for c in v] if kind == "string" else v]}, pa.schema([("i", pa.int32()), ("v", pa.list_(pa.string() if kind == "string" else pa.float64()))]))

    schema = f"i int, v array<{kind}>"
    found = df.mapInArrow(part, schema).repartition("i").mapInArrow(add, schema).collect()  # one matrix
    return np.array([[int(c) for c in r["v"]] if kind == "string" else r["v"] for r in sorted(found, key=lambda r: r["i"])], dtype)


def sums(distinct: DataFrame, d: int) -> tuple[int, list[int]]:
    """Total weight and weighted sum per dimension of (x, w), exact."""

    def task(b: pa.RecordBatch) -> np.ndarray:
        x, w = _matrix(b.column("x"), d), b.column("w").to_numpy()
        if np.abs(x).max() * float(w.sum()) < 2.0**62:
            return np.array([[int(w.sum()), *(int(c) for c in w @ x)]], object)
        return np.array([[int(w.sum()), *(sum(int(a) * int(c) for a, c in zip(w, col)) for col in x.T)]], object)

    found = _added(distinct, task, "string")
    return (found[0][0], list(found[0][1:])) if len(found) else (0, [])


def _centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """(n * x - s) / n, each entry rounded once: whole part and rest of s / n are taken apart."""
    whole, rest = np.array([c // n for c in s], np.int64), np.array([(c % n) / n for c in s])
    return (x - whole).astype(np.float64) - rest


def covariance(df: DataFrame, column: str, d: int, n: int, s: list[int] | None = None) -> np.ndarray:
    """Weighted covariance of an array column, divisor ``n``: centred at s / n, or at its own mean where no sums are given."""
    if s is None:
        first = _added(df, lambda b: (b.column("w").to_numpy() @ _matrix(b.column(column), d))[None, :], "double")
        mean = first[0] / n
        centred = lambda m: m - mean
    else:
        centred = lambda m: _centred(m, n, s)

    def task(b: pa.RecordBatch) -> np.ndarray:
        m = centred(_matrix(b.column(column), d))
        return (m * b.column("w").to_numpy()[:, None]).T @ m

    found = _added(df, task, "double") / n
    return (found + found.T) / 2


def components(cov: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and unit eigenvectors (columns) with variance; the largest entry of each is positive."""
    values, vectors = np.linalg.eigh(cov)
    order = [i for i in np.argsort(values)[::-1][:most] if values[i] > _LEAST * max(values.max(), 0)]
    values, vectors = values[order], vectors[:, order]
    return values, vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(len(order))] < 0, -1, 1) if len(order) else vectors


def _deviation(x: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - s)**2 of each row, exact; None where it is no long."""
    away = np.abs(_centred(x, n, s)).max(axis=1) * float(n)
    small = (away + 1) ** 2 * x.shape[1] < 2.0**62
    out: list[int | None] = [None] * len(x)
    if small.any() and max(abs(c) for c in s) < 1 << 62 and np.abs(x[small]).max() * float(n) < 2.0**62:
        diff = x[small] * np.int64(n) - np.array(s, np.int64)
        for i, v in zip(np.flatnonzero(small), (diff * diff).sum(axis=1)):
            out[i] = int(v)
    else:
        small[:] = False
    for i in np.flatnonzero(~small):
        v = sum((n * int(a) - c) ** 2 for a, c in zip(x[i], s))
        out[i] = v if v < 1 << 63 else None
    return out


def whitened(df: DataFrame, vector: str = "embedding", weight: str = "one", most: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Rows of ``df`` that have an x, with a struct column: n, deviation, values (whitened, one per component), explained (likewise), identity_error.

    ``weight``: ``one`` fits on each distinct x once, ``count`` on each as often as it stands.  The struct's name is the last of the columns.
    """
    if weight not in ("one", "count"):
        raise ValueError(f"weight must be 'one' or 'count', not {weight!r}")
    spark, xc, name = df.sparkSession, fresh(df, "x"), fresh(df, "white")
    rows = quantised(df, vector, xc, scale, offset).where(F.col(xc).isNotNull())
    path = shared(spark, "vectors")
    rows.groupBy(F.col(xc).alias("x")).agg(F.count(F.lit(1)).alias("k")).withColumn("w", F.col("k") if weight == "count" else F.lit(1).cast("long")).write.parquet(path)
    distinct = spark.read.parquet(path)
    lengths = distinct.groupBy(F.size("x").alias("d")).agg(F.sum("k").alias("k")).orderBy(F.desc("k"), F.desc("d")).first()
    d = lengths["d"] if lengths else 1
    distinct = distinct.where(F.size("x") == d)
    n, s = sums(distinct, d)
    cov = covariance(distinct, "x", d, n, s) if n else np.zeros((d, d))
    values, vectors = components(cov, most)
    explained = [float(e / np.trace(cov)) for e in values]
    sent = send(spark, (n, s, vectors / np.sqrt(values)))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, to = received(sent)
        for b in batches:
            if len(b):
                x = _matrix(b.column("x"), d)
                out = _centred(x, n, s) @ to
                yield pa.RecordBatch.from_arrays([b.column("x"), b.column("w"), pa.array(_deviation(x, n, s), pa.int64()), pa.array(list(out), pa.list_(pa.float64()))], names=["x", "w", "deviation", "values"])

    path = shared(spark, "whitened")
    distinct.mapInArrow(project, "x array<long>, w long, deviation long, values array<double>").write.parquet(path)
    white, k = spark.read.parquet(path), len(values)
    error = float(np.abs(covariance(white, "values", k, n) - np.eye(k)).max()) if k else 0.0
    facts = F.struct(F.lit(n).cast("long").alias("n"), "deviation", "values", F.array(*map(F.lit, explained)).cast("array<double>").alias("explained"), F.lit(error).alias("identity_error"))
    white = white.select(F.col("x").alias(xc), facts.alias(name))
    return rows.join(white, xc).drop(xc)


def digest(embeddings: DataFrame) -> DataFrame:
    out = whitened(embeddings.select("vec_id", "embedding"))
    w = out.columns[-1]
    each = out.select("vec_id", F.col(w), F.posexplode(F.arrays_zip(F.col(f"{w}.values").alias("whitened"), F.col(f"{w}.explained").alias("explained"))).alias("c", "v"))
    return each.select("vec_id", (F.col("c") + 1).alias("component"), f"{w}.n", f"{w}.deviation", F.col("v.whitened"), F.col("v.explained"), f"{w}.identity_error")
