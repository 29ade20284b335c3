"""Toxicity: a factorization machine over hashed terms.

Terms are a text's words and the words' first four and six bytes, hashed to
2^BITS places; a term counts 1 + log of its number, over the text's norm.  The
score is sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j): the
pairs catch what is toxic only together, such as an insult and who it is said of.
Learned by AdaGrad on a bounded sample of ``rows`` labelled documents a class,
classes weighted to be equal, over the terms of at least ``MIN_DOCS`` of them, then calibrated for the classes' whole sizes on a
fifth of the sample that the machine has not seen.

Edge cases: a null or empty text, or one without words, has the score of the
constant.  Without labels of both classes every score is 0.5.  Very long texts are hashed whole.  Equal texts have
equal scores; of repeated ids one text is learned from; a document labelled both ways counts for both.  An empty table gives no row; other
columns pass through and the score gets a free name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import fresh, held, pieces, received, send, utf8
from .learn import labelled_sample, logistic, sigmoid
from .textnp import Words, mixed

BITS, RANK = 18, 4
ROWS, EPOCHS, STEPS, BATCH, RATE, DECAY = 3000, 16, 1000, 64, 0.2, 1e-4
MIN_DOCS = 4
_HEADS = (4, 6)


class Terms:
    """Sparse rows of texts: place of the first term of each text, terms and values."""

    def __init__(self) -> None:
        self.words = Words()

    def rows(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw, at = utf8(col)
        h, s, e, first = self.words.split(raw, at)
        if not len(h):
            return np.zeros(len(col) + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
        doc = np.repeat(np.arange(len(col), dtype=np.uint64), np.diff(first))
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.words.lut[raw] * self.words.up[: len(raw)], out=total[1:])
        kinds = [h] + [mixed((total[np.minimum(s + n, e)] - total[s]) * self.words.down[s] + np.uint64(n)) for n in _HEADS]
        key = np.concatenate([doc << np.uint64(BITS) | x >> np.uint64(64 - BITS) for x in kinds])
        key, n = np.unique(key, return_counts=True)
        doc, term = (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)
        value = 1 + np.log(n)
        norm = np.sqrt(np.bincount(doc, value * value, len(col)))
        return np.searchsorted(doc, np.arange(len(col) + 1)), term, value / norm[doc]


class Machine:
    """The model, and its score of sparse rows."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.w0, self.w = 0.0, np.zeros(1 << BITS, np.float32)
        self.v = (rng.standard_normal((1 << BITS, RANK)) * 0.01).astype(np.float32)
        self.scale = np.array([1.0, 0.0])

    def raw(self, first: np.ndarray, term: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each row, its sum of v x, and the row of each term."""
        n = len(first) - 1
        row = np.repeat(np.arange(n), np.diff(first))
        vx = self.v[term] * value[:, None]
        s = np.stack([np.bincount(row, vx[:, f], n) for f in range(RANK)], 1)
        pairs = 0.5 * ((s * s).sum(1) - np.bincount(row, (vx * vx).sum(1), n))
        return self.w0 + np.bincount(row, self.w[term] * value, n) + pairs, s, row

    def train(self, rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        y = np.array([r[0] for r in rows])
        weight = (len(y) / 2 / np.bincount(y, minlength=2))[y]
        g0, gw, gv = 1e-8, np.full(1 << BITS, 1e-8, np.float32), np.full((1 << BITS, RANK), 1e-8, np.float32)
        seen = np.bincount(np.concatenate([r[1] for r in rows]), minlength=1 << BITS) >= MIN_DOCS
        rows = [(label, t[seen[t]], x[seen[t]]) for label, t, x in rows]
        self.v[~seen] = 0  # terms that nothing was learned of add nothing
        for _ in range(max(epochs, STEPS * BATCH // len(rows))):
            order = rng.permutation(len(rows))
            for k in range(0, len(order), BATCH):
                own = order[k : k + BATCH]
                first = np.concatenate([[0], np.cumsum([len(rows[i][1]) for i in own])])
                term, value = np.concatenate([rows[i][1] for i in own]), np.concatenate([rows[i][2] for i in own])
                z, s, row = self.raw(first, term, value)
                d = weight[own] * (sigmoid(z) - y[own]) / len(own)
                g0 += d.sum() ** 2
                self.w0 -= RATE * d.sum() / np.sqrt(g0)
                terms, place = np.unique(term, return_inverse=True)
                dx = d[row] * value
                g = np.bincount(place, dx, len(terms)) + DECAY * self.w[terms]
                gw[terms] += g * g
                self.w[terms] -= RATE * g / np.sqrt(gw[terms])
                for f in range(RANK):
                    g = np.bincount(place, dx * (s[row, f] - self.v[term, f] * value), len(terms)) + DECAY * self.v[terms, f]
                    gv[terms, f] += g * g
                    self.v[terms, f] -= RATE * g / np.sqrt(gv[terms, f])


def _sample_rows(sample: DataFrame) -> tuple[list, list]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for b in batches:
            for lo, hi in pieces(b.column(2)):
                first, term, value = terms.rows(b.column(2)[lo:hi])
                cutting = [slice(first[i], first[i + 1]) for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], b.column(1)[lo:hi], pa.array([term[c].astype(np.int32).tobytes() for c in cutting], pa.binary()), pa.array([value[c].astype(np.float32).tobytes() for c in cutting], pa.binary())], ["part", "y", "term", "value"])

    got = sample.select(F.pmod(F.xxhash64(F.lit(5), F.col("id")), F.lit(5)).alias("part"), "y", "text").mapInArrow(run, "part long, y int, term binary, value binary").collect()
    rows = sorted((r.part, r.y, bytes(r.term), bytes(r.value)) for r in got)  # the same model for any order of rows
    out = [(p, y, np.frombuffer(t, np.int32).astype(np.int64), np.frombuffer(x, np.float32).astype(np.float64)) for p, y, t, x in rows]
    return [r[1:] for r in out if r[0]], [r[1:] for r in out if not r[0]]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = ROWS, epochs: int = EPOCHS) -> Machine | None:
    sample, sizes = labelled_sample(docs, labels, label_col, rows)
    if len(sizes) < 2:
        return None
    train, check = _sample_rows(sample)
    if len({r[0] for r in train}) < 2:
        return None
    model = Machine()
    model.train(train, epochs)
    if len({r[0] for r in check}) < 2:
        check = train
    z = np.concatenate([model.raw(np.array([0, len(t)]), t, x)[0] for _, t, x in check])
    y = np.array([r[0] for r in check])
    weight = np.array([sizes[0], sizes[1]], float)[y] / np.bincount(y, minlength=2)[y]
    model.scale = logistic(z[:, None], y, weight / weight.mean(), ridge=1e-2)
    return model


def scored(docs: DataFrame, model: Machine | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` and the score as a last column."""
    name = fresh(docs, name)
    sent, place = send(docs.sparkSession, model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, terms = received(sent), Terms()
        for b in batches:
            for lo, hi in pieces(b.column(place)):
                part = b.slice(lo, hi - lo)
                score = sigmoid(known.raw(*terms.rows(part.column(place)))[0] * known.scale[0] + known.scale[1]) if known else np.full(hi - lo, 0.5)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of query op6; rows whose crc32 leaves 0 of 5 are held out."""
    model = fit(docs, labels.where(~held("doc_id", 5, 0)))
    out = scored(docs.select("doc_id", held("doc_id", 5, 0).alias("held_out"), F.col("text")), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
