"""Compression classifier: two zstandard dictionaries, one from good and one from bad labelled text.

Every text is cut into blocks of ``BLOCK`` bytes and each block is compressed
with either dictionary; the difference of the compressed sizes, normalised by
the raw size and by the compressed size, and the size itself are calibrated to a
probability by logistic regression on labelled texts that the dictionaries
have not seen.  Classes are weighted by their whole sizes.

What is learned comes from a bounded sample: ``rows`` documents of each class,
half for the dictionaries (of these ``sample_bytes`` of blocks a class), half for the calibration.

Edge cases: null and empty texts compress to nothing, so they get the share of
good labels as score.  Without labels of both classes every score is 0.5.  Very long texts are compressed whole, block
by block.  Equal texts have equal scores; of repeated ids one text is learned from; a document labelled both ways counts for both.  An
empty table gives no row; other columns pass through and the score gets a free name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from .common import fresh, held, received, send
from .learn import labelled_sample, logistic, sigmoid

BLOCK, DICT_BYTES, LEVEL = 512, 112 << 10, 3
ROWS, SAMPLE_BYTES = 6000, 8 << 20


def blocks(text: bytes) -> Iterator[bytes]:
    return (text[i : i + BLOCK] for i in range(0, len(text), BLOCK))


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples as they are where there are too few to train."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


class Sizes:
    """Compressed sizes under the dictionaries; made in the task, as compressors can't be sent."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.pair = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.pair.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def features(self, text: bytes) -> list[float]:
        if not text:
            return [0.0, 0.0, 0.0]
        good, bad = (sum(len(c.compress(x)) for x in blocks(text)) for c in self.pair)
        return [(bad - good) / (bad + good), (bad - good) / len(text), (bad + good) / len(text) / 2]


def _binary(col: pa.Array) -> list[bytes]:
    return [x or b"" for x in pc.cast(col, pa.binary()).to_pylist()]


def _dictionary_blocks(sample: DataFrame, want: int) -> dict[int, list[bytes]]:
    """About ``want`` bytes of blocks of each class, taken by a hash of the block's place."""
    total = {r.y: r.n for r in sample.groupBy("y").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    share = {y: min(1.0, want / n) if n else 1.0 for y, n in total.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text, y in zip(b.column(0).to_pylist(), _binary(b.column(1)), b.column(2).to_pylist(), strict=True):
                n = -(-len(text) // BLOCK)
                # whole runs of blocks, so that a short text is taken or left as one
                keep = np.flatnonzero(((np.arange(n) // 8 + i) * 2654435761 % 2**32) < share[y] * 2**32)
                if len(keep):
                    yield pa.RecordBatch.from_arrays([pa.array([y] * len(keep), pa.int32()), pa.array([text[k * BLOCK : (k + 1) * BLOCK] for k in keep], pa.binary())], ["y", "block"])

    out: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sample.select(F.pmod(F.xxhash64("id"), F.lit(1 << 20)).alias("i"), "text", "y").mapInArrow(run, "y int, block binary").collect():
        out[r.y].append(bytes(r.block))
    return {y: sorted(x) for y, x in out.items()}  # the same dictionary for any order of rows


def _features(df: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good, bad)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sizes.features(x) for x in _binary(b.column(1))], pa.list_(pa.float64()))], ["y", "x"])

    return df.select("y", "text").mapInArrow(run, "y int, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = ROWS, sample_bytes: int = SAMPLE_BYTES) -> tuple[bytes, bytes, np.ndarray, float] | None:
    """Both dictionaries, the weights of the calibration and the share of good labels; None without both classes."""
    sample, sizes = labelled_sample(docs, labels, label_col, rows)
    if len(sizes) < 2:
        return None
    half = F.pmod(F.xxhash64(F.lit(5), F.col("id")), F.lit(2)) == 0
    parts = _dictionary_blocks(sample.where(half), sample_bytes)
    good, bad = dictionary(parts[1]), dictionary(parts[0])
    got = _features(sample.where(~half & (F.octet_length("text") > 0)), good, bad).collect()
    y = np.array([r.y for r in got])
    if len(set(y.tolist())) < 2:
        return None
    weight = np.array([sizes[0], sizes[1]], float)[y] / np.bincount(y, minlength=2)[y]
    return good, bad, logistic(np.array([r.x for r in got]), y, weight / weight.mean()), sizes[1] / (sizes[0] + sizes[1])


def scored(docs: DataFrame, model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` and the score as a last column."""
    name = fresh(docs, name)
    sent, place = send(docs.sparkSession, model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = received(sent)
        sizes = Sizes(*known[:2]) if known else None
        for b in batches:
            if known:
                texts = _binary(b.column(place))
                x = np.array([sizes.features(t) for t in texts]).reshape(b.num_rows, 3)
                score = np.where([bool(t) for t in texts], sigmoid(x @ known[2][:-1] + known[2][-1]), known[3])
            else:
                score = np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of query op2; rows whose crc32 leaves 1 of 3 are held out."""
    model = fit(docs, labels.where(~held("doc_id", 3, 1)))
    out = scored(docs.select("doc_id", held("doc_id", 3, 1).alias("held_out"), F.col("text")), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
