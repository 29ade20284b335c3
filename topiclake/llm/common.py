"""Small helpers shared by the operators: fresh column names, text batches, row identity, shared folders."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from topiclake.session import fresh_path, shared_root

# Bytes of text that a Python worker turns into numpy arrays at once (a longer single text goes alone).
PIECE_BYTES = 1 << 21


def fresh(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def shared(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder (``spark.checkpoint.dir``)."""
    return fresh_path(spark, "llm", name)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from the shared checkpoint folder, which every executor sees."""
    shared_root(df.sparkSession)  # sets a checkpoint dir where none is set, as in tests
    return df.checkpoint()


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """``df`` and a struct column naming each row by its file and place in it.

    A frame that is no plain file scan is written to the shared folder first.
    """
    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).alias(name)
    try:
        return df.select("*", place)
    except AnalysisException:
        path = shared(df.sparkSession, "rows")
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path).select("*", place)


def pieces(col: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column with about ``limit`` bytes each, one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(col):
        base = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield lo, hi
        lo = hi


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes in one array and the n + 1 offsets in it; null is empty."""
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and at[-1] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def held(key: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text leaves ``fold``; false for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(False))


def sampled(df: DataFrame, key: str, by: str, rows: int) -> tuple[DataFrame, dict]:
    """About ``rows`` rows of each class ``by`` at most: those whose hash of ``key`` is under the class's share.

    The classes are counted first; only that small table reaches the driver.
    Which rows are taken depends on the rows of ``df`` alone.  The class sizes
    come second.  A class of over a million times ``rows`` is thinned by a second hash, so the bound holds at any size.
    """
    sizes = {r[0]: r[1] for r in df.groupBy(by).count().collect()}
    part = F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(1_000_000))
    keep = F.lit(False)
    for value, n in sizes.items():
        share = min(1_000_000, -(-rows * 1_000_000 // n))
        taken = (F.col(by) == F.lit(value)) & (part < share)
        if n > rows * 1_000_000:
            taken = taken & (F.pmod(F.xxhash64(F.lit(18), F.col(key)), F.lit(1_000_000)) < -(-rows * 1_000_000**2 // n))
        keep = keep | taken
    return df.where(keep), sizes


def send(spark: SparkSession, value):
    """A broadcast that workers read with ``received``; classes travel with it, so executors need no copy of the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent):
    return pickle.loads(sent.value)
