"""Sequential offsets: 0, 1, 2, … per group, in a total order.

``row_number() OVER (PARTITION BY groups ORDER BY order) - 1`` alone runs one task per
group, and a group (one topic partition) can hold a third of all rows.  So a
group with more rows than a leaf may have is cut into buckets by a pure function
of its order columns, and a bucket that is still too large is cut again:

1. the rows are written once to the shared folder with their source position, so that whatever it takes to
   make them (parsing messages) is done once, and every later pass sees the same rows;
2. a pass over the narrow order columns counts rows, and the least and largest
   value of each order column, per bucket;
3. a bucket over the leaf size gets equal ranges of the first order column that
   varies in it; copies of one record (no column varies) are cut by their source
   position, which any order of copies allows;
4. when no bucket is too large, the rows are numbered within their bucket by a
   window (what is computed for the order, such as a hash, is computed after the shuffle and doesn't travel), and a prefix sum over the counts of the buckets of cut groups gives each bucket's first offset. These are a few
   per leaf, so they are broadcast: the rows are neither shuffled nor sorted again to learn them.

Where groups are many (``many_groups``, e.g. payments), their sizes are counted first, from the group columns alone: if none is too large, the
plain window numbers the rows and nothing is written aside; else bounds are looked for in the groups that are.

Nothing is sampled and nothing is persisted: every pass evaluates the same function, and the rows
themselves are shuffled once, on (groups, buckets), into as many partitions as their number asks for, whatever the session's
number of shuffle partitions: what a task sorts and numbers stays in memory, however large the input.  A leaf has ``TASK_ROWS`` rows, more only so
that at most ``MAX_CUTS`` buckets are cut per pass: only that many
(counts and bounds) reach the driver and are broadcast.  An input that Spark estimates at
``SMALL_BYTES`` or less has no group worth cutting, as one task sorts it in seconds: it goes through the plain
window straight away.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclake import session

# Bound on the buckets that are cut in one pass, and so on what is broadcast (about 60 bytes each).
MAX_CUTS = 50_000
# Leaf size: about a third of a core's share of the rows, within these bounds unless MAX_CUTS asks for more.
LEAF_ROWS = (250_000, 2_000_000)
# Rows that one task sorts and numbers, on average; also the leaf size of rows that are moved whole.
TASK_ROWS = 250_000

# Estimated bytes (of compressed files) up to which the plain window numbers the rows.
SMALL_BYTES = 64 << 20

TIE = "_tl_tie"
_RANK = "_tl_rank"
_CUT = "_tl_cut"
_HOT = "_tl_hot"  # whether the row's group is cut
_LEAST = -(1 << 63)


def leaf_size(df: DataFrame, total: int) -> int:
    """Rows one task numbers at most, from the row count."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(min(max(total // (3 * cores), LEAF_ROWS[0]), LEAF_ROWS[1]), total // MAX_CUTS)


def with_tie(df: DataFrame) -> DataFrame:
    """Source position of each row; orders copies of one record among themselves."""
    return df if TIE in df.columns else df.withColumn(TIE, F.monotonically_increasing_id())


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Join on ``cols``, null equal to null; the columns of ``left`` and what ``right`` adds."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(r[f"_r_{c}"]) for c in cols])
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in cols])


def _ranks(df: DataFrame, order: Sequence[str | Column]) -> tuple[list[Column], bool]:
    """BIGINTs that sort as the order columns do, and whether equal ranks mean equal values."""
    ranks: list[Column] = []
    for c in order:
        c = F.col(c) if isinstance(c, str) else c
        kind = df.select(c.alias("c")).schema["c"].dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            ranks.append(c.cast("long"))
        elif isinstance(kind, T.TimestampType):
            ranks.append(F.unix_micros(c))
        elif isinstance(kind, T.StringType):  # 21 bytes, seven at a time
            raw = F.hex(F.encode(c, "UTF-8"))
            ranks += [F.conv(F.rpad(F.substring(raw, 14 * i + 1, 14), 14, "0"), 16, 10).cast("long") for i in range(3)]
            return [F.coalesce(r, F.lit(_LEAST)) for r in ranks], False
        else:
            return [F.coalesce(r, F.lit(_LEAST)) for r in ranks], False
    return [F.coalesce(r, F.lit(_LEAST)) for r in ranks], True


def assign_offsets(
    df: DataFrame,
    groups: Sequence[str] = ("topic", "partition"),
    order: Sequence[str | Column] = ("key", "value"),
    column: str = "offset",
    method: str = "split",
    leaf_rows: int | None = None,
    base: DataFrame | None = None,
    written: bool = False,
    many_groups: bool = False,
) -> DataFrame:
    """Add ``column`` = 0-based position of the row in its group, in ``order`` (nulls first).

    ``base`` (groups…, ``base``) shifts each group, e.g. by the offsets earlier
    micro-batches used.  ``method="window"`` is the plain window, one task per group.
    ``written`` says that ``df`` reads rows written once with :func:`with_tie`, so they are not written again.
    ``many_groups`` says that most groups are small, so that it pays to look at their sizes before anything else.
    """
    groups = list(groups)
    if method == "window":
        out = _window_offsets(df, groups, list(order), column)
    elif method == "split":
        out = _split_offsets(df, groups, list(order), column, leaf_rows, written, many_groups)
    else:
        raise ValueError(f"unknown method {method!r}")
    if base is not None:
        out = _same(out, F.broadcast(base.select(*groups, F.col("base").cast("long").alias("_tl_base"))), groups, "left")
        out = out.withColumn(column, F.col(column) + F.coalesce(F.col("_tl_base"), F.lit(0).cast("long"))).drop("_tl_base")
    return out


def _window_offsets(df: DataFrame, groups: list[str], order: list, column: str) -> DataFrame:
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(column, (F.row_number().over(w) - 1).cast("long"))


def _split_offsets(df: DataFrame, groups: list[str], order: list, column: str, leaf_rows: int | None, written: bool = False,
                   many_groups: bool = False) -> DataFrame:
    if leaf_rows is None and session.estimated_bytes(df) <= SMALL_BYTES:
        return _window_offsets(df, groups, order, column)
    if many_groups:
        sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
        leaf_rows = leaf_rows or leaf_size(df, sizes["all"] or 0)
        if (sizes["most"] or 0) <= leaf_rows:
            return _window_offsets(df, groups, order, column)
    keyed = df
    if not written:
        path = session.fresh_path(df.sparkSession, "staged", "offsets")
        keyed = with_tie(df)
        keyed.write.option("compression", "zstd").parquet(path)
        keyed = df.sparkSession.read.schema(keyed.schema).parquet(path)
    total = keyed.count()
    ranks, exact = _ranks(keyed, order)
    if exact:
        ranks.append(F.col(TIE))
    rows = keyed.withColumn(_RANK, F.array(*ranks))
    cut, cuts = _cut(rows, groups, len(ranks), leaf_rows or max(TASK_ROWS, total // MAX_CUTS), many_groups)
    keys = [*groups, *cuts]
    within = Window.partitionBy(*keys).orderBy(*order, TIE)
    tasks = max(-(-total // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism)
    rows = cut.repartition(tasks, *keys).withColumn("_tl_n", F.row_number().over(within) - 1)  # the window would compute its order before its own shuffle
    if cuts:
        counts = cut.where(F.col(_HOT)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_tl_size"))
        before = Window.partitionBy(*groups).orderBy(*cuts).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.select(*keys, F.coalesce(F.sum("_tl_size").over(before), F.lit(0)).alias("_tl_first"))
        rows = _same(rows, F.broadcast(counts), keys, "left").withColumn("_tl_n", F.col("_tl_n") + F.coalesce("_tl_first", F.lit(0)))
    return rows.select(*df.columns, F.col("_tl_n").cast("long").alias(column))


def _cut(rows: DataFrame, groups: list[str], n_ranks: int, leaf: int, many_groups: bool = False) -> tuple[DataFrame, list[str]]:
    """``rows`` with the columns that name each row's bucket (none where no group is too large)."""
    narrow = rows.select(*groups, _RANK)
    spark, cuts = rows.sparkSession, []
    at = [F.element_at(_RANK, i + 1) for i in range(n_ranks)]
    if many_groups:
        large = narrow.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf).select(*groups)
        large = spark.createDataFrame(large.collect(), large.schema)  # MAX_CUTS at most
        narrow = _same(narrow, F.broadcast(large), groups, "left_semi")
    while True:
        keys = [*groups, *cuts]
        stats = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array(*[F.min(x) for x in at]).alias("lo"), F.array(*[F.max(x) for x in at]).alias("hi"))
        varies = F.expr("filter(sequence(1, size(lo)), i -> element_at(lo, i) < element_at(hi, i))")
        heavy = stats.where(F.col("n") > leaf).withColumn("by", F.try_element_at(varies, F.lit(1))).where("by is not null")
        low, high = (F.element_at(c, F.col("by")).cast("decimal(20,0)") for c in ("lo", "hi"))
        pieces = F.ceil(4 * F.col("n") / leaf)
        heavy = heavy.select(*keys, F.col("by").alias("_tl_by"), low.alias("_tl_lo"), F.ceil((high - low + 1) / pieces).cast("decimal(20,0)").alias("_tl_w"))
        found = heavy.collect()  # MAX_CUTS at most: each has more than total / MAX_CUTS rows
        if not found:
            break
        heavy = F.broadcast(spark.createDataFrame(found, heavy.schema))
        name = f"{_CUT}{len(cuts)}"
        child = F.floor((F.element_at(_RANK, F.col("_tl_by")).cast("decimal(20,0)") - F.col("_tl_lo")) / F.col("_tl_w")).cast("long")
        narrow = _same(narrow, heavy, keys, "inner").select(*keys, child.alias(name), _RANK)
        rows = _same(rows, heavy, keys, "left").withColumn(name, F.coalesce(child, F.lit(0).cast("long")))
        rows = (rows if cuts else rows.withColumn(_HOT, child.isNotNull())).drop("_tl_by", "_tl_lo", "_tl_w")
        cuts.append(name)
    return rows, cuts
