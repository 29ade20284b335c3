"""What a job shuffles and writes besides its result: rows once, compressed."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake import session
from topiclake.operators import bronze as B
from topiclake.operators.offsets import assign_offsets
from topiclake.sources import topics as T
from topiclake.streaming import bronze_stream as BS

ROWS = [("hot", i % 2, i % 40, f"v{i % 9}") for i in range(300)] + [(None, None, None, None)] * 30 + [("cold", 0, i, "v") for i in range(9)]


def _rows(spark):
    return spark.createDataFrame(ROWS, "topic STRING, partition INT, key BIGINT, value STRING")


def _names(spark, path):
    return [f for f, _, _ in session.file_stamps(spark, path) if "/part-" in f]


def test_rows_meet_the_counts_by_broadcast_however_large(spark):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the table is too large for Spark to choose it
    try:
        base = spark.createDataFrame([("hot", 0, 7), (None, None, 3)], "topic STRING, partition INT, base BIGINT")
        out = assign_offsets(_rows(spark), order=B.multiplex_order(), leaf_rows=20, base=base)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        want = assign_offsets(_rows(spark), order=B.multiplex_order(), method="window", base=base)
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_a_micro_batch_is_staged_once(spark):
    path = session.fresh_path(spark, "tables", "staged_once")
    staged = lambda: session.matching(spark, session.shared_path(spark, "staged", "offsets-*"))
    before = staged()
    rows = _rows(spark).where("topic is not null").withColumn("timestamp", F.timestamp_seconds("key"))
    BS.BronzeBatchWriter(path, run="r1", leaf_rows=20)(rows, 0)
    assert staged() == before
    got = BS.read_bronze(spark, path)
    assert got.count() == 309 and got.select("topic", "partition", "offset").distinct().count() == 309
    assert all(".zstd." in f for f in _names(spark, path))


def test_topic_folders_and_tables_are_compressed(spark, sf):
    folder = T.topic_folder(spark, sf, "orders")
    names = _names(spark, folder)
    assert names and all(f.endswith(".snappy") for f in names)
    lines = [(f'{{"data":{{"_sequence_id":{i}}}}}',) for i in range(7)]
    own = session.fresh_path(spark, "topics", "few")
    T.write_topic_folder(spark.createDataFrame(lines, "value STRING").coalesce(1), own, 3)
    assert len(_names(spark, own)) == 3  # a compressed file is read by one task, so it is bounded
    assert sorted(r.value for r in T.read_folder_text(spark, own).collect()) == sorted(x for x, in lines)
    table = session.fresh_path(spark, "tables", "zstd")
    B.write_table(_rows(spark), table)
    assert all(".zstd." in f for f in _names(spark, table))


def test_as_of_makes_its_rows_once(spark):
    from topiclake.operators.asof import as_of

    made = spark.sparkContext.accumulator(0)

    def place(i):
        made.add(1)
        return i % 7

    points = spark.range(200).repartition(4).select((F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id")).alias("at"), F.udf(place, "long")("id").alias("place"))
    events = spark.range(40).select((F.col("id") % 4).alias("k"), F.timestamp_seconds(F.col("id") * 5).alias("t"), F.col("id").alias("event"))
    got = as_of(events, points, "k", "t", "at", ["place"], slices=5)
    rows = sorted(map(str, got.collect()))
    assert made.value == 200
    assert rows == sorted(map(str, as_of(events, points, "k", "t", "at", ["place"], method="window").collect()))


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_groups_that_are_all_small_are_not_written_aside(spark):
    from topiclake.operators import offsets as O

    staged = lambda: session.matching(spark, session.shared_path(spark, "staged", "offsets-*"))
    rows = spark.range(3000).select((F.col("id") % 50).alias("payment"), (F.col("id") * 7 % 11).alias("t"), "id")
    rows = rows.unionByName(spark.range(40).select(F.lit(None).cast("long").alias("payment"), F.lit(1).cast("long").alias("t"), "id"))
    want = sorted(map(str, O.assign_offsets(rows, ("payment",), ("t", "id"), method="window").collect()))
    before = staged()
    got = O.assign_offsets(rows, ("payment",), ("t", "id"), leaf_rows=60, many_groups=True)
    assert staged() == before and sorted(map(str, got.collect())) == want
    hot = O.assign_offsets(rows, ("payment",), ("t", "id"), leaf_rows=50, many_groups=True)  # these groups are cut
    assert len(staged()) == len(before) + 1 and sorted(map(str, hot.collect())) == want


def test_the_hash_of_the_order_is_computed_after_the_shuffle(spark):
    out = assign_offsets(_rows(spark), order=B.multiplex_order(), leaf_rows=20)
    lines = out._jdf.queryExecution().sparkPlan().toString().splitlines()
    hashed = [i for i, x in enumerate(lines) if "xxhash64" in x and "_w" in x]
    assert hashed and hashed[0] < min(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x)


def test_files_are_put_together_without_a_shuffle(spark, sf):
    many = spark.range(0, 500, 1, 8).select(F.col("id").cast("string").alias("value"))
    few = many.coalesce(2)
    kept = F.col("value").cast("int") % 3 == 0
    for rows, shuffled in ((many, 0), (few, 1)):
        dealt = T.in_files(rows, 3, kept)
        assert _shuffles(dealt) == shuffled and dealt.rdd.getNumPartitions() == 3
        path = session.fresh_path(spark, "topics", "in_files")
        T.write_topic_folder(dealt, path)
        assert len(_names(spark, path)) == 3
        assert sorted(int(r.value) for r in T.read_folder_text(spark, path).collect()) == list(range(0, 500, 3))
    lop = spark.range(0, 500, 1, 8).where("id >= 400").select(F.col("id").cast("string").alias("value"))  # six empty partitions
    assert _shuffles(T.in_files(lop, 3)) == 1


def test_a_task_numbers_few_rows_whatever_the_number_of_shuffle_partitions(spark, monkeypatch):
    from topiclake.operators import offsets as O

    for name, value in (("SMALL_BYTES", 0), ("TASK_ROWS", 100)):
        monkeypatch.setattr(O, name, value, raising=False)
    rows = spark.range(4000).selectExpr("CAST(id % 2 AS STRING) AS topic", "0 AS partition", "id % 900 AS key", "CAST(id % 7 AS STRING) AS value")
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        out = assign_offsets(rows, order=B.multiplex_order())
        most = out.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]
        assert most <= 600
        assert sorted(map(str, out.collect())) == sorted(map(str, assign_offsets(rows, order=B.multiplex_order(), method="window").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)


def test_sorted_points_come_sorted_where_they_are_cut(spark, sf, monkeypatch):
    from topiclake.operators import offsets as O
    from topiclake.plans import registry, topics

    topics.bronze_path(spark, sf)
    for name, value in (("SMALL_BYTES", 0), ("TASK_ROWS", 100), ("LEAF_ROWS", (100, 100))):
        monkeypatch.setattr(O, name, value, raising=False)
    for name in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize"):  # so that partitions aren't put together
        spark.conf.set(f"spark.sql.adaptive.{name}", "1")
    try:
        places = [r.place for r in registry.QUERIES["gps_sorted_desc"](spark, sf).collect()]
    finally:
        for name in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize"):
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    assert places == list(range(len(places))) and len(places) > 100
