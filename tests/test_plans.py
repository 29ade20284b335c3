"""Physical plans: pruning, pushdown, no needless exchange, bounded broadcast."""

from __future__ import annotations

import __spark_entry__ as entry
from topiclake.plans import topics as P
from topiclake.sources import topics as T

Q = entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_gold_count_reads_only_key_column(spark, sf):
    text = formatted(Q["bronze_count_by_topic"](spark, sf))
    assert "ReadSchema: struct<key:bigint>" in text
    assert "partial_count" in text  # map-side combine before the shuffle


def test_topic_filter_is_partition_pruning_and_null_filter_pushed(spark, sf):
    text = formatted(Q["orders_by_method"](spark, sf))
    assert "PartitionFilters: [topic#" in text and "IN (kafka-orders,ordem)" in text
    assert "PushedFilters: [IsNotNull(value)]" in text
    assert "ReadSchema: struct<value:string>" in text


def test_union_of_topics_has_no_exchange(spark, sf):
    frames = T.union_topics([P.parsed_topic(spark, sf, k) for k in P.KINDS])
    assert "Exchange" not in formatted(frames.select("_topic_name", "data._sequence_id"))


def test_flattening_has_no_exchange(spark, sf):
    for kind in P.KINDS:
        assert "Exchange" not in formatted(Q[f"flatten_{kind}"](spark, sf))
    assert "Exchange" not in formatted(Q["kafka_record_as_text"](spark, sf))


def test_nothing_stays_persisted(spark, sf):
    held = spark.sparkContext._jsc.getPersistentRDDs
    before = held().size()
    for name in ("bronze_batch", "assign_offsets", "event_sequence", "ext_events_session", "flatten_orders", "ext_order_gps_join"):
        Q[name](spark, sf).count()
        assert held().size() == before, name


def test_top10_is_take_ordered(spark, sf):
    assert "TakeOrderedAndProject" in formatted(Q["bronze_last_10"](spark, sf))


def test_last_100_per_topic_uses_group_limit(spark, sf):
    assert "WindowGroupLimit" in formatted(Q["last_100_per_topic"](spark, sf))


def test_payment_events_pre_aggregated_by_hash(spark, sf):
    text = formatted(Q["ext_payment_events_join"](spark, sf))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_order_gps_join_splits_a_hot_order(spark):
    """One order with most of the points: the adaptive join reads its partition in several tasks."""
    from topiclake.operators import extensions as E

    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                           "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.advisoryPartitionSizeInBytes") if spark.conf.get(k, None) is not None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10k")
    try:
        orders = spark.range(50).selectExpr("concat('ord-', id) AS order_key", "CAST(id AS DOUBLE) AS amount", "'pending' AS status")
        gps = spark.range(40_000).repartition(8).selectExpr("concat('ord-', IF(id % 3 > 0, 7, id % 50)) AS order_id", "rand(1) AS lat", "rand(2) AS lon", "10 AS speed_kph")
        out = E.order_gps(orders, gps)
        assert out.count() == 40_000
        rows = out.groupBy("order_key").count()
        rows.collect()
        out.write.format("noop").mode("overwrite").save()
        assert "SortMergeJoin" in formatted(out)
        final = out.where("lat >= 0")
        final.collect()
        assert "skew=true" in final._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.set(k, keep[k]) if k in keep else spark.conf.unset(k)


def test_silver_parse_schema_pruned_to_fields_read(spark, sf):
    text = formatted(Q["orders_by_method"](spark, sf))
    assert "from_json(StructField(method,StringType,true), value" in text
    assert "StructField(amount" not in text
