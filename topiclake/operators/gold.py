"""Gold: aggregates and top-k over bronze and silver.

All are plain ``groupBy().agg()`` (partial + final hash aggregate, so a hot
group is pre-aggregated map-side before the shuffle), ``orderBy().limit()``
(``TakeOrderedAndProject``) or a per-group limit (``WindowGroupLimit``).
Money is summed in DECIMAL(18,2) and returned as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topiclake.functions.payload import money_sum
from topiclake.schemas import FOLDER_TOPICS, KAFKA_TOPICS, PER_TOPIC_TABLES

# ------------------------------------------------------------ bronze


def count_by_topic(bronze: DataFrame) -> DataFrame:
    """Messages, smallest and largest key per topic."""
    return (
        bronze.groupBy("topic")
        .agg(F.count(F.lit(1)).alias("count"), F.min("key").alias("min_key"), F.max("key").alias("max_key"))
        .orderBy("topic")
    )


def partition_distribution(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("count")).orderBy("topic", "partition")


def max_offset(bronze: DataFrame) -> DataFrame:
    return (
        bronze.groupBy("topic", "partition").agg(F.max("offset").alias("max_offset")).orderBy("topic", "partition")
    )


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def rows_per_table(bronze: DataFrame) -> DataFrame:
    """Row count of each per-topic table, named as the tables are."""
    names = F.create_map(*[x for k, t in PER_TOPIC_TABLES.items() for x in (F.lit(FOLDER_TOPICS[k]), F.lit(t))])
    return bronze.groupBy("topic").agg(F.count(F.lit(1)).alias("total_rows")).select(
        names[F.col("topic")].alias("table_name"), "total_rows"
    )


def last_by_key(bronze: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` records with the largest keys; topic, offset and partition break ties (topics share keys, replays repeat them)."""
    return bronze.orderBy(F.col("key").desc(), F.col("topic").desc(), F.col("offset").desc(), F.col("partition").desc()).limit(n)


def sample(bronze: DataFrame, n: int = 5, repeatable: bool = False) -> DataFrame:
    """Any ``n`` rows, all where there are fewer.

    ``repeatable`` takes the same rows of the same table every time: those of least mixed key, partition and offset
    (each task keeps its ``n`` least, nothing is shuffled but these).
    """
    if not repeatable:
        return bronze.limit(n)
    mixed = F.pmod(F.coalesce("key", F.lit(0)) % 1_000_003 * 7919 + F.col("partition") * 104_729 + F.col("offset") % 1_000_003 * 611_953, F.lit(1_000_003))
    return bronze.orderBy(mixed, "topic", "partition", "offset").limit(n)


def preview(bronze: DataFrame, n: int = 10, width: int = 100) -> DataFrame:
    """Last records by key with a truncated value."""
    return last_by_key(bronze, n).select(
        "key", "topic", "partition", "offset", "ingestion_timestamp", F.substring("value", 1, width).alias("value_preview")
    )


def last_per_topic(bronze: DataFrame, n: int = 100) -> DataFrame:
    """The last ``n`` records (by key, then offset and partition) of each topic."""
    w = Window.partitionBy("topic").orderBy(F.col("key").desc(), F.col("offset").desc(), F.col("partition").desc())
    return bronze.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).drop("rn")


def distinct_topics(bronze: DataFrame) -> DataFrame:
    return bronze.select("topic").distinct()


def count_by_partition(table: DataFrame) -> DataFrame:
    """Per-topic table: records per partition."""
    return table.groupBy("partition").agg(F.count(F.lit(1)).alias("count")).orderBy("partition")


def max_offset_by_partition(table: DataFrame) -> DataFrame:
    return table.groupBy("partition").agg(F.max("offset").alias("max_offset")).orderBy("partition")


def latest(table: DataFrame, n: int = 10, time_col: str = "bronze_ingestion_timestamp") -> DataFrame:
    """Most recent ``n`` rows; offset then partition break ties of equal times."""
    return table.orderBy(F.col(time_col).desc(), F.col("offset").desc(), F.col("partition").desc()).limit(n)


# ------------------------------------------------------------ silver


def orders_by_method(orders: DataFrame) -> DataFrame:
    return orders.groupBy("method").agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "method")


def avg_amount_by_status(orders: DataFrame) -> DataFrame:
    # Summed as decimals: the same for any order of the rows.
    return orders.groupBy("status").agg(
        F.round(F.sum(F.col("amount").cast("decimal(18,2)")).cast("double") / F.count("amount"), 2).alias("avg_amount"),
        F.count(F.lit(1)).alias("count"),
    )


def status_summary_sql(bronze_view: str, form: str = "record") -> str:
    """Gold SQL over a bronze view: parse the value once (``form`` as in silver), then group by status."""
    fields = "status STRING, amount DOUBLE"
    schema, record = (fields, "") if form == "record" else (f"data STRUCT<{fields.replace(' ', ': ').replace(',:', ',')}>", ".data")
    return f"""
        SELECT status, COUNT(*) AS order_count, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
        FROM (
          SELECT r{record}.status AS status, r{record}.amount AS amount
          FROM (SELECT from_json(value, '{schema}') AS r FROM {bronze_view}
                WHERE topic IN ('{FOLDER_TOPICS["orders"]}', '{KAFKA_TOPICS["orders"]}') AND value IS NOT NULL) parsed
        ) s
        GROUP BY status
    """


def status_summary(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(F.count(F.lit(1)).alias("order_count"), money_sum("amount").alias("total_amount"))


def gps_avg_by(gps: DataFrame, by: str, digits: int = 6) -> DataFrame:
    """Points, average latitude and longitude per ``by`` (streaming or batch)."""
    return gps.groupBy(by).agg(
        F.count(F.lit(1)).alias("points"),
        F.round(F.avg("lat"), digits).alias("avg_lat"),
        F.round(F.avg("lon"), digits).alias("avg_lon"),
    )


def gps_partials(gps: DataFrame, by: str) -> DataFrame:
    """Decomposable pieces of :func:`gps_avg_by` for one slice of the data (e.g. a micro-batch)."""
    return gps.groupBy(by).agg(
        F.count(F.lit(1)).alias("points"), F.sum("lat").alias("sum_lat"), F.sum("lon").alias("sum_lon"))


def fold_gps_partials(parts: DataFrame, by: str) -> DataFrame:
    """One partial per group out of any number."""
    return parts.groupBy(by).agg(*[F.sum(c).alias(c) for c in ("points", "sum_lat", "sum_lon")])


def merge_gps_partials(parts: DataFrame, by: str, digits: int = 6) -> DataFrame:
    """Points and averages per ``by`` from any number of partial rows per group."""
    g = parts.groupBy(by).agg(F.sum("points").alias("points"), F.sum("sum_lat").alias("sum_lat"),
                              F.sum("sum_lon").alias("sum_lon"))
    return g.select(by, "points", F.round(F.col("sum_lat") / F.col("points"), digits).alias("avg_lat"),
                    F.round(F.col("sum_lon") / F.col("points"), digits).alias("avg_lon"))


def gps_count_by(gps: DataFrame, by: str = "speed_kph") -> DataFrame:
    return gps.groupBy(by).agg(F.count(F.lit(1)).alias("count"))


def column_rows(df: DataFrame) -> DataFrame:
    """(column, type, nullable, n_values) of a stored table: its schema as rows, with the values that are not null, counted in one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    facts = F.array(*[F.struct(F.lit(name).alias("column"), F.lit(kind).alias("type"), F.lit(nullable).alias("nullable"), F.col(name).alias("n_values"))
                      for name, kind, nullable in schema_rows(df)])
    return counts.select(F.inline(facts))


def schema_rows(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(column, type, nullable) of a frame's schema — ``printSchema`` as data."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]

