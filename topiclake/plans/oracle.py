"""DuckDB SQL that recomputes each registered query from the base tables.

The oracle never reads our JSON: it projects the tables into the three
topics itself, so a parse or projection error of ours shows up as a
difference.  Key partitions use Spark's Murmur3 (x86, 32 bit, seed 42) of a
BIGINT written in plain SQL arithmetic.
"""

from __future__ import annotations


def ms(x: str) -> str:
    """Millisecond event-time text, as ``date_format(x, 'yyyy-MM-dd HH:mm:ss.SSS')``."""
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%g')"


ORDERS_TOPIC = f"""orders_topic AS (
  SELECT o_orderkey AS _sequence_id,
         'pay-' || o_orderkey AS payment_id,
         'ord-' || o_orderkey AS order_key,
         o_totalprice AS amount,
         CASE o_custkey % 3 WHEN 0 THEN 'BRL' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency,
         CASE o_orderkey % 3 WHEN 0 THEN 'Card' WHEN 1 THEN 'Pix' ELSE 'Boleto' END AS method,
         CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'pending' ELSE 'succeeded' END AS status,
         CASE o_custkey % 3 WHEN 0 THEN 'Visa' WHEN 1 THEN 'MasterCard' ELSE 'Elo' END AS card_brand,
         lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS card_last4,
         CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.9 AS DECIMAL(2,1)), 2) AS DOUBLE) AS net_amount,
         'BR' AS country,
         '10.0.' || (CAST(floor(o_orderkey / 256) AS BIGINT) % 256) || '.' || (o_orderkey % 256) AS ip_address,
         {ms('o_orderdate')} AS timestamp,
         {ms('o_orderdate')} AS dt_current_timestamp,
         o_orderpriority AS _priority
  FROM orders)"""

EVENTS_TOPIC = f"""events_topic AS (
  SELECT e.event_id AS _sequence_id,
         'evt-' || e.event_id AS event_id,
         'pay-' || e.user_id AS payment_id,
         CASE e.event_type WHEN 'click' THEN 'created' WHEN 'view' THEN 'authorized'
              WHEN 'purchase' THEN 'captured' WHEN 'signup' THEN 'succeeded' ELSE 'refunded' END AS event_name,
         {ms('e.ts')} AS event_timestamp,
         {ms('e.ts')} AS dt_current_timestamp,
         e.ts AS _ts, e.event_type AS _event_type, e.props AS _props
  FROM events e)"""

GPS_TOPIC = f"""gps_topic AS (
  SELECT o_orderkey AS _sequence_id,
         'gps-' || o_orderkey AS gps_id,
         'ord-' || o_orderkey AS order_id,
         CAST(-236000 + o_orderkey % 1001 AS DOUBLE) / 10000 AS lat,
         CAST(-467000 + (o_orderkey * 7) % 1001 AS DOUBLE) / 10000 AS lon,
         CAST(10 + o_orderkey % 51 AS INTEGER) AS speed_kph,
         CAST(50 + o_orderkey % 451 AS DOUBLE) / 10 AS accuracy_m,
         {ms('o_orderdate')} AS timestamp,
         {ms('o_orderdate')} AS dt_current_timestamp
  FROM orders)"""

TOPICS = ",\n".join([ORDERS_TOPIC, EVENTS_TOPIC, GPS_TOPIC])

# Spark hash(bigint) → abs(h) % 3, over a relation ``keys(key)`` of non-negative keys.
MURMUR_PARTS = """m0 AS (SELECT key, (key % 4294967296)::HUGEINT AS lo, (key // 4294967296)::HUGEINT AS hi FROM keys),
m1 AS (SELECT key, (lo*3432918353)%4294967296 AS a, (hi*3432918353)%4294967296 AS b FROM m0),
m2 AS (SELECT key, (((a*32768)%4294967296 + a//131072)*461845907)%4294967296 AS a, (((b*32768)%4294967296 + b//131072)*461845907)%4294967296 AS b FROM m1),
m3 AS (SELECT key, b, xor(42::HUGEINT, a) AS h FROM m2),
m4 AS (SELECT key, b, (((h*8192)%4294967296 + h//524288)*5 + 3864292196)%4294967296 AS h FROM m3),
m5 AS (SELECT key, xor(h, b) AS h FROM m4),
m6 AS (SELECT key, xor((((h*8192)%4294967296 + h//524288)*5 + 3864292196)%4294967296, 8::HUGEINT) AS h FROM m5),
m7 AS (SELECT key, (xor(h, h//65536)*2246822507)%4294967296 AS h FROM m6),
m8 AS (SELECT key, (xor(h, h//8192)*3266489909)%4294967296 AS h FROM m7),
m9 AS (SELECT key, xor(h, h//65536) AS h FROM m8),
key_parts AS (SELECT key, (CASE WHEN h > 2147483647 THEN 4294967296 - h ELSE h END % 3)::INTEGER AS partition FROM m9)"""

BRONZE = f"""{TOPICS},
bronze_src AS (
  SELECT _sequence_id AS key, 'kafka-orders' AS topic FROM orders_topic
  UNION ALL SELECT _sequence_id, 'kafka-events' FROM events_topic
  UNION ALL SELECT _sequence_id, 'kafka-gps' FROM gps_topic),
keys AS (SELECT DISTINCT key FROM bronze_src),
{MURMUR_PARTS},
bronze AS (
  SELECT s.key, s.topic, p.partition,
         row_number() OVER (PARTITION BY s.topic, p.partition ORDER BY s.key) - 1 AS "offset"
  FROM bronze_src s JOIN key_parts p USING (key))"""


def with_topics(select: str) -> str:
    return f"WITH {TOPICS}\n{select}"


def with_bronze(select: str) -> str:
    return f"WITH {BRONZE}\n{select}"


ORDER_FIELDS = ("_sequence_id, payment_id, order_key, amount, currency, method, status, card_brand, card_last4, "
                "net_amount, country, ip_address, timestamp, dt_current_timestamp")
EVENT_FIELDS = "_sequence_id, event_id, payment_id, event_name, event_timestamp, dt_current_timestamp"
GPS_FIELDS = "_sequence_id, gps_id, order_id, lat, lon, speed_kph, accuracy_m, timestamp, dt_current_timestamp"


# Partition of a message by its text key: the first 32 bits of the key's MD5.
MESSAGE_PART = "(('0x' || substr(md5({key}), 1, 8))::BIGINT % 3)::INTEGER"


def _per_topic(topic_cte: str, key_expr: str, topic: str) -> str:
    """Per-topic bronze of one topic: message key and its partition, offsets by sequence id."""
    return f"""WITH {TOPICS},
src AS (SELECT _sequence_id, {key_expr} AS key, {MESSAGE_PART.format(key=key_expr)} AS partition FROM {topic_cte}),
per_topic AS (
  SELECT key, partition, row_number() OVER (PARTITION BY partition ORDER BY _sequence_id) - 1 AS "offset",
         '{topic}' AS topic, 0 AS "timestampType", _sequence_id FROM src)"""


PER_TOPIC_ROWS = f"""{TOPICS},
src AS (SELECT _sequence_id, order_key AS key, 'kafka-orders' AS topic, 'ordem' AS kafka_topic, payment_id AS link FROM orders_topic
  UNION ALL SELECT _sequence_id, payment_id, 'kafka-events', 'eventos', event_id FROM events_topic
  UNION ALL SELECT _sequence_id, order_id, 'kafka-gps', 'gps', gps_id FROM gps_topic),
parts AS (SELECT *, {MESSAGE_PART.format(key="key")} AS partition FROM src),
per_topic AS (SELECT *, row_number() OVER (PARTITION BY topic, partition ORDER BY _sequence_id) - 1 AS "offset", 0 AS "timestampType" FROM parts)"""
PER_TOPIC_ALL = f'WITH {PER_TOPIC_ROWS}\nSELECT key, partition, "offset", topic, "timestampType" FROM per_topic'

PER_TOPIC = {
    "orders": _per_topic("orders_topic", "order_key", "kafka-orders"),
    "events": _per_topic("events_topic", "payment_id", "kafka-events"),
    "gps": _per_topic("gps_topic", "order_id", "kafka-gps"),
}

_SILVER_ORDERS = f"""SELECT b.key, b.partition, b."offset", {', '.join('o.' + c for c in ORDER_FIELDS.split(', '))}
FROM bronze b JOIN orders_topic o ON b.key = o._sequence_id WHERE b.topic = 'kafka-orders' AND b.key % 97 <> 0"""


def _flatten(kind: str) -> str:
    cte = PER_TOPIC[kind]
    if kind == "orders":
        cols, src = ORDER_FIELDS, "orders_topic"
        ts = "strftime(o.timestamp::TIMESTAMP, '%Y-%m-%d %H:%M:%S')"
    elif kind == "events":
        cols, src = EVENT_FIELDS, "events_topic"
        ts = "strftime(o.event_timestamp::TIMESTAMP, '%Y-%m-%d %H:%M:%S')"
    else:
        cols, src = GPS_FIELDS, "gps_topic"
        ts = "strftime(o.timestamp::TIMESTAMP, '%Y-%m-%d %H:%M:%S')"
    sel = ", ".join("o." + c for c in cols.split(", "))
    return f"""{cte}
SELECT p.key, {sel}, {ts} AS kafka_timestamp FROM per_topic p JOIN {src} o ON p._sequence_id = o._sequence_id"""


_SUMMARY = """SELECT topic, partition, COUNT(*) AS n, MIN("offset") AS min_offset, MAX("offset") AS max_offset,
       COUNT(DISTINCT "offset") AS distinct_offsets, COUNT(DISTINCT key) AS distinct_keys
FROM bronze GROUP BY topic, partition"""

_EV_TIMES = "events_t AS (SELECT *, ts AS event_time FROM events)"

# Delivery of an event's time: ten days of January 2024 each.
_SLICE10 = "LEAST(CAST(floor((epoch(event_timestamp::TIMESTAMP) - 1704067200) / 864000) AS BIGINT), 2)"

ORACLE: dict[str, str] = {
    # ---------------------------------------------------------- sources
    "project_orders": with_topics(f"SELECT {ORDER_FIELDS} FROM orders_topic"),
    "project_events": with_topics(f"SELECT {EVENT_FIELDS} FROM events_topic"),
    "project_gps": with_topics(f"SELECT {GPS_FIELDS} FROM gps_topic"),
    "batch_read_orders": with_topics(f"SELECT {ORDER_FIELDS} FROM orders_topic"),
    "stream_read_orders": with_topics(f"SELECT {ORDER_FIELDS} FROM orders_topic"),
    "batch_read_offset_range": f'WITH {PER_TOPIC_ROWS}\nSELECT topic, key, partition, "offset" FROM per_topic '
                               'WHERE (partition <> 0 OR "offset" >= 100) AND (partition <> 1 OR "offset" < 400)',
    "multi_topic_read": with_bronze("SELECT topic, key FROM bronze_src"),
    "file_stream_read_events": with_topics(f"SELECT {EVENT_FIELDS}, 'kafka-events' AS _topic_name FROM events_topic"),
    "rescue_unknown_fields": "SELECT o_orderkey AS _sequence_id, 'priority' AS rescued_key, "
                             "o_orderpriority AS rescued_value FROM orders",
    "read_back_gps": with_topics(f"SELECT {GPS_FIELDS} FROM gps_topic"),
    "sql_select_bronze": with_bronze('SELECT key, topic, partition, "offset" FROM bronze'),
    # ---------------------------------------------------------- sinks
    "stream_named_orders": with_topics(f"SELECT order_key AS key, {ORDER_FIELDS} FROM orders_topic"),
    "bronze_multiplex_stream": with_bronze('SELECT key, topic, partition, "offset" FROM bronze'),
    "bronze_schema_growth": with_topics(
        "SELECT key, topic, CASE WHEN grown THEN event_name END AS event_name FROM ("
        "SELECT _sequence_id AS key, 'kafka-orders' AS topic, CAST(NULL AS VARCHAR) AS event_name FROM orders_topic "
        "UNION ALL SELECT _sequence_id, 'kafka-events', event_name FROM events_topic "
        "UNION ALL SELECT _sequence_id, 'kafka-gps', NULL FROM gps_topic) x, (VALUES (false), (true)) v(grown)"),
    "bronze_per_topic_stream": PER_TOPIC_ALL,
    "stream_gps_to_path": with_topics(f"SELECT {GPS_FIELDS} FROM gps_topic"),
    "bronze_per_topic_orders": PER_TOPIC["orders"] + '\nSELECT key, partition, "offset", topic, "timestampType" FROM per_topic',
    "bronze_per_topic_events": PER_TOPIC["events"] + '\nSELECT key, partition, "offset", topic, "timestampType" FROM per_topic',
    "bronze_per_topic_gps": PER_TOPIC["gps"] + '\nSELECT key, partition, "offset", topic, "timestampType" FROM per_topic',
    "to_topic_records": with_topics(
        "SELECT 'kafka-orders' AS topic, order_key AS key, _sequence_id FROM orders_topic "
        "UNION ALL SELECT 'kafka-events', payment_id, _sequence_id FROM events_topic "
        "UNION ALL SELECT 'kafka-gps', order_id, _sequence_id FROM gps_topic"),
    "topic_files_roundtrip": with_topics(f"SELECT {ORDER_FIELDS} FROM orders_topic"),
    # ---------------------------------------------------------- projections
    "select_rename": with_topics(
        "SELECT _sequence_id AS key, 'kafka-orders' AS topic, payment_id AS link_id FROM orders_topic "
        "UNION ALL SELECT _sequence_id, 'kafka-events', payment_id FROM events_topic "
        "UNION ALL SELECT _sequence_id, 'kafka-gps', order_id FROM gps_topic"),
    "kafka_record_as_text": PER_TOPIC["orders"] + """
SELECT p.key AS order_key, p.partition, p."offset", o.amount, o.status
FROM per_topic p JOIN orders_topic o ON p._sequence_id = o._sequence_id""",
    "flatten_orders": _flatten("orders"),
    "flatten_events": _flatten("events"),
    "flatten_gps": _flatten("gps"),
    "nested_event_name": with_topics("SELECT _sequence_id AS key, event_name FROM events_topic"),
    "tag_topic": with_topics(
        "SELECT _sequence_id, 'kafka-orders' AS _topic_name FROM orders_topic "
        "UNION ALL SELECT _sequence_id, 'kafka-events' FROM events_topic "
        "UNION ALL SELECT _sequence_id, 'kafka-gps' FROM gps_topic"),
    "bronze_batch": with_bronze(
        'SELECT key, topic, partition, "offset", '
        "strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(key), '%Y-%m-%d %H:%M:%S') AS timestamp FROM bronze"),
    "gps_points": with_topics("SELECT lat, lon, speed_kph FROM gps_topic"),
    "key_as_timestamp": "SELECT o_orderkey AS key, "
                        "strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(o_orderkey), '%Y-%m-%d %H:%M:%S') "
                        "AS key_time FROM orders",
    # ---------------------------------------------------------- filters
    "silver_orders": with_bronze(_SILVER_ORDERS),
    "silver_from_per_topic": PER_TOPIC["events"] + """
SELECT p.key, p.partition, p."offset", e._sequence_id, e.event_id, e.payment_id, e.event_name, e.event_timestamp
FROM per_topic p JOIN events_topic e ON p._sequence_id = e._sequence_id""",
    "gold_from_per_topic": with_topics(
        "SELECT status, COUNT(*) AS order_count, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount "
        "FROM orders_topic GROUP BY status"),
    "kafka_shape_multiplex": f'WITH {PER_TOPIC_ROWS}\nSELECT kafka_topic AS topic, partition, "offset", CAST(NULL AS BIGINT) AS key, '
                             "key AS message_key, link FROM per_topic",
    "bronze_with_rescue": with_bronze(
        "SELECT topic, CASE WHEN key % 89 <> 0 THEN key END AS key, CASE WHEN key % 89 <> 0 AND key % 7 = 0 THEN 'x' END AS extra, "
        "CASE WHEN key % 89 = 0 THEN '{bad ' || key END AS corrupt, CASE WHEN key % 89 = 0 THEN true END AS kept FROM bronze_src"),
    "bronze_demux_topic": with_bronze("SELECT key, partition, \"offset\" FROM bronze WHERE topic = 'kafka-orders'"),
    # ---------------------------------------------------------- aggregations
    "bronze_count_by_topic": with_bronze(
        "SELECT topic, COUNT(*) AS count, MIN(key) AS min_key, MAX(key) AS max_key FROM bronze "
        "GROUP BY topic ORDER BY topic"),
    "bronze_partition_distribution": with_bronze(
        "SELECT topic, partition, COUNT(*) AS count FROM bronze GROUP BY topic, partition ORDER BY topic, partition"),
    "bronze_max_offset": with_bronze(
        'SELECT topic, partition, MAX("offset") AS max_offset FROM bronze GROUP BY topic, partition '
        "ORDER BY topic, partition"),
    "bronze_total_rows": with_bronze("SELECT COUNT(*) AS total_rows FROM bronze"),
    "bronze_rows_per_table": with_topics(
        "SELECT 'kafka_bronze_ordem' AS table_name, COUNT(*) AS total_rows FROM orders_topic "
        "UNION ALL SELECT 'kafka_bronze_eventos', COUNT(*) FROM events_topic "
        "UNION ALL SELECT 'kafka_bronze_gps', COUNT(*) FROM gps_topic"),
    "topic_message_count": with_topics(
        "SELECT 'kafka-orders' AS topic, COUNT(*) AS message_count FROM orders_topic "
        "UNION ALL SELECT 'kafka-events', COUNT(*) FROM events_topic "
        "UNION ALL SELECT 'kafka-gps', COUNT(*) FROM gps_topic"),
    "stream_gps_avg_by_order": with_topics(
        "SELECT order_id, COUNT(*) AS points, round(avg(lat), 6) AS avg_lat, round(avg(lon), 6) AS avg_lon "
        "FROM gps_topic GROUP BY order_id"),
    "stream_gps_avg_by_speed": with_topics(
        "SELECT speed_kph, COUNT(*) AS points, round(avg(lat), 6) AS avg_lat, round(avg(lon), 6) AS avg_lon "
        "FROM gps_topic GROUP BY speed_kph"),
    "gps_count_by_speed": with_topics("SELECT speed_kph, COUNT(*) AS count FROM gps_topic GROUP BY speed_kph"),
    "orders_by_method": with_topics(
        "SELECT method, COUNT(*) AS count FROM orders_topic GROUP BY method ORDER BY count DESC, method"),
    "avg_amount_by_status": with_topics(
        "SELECT status, round(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount), 2) AS avg_amount, "
        "COUNT(*) AS count FROM orders_topic GROUP BY status"),
    "gold_status_summary": with_topics(
        "SELECT status, COUNT(*) AS order_count, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount "
        "FROM orders_topic GROUP BY status"),
    "orders_count_by_partition": PER_TOPIC["orders"] + "\nSELECT partition, COUNT(*) AS count FROM per_topic "
                                                       "GROUP BY partition ORDER BY partition",
    "orders_max_offset": PER_TOPIC["orders"] + '\nSELECT partition, MAX("offset") AS max_offset FROM per_topic '
                                               "GROUP BY partition ORDER BY partition",
    # ---------------------------------------------------------- windows
    "assign_offsets": with_bronze('SELECT topic, partition, key, "offset" FROM bronze'),
    "event_sequence": with_topics(
        "SELECT payment_id, event_id, event_name, event_timestamp, "
        "CAST(row_number() OVER (PARTITION BY payment_id ORDER BY event_timestamp, event_id) AS INTEGER) AS seq "
        "FROM events_topic"),
    # ---------------------------------------------------------- sorts / limits
    "bronze_last_10": with_bronze(
        'SELECT key, topic, partition, "offset" FROM bronze ORDER BY key DESC, topic DESC LIMIT 10'),
    "orders_latest_10": PER_TOPIC["orders"] + '\nSELECT key, partition, "offset" FROM per_topic '
                                              'ORDER BY "offset" DESC, partition DESC LIMIT 10',
    "gps_sorted_desc": with_topics(
        "SELECT gps_id, order_id, timestamp, row_number() OVER (ORDER BY timestamp DESC, length(gps_id) DESC, gps_id DESC) - 1 AS place "
        "FROM gps_topic"),
    "bronze_sample_5": with_bronze(
        'SELECT topic, key, partition, "offset" FROM bronze ORDER BY (key % 1000003 * 7919 + partition * 104729 + "offset" % 1000003 * 611953) % 1000003, topic, partition, "offset" LIMIT 5'),
    "topic_file_inventory": with_topics(
        "SELECT topic, COUNT(*) AS n_files, SUM(n)::BIGINT AS n_messages, MAX(n) AS largest_file FROM ("
        "SELECT 'kafka-orders' AS topic, _sequence_id // 1000 AS f, COUNT(*) AS n FROM orders_topic GROUP BY ALL "
        "UNION ALL SELECT 'kafka-events', _sequence_id // 1000, COUNT(*) FROM events_topic GROUP BY ALL "
        "UNION ALL SELECT 'kafka-gps', _sequence_id // 1000, COUNT(*) FROM gps_topic GROUP BY ALL) GROUP BY topic"),
    "last_100_per_topic": with_bronze(
        'SELECT topic, key, partition, "offset" FROM bronze '
        "QUALIFY row_number() OVER (PARTITION BY topic ORDER BY key DESC) <= 100"),
    # ---------------------------------------------------------- set operations
    "multiplex_topics": with_bronze("SELECT topic, key, partition FROM bronze"),
    "distinct_topics": with_bronze("SELECT DISTINCT topic FROM bronze"),
    # ---------------------------------------------------------- scalar functions
    "json_parse_orders": with_topics(f"SELECT {ORDER_FIELDS} FROM orders_topic"),
    "parse_event_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "key_partition": f"""WITH src AS (SELECT o_orderkey AS key, 'kafka-orders' AS topic FROM orders
  UNION ALL SELECT o_orderkey, 'kafka-gps' FROM orders
  UNION ALL SELECT event_id, 'kafka-events' FROM events),
keys AS (SELECT DISTINCT key FROM src),
{MURMUR_PARTS}
SELECT s.topic, s.key, p.partition FROM src s JOIN key_parts p USING (key)""",
    "net_amount_decimal": with_topics("SELECT _sequence_id, amount, net_amount FROM orders_topic"),
    "value_preview": "SELECT event_id, substring(props, 1, 100) AS value_preview FROM events",
    # ---------------------------------------------------------- stream control
    "stream_resume_no_duplicates": with_bronze(f"SELECT *, true AS several_batches FROM ({_SUMMARY}) s"),
    "stream_replay_idempotent": with_bronze(_SUMMARY),
    "stream_interleaved_runs": with_bronze(_SUMMARY),
    "stream_replay_duplicates": with_bronze(
        "SELECT topic, 2 * COUNT(*) AS total_rows, COUNT(DISTINCT key) AS distinct_keys, "
        "2 * COUNT(*) AS distinct_offsets FROM bronze_src GROUP BY topic"),
    "stream_read_from_offset": with_bronze(
        'SELECT b.topic, b.key, b.partition, b."offset" + c.n AS "offset" FROM bronze b JOIN '
        "(SELECT topic, partition, COUNT(*) AS n FROM bronze GROUP BY ALL) c ON b.topic = c.topic AND b.partition = c.partition"),
    "stream_bronze_sql_table": with_bronze(
        "SELECT topic, COUNT(*) AS in_table, COUNT(*) AS compacted, COUNT(*) AS offsets FROM bronze_src GROUP BY topic"),
    "describe_bronze_schema": with_bronze(
        """SELECT t.*, COALESCE(CASE "column" WHEN 'key' THEN c.k WHEN 'partition' THEN c.p WHEN 'offset' THEN c.o ELSE c.n END, 0) AS n_values
  FROM (VALUES ('key', 'bigint', true), ('value', 'string', true),
  ('topic', 'string', true), ('partition', 'int', true), ('offset', 'bigint', true),
  ('timestamp', 'timestamp', true), ('ingestion_timestamp', 'timestamp', true)) t("column", "type", nullable),
  (SELECT COUNT(key) AS k, COUNT(partition) AS p, COUNT("offset") AS o, COUNT(*) AS n FROM bronze) c"""),
    "list_bronze_tables": with_topics(
        "SELECT 'kafka_bronze_ordem' AS \"tableName\", COUNT(*) AS n_rows FROM orders_topic "
        "UNION ALL SELECT 'kafka_bronze_eventos', COUNT(*) FROM events_topic UNION ALL SELECT 'kafka_bronze_gps', COUNT(*) FROM gps_topic"),
    "stream_offset_range": with_bronze(
        "SELECT partition, \"offset\", m AS merged FROM bronze, (VALUES (false), (true)) AS v(m) "
        "WHERE topic = 'kafka-orders' AND ((partition = 0 AND \"offset\" >= 100 AND \"offset\" < 400) OR (partition = 1 AND \"offset\" >= 50))"),
    "bronze_typed_growth": """SELECT 'bigint' AS units_type, 'decimal(22,2)' AS weight_type, 'string' AS lot_type,
  'struct<row:decimal(2,1),shelf:bigint>' AS place_type, 'array<bigint>' AS tags_type, SUM(o_orderkey % 50)::BIGINT AS units,
  SUM(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE o_orderkey + 0.25 END)::DOUBLE AS weight, COUNT(DISTINCT o_orderkey) AS lots,
  SUM(o_orderkey % 7)::BIGINT AS shelves, SUM(CASE WHEN o_orderkey % 5 = 0 THEN 1.5 END)::DOUBLE AS "rows", SUM(o_orderkey % 4)::BIGINT AS tags, 0::BIGINT AS left_over FROM orders""",
    "stream_progress_rows": with_topics(
        "SELECT 0::BIGINT AS batch_id, COUNT(*) AS num_input_rows FROM orders_topic "
        "UNION ALL SELECT 0, COUNT(*) FROM events_topic UNION ALL SELECT 0, COUNT(*) FROM gps_topic"),
    "three_queries_total": with_topics(
        "SELECT 'kafka-orders' AS topic, COUNT(*) AS rows FROM orders_topic "
        "UNION ALL SELECT 'kafka-events', COUNT(*) FROM events_topic "
        "UNION ALL SELECT 'kafka-gps', COUNT(*) FROM gps_topic"),
    "batch_equals_stream": with_bronze("SELECT topic, COUNT(*) AS streamed_rows, 0::BIGINT AS differences FROM bronze_src GROUP BY topic"),
    # ---------------------------------------------------------- extensions
    "ext_events_tumbling": f"""WITH {_EV_TIMES}
SELECT strftime(time_bucket(INTERVAL 1 HOUR, event_time), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, COUNT(*) AS n
FROM events_t GROUP BY ALL""",
    "ext_events_sliding": f"""WITH {_EV_TIMES},
w AS (SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS s, event_type FROM events_t
      UNION ALL SELECT time_bucket(INTERVAL 1 HOUR, event_time) - INTERVAL 1 HOUR, event_type FROM events_t)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(s + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, event_type, COUNT(*) AS n
FROM w GROUP BY ALL""",
    "ext_events_session": f"""WITH {_EV_TIMES},
g AS (SELECT user_id, event_time,
             CASE WHEN lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time) IS NULL
                    OR event_time >= lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time) + INTERVAL 30 MINUTE
                  THEN 1 ELSE 0 END AS new_session FROM events_t),
s AS (SELECT *, SUM(new_session) OVER (PARTITION BY user_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT strftime(MIN(event_time), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(MAX(event_time) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, user_id, COUNT(*) AS n
FROM s GROUP BY user_id, sid""",
    "ext_watermark_counts": f"""WITH {_EV_TIMES},
c AS (SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS s, event_type, COUNT(*) AS n FROM events_t GROUP BY ALL)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, n
FROM c WHERE s + INTERVAL 1 HOUR <= (SELECT MAX(event_time) FROM events_t) - INTERVAL 10 MINUTE""",
    "ext_events_sliding_day": f"""WITH {_EV_TIMES},
p AS (SELECT CAST(floor(epoch(event_time) / 300) AS BIGINT) AS pane, event_type, COUNT(*) AS n FROM events_t GROUP BY ALL),
w AS (SELECT pane - k AS s, event_type, n FROM p, range(288) AS r(k))
SELECT strftime(TIMESTAMP '1970-01-01' + to_seconds(s * 300), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(TIMESTAMP '1970-01-01' + to_seconds(s * 300 + 86400), '%Y-%m-%d %H:%M:%S') AS window_end, event_type, SUM(n)::BIGINT AS n
FROM w GROUP BY s, event_type""",
    "ext_stream_payment_events": with_topics(
        "SELECT o.payment_id, strftime(o.paid_at, '%Y-%m-%d %H:%M:%S.%g') AS paid_at, e.event_id, e.event_name, e.event_timestamp AS event_time "
        "FROM (SELECT payment_id, TIMESTAMP '2024-01-01' + to_hours(4 * (_sequence_id % 174)) AS paid_at FROM orders_topic) o "
        "LEFT JOIN events_topic e ON o.payment_id = e.payment_id AND e.event_timestamp::TIMESTAMP BETWEEN o.paid_at AND o.paid_at + INTERVAL 1 DAY"),
    "ext_windows_and_late": with_topics(
        "SELECT kind, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, event_name, n, event_id FROM ("
        "WITH e AS (SELECT event_id, event_name, event_timestamp::TIMESTAMP AS t, time_bucket(INTERVAL 1 HOUR, event_timestamp::TIMESTAMP) AS s, "
        f"CASE WHEN _sequence_id * 7919 % 5 = 0 THEN (_sequence_id * 7919 // 5) % 3 ELSE {_SLICE10} END AS d FROM events_topic), "
        "m AS (SELECT d, max(t) AS t FROM e GROUP BY d), "
        "l AS (SELECT e.*, coalesce(s + INTERVAL 1 HOUR <= (SELECT max(t) FROM m WHERE m.d < e.d) - INTERVAL 10 MINUTE, false) AS late FROM e) "
        "SELECT 'late' AS kind, s, event_name, 1::BIGINT AS n, event_id FROM l WHERE late "
        "UNION ALL SELECT 'window', s, event_name, count(*), NULL FROM l WHERE NOT late GROUP BY s, event_name) x"),
    "ext_stream_sessions": with_topics(
        "SELECT payment_id, strftime(MIN(t), '%Y-%m-%d %H:%M:%S') AS window_start, strftime(MAX(t) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, COUNT(*) AS n FROM ("
        "SELECT *, SUM(opens) OVER (PARTITION BY payment_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS sid FROM ("
        "SELECT payment_id, event_timestamp::TIMESTAMP AS t, CASE WHEN lag(event_timestamp::TIMESTAMP) OVER w + INTERVAL 30 MINUTE > event_timestamp::TIMESTAMP THEN 0 ELSE 1 END AS opens "
        "FROM events_topic WINDOW w AS (PARTITION BY payment_id ORDER BY event_timestamp))) GROUP BY payment_id, sid"),
    "ext_stream_without_resent": with_topics(
        "SELECT event_id, event_name, event_timestamp FROM events_topic UNION ALL "
        "SELECT event_id, event_name, event_timestamp FROM events_topic WHERE _sequence_id % 10 = 7"),
    "stream_event_sequence": with_topics(
        "SELECT payment_id, event_id, event_name, row_number() OVER (PARTITION BY payment_id ORDER BY event_timestamp, event_id) AS seq, "
        f"coalesce(_sequence_id % 11 = 0 AND {_SLICE10} < 2 AND EXISTS (SELECT 1 FROM events_topic o WHERE o.payment_id = e.payment_id "
        f"AND (o.event_timestamp, o.event_id) > (e.event_timestamp, e.event_id) AND {_SLICE10.replace('event_timestamp', 'o.event_timestamp')} = {_SLICE10.replace('event_timestamp', 'e.event_timestamp')} "
        "AND o._sequence_id % 11 <> 0), false) AS out_of_order FROM events_topic e"),
    "stream_pattern_topics": with_topics(
        "SELECT 'kafka-orders' AS topic, COUNT(*) AS n, COUNT(*) AS keys, 0::BIGINT AS whole_lines, COUNT(*) AS offsets FROM orders_topic "
        "UNION ALL SELECT 'kafka-events', COUNT(*), COUNT(*), 0, COUNT(*) FROM events_topic "
        "UNION ALL SELECT 'kafka-unknown', COUNT(*), 0, COUNT(*), COUNT(*) FROM gps_topic"),
    "ext_position_at_event": with_topics(
        "SELECT e.payment_id, e.event_id, p.place FROM events_topic e ASOF LEFT JOIN ("
        "SELECT 'pay-' || l_orderkey AS payment_id, TIMESTAMP '2024-01-01' + to_minutes((l_partkey * 37 + l_suppkey * 11 + l_linenumber * 1009) % 41760) AS t, MAX(l_partkey % 1001)::BIGINT AS place "
        "FROM lineitem GROUP BY ALL) p ON e.payment_id = p.payment_id AND e.event_timestamp::TIMESTAMP >= p.t"),
    "ext_order_gps_join": with_topics(
        "SELECT o.order_key, o.amount, o.status, g.lat, g.lon, g.speed_kph FROM orders_topic o "
        "JOIN gps_topic g ON o.order_key = g.order_id"),
    "ext_payment_events_join": with_topics(
        "SELECT o.payment_id, o.status, e.n_events, e.first_event, e.last_event FROM orders_topic o JOIN "
        "(SELECT payment_id, COUNT(*) AS n_events, MIN(event_timestamp) AS first_event, "
        "MAX(event_timestamp) AS last_event FROM events_topic GROUP BY payment_id) e ON o.payment_id = e.payment_id"),
}
