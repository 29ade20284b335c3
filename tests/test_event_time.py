"""Event time on streams: joins, late rows, sessions, resent messages, sequences; any split of the input, replays, restarts."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from topiclake import session
from topiclake.operators import extensions as E
from topiclake.operators.silver import event_sequence
from topiclake.plans import registry as R
from topiclake.plans import topics as P
from topiclake.streaming import control as C
from topiclake.streaming import event_time as ET
from topiclake.streaming import sequence as SQ

START = dt.datetime(2024, 1, 1)
SCHEMA = "key STRING, id STRING, t TIMESTAMP"


def run_split(spark, batches, build, name, sink=None):
    """Streams each batch of rows (plus a beat at the end) as one delivery; the query restarts in between."""
    P.prepared(spark)
    folder, out, cp = (session.fresh_path(spark, "streams", f"{name}_{x}") for x in ("in", "out", "cp"))
    queries = []
    for rows in [*batches, [(None, None, dt.datetime.fromisoformat(ET.BEAT))]]:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        df = build(spark.readStream.schema(SCHEMA).parquet(folder))
        how = {"sink": "foreachBatch", "foreach_batch": sink(out)} if sink else {"path": out}
        queries.append(C.run_to_end(C.start(df, f"{name}_{out[-8:]}", cp, trigger="availableNow", **how)))
    return out, df.schema, queries


def events(seed, n=300, keys=5, hours=60):
    rng = random.Random(seed)
    times = [START + dt.timedelta(seconds=rng.randrange(hours * 3600)) for _ in range(n)]
    return [(f"k{rng.randrange(keys)}" if rng.random() > 0.3 else "hot", f"e{i}", t) for i, t in enumerate(times)], rng


def test_join_restarts_and_lets_go_of_state(spark, sf):
    out, queries = R.stream_payment_events(spark, sf)
    held = [q.lastProgress["stateOperators"][0]["numRowsTotal"] for q in queries]
    n = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert max(held[:-1]) > 100 and held[-1] == 0
    got = spark.read.parquet(out)
    assert got.select("payment_id").distinct().count() == n and got.where("event_id IS NULL").count() > 0


def test_a_restarted_join_does_not_put_in_what_it_let_go(spark, sf, monkeypatch):
    cp, most = session.fresh_path(spark, "checkpoints", "join_state"), spark.sparkContext.defaultParallelism + 3
    monkeypatch.setattr(C, "checkpoint_for", lambda *_: cp)
    name = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    with session.settings(spark, {"spark.sql.shuffle.partitions": str(most)}):
        _, queries = R.stream_payment_events(spark, sf)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(most) and spark.conf.get(name) == "true"
    (state,) = queries[0].lastProgress["stateOperators"]
    assert state["numShufflePartitions"] == most - 3  # few messages: one a core
    stored = [f.rsplit("/", 1)[1] for f, _, _ in session.file_stamps(spark, f"{cp}/state")]
    assert sum(f.endswith(".zip") for f in stored) >= most - 3 and not any(f.endswith(".changelog") for f in stored)


def test_state_partitions_follow_the_messages(spark):
    with session.settings(spark, {"spark.sql.shuffle.partitions": "100"}):
        n = [int(ET.join_state(spark, m)["spark.sql.shuffle.partitions"]) for m in (0, 90 * ET.STATE_MESSAGES - 1, 10**12)]
    assert n == [min(100, spark.sparkContext.defaultParallelism), 90, 100]


@pytest.mark.parametrize("seed,salts", [(1, 1), (2, 3)])
def test_windows_and_late_rows_are_all_rows(spark, seed, salts):
    rows, rng = events(seed)
    batches = [[r for r in rows if rng.random() < 0.3] for _ in range(1)]
    rest = [r for r in rows if r not in batches[0]]
    rng.shuffle(rest)
    batches += [rest[:100], [], rest[100:]]
    batches = [b for b in batches if b]
    out, schema, _ = run_split(spark, batches, lambda df: ET.windows_and_late(df, "key", "t", 3600, "2 hours", salts), "late", ET.WindowSink)
    windows, late = ET.read_windows(spark, out, schema)
    counts, missed, clock = Counter(), set(), None
    for b in batches:
        for k, i, t in b:
            start = t.replace(minute=0, second=0)
            if clock is not None and start + dt.timedelta(hours=1) <= clock:
                missed.add((k, i, t))
            else:
                counts[k, start] += 1
        newest = max(t for _, _, t in b) - dt.timedelta(hours=2)
        clock = max(clock or newest, newest)
    assert {(r.key, r.window_start): r.n for r in windows.collect()} == counts
    assert {(r.key, r.id, r.t) for r in late.collect()} == missed and missed
    assert sum(counts.values()) + len(missed) == len(rows)


def test_late_rows_keep_their_microseconds_and_nulls(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    batches = [[("a", "x", START + dt.timedelta(days=1))], [("a", None, t), (None, "y", t)]]
    out, schema, _ = run_split(spark, batches, lambda df: ET.windows_and_late(df, "key", "t", 60, "1 minute"), "micro", ET.WindowSink)
    windows, late = ET.read_windows(spark, out, schema)
    assert {(r.key, r.id, r.t) for r in late.collect()} == {("a", None, t), (None, "y", t)} and windows.count() == 1


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_sessions_of_any_split_are_the_batch_sessions(spark, seed):
    rows, rng = events(seed, hours=100)
    cuts = sorted(rng.randrange(1, len(rows)) for _ in range(rng.randrange(1, 4)))
    shuffled = rng.sample(rows, len(rows))
    batches = [b for b in (shuffled[i:j] for i, j in zip([0, *cuts], [*cuts, len(rows)])) if b]
    out, _, _ = run_split(spark, batches, lambda df: ET.stream_sessions(df, "key", "t", "30 minutes", delay="5 days"), "sess")
    got = spark.read.parquet(out).selectExpr("date_format(session_start, 'yyyy-MM-dd HH:mm:ss') AS window_start", "date_format(session_end, 'yyyy-MM-dd HH:mm:ss') AS window_end", "key", "n")
    want = E.session_counts(spark.createDataFrame(rows, SCHEMA).withColumn("event_time", F.col("t")), "30 minutes", by="key", method="window")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_resent_messages_and_bounded_state(spark):
    hour = dt.timedelta(hours=1)
    batches = [[("a", f"m{i}", START + i * hour) for i in range(48)] + [("a", "m3", START + 4 * hour)],
               [("a", f"m{i}", START + (i + 2) * hour) for i in range(46, 48)] + [("a", "m2", START + 60 * hour), ("a", "n", START + 96 * hour)]]
    out, _, queries = run_split(spark, batches, lambda df: ET.without_resent(df, ["id"], "t", "6 hours"), "dedup")
    got = Counter(r.id for r in spark.read.parquet(out).collect())
    assert got.pop("m2") == 2 and set(got.values()) == {1} and len(got) == 48
    held = [q.lastProgress["stateOperators"][0]["numRowsTotal"] for q in queries]
    assert held[0] <= 13 and held[-1] == 0


@pytest.mark.parametrize("seed", [6, 7])
def test_sequence_of_any_split(spark, seed):
    rng = random.Random(seed)
    rows = [(f"p{rng.randrange(4)}" if rng.random() > 0.05 else None, f"e{i:03}", START + dt.timedelta(minutes=rng.randrange(200))) for i in range(240)]
    schema = "payment_id STRING, event_id STRING, event_time TIMESTAMP"
    path = session.fresh_path(spark, "tables", "seq")
    batches = [[r for r in rows if rng.random() < 0.5]]
    batches += [[r for r in rows if r not in batches[0]][i::4] for i in range(4)]
    writer = SQ.SequenceWriter(path, "run", every=2)
    for i, b in enumerate(batches):
        writer(spark.createDataFrame(b, schema), i)
        if i in (1, 3):  # replayed, at and after a total
            writer(spark.createDataFrame(b[::-1], schema), i)
    df = spark.createDataFrame(rows, schema)
    got = SQ.read_sequence(spark, path, df.schema)
    want = event_sequence(df.withColumn("event_timestamp", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS")), method="window")
    cols = ["payment_id", "event_id", "seq"]
    assert Counter(map(tuple, got.select(cols).collect())) == Counter(map(tuple, want.select(cols).collect()))
    marked = {r.event_id for r in got.where("out_of_order").collect()}
    seen, late = defaultdict(lambda: (START, "")), set()
    for b in batches:
        late |= {i for p, i, t in b if (t, i) < seen[p]}
        for p, i, t in b:
            seen[p] = max(seen[p], (t, i))
    assert marked == late
    with pytest.raises(RuntimeError, match="another query"):
        SQ.SequenceWriter(path, "other")(df, 0)


def test_sequence_in_time_order_renumbers_nothing(spark):
    path = session.fresh_path(spark, "tables", "seq_ordered")
    df = spark.range(60).selectExpr("concat('p', id % 3) AS payment_id", "lpad(id, 3, '0') AS event_id", "timestamp_seconds(id * 60) AS event_time")
    for i in range(3):
        SQ.SequenceWriter(path, "run")(df.where(f"event_id >= '{20 * i:03}' AND event_id < '{20 * (i + 1):03}'"), i)
    got = SQ.read_sequence(spark, path, df.schema)
    assert got.where("out_of_order").count() == 0
    assert {(r.event_id, r.seq) for r in got.collect()} == {(f"{i:03}", i // 3 + 1) for i in range(60)}
