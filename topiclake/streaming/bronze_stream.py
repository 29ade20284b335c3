"""Streamed bronze: exactly-once, gap-free offsets across micro-batches, restarts and runs.

A window over a stream is refused, and would restart at 0 each micro-batch
anyway.  So each micro-batch goes through ``foreachBatch``:

1. the commit log next to the table holds, for every (run, batch), one entry: its
   place in one global order, and per (topic, partition) the first offset it
   uses and the next one after it.  A replayed batch reads its own entry;
   a new batch starts where the log's last entry ends, whichever run wrote it;
2. a new batch counts its rows, claims the next place in the order (the claim file is
   created exclusively: a second writer at work on the same table is refused) and
   writes its entry *before* the rows;
3. rows get offsets within the batch + the entry's first ones and are written with
   dynamic partition overwrite on (``topic``, ``_run``, ``_batch_id``): a replay
   overwrites its own folders with the same rows.

``_run`` names the checkpoint: a query on a fresh checkpoint appends a new run
after everything already there.  The tag starts with a letter, and tables are
read with an explicit schema, so no tag or topic name is ever read as a number.

``compact`` merges the folders of finished batches.  What it is about to do stands in the commit log first: a plan
before the merged rows are written, a swap before the old folders go.  Readers leave out merged rows that are only planned and old
rows that are swapped, and the next ``compact`` ends what a crash left, so a row is there once at any moment.
"""

from __future__ import annotations

import hashlib
import json
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST
from pyspark.sql.streaming import StreamingQuery

from topiclake import session
from topiclake.operators import bronze as B
from topiclake.operators.offsets import assign_offsets, with_tie
from topiclake.schemas import BRONZE_MULTIPLEX, BRONZE_PER_TOPIC
from topiclake.sources.topics import union_topics
from topiclake.streaming import control

LOG_DIR = "__commits"
COMPACTED = "r0compacted"
_PLAIN = "!$&()+,;@ -._~|<>`"  # what a partition folder's name keeps as it is, besides letters and digits


class CommitLog:
    """Entries of one streamed table, each a small JSON file found by its exact path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, f"{path.rstrip('/')}{LOG_DIR}"

    def _entry(self, run: str, batch_id: int) -> str:
        return f"{self.root}/entries/{run}-{batch_id}.json"

    def entry(self, run: str, batch_id: int) -> dict | None:
        text = session.read_text(self.spark, self._entry(run, batch_id))
        return json.loads(text) if text else None

    def last(self) -> dict | None:
        """The entry with the highest place."""
        head = session.read_text(self.spark, f"{self.root}/head.json")
        return self.entry(*json.loads(head)) if head else None

    def append(self, run: str, batch_id: int, counts: dict[tuple, int]) -> dict:
        """A new entry after the last one."""
        last = self.last()
        before = {(t, p): n for t, p, n in last["next"]} if last else {}
        place = last["place"] + 1 if last else 0
        mine = json.dumps([run, batch_id])
        claim = f"{self.root}/claims/{place}.json"
        if not session.write_text(self.spark, claim, mine, overwrite=False) and session.read_text(self.spark, claim) != mine:
            raise RuntimeError(f"another writer is at work on this table: {claim} is not ours; "
                               "delete the claim if that writer died before its entry was written")
        after = before | {k: before.get(k, 0) + n for k, n in counts.items()}
        entry = {"place": place, "run": run, "batch_id": batch_id,
                 "base": [[*k, before.get(k, 0)] for k in sorted(counts, key=str)],
                 "next": [[*k, n] for k, n in sorted(after.items(), key=str)]}
        session.write_text(self.spark, self._entry(run, batch_id), json.dumps(entry), overwrite=True)
        self.settle(entry)
        return entry

    def settle(self, entry: dict) -> None:
        """Points the head at the entry, unless it is behind."""
        last = self.last()
        if last is None or last["place"] < entry["place"]:
            session.write_text(self.spark, f"{self.root}/head.json", json.dumps([entry["run"], entry["batch_id"]]), overwrite=True)


    # ------------------------------------------------------------ bounded reads

    def at(self, place: int) -> dict | None:
        """The entry of a place."""
        claim = session.read_text(self.spark, f"{self.root}/claims/{place}.json")
        return self.entry(*json.loads(claim)) if claim else None

    def _first(self, last: int, holds) -> int:
        """The first place up to ``last`` whose entry holds; ``last`` + 1 if none does.  Entries grow with their place, so halves are enough."""
        lo, hi = 0, last + 1
        while lo < hi:
            mid = (lo + hi) // 2
            entry = self.at(mid)
            if entry is not None and holds(entry):
                hi = mid
            else:
                lo = mid + 1
        return lo

    def places(self, topic: str, partition: int, start: int, end: int | None) -> tuple[int, int]:
        """Places [first, last) whose entries have offsets of a topic partition from ``start`` to ``end`` (excluded; None: no end)."""
        newest = self.last()
        if newest is None:
            return 0, 0
        after = lambda e: next((n for t, p, n in e["next"] if (t, p) == (topic, partition)), 0)
        first = self._first(newest["place"], lambda e: after(e) > start)
        last = newest["place"] + 1 if end is None else self._first(newest["place"], lambda e: after(e) >= end) + 1
        return first, max(first, min(last, newest["place"] + 1))

    def batches(self, first: int, last: int) -> list[tuple[str, int]]:
        """(run, batch) of the places [first, last)."""
        return [(e["run"], e["batch_id"]) for e in map(self.at, range(first, last)) if e]

    def merged(self) -> list[dict]:
        """What each compaction merged: number, and per topic partition the first and the next offset."""
        return [json.loads(session.read_text(self.spark, f)) for f, _, _ in session.file_stamps(self.spark, f"{self.root}/merged") if f.endswith(".json")]

    # ------------------------------------------------------------ compaction

    def note(self, step: str, what: dict) -> None:
        """The step of the compaction in progress: ``plan``, then ``swap``."""
        session.replace_text(self.spark, f"{self.root}/compaction/{step}.json", json.dumps(what))

    def noted(self) -> tuple[dict | None, dict | None]:
        """(plan, swap) of a compaction that has not ended."""
        plan, swap = (session.read_text(self.spark, f"{self.root}/compaction/{s}.json") for s in ("plan", "swap"))
        return (json.loads(plan) if plan else None), (json.loads(swap) if swap else None)

    def ended(self) -> None:
        for step in ("plan", "swap"):  # in this order: a swap alone is ended again, a plan alone would be undone
            session.delete(self.spark, f"{self.root}/compaction/{step}.json")

    def follow(self, table: str) -> None:
        """A catalog table that shows this folder, and is to learn of compactions."""
        session.write_text(self.spark, f"{self.root}/tables/{hashlib.sha1(table.encode()).hexdigest()}.txt", table, overwrite=True)

    def followers(self) -> list[str]:
        return [session.read_text(self.spark, f) for f, _, _ in session.file_stamps(self.spark, f"{self.root}/tables") if f.endswith(".txt")]


class BronzeBatchWriter:
    """``foreachBatch`` function: flat bronze rows of a micro-batch → offsets → Parquet folder.

    ``layout="multiplex"``: rows of :func:`bronze.bronze_rows`, offsets in
    (key, value) order, multiplex columns.  ``layout="per_topic"``: rows of
    :func:`bronze.kafka_rows`, offsets in the producer's sequence, per-topic
    columns (one folder per topic under ``path``).  Columns beyond the layout's
    are kept, so the table grows with its input.  ``table`` names a catalog table
    over the folder that learns of each batch as it is written.
    """

    def __init__(self, path: str, run: str, method: str = "split", leaf_rows: int | None = None,
                 layout: str = "multiplex", table: str | None = None):
        self.path = path.rstrip("/")
        self.run = run
        self.method = method
        self.leaf_rows = leaf_rows
        self.layout = layout
        self.table = table

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{self.path}__staged/{self.run}-{batch_id}"
        batch = with_tie(batch)
        batch.write.mode("overwrite").option("compression", "zstd").parquet(staged)  # the messages are parsed once; counts, offsets and rows are read from here
        try:
            self._write(spark, spark.read.schema(batch.schema).parquet(staged), batch_id)
        finally:
            session.delete(spark, staged)

    def _write(self, spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        log = CommitLog(spark, self.path)
        entry = log.entry(self.run, batch_id)
        if entry is None:
            counts = {(r["topic"], r["partition"]): r["n"]  # a row per topic partition
                      for r in batch.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n")).collect()}
            if not counts:
                return
            entry = log.append(self.run, batch_id, counts)
        else:
            log.settle(entry)
        base = spark.createDataFrame([tuple(x) for x in entry["base"]], "topic STRING, partition INT, base BIGINT")
        order = B.multiplex_order() if self.layout == "multiplex" else B.kafka_order()
        rows = assign_offsets(batch, order=order, method=self.method, leaf_rows=self.leaf_rows, base=base, written=True)
        known = {"key", "value", "topic", "partition", "offset", "timestamp", "timestampType", "_seq"}
        more = [c for c in rows.columns if c not in known and not c.startswith("_tl_")]
        stamp = "ingestion_timestamp" if self.layout == "multiplex" else "bronze_ingestion_timestamp"
        columns = B.MULTIPLEX_COLUMNS if self.layout == "multiplex" else B.PER_TOPIC_COLUMNS
        out = rows.withColumns({stamp: F.current_timestamp(), "_run": F.lit(self.run), "_batch_id": F.lit(batch_id).cast("long")})
        out = out.select(*columns, *more, "_run", "_batch_id")
        (out.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
            .partitionBy("topic", "_run", "_batch_id").parquet(self.path))
        if self.table:
            parts = " ".join(f"PARTITION (topic={_sql(t)}, _run='{self.run}', _batch_id={batch_id})"
                             for t in sorted({t for t, _, _ in entry["base"] if t is not None}))
            spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {parts}")
            spark.catalog.refreshTable(self.table)


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_schema(layout: str = "multiplex", more: ST.StructType | None = None) -> ST.StructType:
    """Schema of a streamed table: the layout's, columns added since, and the folder columns."""
    plain = BRONZE_MULTIPLEX if layout == "multiplex" else BRONZE_PER_TOPIC
    own = [f for f in plain.fields if f.name != "topic"]
    own += [f for f in (more or ST.StructType()).fields if f.name not in {*plain.names, "_run", "_batch_id"}]
    return ST.StructType([*own, ST.StructField("topic", ST.StringType()), ST.StructField("_run", ST.StringType()),
                          ST.StructField("_batch_id", ST.LongType())])


def declare_table(spark: SparkSession, name: str, path: str, layout: str = "multiplex") -> str:
    """A catalog table (``database.table``) over a streamed folder, with the folders that are there."""
    database, _, table = name.partition(".")
    session.ensure_database(spark, database)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(layout).fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({columns}) USING parquet "
              f"PARTITIONED BY (topic, _run, _batch_id) LOCATION '{path}'")
    if session.path_exists(spark, path):
        spark.sql(f"MSCK REPAIR TABLE `{database}`.`{table}`")
    CommitLog(spark, path).follow(f"`{database}`.`{table}`")
    return f"`{database}`.`{table}`"


def read_bronze(spark: SparkSession, path: str, layout: str = "multiplex", merge_schema: bool = False) -> DataFrame:
    """The streamed bronze table; ``merge_schema`` adds the columns that any batch has beyond the layout's."""
    more = spark.read.option("mergeSchema", "true").parquet(path).schema if merge_schema else None
    return settled(spark.read.schema(table_schema(layout, more)).parquet(path), path)  # lists the files before the log is asked


def settled(rows: DataFrame, path: str) -> DataFrame:
    """Rows of the streamed table at ``path`` without what a compaction in progress has there twice."""
    plan, swap = CommitLog(rows.sparkSession, path).noted()
    if swap:
        return _without(rows, swap["gone"])
    if plan:
        return rows.where((F.col("_run") != COMPACTED) | (F.col("_batch_id") != plan["number"]))
    return rows


def read_offsets(spark: SparkSession, path: str, topic: str, starting: dict[int, int], ending: dict[int, int] | None = None,
                 layout: str = "multiplex") -> DataFrame:
    """Rows of ``topic`` from ``starting`` to ``ending`` offsets per partition (start included, end excluded; partitions not in
    ``starting`` are not read, those not in ``ending`` have no end).

    The commit log says which micro-batches hold these offsets (halving over its places, whose offsets grow), so only their folders
    are listed and opened: what is read follows the range, not the table.
    """
    path, ending = path.rstrip("/"), ending or {}
    log = CommitLog(spark, path)
    spans = {p: log.places(topic, p, lo, ending.get(p)) for p, lo in starting.items()}
    wanted = {x for first, last in spans.values() for x in log.batches(first, last)}
    wanted |= {(COMPACTED, m["number"]) for m in log.merged()
               if any(t == topic and p in starting and hi > starting[p] and (p not in ending or lo < ending[p]) for t, p, lo, hi in m["spans"])}
    plan, swap = log.noted()
    wanted -= {(r, b) for r, b in swap["gone"]} if swap else {(COMPACTED, plan["number"])} if plan else set()
    folder = f"{path}/topic={quote(topic, safe=_PLAIN)}"
    folders = [f for r, b in sorted(wanted) if session.path_exists(spark, f := f"{folder}/_run={r}/_batch_id={b}")]
    if not folders:
        return spark.createDataFrame([], table_schema(layout))
    rows = spark.read.schema(table_schema(layout)).option("basePath", path).parquet(*folders)
    bounds = F.lit(False)
    for p, lo in starting.items():
        one = (F.col("partition") == p) & (F.col("offset") >= lo)
        bounds = bounds | (one & (F.col("offset") < ending[p]) if p in ending else one)
    return rows.where(bounds)


def _without(rows: DataFrame, batches: list) -> DataFrame:
    """``rows`` of other batches: folder columns alone, so the folders are not opened."""
    by_run: dict[str, list[int]] = {}
    for run, batch in batches:
        by_run.setdefault(run, []).append(batch)
    gone = F.lit(False)
    for run, ids in by_run.items():
        gone = gone | ((F.col("_run") == run) & F.col("_batch_id").isin(ids))
    return rows.where(~gone)


def compact(spark: SparkSession, path: str, layout: str = "multiplex") -> int:
    """Merges the batches of a table into one folder per topic; returns how many went.

    Only while no query writes the table.  The last batch of each run stays as it
    is, as a restart may replay it.  Catalog tables over the folder (``declare_table``) get the new
    folders and lose the old ones; a reader by name meanwhile may see either.  A compaction that
    died is ended first: undone up to its swap, carried through after it.
    """
    path = path.rstrip("/")
    log = CommitLog(spark, path)
    plan, swap = log.noted()
    if swap:
        _swap(spark, log, path, swap)
    elif plan:
        _forget(spark, log, [[COMPACTED, plan["number"]]])
        session.delete_matching(spark, f"{path}/topic=*/_run={COMPACTED}/_batch_id={plan['number']}")
        log.ended()
    rows = read_bronze(spark, path, layout, merge_schema=True)
    batches = {(r["_run"], r["_batch_id"]) for r in rows.select("_run", "_batch_id").distinct().collect()}
    newest: dict[str, int] = {}
    for run, batch in batches:
        newest[run] = max(newest.get(run, -1), batch)
    gone = sorted(x for x in batches if x[0] != COMPACTED and x[1] < newest[x[0]])
    if not gone:
        return 0
    step = {"number": newest.get(COMPACTED, -1) + 1, "gone": gone}
    spans: dict[tuple, list[int]] = {}
    for run, batch in gone:
        entry = log.entry(run, batch)
        after = {(t, p): n for t, p, n in entry["next"]}
        for t, p, base in entry["base"]:
            span = spans.setdefault((t, p), [base, after[t, p]])
            spans[t, p] = [min(span[0], base), max(span[1], after[t, p])]
    session.replace_text(spark, f"{log.root}/merged/{step['number']}.json", json.dumps({"number": step["number"], "spans": [[*k, *v] for k, v in spans.items()]}))
    log.note("plan", step)
    old = spark.createDataFrame(gone, "_run STRING, _batch_id BIGINT")
    kept = rows.join(F.broadcast(old), ["_run", "_batch_id"], "left_semi").drop("_run", "_batch_id")
    kept = kept.withColumns({"_run": F.lit(COMPACTED), "_batch_id": F.lit(step["number"]).cast("long")})
    (kept.repartition("topic", F.spark_partition_id()).write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
     .partitionBy("topic", "_run", "_batch_id").parquet(path))
    log.note("swap", step)
    _swap(spark, log, path, step)
    return len(gone)


def _forget(spark: SparkSession, log: CommitLog, batches: list) -> None:
    """Takes the folders of batches out of the catalog tables (the files stay)."""
    gone = {(run, str(batch)) for run, batch in batches}
    for table in log.followers():
        if spark.catalog.tableExists(table):
            parts = [dict(x.split("=", 1) for x in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
            old = [f"PARTITION (topic={_sql(unquote(p['topic']))}, _run='{p['_run']}', _batch_id={p['_batch_id']})"
                   for p in parts if (p["_run"], p["_batch_id"]) in gone]
            if old:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(old))


def _swap(spark: SparkSession, log: CommitLog, path: str, step: dict) -> None:
    """Merged folder in, old folders out: first in the catalog tables, then on disk, then in the log."""
    merged = session.matching(spark, f"{path}/topic=*/_run={COMPACTED}/_batch_id={step['number']}")
    parts = " ".join(f"PARTITION (topic={_sql(unquote(p.split('/topic=')[-1].split('/')[0]))}, _run='{COMPACTED}', _batch_id={step['number']})" for p in merged)
    tables = [t for t in log.followers() if spark.catalog.tableExists(t)]
    for table in tables:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    _forget(spark, log, step["gone"])
    for run, batch in step["gone"]:
        session.delete_matching(spark, f"{path}/topic=*/_run={run}/_batch_id={batch}")
    for table in tables:
        spark.catalog.refreshTable(table)
    log.ended()


def read_bronze_stream(spark: SparkSession, path: str, starting: dict | None = None) -> DataFrame:
    """The bronze table as a stream; ``starting`` = {(topic, partition): offset} keeps later rows only.

    ``starting=latest_offsets(...)`` taken when the consumer starts is the
    file-table form of Kafka's ``startingOffsets=latest``.
    """
    rows = spark.readStream.schema(table_schema()).parquet(path)
    if starting:
        cond = None
        for (topic, part), off in starting.items():
            c = (F.col("topic") == topic) & (F.col("partition") == part) & (F.col("offset") > off)
            cond = c if cond is None else cond | c
        known = None
        for topic, part in starting:
            c = (F.col("topic") == topic) & (F.col("partition") == part)
            known = c if known is None else known | c
        rows = rows.where(cond | ~known)
    return rows


def latest_offsets(bronze: DataFrame) -> dict:
    """{(topic, partition): largest offset} — one row per topic partition, a bounded result."""
    return {(r["topic"], r["partition"]): r["max_offset"]
            for r in bronze.groupBy("topic", "partition").agg(F.max("offset").alias("max_offset")).collect()}


def start_bronze_stream(
    parsed_topics: list[DataFrame],
    path: str,
    name: str,
    checkpoint: str,
    trigger: str | None = "5 seconds",
    keep_raw: bool = False,
    time_from: str = "key",
    method: str = "split",
    table: str | None = None,
) -> StreamingQuery:
    """One query over the union of the topic streams → bronze multiplex at ``path``.

    Each topic becomes flat bronze rows *before* the union, so every value is
    serialised from its own topic's record (same text as by batch).  ``table``
    (``database.table``) makes the growing folder readable by name in SQL.
    """
    rows = union_topics([B.bronze_rows(t, keep_raw, time_from) for t in parsed_topics])
    full = declare_table(rows.sparkSession, table, path) if table else None
    writer = BronzeBatchWriter(path, run=run_of(checkpoint), method=method, table=full)
    return control.start(rows, name, checkpoint, sink="foreachBatch", foreach_batch=writer, trigger=trigger)


def start_bronze_pattern(spark: SparkSession, root: str, pattern: str, path: str, name: str, checkpoint: str, trigger: str | None = "5 seconds",
                         kinds: dict[str, str] | None = None, table: str | None = None, **limits) -> StreamingQuery:
    """One query over every topic folder below ``root`` whose name matches ``pattern``, whenever it appears → bronze multiplex."""
    from topiclake.sources.topics import read_pattern

    full = declare_table(spark, table, path) if table else None
    rows = B.pattern_rows(read_pattern(spark, root, pattern, kinds, **limits))
    writer = BronzeBatchWriter(path, run=run_of(checkpoint), table=full)
    return control.start(rows, name, checkpoint, sink="foreachBatch", foreach_batch=writer, trigger=trigger)


def start_per_topic_stream(
    text_topics: dict[str, DataFrame],
    path: str,
    name: str,
    checkpoint: str,
    trigger: str | None = "5 seconds",
    method: str = "split",
) -> StreamingQuery:
    """Per-topic bronze (all Kafka metadata) from topic folders: ``{kind: read_topic_text(...)}`` →
    ``path/topic=<name>/``, offsets per topic partition in the producer's sequence."""
    from topiclake.sources.fixtures import MESSAGE_KEY

    writer = BronzeBatchWriter(path, run=run_of(checkpoint), method=method, layout="per_topic")
    rows = union_topics([B.kafka_rows(df, MESSAGE_KEY[kind]) for kind, df in text_topics.items()])
    return control.start(rows, name, checkpoint, sink="foreachBatch", foreach_batch=writer, trigger=trigger)


def start_kafka_bronze(spark: SparkSession, spec, path: str, name: str, checkpoint: str,
                       trigger: str | None = "5 seconds") -> StreamingQuery:
    """Per-topic bronze straight from Kafka: partition and offset come from the broker, so this is a
    plain append stream (the file sink's log makes it exactly once), laid out by ``topic``."""
    from topiclake.sources.topics import read_kafka, records_as_text

    rows = records_as_text(read_kafka(spark, spec, "stream"))
    return control.start(B.per_topic(rows), name, checkpoint, sink="parquet", path=path, trigger=trigger,
                         partition_by=("topic",))


def run_of(checkpoint: str) -> str:
    """The run tag of a checkpoint: a query on a fresh checkpoint is a new run."""
    return "r" + hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]
