"""WARC archives of pages and their capture index.

Writing.  Each page becomes one record.  Of the pages with equal payloads (same
SHA-1 and length) the one with the smallest id is the response, the others are
revisits that name it.  Records are written by Spark's text writer: a row is
header and payload, the line separator is the two CRLFs that end a record, so the files
are WARC files, compressed with gzip, on any file system Spark knows, committed task by task.  Pages are written by size class, so that
a file holds about ``FILE_BYTES`` of payload at most, or one record.

Reading.  The files are read back whole (they are bounded) and parsed record by record by Content-Length; response payloads are hashed again.

Index.  The captures of each archive file are one run, sorted locally by (URL key, timestamp, page id, place in the file).  The
merge is external: run by run, a task cuts the sorted run at the bounds of key ranges into pieces, and each piece travels as one
row that holds its captures in order, so no shuffle takes its order away.  A range gets its pieces of the k runs and pulls them through a loser tree; nothing
is sorted again, and a task holds one range of bounded size.  The bounds come from every n-th capture of each run; as the
place in the file is part of the order, a very frequent URL, and many captures of one page id, spread over many ranges.  The ranges
are in order, so a range's first place is the sum of the sizes before it: the result is one globally ordered capture history, and each
capture names the file, and the offset and length in the unpacked file, where its record stands.

Edge cases: a null or empty html has an empty payload (a revisit of the first empty one).
A null url has the key ``-``; a page without id is the last among equal payloads.
Repeated rows are records of their own; captures that tie are in the order of file name and place.  Very long pages are files of their own; an empty table
has an empty archive and no capture.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import cut, received, send, shared

FILE_ROWS, FILE_BYTES, RANGE_ROWS = 2000, 64 << 20, 20_000
# Payload bytes up to which a page belongs to each size class (the last has no bound); captures named to the driver for the bounds of ranges, at most.
CLASSES, MOST_MARKS = (FILE_BYTES // FILE_ROWS, 1 << 20, 16 << 20), 100_000
BROADCAST_ROWS = 200_000  # of about 60 bytes
END = "\r\n\r\n"
# Fixed value: the format's name of a revisit by equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_START = 1_577_836_800  # a page has no time of its own: seconds from here, by its id


def url_key(url: str | None) -> str:
    """Host labels in reverse order, then path and query, lower-cased."""
    if not url:
        return "-"
    m = re.match(r"(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^#]*)", url.lower())
    host, rest = m[1], m[2]
    return ",".join(reversed(host.removeprefix("www.").split("."))) + ")" + (rest or "/")


def with_digests(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, html, bytes, sha1): the payload's length and its SHA-1 in hexadecimal."""
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    return slim.withColumns({"bytes": F.octet_length("html").cast("long"), "sha1": F.sha1(F.col("html").cast("binary"))})


def base32(digest: Column) -> Column:
    """Base32 of a 160-bit digest in hexadecimal: 32 letters of five bits, four at a time."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = [F.conv(F.substring(digest, 10 * i + 1, 10), 16, 10).cast("long") for i in range(4)]  # 40 bits each
    return F.concat(*(F.substr(letters, (F.shiftright(g, 35 - 5 * j).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for g in groups for j in range(8)))


def linked(pages: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``with_digests`` rows with a column first: the smallest id with the payload.

    Only payloads that occur more than once are joined: by broadcast if they are few, else by a shuffle
    (a payload with very many pages is split there at run time).
    """
    first = cut(pages.groupBy("sha1", "bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    j = pages.join(F.broadcast(first) if first.count() <= broadcast_rows else first, ["sha1", "bytes"], "left")
    return j.withColumn("first", F.coalesce("first", "page_id"))


def _class(size: Column) -> Column:
    return sum((F.when(size > c, 1).otherwise(0) for c in CLASSES), F.lit(0))


def size_classes(pages: DataFrame) -> list[tuple[int, int]]:
    """(class, largest payload) of the size classes that ``with_digests`` rows have."""
    return sorted(tuple(r) for r in pages.groupBy(_class(F.col("bytes"))).agg(F.max("bytes")).collect())


def write_archives(pages: DataFrame, path: str, file_rows: int = FILE_ROWS, file_bytes: int = FILE_BYTES, classes: list[tuple[int, int]] | None = None) -> None:
    """One WARC record per row of ``linked``, in files of at most ``file_rows`` records and about ``file_bytes`` of payload.

    ``classes``: ``size_classes`` of the rows, where they are known.
    """
    revisit = ~F.col("page_id").eqNullSafe(F.col("first"))
    payload = F.when(revisit, "").otherwise(F.col("html"))
    crlf = "\r\n"
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    stamp = F.date_format(F.timestamp_seconds(F.lit(_START) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")), F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
            F.concat(F.lit("WARC-Date: "), stamp), F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("-")), r"[\r\n]", "")), F.lit("Content-Type: text/html; charset=utf-8"),
            F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("sha1"))), F.concat(F.lit("WARC-Payload-Length: "), F.col("bytes")),
            F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{crlf}WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))),
            F.concat(F.lit("Content-Length: "), F.octet_length(payload))]
    record = F.concat(F.concat_ws(crlf, *head), F.lit(END), payload).alias("value")
    largest = (*CLASSES, None)
    for c, most in (size_classes(pages) if classes is None else classes) or [(0, 0)]:  # an empty table makes an empty archive
        rows = max(1, min(file_rows, file_bytes // max(1, largest[c] or most)))
        pages.where(_class(F.col("bytes")) == c).select(record).write.option("lineSep", END).option("maxRecordsPerFile", rows).text(f"{path}/size-{c}", compression="gzip")


def records(content: memoryview) -> Iterator[tuple[dict, memoryview]]:
    """Headers (with the record's own offset and length) and payload of each record of an archive."""
    at, raw = 0, content.obj if isinstance(content.obj, bytes) else bytes(content)
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        n = int(head["content-length"])
        head |= {"offset": at, "length": end + 4 + n + 4 - at}
        yield head, memoryview(raw)[end + 4 : end + 4 + n]
        at = end + 4 + n + 4


def _page(name: str | None) -> int | None:
    name = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return None if name in ("", "-") else int(name)


_CAPTURE = pa.schema([("key", pa.string()), ("stamp", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
                      ("kind", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
_DDL = "key string, stamp string, page_id long, file string, offset long, length long, url string, kind string, refers_to long, payload_bytes long, payload_digest string"


def _order(b: pa.RecordBatch) -> list[tuple]:
    """What captures are ordered by: the first five columns, null ids last."""
    key, stamp, page, file, offset = (b.column(i).to_pylist() for i in range(5))
    return [(k, t, p is None, p or 0, f, o) for k, t, p, f, o in zip(key, stamp, page, file, offset, strict=True)]


def _packed(b: pa.RecordBatch) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(b)
    return sink.getvalue()


def _unpacked(piece: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(piece) as source:
        return source.read_next_batch()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for every file under ``path``: (file, n, run), its captures as one sorted run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows, file = [], name.rpartition("/")[2]
                for head, payload in records(memoryview(gzip.decompress(content.as_buffer()))):
                    digest, n = head["warc-payload-digest"].removeprefix("sha1:"), int(head["warc-payload-length"])
                    if head["warc-type"] == "response":
                        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != n:
                            raise ValueError(f"payload and digest differ in {name}")
                    rows.append((url_key(head["warc-target-uri"]), head["warc-date"], _page(head["warc-record-id"]), file, head["offset"], head["length"], head["warc-target-uri"], head["warc-type"], _page(head.get("warc-refers-to")), n, digest))
                yield sorted_run(rows, file)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, n long, run binary")


def sorted_run(rows: list[tuple], file: str) -> pa.RecordBatch:
    """The captures of a file (columns of the index) as a row of ``read_archives``."""
    rows = sorted(rows, key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0, r[3], r[4]))
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(_CAPTURE)
    whole = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _CAPTURE, strict=True)], schema=_CAPTURE)
    return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([len(rows)], pa.int64()), pa.array([_packed(whole)], pa.binary())], ["file", "n", "run"])


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list]) -> None:
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(runs))
        self.head = [next(r, None) for r in self.runs] or [None]
        self.tree = [-1] * self.k
        for leaf in range(self.k):
            self._play(leaf, first=True)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def _play(self, leaf: int, first: bool = False) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.tree[node] < 0 and first:
                self.tree[node] = winner  # waits here for its opponent
                return
            if self._less(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while (head := self.head[w := self.tree[0]]) is not None:
            yield head
            self.head[w] = next(self.runs[w], None)
            self._play(w)


def range_bounds(runs: DataFrame, range_rows: int) -> list[tuple]:
    """Where the key order is cut into ranges of about ``range_rows`` captures: from every n-th capture of each run."""
    total = runs.agg(F.sum("n")).first()[0] or 0
    step = max(1, range_rows // 16, total // MOST_MARKS)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for piece in b.column(0):
                own = _unpacked(piece.as_buffer())
                own = pa.RecordBatch.from_arrays([own.column(i).take(pa.array(range(step // 2, len(own), step), pa.int64())) for i in range(5)], names=_CAPTURE.names[:5])
                if len(own):
                    yield own

    found = runs.select("run").mapInArrow(marks, "key string, stamp string, page_id long, file string, offset long").collect()  # MOST_MARKS and one a run
    found = sorted((r[0], r[1], r[2] is None, r[2] or 0, r[3], r[4]) for r in found)
    every = max(1, range_rows // step)
    return found[every::every]


def merged_history(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The captures of all ``runs`` with a column place: their number (from 0) in the order of key, timestamp, page id, file and offset."""
    spark = runs.sparkSession
    runs = cut(runs)
    bounds = range_bounds(runs, range_rows)
    sent = send(spark, bounds)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = received(sent)
        for b in batches:
            for file, run in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own = _unpacked(run.as_buffer())
                order, lo, part = _order(own), 0, 0
                while lo < len(order):
                    part = bisect.bisect_right(bounds, order[lo], part)
                    hi = bisect.bisect_left(order, bounds[part], lo) if part < len(bounds) else len(order)
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([file]), pa.array([_packed(own.slice(lo, hi - lo))], pa.binary())], ["part", "file", "piece"])
                    lo = hi

    def merge(t: pa.Table) -> pa.Table:
        held = [_unpacked(p.as_buffer()) for _, p in sorted(zip(t.column("file").to_pylist(), t.column("piece"), strict=True), key=lambda x: x[0])]
        start = [0]
        for b in held:
            start.append(start[-1] + len(b))
        take = [start[w] + i for w, i in merged([_order(b) for b in held])]
        out = pa.Table.from_batches(held).take(pa.array(take, pa.int64()))
        return out.append_column("place", pa.array(range(len(take)), pa.int64())).append_column("part", pa.array([t.column("part")[0].as_py()] * len(take), pa.int32()))

    parts = runs.select("file", "run").mapInArrow(pieces, "part int, file string, piece binary").groupBy("part")
    out = cut(parts.applyInArrow(merge, _DDL + ", place long, part int"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    base = out.groupBy("part").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return out.join(F.broadcast(base.select("part", "base")), "part").withColumn("place", F.col("place") + F.col("base")).drop("part", "base")


def merged(orders: list[list[tuple]]) -> Iterator[tuple[int, int]]:
    """(run, place in it) of all captures of sorted runs, in order."""
    at = [0] * len(orders)
    for _, run in LoserTree([[(x, w) for x in o] for w, o in enumerate(orders)]):
        yield run, at[run]
        at[run] += 1


def digest(pages: DataFrame) -> DataFrame:
    """The columns of query op7, the URL key, and the place in the global capture history."""
    spark = pages.sparkSession
    path = shared(spark, "warc")
    pages = with_digests(pages)
    write_archives(linked(pages), path, classes=size_classes(pages))
    out = merged_history(read_archives(spark, path))
    return out.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to", F.col("key").alias("url_key"), F.col("place").alias("capture_place"))


_GROUP = "('0x' || substr(sha, {0}, 10))::BIGINT"
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((({_GROUP.format(10 * i + 1)}) >> {35 - 5 * j}) & 31)::INT + 1, 1)" for i in range(4) for j in range(8))

#: The same in DuckDB, without archives.
ORACLE = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT *, strlen(html) AS n, sha1(html) AS sha, min(page_id) OVER (PARTITION BY sha1(html), strlen(html)) AS first FROM p),
k AS (SELECT *, strftime(TIMESTAMP '2020-01-01' + to_seconds(coalesce(page_id, 0) % 1000000000), '%Y-%m-%dT%H:%M:%SZ') AS stamp,
  regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]+)?([^#]*)', ['host', 'rest']) AS m FROM d),
u AS (SELECT *, CASE WHEN coalesce(url, '') = '' THEN '-' ELSE array_to_string(list_reverse(string_split(regexp_replace(m.host, '^www[.]', ''), '.')), ',') || ')' || CASE WHEN m.rest = '' THEN '/' ELSE m.rest END END AS url_key FROM k)
SELECT page_id, n::BIGINT AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, url_key, row_number() OVER (ORDER BY url_key, stamp, page_id NULLS LAST) - 1 AS capture_place FROM u
"""
