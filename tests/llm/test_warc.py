"""op7: exact round trip of the payloads, revisits, and the order of the merged index."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
from collections import Counter

from topiclake.llm import warc
from topiclake.session import fresh_path


def test_loser_tree():
    for seed in range(300):
        rng = random.Random(seed)
        runs = [sorted(rng.randrange(30) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(10))]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_round_trip(spark):
    rows = [(i, f"http://www.h{i % 3}.example.com/p{i % 5}?q={i}#f", f"<html>é {i % 11}\r\n\r\nWARC/1.1\r\n</html>") for i in range(120)]
    rows += [(200, None, "x"), (201, "ftp://u@Host:80", None), (202, "u\r\nv", ""), (None, "n", "<html>é 3\r\n\r\nWARC/1.1\r\n</html>"), (5, "again", "<html>é 5\r\n\r\nWARC/1.1\r\n</html>"), (203, "big", "ß" * 200_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    out = warc.digest(pages).collect()
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = i != first[html or ""]
        want[i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first[html or ""] if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    ordered = sorted(out, key=lambda r: r.capture_place)
    assert [r.capture_place for r in ordered] == list(range(len(rows)))
    assert [r.url_key for r in ordered] == sorted(r.url_key for r in out)


def test_payloads_in_the_files(spark):
    import pyspark.sql.functions as F

    few = warc.with_digests(spark.range(40).selectExpr("id AS page_id", "'u' AS url", "CAST(id % 9 AS STRING) AS html"))
    assert sorted(map(tuple, warc.linked(few, broadcast_rows=0).select("page_id", "first").collect())) == sorted(map(tuple, warc.linked(few).select("page_id", "first").collect())) == [(i, i % 9) for i in range(40)]
    assert few.select(warc.base32(F.sha1(F.lit("x"))).alias("d")).first().d == base64.b32encode(hashlib.sha1(b"x").digest()).decode()
    path = fresh_path(spark, "llm", "warc-test")
    pages = spark.createDataFrame([(1, "a.b/c", "é\r\n\r\n"), (2, "a.b/c", "é\r\n\r\n"), (3, "z", "")], "page_id long, url string, html string")
    warc.write_archives(warc.linked(warc.with_digests(pages)), path, file_rows=1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect()
    got = {h["warc-record-id"]: (h["warc-type"], bytes(p)) for f in files for h, p in warc.records(memoryview(gzip.decompress(f.content)))}
    assert got == {"<urn:page:1>": ("response", "é\r\n\r\n".encode()), "<urn:page:2>": ("revisit", b""), "<urn:page:3>": ("response", b"")}


def _runs(spark, captures):
    """Captures (file, key, stamp, page_id, offset) as rows of read_archives."""
    files = sorted({c[0] for c in captures})
    rows = [warc.sorted_run([(k, t, p, f, o, 1, "u", "response", None, 0, "d") for f, k, t, p, o in captures if f == file], file).to_pylist()[0] for file in files]
    return spark.createDataFrame([(r["file"], r["n"], bytearray(r["run"])) for r in rows], "file string, n long, run binary")


def test_merge_over_many_ranges(spark):
    """A hot key, one page id and null ids are all cut over ranges; nothing is sorted after the runs."""
    captures = [(f"f{i % 7}", f"k{min(i % 9, 3)}", str(i * 7919 % 400), None if i % 50 == 0 else i, i) for i in range(1000)]
    captures += [(f"g{i % 3}", "k3", "7", 5, i) for i in range(400)] + [(f"g{i % 3}", "k3", "7", None, 1000 + i) for i in range(300)]
    runs = _runs(spark, captures)
    assert len(warc.range_bounds(runs, 60)) > 20
    out = warc.merged_history(runs, range_rows=60)
    got = sorted(out.collect(), key=lambda r: r.place)
    assert [r.place for r in got] == list(range(1700))
    order = [(r.key, r.stamp, r.page_id is None, r.page_id or 0, r.file, r.offset) for r in got]
    assert order == sorted(order) and len(set(order)) == 1700


def test_no_range_is_much_larger(spark):
    captures = [(f"f{i % 5}", "hot", "same", None, i) for i in range(3000)]
    bounds = warc.range_bounds(_runs(spark, captures), 100)
    import bisect

    sizes = Counter(bisect.bisect_right(bounds, (k, t, True, 0, f, o)) for f, k, t, _, o in captures)
    assert max(sizes.values()) <= 200


def test_files_are_bounded_by_bytes(spark):
    """Long pages are written a few a file, the longest alone; every record can be cut out of its file by offset and length."""
    path = fresh_path(spark, "llm", "warc-sizes")
    pages = spark.createDataFrame([(i, f"http://a.b/{i}", "x" * n + str(i)) for i, n in enumerate([10] * 30 + [40_000] * 8 + [2_000_000] * 3)], "page_id long, url string, html string")
    warc.write_archives(warc.linked(warc.with_digests(pages.coalesce(1))), path, file_bytes=1 << 20)
    files = {f.path.rpartition("/")[2]: gzip.decompress(f.content) for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect()}
    assert max(len(f) for f in files.values()) < 2_001_000 and sum(len(f) > 1 << 20 for f in files.values()) == 3
    for r in warc.merged_history(warc.read_archives(spark, path)).collect():
        one = files[r.file][r.offset : r.offset + r.length]
        ((head, payload),) = warc.records(memoryview(one))
        assert head["warc-record-id"] == f"<urn:page:{r.page_id}>" and bytes(payload).endswith(str(r.page_id).encode()) and head["content-type"].startswith("text/html")


def test_empty_table(spark):
    assert warc.digest(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_url_key():
    assert warc.url_key("http://WWW.Example.com:80/A?b#c") == "com,example)/a?b"
    assert warc.url_key("https://example.com") == "com,example)/" and warc.url_key(None) == "-"
