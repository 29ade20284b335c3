"""Benchmark decontamination by winnowing.

A window is ``span`` consecutive words of a benchmark item, or the whole item
if it has fewer.  Of each window's k-gram hashes the smallest is its
fingerprint.  A document and an item that share a window have the same
smallest hash there, so joining fingerprints misses no shared window; each hit
is then extended to the full window and compared word by word (64-bit word
hashes, all of them).

The benchmark side is taken in blocks of at most ``block_words`` words: one
block is one broadcast index of bounded size and one pass over the documents;
a benchmark of more words takes more passes, whose hits are merged per text.

Edge cases: a null text has no words; empty texts have none either.  An item
without words has no window.  Items with the same id are one item; a null id is
written as an empty string.  Repeated documents get a row each.  Very long texts are searched whole; an empty benchmark hits
nothing and an empty table gives no row; other columns pass through and the new one gets a free name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import cut, fresh, pieces, received, send, utf8
from .textnp import Words, grams, mixed, sliding

SPAN, GRAM = 13, 5
BLOCK_WORDS = 500_000
_STEP = 0xA24BAED4963EE407

SPANS = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def item_words(bench: DataFrame, item_col: str, text_col: str, span: int, block_words: int) -> DataFrame:
    """Item id and word hashes; a long item in parts that overlap by ``span - 1`` words."""
    part = max(1, block_words // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            for lo, hi in pieces(b.column(1)):
                ids = b.column(0)[lo:hi].to_pylist()
                h, _, _, at = words.split(*utf8(b.column(1)[lo:hi]))
                for i, item in enumerate(ids):
                    own = h[at[i] : at[i + 1]]
                    for k in range(0, max(1, len(own) - span + 1), part) if len(own) else ():
                        yield pa.RecordBatch.from_arrays([pa.array([item or ""]), pa.array([own[k : k + part + span - 1].tobytes()], pa.binary())], ["item", "words"])

    return bench.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "item string, words binary")


def window_hash(words: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    out, q = np.zeros(len(starts), np.uint64), 1
    for j in range(n):
        out += words[starts + j] * np.uint64(q)
        q = q * _STEP % (1 << 64)
    return mixed(out)


def winnowed(h: np.ndarray, n: int, k: int) -> np.ndarray:
    """For each start of ``n`` words, the smallest hash of the k-grams within."""
    k = min(k, n)
    return sliding(grams(h, k), n - k + 1, np.minimum)


class Index:
    """The windows of one block of the benchmark, by window length."""

    def __init__(self, rows: list[tuple[str, bytes]], span: int, k: int) -> None:
        self.k = k
        self.items = sorted({r[0] for r in rows})
        number = {x: i for i, x in enumerate(self.items)}
        self.words = np.frombuffer(b"".join(r[1] for r in rows), np.uint64)
        by_length: dict[int, list] = {}
        base = 0
        for item, raw in rows:
            n = len(raw) // 8
            by_length.setdefault(min(n, span), []).append((number[item], base, n))
            base += n
        self.lengths = []
        for n, parts in sorted(by_length.items()):
            start = np.concatenate([np.arange(b, b + m - n + 1) for _, b, m in parts])
            item = np.concatenate([np.full(m - n + 1, i) for i, _, m in parts])
            print_ = np.concatenate([winnowed(self.words[b : b + m], n, k) for _, b, m in parts])
            whole = window_hash(self.words, start, n)
            pair = np.unique(np.stack([whole, item.astype(np.uint64)], 1), axis=0)  # each window's items, in order
            hashes, first = np.unique(pair[:, 0], return_index=True)
            sample = start[np.unique(whole, return_index=True)[1]]  # a place of each window
            prints = np.unique(print_)
            bits = np.zeros(1 << 20, bool)
            bits[(prints & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.lengths.append((n, prints, bits, hashes, sample, np.append(first, len(pair)), pair[:, 1].astype(np.int64)))

    def matches(self, h: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """By window length: documents, first words and windows of all occurrences in these texts."""
        for n, prints, bits, hashes, sample, _, _ in self.lengths:
            low = winnowed(h, n, self.k)
            hit = np.flatnonzero(bits[(low & np.uint64((1 << 20) - 1)).astype(np.int64)])
            hit = hit[prints[np.minimum(np.searchsorted(prints, low[hit]), len(prints) - 1)] == low[hit]]
            doc = np.searchsorted(at, hit, side="right") - 1
            keep = hit + n <= at[doc + 1]
            hit, doc = hit[keep], doc[keep]
            own = window_hash(h, hit, n)
            win = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            same = hashes[win] == own
            for j in range(n):
                same &= h[hit + j] == self.words[sample[win] + j]
            yield n, doc[same], hit[same], win[same]

    def found(self, h: np.ndarray, at: np.ndarray) -> dict[int, tuple[list, list]]:
        """By document with hits: merged spans of hit words (first and last), and items in string order."""
        cover = np.zeros(len(h) + 1, np.int64)
        owners: dict[int, set] = {}
        for (n, doc, hit, win), (_, _, _, _, _, first, item) in zip(self.matches(h, at), self.lengths, strict=True):
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + n, -1)
            for d, w in np.unique(np.stack([doc, win], 1), axis=0) if len(doc) else ():
                owners.setdefault(int(d), set()).update(item[first[w] : first[w + 1]].tolist())
        inside = np.cumsum(cover[:-1]) > 0
        out = {}
        for d, own in owners.items():
            edge = np.diff(inside[at[d] : at[d + 1]].astype(np.int8), prepend=0, append=0)
            out[d] = list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True)), [self.items[i] for i in sorted(own)]
        return out


def _scan(docs: DataFrame, text_col: str, block, names: list[str]) -> DataFrame:
    """All columns of ``docs`` and ``names``: word count, spans and items found with one block."""
    place = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(x, t) for x, t in zip(names, (T.LongType(), SPANS, T.ArrayType(T.StringType())), strict=True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, index = Words(), received(block)
        for b in batches:
            for lo, hi in pieces(b.column(place)):
                part = b.slice(lo, hi - lo)
                h, _, _, at = words.split(*utf8(part.column(place)))
                found = index.found(h, at) if index is not None else {}
                spans = [[{"first": x, "last": y} for x, y in found[i][0]] if i in found else [] for i in range(hi - lo)]
                items = [found[i][1] if i in found else [] for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(at), pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))], [*b.schema.names, *names])

    return docs.mapInArrow(run, schema)


def _merged(block_hits: DataFrame) -> DataFrame:
    """Hits of several blocks by text: spans that overlap or touch joined, items in string order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = []
            for row in b.column(2).to_pylist():
                out: list[list[int]] = []
                for x, y in sorted((s["first"], s["last"]) for s in row):
                    if out and x <= out[-1][1] + 1:
                        out[-1][1] = max(out[-1][1], y)
                    else:
                        out.append([x, y])
                spans.append([{"first": x, "last": y} for x, y in out])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, _SPANS), b.column(3)], ["k1", "k2", "spans", "items"])

    grouped = block_hits.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return grouped.mapInArrow(run, T.StructType([T.StructField("k1", T.LongType()), T.StructField("k2", T.StringType()), T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(T.StringType()))]))


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", bench_text_col: str = "text",
                  span: int = SPAN, k: int = GRAM, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with a struct column ``hits``: n_words, n_hit, item_ids (in string order), spans (first and last hit words).

    If ``docs`` has a column ``hits`` already, the new one's name gets underscores in front.
    """
    spark = docs.sparkSession
    names = [fresh(docs, x) for x in ("n_words", "hit_spans", "hit_items")]
    blocks = _blocks(item_words(bench, item_col, bench_text_col, span, block_words), block_words)
    first = next(blocks, None)
    second = next(blocks, None)
    if second is None:
        scanned = _scan(docs, text_col, send(spark, Index(first, span, k) if first else None), names)
    else:
        keys = [F.xxhash64(text_col), F.sha1(text_col)]  # hits depend on the text alone
        hits, rows = None, first
        texts = docs.select(text_col)
        while rows:
            sent = send(spark, Index(rows, span, k))
            own = ["n_words", "spans", "items"]
            got = cut(_scan(texts, text_col, sent, own).where(F.size("items") > 0)
                      .select(keys[0].alias("k1"), keys[1].alias("k2"), "spans", "items").dropDuplicates(["k1", "k2"]))
            sent.unpersist()
            hits = got if hits is None else hits.unionByName(got)
            rows, second = second, next(blocks, None)
        hits = _merged(hits)
        plain = _scan(docs, text_col, send(spark, None), names).drop(*names[1:])
        j = plain.join(hits, (hits.k1 == keys[0]) & (hits.k2 == keys[1]), "left")
        scanned = j.select(*(plain[c] for c in plain.columns), F.coalesce(hits["spans"], F.array().cast(SPANS)).alias(names[1]), F.coalesce(hits["items"], F.array().cast("array<string>")).alias(names[2]))
    n_hit = F.aggregate(names[1], F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"] + 1)
    return scanned.select(*docs.columns, F.struct(F.col(names[0]).alias("n_words"), n_hit.alias("n_hit"), F.col(names[2]).alias("item_ids"), F.col(names[1]).alias("spans")).alias(fresh(docs, "hits")))


def _blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[str, bytes]]]:
    """Rows of the benchmark, read one partition at a time, in lists of at most ``block_words`` words."""
    rows, size = [], 0
    for r in items.toLocalIterator():
        if rows and size + len(r.words) // 8 > block_words:
            yield rows
            rows, size = [], 0
        rows.append((r.item, bytes(r.words)))
        size += len(r.words) // 8
    if rows:
        yield rows


def contaminated(hits: str = "hits"):
    """The rule: at least a twentieth of the words are hit."""
    return (F.col(f"{hits}.n_hit") > 0) & (20 * F.col(f"{hits}.n_hit") >= F.col(f"{hits}.n_words"))


def digest(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The columns of query op3."""
    out = decontaminate(docs.select("doc_id", "text"), bench)
    return out.select("doc_id", "hits.n_words", "hits.n_hit", F.size("hits.item_ids").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "hits.item_ids"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def brute_force(texts: list[str | None], items: list[tuple[object, str | None]], span: int = SPAN) -> list[tuple]:
    """The contract, word by word, for tests."""
    import re

    def split(t):
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)

    wins: dict[tuple, set] = {}
    for item, t in items:
        w = split(t)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    sizes = {len(x) for x in wins}
    out = []
    for t in texts:
        w = split(t)
        hit, own = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i : i + n])) in wins:
                    hit.update(range(i, i + n))
                    own |= wins[x]
        out.append((len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: The same in DuckDB: every window of every document joined with every window of the benchmark.
ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 13) AS size FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
a AS (SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS span FROM i, unnest(generate_series(1, len(w) - size + 1)) AS g(p)),
s AS (SELECT DISTINCT size FROM i),
b AS (SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS span FROM d, s, unnest(generate_series(1, len(w) - size + 1)) AS g(p) WHERE len(w) >= size),
h AS (SELECT doc_id, p, size, item_id FROM b JOIN a USING (size, span)),
n AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + size - 1)) AS place FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
