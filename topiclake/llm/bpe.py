"""BPE encoding and decoding with forced boundaries.

A pair of adjacent symbols that stands next to each other inside no vocabulary
token can never end up inside one token: between them the text is cut for
certain.  The fragments between cuts are encoded on their own (merges by rank)
and their ids are concatenated, which gives what merging the whole would.
Fragments, and the white-space separated chunks made of them, repeat a lot, so
each worker keeps the ids of those it has seen in dictionaries of bounded size.

The rules around the merges are those of the vocabulary file: special tokens
are found in the raw text; the rest is NFC, lower case (character by character)
and split at white space; chunks are split into contractions, letter runs,
single digits and runs of other characters; each piece's last byte carries
the end mark.  Decoding joins the ids' token strings by a space.

Edge cases: null and empty texts have no ids, and decode to the empty text.  Null ids decode to null;
ids that the vocabulary lacks, and nulls among ids, are passed over, as the tokenizer library does.
A long text is taken block by block, cut at white space; a long run without white space is one fragment at worst, merged
with a heap, and not cached.  Repeated rows are encoded each; an empty table gives no row; other columns pass through, the new one gets a free name.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from .common import fresh, received, send

# Entries of each cache, symbols of the longest one kept there, symbols up to which a scan finds the next merge faster than a heap.
CACHE, LONGEST, SCAN = 300_000, 256, 64
_BLOCK = 1 << 18
_CUT = re.compile(r"[ \n]")
# What the tokenizer file's normaliser takes for white space, where Python's split() takes \x1c-\x1f too.
_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_MORE = re.compile(r"[\x1c-\x1f]")
# Characters outside these ranges may be younger than this Python's Unicode tables: texts with them are split by the tokenizer library's own rules.
_YOUNG = re.compile(r"[^\x00-\u052f\u1e00-\u208e\u20a0-\u2bff\u3000-\u9fff\uac00-\ud7a3\U0001f300-\U0001faff]")
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one tokenizer file (its text, as JSON)."""

    def __init__(self, spec: str) -> None:
        data = json.loads(spec)
        model = data["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.rank = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.inside = {pair for t in self.ids for pair in self._pairs(t)}
        self.letters = byte_letters()
        self.piece = regex.compile(_PIECE)
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.spec, self.library = spec, None
        self.chunks: dict[str, tuple[int, ...]] = {}
        self.fragments: dict[tuple[str, ...], tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.end) and len(token) > len(self.end):
            core = token[: -len(self.end)]
            return [*core[:-1], core[-1] + self.end]
        return [*token]

    def _pairs(self, token: str) -> Iterator[tuple[str, str]]:
        s = self._symbols(token)
        return zip(s, s[1:], strict=False)

    def cut(self, symbols: list[str]) -> Iterator[tuple[str, ...]]:
        """The fragments between forced boundaries."""
        lo = 0
        for i in range(1, len(symbols)):
            if (symbols[i - 1], symbols[i]) not in self.inside:
                yield tuple(symbols[lo:i])
                lo = i
        if lo < len(symbols):
            yield tuple(symbols[lo:])

    def merged(self, symbols: tuple[str, ...]) -> tuple[int, ...]:
        """Ids of one fragment: the adjacent pair of least rank is merged until none is left."""
        if len(symbols) > SCAN:
            return self._merged_long(symbols)
        s, none = list(symbols), len(self.rank)
        of = self.rank.get
        ranks = [of(p, none) for p in zip(s, s[1:], strict=False)]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            s[i] += s.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = of((s[i - 1], s[i]), none)
            if i < len(ranks):
                ranks[i] = of((s[i], s[i + 1]), none)
        return tuple(self.ids[x] for x in s)

    def _merged_long(self, symbols: tuple[str, ...]) -> tuple[int, ...]:
        """The same with a heap of (rank, place) over linked symbols; an entry that no longer names its pair's rank is passed over."""
        s, n, of = list(symbols), len(symbols), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := of((s[i], s[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if s[i] is None or j >= n or of((s[i], s[j])) != r:
                continue
            s[i], s[j], after[i] = s[i] + s[j], None, after[j]
            k, h = after[i], before[i]
            if k < n:
                before[k] = i
                if (r := of((s[i], s[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if h >= 0 and (r := of((s[h], s[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return tuple(self.ids[x] for x in s if x is not None)

    def _fragment(self, symbols: tuple[str, ...]) -> tuple[int, ...]:
        if len(symbols) > LONGEST:
            return self.merged(symbols)
        got = self.fragments.get(symbols)
        if got is None:
            if len(self.fragments) >= CACHE:
                self.fragments.clear()
            got = self.fragments[symbols] = self.merged(symbols)
        return got

    def _piece(self, piece: str) -> tuple[int, ...]:
        got = self.pieces.get(piece)
        if got is None:
            symbols = [*piece[:-1], piece[-1] + self.end]
            parts = list(self.cut(symbols))
            got = self.merged(parts[0]) if len(parts) == 1 else tuple(i for x in parts for i in self._fragment(x))
            if len(piece) <= LONGEST:
                if len(self.pieces) >= CACHE:
                    self.pieces.clear()
                self.pieces[piece] = got
        return got

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        pieces = ["".join([self.letters[b] for b in p.encode()]) for p in self.piece.findall(chunk)]
        got = self._piece(pieces[0]) if len(pieces) == 1 else tuple(i for p in pieces for i in self._piece(p))
        if len(chunk) < 64:
            if len(self.chunks) >= CACHE:
                self.chunks.clear()
            self.chunks[chunk] = got
        return got

    def _young(self, text: str) -> list[int]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.spec)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [i for p, _ in pieces for i in self._piece(p)]

    def _plain(self, text: str) -> list[int]:
        if _YOUNG.search(text):
            return self._young(text)
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # the last letter of a word is no exception
            text = text.replace("Σ", "σ")
        text = text.lower()
        out: list[int] = []
        get, add = self.chunks.get, out.extend
        for chunk in _SPACE.split(text) if _MORE.search(text) else text.split():
            got = get(chunk)
            add(self._chunk(chunk) if got is None else got)
        return out

    def blocks(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, block by block."""
        lo = 0
        while lo < len(text):
            at = _CUT.search(text, lo + _BLOCK) if lo + _BLOCK < len(text) else None
            hi = at.start() if at else len(text)
            for i, part in enumerate(self.at_special.split(text[lo:hi]) if self.at_special else [text[lo:hi]]):
                if i % 2:
                    yield [self.special[part]]
                elif part:
                    yield self._plain(part)
            lo = hi

    def encode(self, text: str) -> list[int]:
        return [i for x in self.blocks(text) for i in x]

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def load(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoded(docs: DataFrame, vocabulary: str, text_col: str = "text", name: str = "ids", batch_ids: int = 1 << 20) -> DataFrame:
    """``docs`` without the text, and the ids of each text as a last column; ``vocabulary`` is a path on the driver."""
    docs = docs.select(*(c for c in docs.columns if c != text_col), F.col(text_col).cast("string"))
    name, sent, place = fresh(docs, name), send(docs.sparkSession, load(vocabulary)), len(docs.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(received(sent))
        for b in batches:
            lo, ids = 0, []
            size = 0
            for i in range(b.num_rows):
                ids.append(np.array(bpe.encode(b.column(place)[i].as_py() or ""), np.int32))
                size += len(ids[-1])
                if size >= batch_ids or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays([*b.slice(lo, i + 1 - lo).columns[:place], pa.array(ids, pa.list_(pa.int32()))], [*b.schema.names[:place], name])
                    lo, ids, size = i + 1, [], 0

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields[:place], T.StructField(name, T.ArrayType(T.IntegerType()))]))


def decoded(df: DataFrame, vocabulary: str, ids_col: str = "ids", name: str = "decoded", batch_ids: int = 1 << 20) -> DataFrame:
    """``df`` and the text of each row's ids as a last column; ``vocabulary`` is a path on the driver."""
    name, sent, place = fresh(df, name), send(df.sparkSession, load(vocabulary)), df.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(received(sent))
        for b in batches:
            lo, texts = 0, []
            size = 0
            for i in range(b.num_rows):
                ids = b.column(place)[i].values
                known = [] if ids is None else [x for x in ids.drop_null().to_numpy(zero_copy_only=False).tolist() if x in bpe.tokens]
                texts.append(None if ids is None else bpe.decode(known))
                size += len(known)
                if size >= batch_ids or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays([*b.slice(lo, i + 1 - lo).columns, pa.array(texts, pa.string())], [*b.schema.names, name])
                    lo, texts, size = i + 1, [], 0

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())]))


def with_digest(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``docs`` and a last column ``tokens``: n_tokens, ids_sha256, decoded_sha256 (hashed block by block)."""
    name = fresh(docs, "tokens")
    sent, place = send(docs.sparkSession, load(vocabulary)), docs.columns.index(text_col)
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def one(bpe: Bpe, decimal: dict[int, str], text: str) -> dict:
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for block in bpe.blocks(text):
            if block:
                gap = " " if n else ""
                ids.update((gap + " ".join(map(decimal.__getitem__, block))).encode())
                decoded.update((gap + bpe.decode(block)).encode())
                n += len(block)
        return {"n_tokens": n, "ids_sha256": ids.hexdigest(), "decoded_sha256": decoded.hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(received(sent))
        decimal = {i: str(i) for i in bpe.tokens}
        for b in batches:
            got = [one(bpe, decimal, x.as_py() or "") for x in b.column(place)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, kind)], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))]))


def digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The columns of query op5."""
    return with_digest(docs.select("doc_id", F.col("text").cast("string").alias("text")), vocabulary).select("doc_id", "tokens.*")
