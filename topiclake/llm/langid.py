"""Language identification by mixture inference.

A language is a distribution over hashed byte trigrams of lower-cased text whose
non-letters are single spaces.  A document is a mixture of languages: its proportions are
estimated by expectation-maximisation from the trigrams' likelihoods.  The set
of languages grows from the best single one, each time by the language whose
share the likelihood asks for most, as long as the gain beats ``PENALTY`` times the log of
the number of trigrams; the likelihood is concave in the shares, so where no language's
gradient is above one the set is already best.

The distributions come from a bounded sample of ``ROWS`` documents a language;
every document is classified from its whole text.

Edge cases: null texts and texts without a letter are ``und`` with score 0, and
so is every text where nothing was learned.  Ties go to the language first in string order.  Very long texts are
taken whole, one at a time.  Repeated rows are judged alike, each; an empty table gives no row; other columns pass through and
the new one gets a free name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .common import fresh, held, pieces, received, sampled, send, utf8

BITS, ROWS, PENALTY, ROUNDS = 15, 4000, 5.0, 25
UNKNOWN = "und"


def trigrams(col: pa.Array) -> Iterator[np.ndarray]:
    """The hashed trigrams of each text."""
    raw, at = utf8(pc.binary_join_element_wise(" ", pc.utf8_lower(pc.fill_null(col, "")), " ", ""))
    keep = np.zeros(256, bool)
    keep[0x61:0x7B] = keep[0x80:] = True
    letter = keep[raw]
    b = np.where(letter, raw, 0x20).astype(np.uint32)
    stay = letter.copy()
    stay[1:] |= letter[:-1]  # of a run of other bytes the first
    stay[at[:-1]] = True
    place = np.concatenate([[0], np.cumsum(stay)])[at]
    b = b[stay]
    code = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435769) >> np.uint32(32 - BITS) if len(b) > 2 else b[:0]
    for lo, hi in zip(place[:-1], place[1:], strict=True):
        yield code[lo : max(lo, hi - 2)]


class Mixture:
    """Languages in string order and their trigram probabilities."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        self.p = (counts + 0.1) / (counts.sum(0) + 0.1 * len(counts))
        self.log = np.log(self.p)

    def shares(self, codes: np.ndarray) -> list[tuple[int, float]]:
        """The chosen languages and their proportions, the largest first."""
        n = len(codes)
        full = np.bincount(codes, minlength=1 << BITS)
        seen = np.flatnonzero(full)
        c, a = full[seen].astype(float), self.p[seen]
        single = c @ self.log[seen]
        chosen = [int(np.argmax(single))]
        share, best, mix = np.ones(1), single[chosen[0]], a[:, chosen[0]]
        while len(chosen) < len(self.languages):
            pull = (c / mix) @ a / n
            pull[chosen] = 0
            new = int(np.argmax(pull))
            if pull[new] <= 1:
                break
            own = a[:, [*chosen, new]]
            w = np.append(share * 0.7, 0.3)
            for _ in range(ROUNDS):
                m = own @ w
                w, old = w * ((c / m) @ own) / n, w
                if np.abs(w - old).max() < 1e-3:
                    break
            m = own @ w
            now = c @ np.log(m)
            if now - best <= PENALTY * np.log(n + 1):
                break
            chosen, share, best, mix = [*chosen, new], w, now, m
        return sorted(zip(chosen, share.tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", rows: int = ROWS) -> Mixture | None:
    """The languages of the rows with a language and an id; None if there are none."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    sample, sizes = sampled(known, "id", "lang", rows)
    if not sizes:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lo, hi in pieces(b.column(1)):
                for lang, codes in zip(b.column(0)[lo:hi].to_pylist(), trigrams(b.column(1)[lo:hi]), strict=True):
                    total.setdefault(lang, np.zeros(1 << BITS, np.int64))
                    total[lang] += np.bincount(codes, minlength=1 << BITS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], ["lang", "code", "n"])

    languages = sorted(sizes)
    place = {x: i for i, x in enumerate(languages)}
    counts = np.zeros((1 << BITS, len(languages)))
    table = sample.select("lang", "text").mapInArrow(run, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    counts[table.column("code").to_numpy(), [place[x] for x in table.column("lang").to_pylist()]] = table.column("n").to_numpy()
    return Mixture(languages, counts)


def identified(docs: DataFrame, model: Mixture | None, text_col: str = "text") -> DataFrame:
    """``docs`` and a last column ``language``: lang_pred, score, and the languages with their shares."""
    name = fresh(docs, "language")
    sent, place = send(docs.sparkSession, model), docs.columns.index(text_col)
    share = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())]))
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("shares", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = received(sent)
        for b in batches:
            for lo, hi in pieces(b.column(place)):
                part = b.slice(lo, hi - lo)
                text = part.column(place)
                letter = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_pylist()
                out = []
                for ok, codes in zip(letter, trigrams(text), strict=True):
                    got = [(known.languages[i], min(1.0, s)) for i, s in known.shares(codes)] if known and ok else []
                    out.append({"lang_pred": got[0][0] if got else UNKNOWN, "score": got[0][1] if got else 0.0, "shares": [{"lang": x, "share": s} for x, s in got]})
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, kind)], [*b.schema.names, name])

    struct = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("shares", share)])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, struct)]))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op1 and the shares; rows whose crc32 leaves 2 of 4 are held out."""
    model = fit(docs.where(~held("doc_id", 4, 2)))
    out = identified(docs.select("doc_id", held("doc_id", 4, 2).alias("held_out"), F.col("text").cast("string").alias("text")), model)
    return out.select("doc_id", "held_out", "language.lang_pred", "language.score", "language.shares")
