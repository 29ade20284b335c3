"""op5 against the tokenizers library."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from topiclake.llm import bpe
from topiclake.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")
ALPHABET = "abc DEF'stm1234!?.,éÉßüñ<|endoftext|>\x1c\x85\xa0 İΣςÅ日本🙂́\t\n\r\v漢٣½  　"


@pytest.fixture(scope="module")
def both():
    return bpe.Bpe(bpe.load(vocabulary())), tokenizers.Tokenizer.from_file(vocabulary())


def test_texts(both):
    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.text(ALPHABET, max_size=60), st.text(max_size=30), st.lists(st.sampled_from(["I'll", "don't", "<|endoftext|>", "WE'VE", " ", "\n", "x" * 40, "thing"])).map("".join)))
    def check(text):
        own, library = both
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)

    check()


def test_fragments_are_independent(both):
    own, _ = both
    symbols = [*"thequickbrownfoxé"[:-1], "g</w>"]
    parts = list(own.cut(symbols))
    assert [s for p in parts for s in p] == symbols
    assert own.merged(tuple(symbols)) == tuple(i for p in parts for i in own.merged(p))


def test_long_text_block_by_block(both, monkeypatch):
    own, library = both
    text = "Some words, and 12 more.\n<|endoftext|> é" * 300
    monkeypatch.setattr(bpe, "_BLOCK", 50)
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_bounded_caches(both, monkeypatch):
    own, library = bpe.Bpe(bpe.load(vocabulary())), both[1]
    monkeypatch.setattr(bpe, "CACHE", 3)
    text = " ".join(f"word{i}x y{i}" for i in range(200))
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, (own.chunks, own.pieces, own.fragments))) <= 3


def test_digest_and_ids(docs_of, both):
    rows = [(1, "Hello <|endoftext|> World's"), (2, None), (3, ""), (None, "x"), (1, "Hello <|endoftext|> World's"), (4, "long word " * 30_000)]
    library = both[1]
    got = sorted(bpe.digest(docs_of(rows), vocabulary()).collect(), key=lambda r: (r.doc_id or 0, r.n_tokens))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(e), sha(" ".join(map(str, e))), sha(library.decode(e, skip_special_tokens=False))))
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: (r[0] or 0, r[1]))
    ids = bpe.encoded(docs_of(rows), vocabulary(), batch_ids=2)
    assert "text" not in ids.columns and ids.columns[-1] == "ids"
    assert sorted(len(r.ids) for r in ids.collect()) == sorted(r[1] for r in want)
    assert bpe.digest(docs_of([]), vocabulary()).count() == 0


def test_decoded_from_an_ids_column(spark, docs_of, both):
    own, library = both
    rows = [(1, "Hello <|endoftext|> World's"), (2, None), (3, ""), (None, "x é 日本"), (4, "long word " * 30_000)]
    ids = bpe.encoded(docs_of(rows, decoded=F.lit("d")), vocabulary())
    got = bpe.decoded(ids, vocabulary(), batch_ids=2)
    assert got.columns == [*ids.columns, "_decoded"]
    want = {i: library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for i, t in rows}
    assert {r.doc_id: r["_decoded"] for r in got.collect()} == want
    odd = spark.createDataFrame([(1, None), (2, []), (3, [5, None, 10**9, 7, -1])], "k int, at array<long>")
    assert {r.k: r.text for r in bpe.decoded(odd, vocabulary(), "at", "text").collect()} == {1: None, 2: "", 3: library.decode([5, 10**9, 7], skip_special_tokens=False)}
    assert bpe.decoded(odd.limit(0), vocabulary(), "at").count() == 0


def test_million_characters_without_white_space(both):
    """Long chunks take n log n; up to the library's own reach they equal it, and a heap equals the scan."""
    import random
    import time

    own, library = both
    rng = random.Random(1)
    for text in ("a" * 3000, "ab" * 2000, "".join(rng.choices("abcdefghij", k=4000)), "".join(rng.choices("ACGT", k=3000)), "".join(rng.choices("aé漢1!", k=2000))):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    for _ in range(200):
        symbols = tuple(rng.choices("eastinrt", k=rng.randrange(1, 60)))
        assert own.merged(symbols) == own._merged_long(symbols)
    began = time.time()
    for text in ("a" * 1_000_000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))):
        ids = own.encode(text)
        assert own.decode(ids).replace(" ", "").replace(own.end, "") == text
    assert time.time() - began < 120 and max(map(len, own.pieces)) <= bpe.LONGEST
