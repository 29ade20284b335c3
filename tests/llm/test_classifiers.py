"""op1, op2, op6: held-out accuracy on the given tables, edge cases, and that held-out labels are not learned from."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from topiclake.llm import langid, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_language_held_out(tables):
    docs, _ = tables
    rows = langid.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_held_out_rows_is_not_read(tables):
    docs, _ = tables
    docs = docs.where("doc_id < 300")
    turned = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang")))
    assert sorted(langid.digest(turned).collect()) == sorted(langid.digest(docs).collect())


def test_language_edges(docs_of):
    en, fr = "the cat and the dog are in the house ", "le chat et le chien sont dans la maison "
    rows = [(i, (en if i % 2 else fr) * 4, "en" if i % 2 else "fr") for i in range(40)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 + 3 = 15!", "en"), (None, en, None), (103, en * 9 + fr * 9, None), (104, "é", None)]
    got = {r.doc_id: r for r in langid.digest(docs_of(rows)).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[102].score == 0
    assert got[None].lang_pred == "en" and not got[None].held_out
    assert {s.lang for s in got[103].shares} == {"en", "fr"} and 0.3 < got[103].score < 0.7
    assert got[104].lang_pred in ("en", "fr")
    assert {r.lang_pred for r in langid.digest(docs_of([(1, "abc", None)])).collect()} == {"und"}
    assert langid.digest(docs_of([])).count() == 0


def test_quality_held_out(tables):
    docs, labels = tables
    rows = quality.digest(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) > 0.95 * len(rows)


def test_toxicity_held_out(tables):
    docs, labels = tables
    rows = toxicity.digest(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    above = sum(t > c for t in toxic for c in clean) / len(toxic) / len(clean)
    assert above > 0.8 and sum(c >= 0.5 for c in clean) < 0.05 * len(clean)


def test_toxicity_learns_pairs():
    """Insult with group mention: neither term alone tells."""
    import numpy as np

    rng = np.random.default_rng(1)
    rows = []
    for _ in range(600):
        a, b = rng.random(2) < 0.5
        terms = np.array(sorted({1 if a else 2, 3 if b else 4, *rng.integers(10, 200, 5)}))
        rows.append((int(a == b), terms, np.full(len(terms), 1 / np.sqrt(len(terms)))))
    model = toxicity.Machine()
    model.train(rows[:400], 40)
    z = np.concatenate([model.raw(np.array([0, len(t)]), t, x)[0] for _, t, x in rows[400:]])
    assert ((z > 0) == np.array([r[0] for r in rows[400:]])).mean() > 0.9


@pytest.mark.parametrize("op,label", [(quality, "quality"), (toxicity, "toxic")])
def test_edges(spark, docs_of, op, label):
    rows = [(i, f"{'good words and more' if i % 2 else '!!! $$$ bad'} {i}") for i in range(60)] + [(100, None), (101, ""), (None, "x"), (3, "again"), (102, "long " * 20_000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (7, None), (100, 1)], f"doc_id long, {label} int")
    out = op.digest(docs_of(rows), labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    none = op.digest(docs_of(rows), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert op.digest(docs_of([]), labels).count() == 0


@pytest.mark.parametrize("op,label,folds,fold", [(quality, "quality", 3, 1), (toxicity, "toxic", 5, 0)])
def test_held_out_labels_are_not_read(tables, op, label, folds, fold):
    docs, labels = tables
    docs = docs.where("doc_id < 400")
    turned = labels.withColumn(label, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, 1 - F.col(label)).otherwise(F.col(label)))
    assert sorted(op.digest(docs, turned).collect()) == sorted(op.digest(docs, labels).collect())


def test_mixture_against_all_subsets():
    """The greedy set is the one of best penalised likelihood among all sets of languages, and its shares those of plain EM."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    counts = np.zeros((1 << langid.BITS, 4))
    for j in range(4):
        counts[rng.choice(4000, 1500, replace=False), j] = rng.integers(1, 60, 1500)
    model = langid.Mixture(list("abcd"), counts)

    def plain(codes, own):
        w, p = np.full(len(own), 1 / len(own)), model.p[codes][:, own]
        for _ in range(2000):
            part = p * w
            w = (part / part.sum(1, keepdims=True)).mean(0)
        return w, np.log(p @ w).sum()

    for truth in ([1.0, 0, 0, 0], [0.5, 0.5, 0, 0], [0, 0.2, 0.3, 0.5], [0.25] * 4, [0.97, 0, 0, 0.03]):
        lang = rng.choice(4, 600, p=truth)
        codes = np.array([rng.choice(1 << langid.BITS, p=model.p[:, j]) for j in lang])
        found = dict(model.shares(codes))
        value = {}
        for k in range(1, 5):
            for own in itertools.combinations(range(4), k):
                w, like = plain(codes, list(own))
                value[own] = like - (k - 1) * langid.PENALTY * np.log(len(codes) + 1)
        best = max(value, key=value.get)
        chosen = tuple(sorted(found))
        assert value[chosen] > value[best] - 1.0, (truth, chosen, best)
        w, _ = plain(codes, list(chosen))
        assert np.abs(w - [found[j] for j in chosen]).max() < 0.02


def test_language_long_ties_repeated_and_clashing(spark):
    en, fr = "the cat and the dog are in the house ", "le chat et le chien sont dans la maison "
    rows = [(i, (en if i % 2 else fr) * 4, "en" if i % 2 else "fr") for i in range(40)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    more = [(1, en * 30_000), (1, en * 30_000), (2, "1é" * 50_000), (3, fr)]
    df = spark.createDataFrame([(*r, "x", 7) for r in more], "doc_id long, text string, language string, _language int")
    out = langid.identified(df, model)
    assert out.columns == ["doc_id", "text", "language", "_language", "__language"]
    got = out.collect()
    assert len(got) == 4 and [r["__language"].lang_pred for r in got if r.doc_id == 1] == ["en", "en"]
    assert langid.Mixture(["a", "b"], __import__("numpy").ones((1 << langid.BITS, 2))).shares(__import__("numpy").array([3, 4]))[0][0] == 0  # equal languages: the first


def test_quality_features_against_a_plain_loop():
    import zstandard

    good, bad = b"good words and more of them. " * 200, b"!!! $$$ BUY now &&& " * 200
    sizes = quality.Sizes(good, bad)
    for text in (b"", b"x", b"good words and more", bytes(range(256)) * 9, b"a" * 5000, "é漢".encode() * 700):
        plain = []
        for raw in (good, bad):
            n = 0
            for i in range(0, len(text), 512):
                one = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=False, write_checksum=False, write_dict_id=False)
                n += len(one.compress(text[i : i + 512]))
            plain.append(n)
        g, b = plain
        assert sizes.features(text) == ([(b - g) / (b + g), (b - g) / len(text), (b + g) / len(text) / 2] if text else [0.0, 0.0, 0.0])


@pytest.mark.parametrize("op", [quality, toxicity])
def test_scores_beside_clashing_columns(spark, docs_of, op):
    rows = [(1, "x y"), (1, "x y"), (2, None), (3, "z " * 200_000)]
    out = op.scored(docs_of(rows), None)
    assert out.columns[-1] == "_score" and [r["_score"] for r in out.collect()] == [0.5] * 4


def test_machine_against_all_pairs_and_numeric_gradient():
    import numpy as np

    rng = np.random.default_rng(5)
    model = toxicity.Machine()
    model.w0, model.w = 0.3, rng.standard_normal(1 << toxicity.BITS).astype(np.float32)
    model.v = rng.standard_normal(model.v.shape).astype(np.float32)
    rows = [np.sort(rng.choice(1000, n, replace=False)) for n in (0, 1, 2, 30)]
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    term, value = np.concatenate(rows), rng.random(33)
    got, s, row = model.raw(first, term, value)
    for k, own in enumerate(rows):
        x = value[first[k] : first[k + 1]]
        pairs = sum(float(model.v[own[i]] @ model.v[own[j]]) * x[i] * x[j] for i in range(len(own)) for j in range(i))
        assert abs(got[k] - (0.3 + float(model.w[own] @ x) + pairs)) < 1e-4
    model.v = model.v.astype(np.float64)
    for at in (0, 5, 32):
        for f in range(toxicity.RANK):
            keep, step = model.v[term[at], f], 1e-5
            model.v[term[at], f] = keep + step
            up = model.raw(first, term, value)[0][row[at]]
            model.v[term[at], f] = keep - step
            down = model.raw(first, term, value)[0][row[at]]
            model.v[term[at], f] = keep
            s = model.raw(first, term, value)[1]
            own = [i for i in range(len(term)) if row[i] == row[at] and term[i] == term[at]]
            assert len(own) == 1
            assert abs((up - down) / (2 * step) - value[at] * (s[row[at], f] - keep * value[at])) < 1e-4
