"""op10 against exact counts."""

from __future__ import annotations

from topiclake.llm import linedup


def brute(rows, sites):
    where, first = {}, {}
    for r, (i, text, _, site) in enumerate(rows):
        for p, line in enumerate((text or "").split("\n") if text is not None else []):
            if line := line.strip(" "):
                where.setdefault(line, set()).update([site] if site is not None else [])
                spot = (i is None, i or 0, p)
                first[line] = min(first.get(line, spot), spot)
    out = []
    for i, text, _, _ in rows:
        if text is None:
            out.append((i, None, 0))
            continue
        lines = text.split("\n")
        gone = {p for p, x in enumerate(lines) if (y := x.strip(" ")) and len(where[y]) >= sites and first[y] != (i is None, i or 0, p)}
        out.append((i, "\n".join(x for p, x in enumerate(lines) if p not in gone), len(gone)))
    return out


def test_equals_brute_force(docs_of):
    rows = []
    for i in range(60):
        body = f"own line {i}\n  shared by all \n\nshared by {i % 7}\nrare {i % 30}\n"
        rows.append((i, body + ("shared by all" if i % 5 == 0 else ""), None, f"s{i % 17}"))
    rows += [(70, None, None, "s1"), (71, "", None, "s2"), (72, "shared by all", None, None), (None, "shared by all\nmine", None, "s3"), (5, rows[5][1], None, "s5"), (80, "x\n" * 3000 + "shared by all", None, "s9")]
    for sites in (3, 9, 17, 18):
        got = linedup.without_boilerplate(docs_of(rows), sites=sites)
        assert sorted((r.doc_id or -1, r.text or "", len(r.removed_lines)) for r in got.collect()) == sorted((i or -1, t or "", n) for i, t, n in brute(rows, sites))


def test_near_threshold_is_exact(docs_of):
    rows = [(s * 100 + k, f"line {k}", None, f"s{s}") for k in range(1, 41) for s in range(k)]
    got = linedup.without_boilerplate(docs_of(rows), sites=20)
    gone = {r.text for r in got.where("size(removed_lines) = 0").select("text").collect()}
    assert got.where("text = ''").count() == sum(k - 1 for k in range(20, 41)) and len(gone) == 40


def test_hot_source_adds_one_site(docs_of):
    rows = [(i, f"own {i}\nshared by many texts", None, "hot" if i < 8 else f"s{i}") for i in range(12)]  # 5 sites
    rows += [(20 + i, f"own {20 + i}\nof the hot source", None, "hot" if i < 30 else f"s{i}") for i in range(32)]  # 3 sites
    got = {r.doc_id: (r.text, r.removed_lines) for r in linedup.without_boilerplate(docs_of(rows)).collect()}
    assert got[0] == ("own 0\nshared by many texts", [])
    assert all(got[i] == (f"own {i}", [1]) for i in range(1, 12))
    assert all(got[i] == (f"own {i}\nof the hot source", []) for i in range(20, 52))


def test_many_removed_lines_in_linear_time(docs_of):
    """Texts of 200,000 lines that lose all but a few: a lookup per line, not a search through all places."""
    import time

    body = "\n".join(f"line {i}" for i in range(200_000))
    rows = [(i, body + f"\nown {i}", None, f"s{i}") for i in range(5)]
    began = time.time()
    got = {r.doc_id: (r.text, len(r.removed_lines)) for r in linedup.without_boilerplate(docs_of(rows)).collect()}
    assert time.time() - began < 120
    assert got == {0: (rows[0][1], 0)} | {i: (f"own {i}", 200_000) for i in range(1, 5)}


def test_clashing_columns(docs_of, spark):
    from pyspark.sql import functions as F

    rows = [(i, f"own {i}\nshared by many texts", None, f"s{i}") for i in range(6)]
    got = linedup.without_boilerplate(docs_of(rows, of=F.lit(5), removed_lines=F.lit("r"), gone=F.lit("g"), flags=F.lit(1.5)))
    assert got.columns[-5:] == ["of", "removed_lines", "gone", "flags", "_removed_lines"]
    assert {(r.of, r.removed_lines, r.gone, r.flags) for r in got.collect()} == {(5, "r", "g", 1.5)}
    assert sum(len(r["_removed_lines"]) for r in got.collect()) == 5


def test_only_near_lines_shuffle_their_sites(docs_of):
    """The sketches are merged from partial ones; a site is grouped by only under the join with the lines near the threshold."""
    rows = [(i, f"own {i}\nshared by many texts", None, f"s{i}") for i in range(6)]
    lines = linedup._lines(docs_of(rows), "doc_id", "text", "source")
    plans = []
    keep = linedup.cut
    linedup.cut = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df)
    try:
        linedup.boilerplate(lines).count()
    finally:
        linedup.cut = keep
    assert len(plans) == 1 and "partial_hll_sketch_agg" in plans[0]
    assert all("site" not in x for x in plans[0].splitlines() if "Exchange hashpartitioning" in x)


def test_empty_table(docs_of):
    assert linedup.digest(docs_of([])).count() == 0
