"""Line dedup by distinct-site spread: boilerplate is a line that stands on many sites.

Lines are keyed by 96 bits of hash of the trimmed line.  Each task makes one HyperLogLog sketch of the sites per line it
has; the sketches of a line are merged by aggregation, so what is shuffled is a row per task and line, whatever the number of
its occurrences.  A line whose estimate is near the threshold (within ``margin``) gets an exact distinct count, for which
only such lines' sites are shuffled; lines well under or over it
are decided by the sketch, whose relative error at 2^lg_k registers is far smaller than the margin.
The threshold is low because a hot source adds one site only, whatever its number of documents.
Every occurrence of a boilerplate line goes but one: the first in the row with
the smallest id, so text that only copies carry is not lost altogether.

Edge cases: blank lines are never boilerplate and stay.  A null site counts as
no site; a null text stays null; a text all of whose lines go becomes empty.
Occurrences in rows without id never are the one that stays, unless no row has
an id.  Repeated rows (same id and text) are treated alike.  Ties for the first occurrence (one id, several texts) go to the
least hash of the text.  Very long texts are split once and lose their lines in one pass; an empty table gives no row; other columns pass
through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, fresh

# Fixed value, from the spread of repeated lines in the given tables (README): 5 sites leave twice as many of them in on skewed sources, 3 take twice as many lines of copies out.
SITES, MARGIN, LG_K = 4, 0.25, 12
# Lines (of about 100 bytes) up to which a set of lines is broadcast to the texts; a larger one is joined by a shuffle whose hot lines are split.
BROADCAST_LINES = 200_000


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    slim = docs.select(F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"), F.col(text_col).cast("string").alias("text"))
    whole = slim.select("id", "site", F.xxhash64("text").alias("of"), F.split("text", "\n", -1).alias("all"))  # hashed before the lines come apart, not for each
    each = whole.select("id", "site", "of", F.posexplode("all").alias("place", "line"))
    each = each.withColumn("line", F.trim("line")).where("line <> ''")
    return each.select("id", "site", "of", "place", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"))


def _small(lines: DataFrame) -> DataFrame:
    """``lines`` (computed before) marked for broadcast if they are few."""
    return F.broadcast(lines) if lines.count() <= BROADCAST_LINES else lines


def boilerplate(lines: DataFrame, sites: int = SITES, margin: float = MARGIN, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2, first) of the lines on at least ``sites`` sites."""
    spot = F.struct(F.col("id").isNull(), F.col("id"), F.col("of"), F.col("place"))
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("about"), F.min(spot).alias("first"))
    spread = cut(spread.where(F.col("about") >= sites * (1 - margin)))
    near = spread.where(F.col("about") < sites * (1 + margin))
    their = lines.select("h1", "h2", "site").join(_small(near.select("h1", "h2")), ["h1", "h2"], "left_semi")
    exact = their.distinct().groupBy("h1", "h2").agg(F.count("site").alias("n")).where(F.col("n") >= sites)
    far = spread.where(F.col("about") >= sites * (1 + margin))
    return far.drop("about").unionByName(near.join(exact.select("h1", "h2"), ["h1", "h2"], "left_semi").drop("about"))


def without_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", sites: int = SITES) -> DataFrame:
    """``docs`` with the lines gone, and a column ``removed_lines``: the places (from 0) of those that went."""
    lines = _lines(docs, id_col, text_col, site_col)
    spot = F.struct(F.col("id").isNull(), F.col("id"), F.col("of"), F.col("place"))
    hits = lines.join(_small(cut(boilerplate(lines, sites))), ["h1", "h2"]).where(~spot.eqNullSafe(F.col("first")))
    gone = hits.groupBy("id", "of").agg(F.sort_array(F.collect_set("place")).alias("gone"))
    gone = gone.withColumn("flags", _flags(F.col("gone")))  # made before the join, so looked up and not made again per line
    of, name = fresh(docs, "of"), fresh(docs, "removed_lines")
    keyed = docs.withColumn(of, F.xxhash64(F.col(text_col).cast("string")))
    j = keyed.join(gone, (keyed[of] == gone["of"]) & keyed[id_col].eqNullSafe(gone["id"]), "left")
    places = F.coalesce(gone["gone"], F.array().cast("array<int>"))
    return j.select(*(_text(keyed[c], gone["flags"]).alias(c) if c == text_col else keyed[c] for c in docs.columns), places.alias(name))


def _flags(places: Column) -> Column:
    """For each place up to the last of ``places`` whether it is one of them."""
    all_of = F.sequence(F.lit(0), F.array_max(places))
    mark = lambda p, is_gone: F.transform(p, lambda i: F.struct(i.alias("i"), F.lit(is_gone).alias("gone")))
    return F.transform(F.sort_array(F.concat(mark(places, True), mark(F.array_except(all_of, places), False))), lambda m: m["gone"])


def _text(text: Column, flags: Column) -> Column:
    kept = F.filter(F.split(text, "\n", -1), lambda _, i: ~F.coalesce(F.get(flags, i), F.lit(False)))
    return F.when(flags.isNull(), text).otherwise(F.array_join(kept, "\n"))


def digest(docs: DataFrame) -> DataFrame:
    """Per document: lines, lines that went, and SHA-256 of the text that stays (null for null)."""
    out = without_boilerplate(docs.select("doc_id", "source", "text", (F.size(F.split("text", "\n", -1))).alias("n_lines")))
    return out.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
                      F.size("removed_lines").cast("long").alias("n_removed"), F.sha2("text", 256).alias("text_sha256"))


#: The same in DuckDB, with exact distinct counts only.
ORACLE = f"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
t AS (SELECT doc_id, source, raw, place, trim(raw) AS line FROM l),
b AS (SELECT line, min({{'d': doc_id, 'p': place}}) AS first FROM t WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {SITES}),
m AS (SELECT t.*, b.line IS NOT NULL AND b.first <> {{'d': doc_id, 'p': place}} AS gone FROM t LEFT JOIN b ON t.line = b.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  sha256(coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS text_sha256 FROM m GROUP BY doc_id
"""
