"""URL filter: rules of host and path first, else a list of canonical URLs behind a blocked Bloom filter.

All of it is DataFrame expressions.  A listed URL's hash names one block of eight 64-bit words and sets one bit in each word, so
the filter is a table of blocks made by ``bit_or``.  A page looks at one block: if a bit is missing it is not listed, and that is the end
of it.  What passes joins the list itself on the canonical text, which removes the false positives.  Blocks are broadcast while their
number, fixed by the list's size, keeps them under ``BROADCAST_BYTES``; a larger filter is joined by block, and skewed blocks are split at run time.

Canonical: scheme and fragment dropped; host with A-Z in lower case, without user, leading ``www.`` and default port; path without trailing
slashes; query parameters sorted, without empty ones and the tracking ones (``ref``, ``utm_…``).

Edge cases: a null URL, or one without ``://``, has empty host and path, fits no rule and is never listed.  Null or such URLs in the
list count for nothing, repeated ones once.  An empty list lets every page pass that no rule names.  Repeated pages are judged alike; long URLs are
treated whole; all columns of the pages stay, the new ones get free names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, shared

# Fixed values: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
# Bits of the filter per listed URL; rules one expression holds at most; largest filter that is broadcast.
BITS, MOST_RULES, BROADCAST_BYTES = 16, 500, 64 << 20
_WORDS, _BLOCK_BYTES = 8, 100  # 512 bits a block; a row with its header
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after(url: Column) -> Column:
    """What follows the first ``://``; null without."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))


def host_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(_after(url), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The canonical form; null for a URL that has none."""
    host, path = host_path(url)
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)?$", ""), "^www\\.", "")
    params = F.split(F.regexp_extract(_after(url), "^[^?#]*\\?([^#]*)", 1), "&")
    params = F.array_sort(F.filter(params, lambda p: (p != "") & ~p.rlike("^(utm_|ref=|ref$)")))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.when(_after(url).isNotNull(), F.concat(host, F.regexp_replace(path, "/+$", ""), query))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule (text of host and path; of equals the one of the longer host) that fits, and its verdict; null without."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; more than {MOST_RULES} belong in a list")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(blocks - 1).cast("long"))


def _masks(key: Column) -> list[Column]:
    """One bit for each word of the block, by six bits of a second hash."""
    h = F.xxhash64(F.lit(7), key)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")) for i in range(_WORDS)]


def bloom(keys: DataFrame, key: str, n: int, bits: int = BITS) -> tuple[DataFrame, int]:
    """(block, w0 … w7) of the filter over ``keys``, ``n`` of them, and the number of blocks (a power of two)."""
    blocks = 1 << max(0, -(-n * bits // (64 * _WORDS)) - 1).bit_length()
    words = keys.select(_block(F.col(key), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))])
    return words.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_WORDS)]), blocks


def judged(pages: DataFrame, listed: DataFrame, rules=RULES, url: str = "url", listed_url: str = "url", bits: int = BITS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` with host, path, rule, verdict (free names, in this order): the rule's, else ``block`` for listed URLs and ``allow`` for others."""
    spark = pages.sparkSession
    path = shared(spark, "listed")
    listed.select(canonical(F.col(listed_url).cast("string")).alias("key")).where("key IS NOT NULL").distinct().write.parquet(path)
    keys = spark.read.parquet(path)
    names = [fresh(pages, c) for c in ("host", "path", "rule", "verdict")]
    key, block = fresh(pages, "key"), fresh(pages, "block")
    host, at = host_path(F.col(url).cast("string"))
    rows = pages.withColumns({names[0]: host, names[1]: at})
    rule, verdict = rule_of(F.col(names[0]), F.col(names[1]), rules)
    rows = rows.withColumns({names[2]: rule, names[3]: verdict})
    ruled = rows.where(F.col(names[2]).isNotNull())
    rest = rows.where(F.col(names[2]).isNull()).withColumn(key, canonical(F.col(url).cast("string")))
    n = keys.count()
    filt, blocks = bloom(keys, "key", n, bits)
    filt = filt.select(F.col("block").alias(block), F.struct(*[f"w{i}" for i in range(_WORDS)]).alias(words := fresh(pages, "words")))
    if blocks * _BLOCK_BYTES <= broadcast_bytes:
        filt = F.broadcast(filt)
    rest = rest.withColumn(block, _block(F.col(key), blocks)).join(filt, block, "left")
    hit = reduce(lambda a, b: a & b, [F.col(f"{words}.w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col(key)))])
    hit = F.coalesce(hit & F.col(key).isNotNull(), F.lit(False))
    clear = rest.where(~hit).withColumn(names[3], F.lit("allow"))
    found = rest.where(hit).join(keys.select(F.col("key").alias(key), F.lit(True).alias(mark := fresh(pages, "mark"))), key, "left")
    found = found.withColumn(names[3], F.when(F.col(mark), "block").otherwise("allow"))
    columns = [*pages.columns, *names]
    return ruled.select(*columns).unionByName(clear.select(*columns)).unionByName(found.select(*columns))


def digest(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The pages judged; listed are the URLs of pages whose number carries a label of toxic or poor text."""
    bad = labels.where("toxic = 1 OR quality = 0").select(F.col("doc_id").alias("page_id")).distinct()
    pages = pages.select("page_id", "url")
    return judged(pages, pages.join(bad, "page_id", "left_semi")).drop("url")


#: The same in DuckDB, with an exact join only.
ORACLE = f"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
q AS (SELECT page_id, rest, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p),
c AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_|ref=|ref$)'))) AS params FROM q),
k AS (SELECT *, CASE WHEN rest IS NOT NULL THEN regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':(80|443)?$', ''), '^www\\.', '') || regexp_replace(path, '/+$', '')
  || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS key FROM c),
l AS (SELECT DISTINCT key FROM k WHERE key IS NOT NULL AND page_id IN (SELECT doc_id FROM labels WHERE toxic = 1 OR quality = 0)),
r(h, p, v) AS (VALUES {', '.join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
f AS (SELECT k.page_id, max_by(r.h || r.p, length(r.h || r.p)) AS rule, max_by(r.v, length(r.h || r.p)) AS v
  FROM k JOIN r ON (k.host = r.h OR ends_with(k.host, '.' || r.h)) AND starts_with(k.path, r.p) GROUP BY k.page_id)
SELECT k.page_id, host, path, f.rule, coalesce(f.v, CASE WHEN l.key IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM k LEFT JOIN f ON f.page_id = k.page_id LEFT JOIN l ON l.key = k.key
"""
