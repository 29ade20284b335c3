"""op13: rules and list against a plain loop; false positives, a joined filter, edge URLs, plan without Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from topiclake.llm import urlfilter as U

LOWER = str.maketrans(U._UPPER, U._LOWER)


def parts(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    raw = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(raw):])[0]
    host = raw.translate(LOWER)
    query = re.match(r"[^?#]*\?([^#]*)", rest)
    params = sorted(p for p in (query[1].split("&") if query else []) if p and not re.match("utm_|ref=|ref$", p))
    name = re.sub("^www\\.", "", re.sub(":(80|443)?$", "", re.sub("^.*@", "", host)))
    return host, path, name + path.rstrip("/") + ("?" + "&".join(params) if params else "")


def plain(url, listed):
    host, path, key = parts(url)
    fits = [(h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, verdict = max(fits, key=lambda r: len(r[0]))
        return host, path, rule, verdict
    return host, path, None, "block" if key is not None and key in listed else "allow"


URLS = [None, "", "no scheme", "://", "http://", "HTTP://A.Example.NET/en/1", "https://example.net/fr/", "http://example.net", "http://xexample.net/en/", "http://EXAMPLE.com/de/x?y", "http://example.com/DE/",
        "http://a.org/fr/", "http://a.org/fr", "http://org/fr/1#t", "http://a.org?x=/fr/", "http://u:p@a.org:80/b/?b=2&a=1&utm_source=z&ref=q&&refer=1#f", "https://www.a.org/b?refer=1&a=1&b=2",
        "http://É.a.org/É?É", "http://a.org/b\n/c", "x://y://z/p", "http://a.org/" + "long/" * 50_000, "http://a.org/b", "http://a.org/b/", "http://m.a.org/b", "http://a.org:8080/b"]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, "h", "v", 1) for i, u in enumerate(URLS + [f"http://s{i % 40}.example.com/en/{i}" for i in range(400)] + ["http://a.org/b"] * 50)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, verdict string, key int")


@pytest.fixture(scope="module")
def listed(spark):
    urls = [None, "junk", "http://WWW.a.org/b/", "http://a.org/b?b=2&a=1&refer=1", "http://a.org/b?b=2&a=1&refer=1", "http://a.org/" + "long/" * 50_000, "http://example.net/fr"]
    return spark.createDataFrame([(u,) for u in urls + [f"http://s{i % 40}.example.com/en/{i}" for i in range(0, 400, 3)]], "url string")


@pytest.mark.parametrize("bits,broadcast", [(16, U.BROADCAST_BYTES), (1, U.BROADCAST_BYTES), (16, 0)])
def test_against_plain(spark, pages, listed, bits, broadcast):
    out = U.judged(pages, listed, bits=bits, broadcast_bytes=broadcast)
    assert out.columns == ["page_id", "url", "host", "verdict", "key", "_host", "path", "rule", "_verdict"]
    keys = {parts(r.url)[2] for r in listed.collect()} - {None}
    got = {r.page_id: (r["_host"], r["path"], r["rule"], r["_verdict"]) for r in out.collect()}
    want = {r.page_id: plain(r.url, keys) for r in pages.collect()}
    assert out.count() == len(want) and got == want
    assert {v[3] for v in want.values()} == {"allow", "block"}


def test_bloom_has_every_key_and_few_others(spark):
    keys = spark.range(5000).select(F.concat(F.lit("a.org/"), "id").alias("key"))
    filt, blocks = U.bloom(keys, "key", 5000)
    assert blocks == 256
    look = spark.range(20000).select(F.concat(F.lit("a.org/"), "id").alias("key"), "id").withColumn("block", U._block(F.col("key"), blocks)).join(filt, "block", "left")
    for i, m in enumerate(U._masks(F.col("key"))):
        look = look.withColumn(f"w{i}", F.col(f"w{i}").bitwiseAND(m) == m)
    hits = [r.id for r in look.where(" AND ".join(f"w{i}" for i in range(8))).select("id").collect()]
    assert set(range(5000)) <= set(hits) and len(hits) < 5000 + 0.01 * 15000


def test_empty_tables_and_bounds(spark, pages, listed):
    assert U.judged(pages, listed.limit(0)).where("_verdict = 'block' AND rule IS NULL").count() == 0
    assert U.judged(pages.limit(0), listed).count() == 0
    with pytest.raises(ValueError, match="rules"):
        U.rule_of(F.lit(""), F.lit(""), [("a", "/", "block")] * 501)


def test_plan_is_native(pages, listed):
    plan = U.judged(pages, listed)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|MapIn", plan) and "BroadcastHashJoin" in plan


def test_longest_rule_wins(spark):
    rules = [("b.c", "/a", "allow"), ("c", "/abcd", "block"), ("c", "/", "block")]
    rule, verdict = U.rule_of(F.lit("a.b.c"), F.lit("/abcde"), rules)
    assert tuple(spark.range(1).select(rule, verdict).first()) == ("c/abcd", "block")
    rules = [("c", "/abc", "block"), ("b.c", "/a", "allow")]  # equal length: the longer host
    rule, verdict = U.rule_of(F.lit("a.b.c"), F.lit("/abcde"), rules)
    assert tuple(spark.range(1).select(rule, verdict).first()) == ("b.c/a", "allow")
