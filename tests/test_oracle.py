"""Every registered query against its DuckDB oracle on sf0.001 (rows-only where no oracle exists)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import compare, duck

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLE:
        ok, msg = compare(df, con, ORACLE[name])
        assert ok, msg
    else:
        assert df.count() >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert [r.topic for r in rows] == ["kafka-events", "kafka-gps", "kafka-orders"]
    assert df.columns == ["topic", "count", "min_key", "max_key"]
