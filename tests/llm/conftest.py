from __future__ import annotations

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text[, lang, source]) as a documents table with an extra column whose name clashes."""

    def make(rows, **extra):
        rows = [(*r, *(None,) * (4 - len(r))) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return df.withColumns({"n_chars": F.length("text").cast("long"), "fp": F.lit("x"), "hits": F.lit(1), "score": F.lit(2.0), "row": F.lit("r"), **extra})

    return make
