from __future__ import annotations

import pytest
from pyspark.sql import types as T

from panelwright.session import ship

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of (doc_id, text, lang, source) rows."""

    def make(rows, extra=()):
        rows = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(rows, DOCUMENTS)
        return df.selectExpr("*", *extra)

    return make
