from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.llm import search

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def terms(spark, rows):
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("x"))
    return df.filter(search.usable(F.col("embedding"))).select(
        "vec_id", search.integer_terms(F.col("embedding")).alias("terms"))


def brute(rows, asks, k):
    out = []
    for q, qv in asks:
        scored = []
        for c, cv in rows:
            if c != q:
                scored.append((-sum(a * b for a, b in zip(qv, cv)), c))
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("tile,sheet", [(8192, 4096), (40, 3)])
def test_top_k_is_exhaustive(spark, monkeypatch, tile, sheet):
    monkeypatch.setattr(search, "TILE_CANDIDATES", tile)
    monkeypatch.setattr(search, "TILE_QUERIES", sheet)
    rng = random.Random(5)
    rows = [(i, [rng.choice([0.0, 0.0, rng.uniform(-1, 1)]) for _ in range(rng.choice([6, 6, 4]))]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 6) for i in range(60)]  # ties
    whole = [(i, [math.floor(1024 * struct) for struct in map(float, v)]) for i, v in rows]
    df = terms(spark, rows)
    exact = {r["vec_id"]: r["terms"] for r in df.collect()}
    whole = sorted(exact.items())
    got = search.top_k(df, df.filter("vec_id % 100 = 0"), 10)
    found = sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())
    assert found == brute(whole, [w for w in whole if w[0] % 100 == 0], 10)


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0]), (1, [1.0, None]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, [0.5]), (None, [1.0, 1.0]), (6, [])]
    got = [tuple(r) for r in search.top_k(terms(spark, rows), terms(spark, rows).filter("vec_id = 0")).collect()]
    assert got == [(0, 1, 5, 512 * 1024), (0, 2, 6, 0)]


def test_repeated_rows_and_queries(spark):
    rows = [(0, [1.0]), (0, [2.0]), (7, [1.0]), (7, [1.0])]
    df = terms(spark, rows)
    got = [tuple(r) for r in search.top_k(df, df.filter("vec_id = 0"), 3).collect()]
    assert got == [(0, 1, 7, 1 << 20), (0, 2, 7, 1 << 20)]


def test_nothing(spark):
    df = terms(spark, [])
    assert search.top_k(df, df).collect() == []
    some = terms(spark, [(1, [1.0])])
    assert search.top_k(some, df).collect() == [] and search.top_k(some, some).collect() == []
