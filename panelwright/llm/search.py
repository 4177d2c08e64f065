"""Exact top-k inner products by exhaustive term-at-a-time accumulation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.llm.tables import read

#: Expected rows of one tile: candidates scored together, queries that meet them, queries scored at a time.
TILE_CANDIDATES = 8_192
TILE_QUERIES = 4_096
SCORED_AT_ONCE = 256


def integer_terms(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, infinite or undefined component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def postings(rows: pd.Series) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """term -> positions of the rows that hold it, and their weights; zero weights have no posting."""
    lengths = rows.map(len).to_numpy()
    if not lengths.sum():
        return {}
    weights = np.concatenate([np.asarray(r, np.int64) for r in rows])
    positions = np.repeat(np.arange(len(rows)), lengths)
    terms = np.arange(len(weights)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    order = np.argsort(terms, kind="stable")
    order = order[weights[order] != 0]
    cuts = np.flatnonzero(np.diff(terms[order])) + 1
    return {int(terms[part[0]]): (positions[part], weights[part]) for part in np.split(order, cuts) if len(part)}


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest allowed scores by partition selection; among equals the first positions."""
    open_positions = np.flatnonzero(allowed)
    if len(open_positions) <= k:
        return open_positions
    values = scores[open_positions]
    least = np.partition(values, len(values) - k)[len(values) - k]
    above = np.flatnonzero(values > least)
    equal = np.flatnonzero(values == least)[: k - len(above)]
    return open_positions[np.concatenate([above, equal])]


def score_tile(candidates: pd.DataFrame, queries: pd.DataFrame, k: int) -> Iterator[pd.DataFrame]:
    """The k best candidates of each query in one tile.

    Query rows are sparse: each of their terms scatters its weighted posting
    into the queries' dense score arrays.
    """
    candidates = candidates.sort_values("vec_id", kind="stable")
    ids, index = candidates["vec_id"].to_numpy(), postings(candidates["terms"])
    for first in range(0, len(queries), SCORED_AT_ONCE):
        asked = queries.iloc[first : first + SCORED_AT_ONCE]
        scores = np.zeros((len(asked), len(ids)), np.int64)
        for term, (rows, weights) in postings(asked["terms"]).items():
            held, values = index.get(term, (np.empty(0, np.int64), None))
            if len(held) == len(ids):
                scores[rows] += weights[:, None] * values
            elif len(held):
                scores[np.ix_(rows, held)] += weights[:, None] * values
        for position, query in enumerate(asked["query_id"]):
            chosen = best(scores[position], ids != query, k)
            yield pd.DataFrame({"query_id": query, "vec_id": ids[chosen], "score": scores[position][chosen]})


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of every query with all other rows.

    Both sides have ``vec_id`` and ``terms`` (array of long; a vector that is
    shorter lacks the later terms).  Candidates and queries are dealt into tiles
    of a bounded expected size by hashes of their ids; each tile scores all its
    pairs, and the tiles' best are merged.  No index, bound or sample leaves a
    candidate out.

    Ties go to the smaller ``vec_id``.  A row of the query's own id is no
    candidate; repeated rows are candidates of their own, and of a repeated
    query the smallest vector asks.  Rows with a null id or null terms take no
    part; no rows on either side give no result.  Scores must fit a long.
    """
    rows = rows.select("vec_id", "terms").filter("vec_id IS NOT NULL AND terms IS NOT NULL")
    asked = (
        queries.filter("vec_id IS NOT NULL AND terms IS NOT NULL")
        .groupBy(F.col("vec_id").alias("query_id"))
        .agg(F.min("terms").alias("terms"))
    )
    tiles = rows.count() // TILE_CANDIDATES + 1
    sheets = asked.count() // TILE_QUERIES + 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.withColumn("tile", F.pmod(F.xxhash64("vec_id", "terms"), F.lit(tiles)).cast("int")).withColumn(
        "sheet", every(sheets)
    )
    asked = asked.withColumn("sheet", F.pmod(F.xxhash64("query_id"), F.lit(sheets)).cast("int")).withColumn(
        "tile", every(tiles)
    )

    def score(candidates: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        found = list(score_tile(candidates, part, k)) if len(candidates) and len(part) else []
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    found = (
        dealt.groupBy("tile", "sheet")
        .cogroup(asked.groupBy("tile", "sheet"))
        .applyInPandas(score, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        read(spark, sf_dir, "embeddings")
        .filter(usable(F.col("embedding")))
        .select("vec_id", integer_terms(F.col("embedding")).alias("terms"))
    )
    return top_k(rows, rows.filter("vec_id % 100 = 0"))


OP4_SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS terms
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.terms, c.terms), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM rows q JOIN rows c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
