"""Connected components of an edge table by local union-find and star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.session import landed


def union_find(left: np.ndarray, right: np.ndarray) -> dict[int, int]:
    """node -> smallest node of its component, for the nodes of some edges."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in zip(left.tolist(), right.tolist()):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


#: Edges that one task contracts by union-find, whose forest it holds in memory.
EDGES_PER_TASK = 500_000


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of a task as stars around the smallest nodes of their components."""
    parts = [(batch["u"].to_numpy(), batch["v"].to_numpy()) for batch in batches]
    if parts:
        found = union_find(*(np.concatenate(side) for side in zip(*parts)))
        yield pd.DataFrame([(x, top) for x, top in found.items() if x != top], columns=["u", "v"], dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node that can be reached, for every node of the edges ``u``, ``v`` (long).

    Tasks first contract bounded shares of the edges by union-find.  Then large
    and small stars alternate until all edges are stars around their smallest
    nodes; each round is a shuffle with a minimum per node, written to the
    shared folder.  Loops and repeated edges change nothing; rows with a null
    end are left out; no edges give no rows.
    """
    links = landed(edges.select("u", "v").filter("u <> v"), "links")
    tasks = links.count() // EDGES_PER_TASK + 1
    links = landed(links.repartition(tasks).mapInPandas(_contract, "u long, v long").distinct(), "links")
    while True:
        children = links.groupBy(F.col("u").alias("child")).agg(F.count(F.lit(1)).alias("parents"))
        # stars already: one parent each, and no parent is a child
        unfinished = children.filter("parents > 1").select("child").unionAll(
            links.join(children, F.col("v") == F.col("child"), "left_semi").select("u")
        )
        done = unfinished.isEmpty()
        if done:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the minima are written before they are joined, so that Spark can split the edges of a hot node
        least = landed(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = landed(large.filter("u <> v"), "links")
        low = landed(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        links = landed(small.filter("u <> v").distinct(), "links")
