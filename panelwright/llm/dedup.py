"""Near duplicates: SuperMinHash signatures, banding, verification on full sets and union-find groups."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import hashing
from panelwright.llm.components import components
from panelwright.llm.tables import read
from panelwright.session import landed

#: Members of a bucket that are compared in one task; larger buckets are cut into tiles of this size.
TILE = 2_048
#: Members of a bucket with which all its members are compared first.
HUBS = 6


@dataclass(frozen=True)
class Rule:
    """Documents are linked whose sets of ``width``-word shingles have a Jaccard similarity of ``percent`` or more.

    The first ``bands`` x ``rows`` of ``slots`` slots make the bands.  At a
    similarity of 0.85 a pair shares no band with probability 1e-8, at 0.8 with
    2e-6.  All slots make the sketch.
    """

    width: int = 5
    percent: int = 80
    bands: int = 25
    rows: int = 4
    slots: int = 256

    @property
    def doubt(self) -> float:
        """Share of equal slots below which a pair is not verified: five standard deviations below the similarity."""
        p = self.percent / 100
        return p - 5 * (p * (1 - p) / self.slots) ** 0.5


def superminhash(elements: np.ndarray, owner: np.ndarray, owners: int, m: int) -> np.ndarray:
    """Signatures (owners x m) of the element sets; rows of empty sets hold the largest word.

    Every element draws its own random permutation of the slots, one position
    at a time (Fisher-Yates), and in round j offers its slot the value j + r,
    r in [0, 1): here j in the top 8 bits and r in the others.  An owner stops
    after the first round in which all its slots hold values of rounds so far,
    as later offers are larger.  Elements must be distinct within an owner.
    """
    table = np.full(owners * m, ~np.uint64(0), np.uint64)
    seeds, base = elements, owner * m
    turned = None
    for j in range(m):
        draw = hashing.nth64(seeds, 2 * j + 1) >> np.uint64(32)
        swap = j + ((draw * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        if turned is None:
            slot = swap
        else:
            at = np.arange(len(seeds))
            slot = turned[at, swap].astype(np.int64)
            turned[at, swap] = turned[:, j]
        value = (hashing.nth64(seeds, 2 * j) >> np.uint64(8)) | np.uint64(j << 56)
        np.minimum.at(table, base + slot, value)
        filled = (table.reshape(owners, m) >> np.uint64(56)).max(axis=1) <= j
        going = ~filled[base // m]
        if not going.any():
            break
        if turned is None:
            # the first swap of the permutation, made up for by those who go on
            at = np.flatnonzero(going)
            turned = np.tile(np.arange(m, dtype=np.uint8), (len(at), 1))
            turned[np.arange(len(at)), swap[at]] = 0
            seeds, base = seeds[at], base[at]
        elif not going.all():
            seeds, base, turned = seeds[going], base[going], turned[going]
    return table.reshape(owners, m)


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, digest (of the set), buckets (a long per band) and sketch (a byte per slot)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, cuts in hashing.slices(batch.column("text")):
                hashes, _, _, counts = hashing.words(data, cuts)
                elements, owner = hashing.distinct(*hashing.shingles(hashes, counts, rule.width))
                n = len(cuts) - 1
                sizes = np.bincount(owner, minlength=n)
                table = superminhash(elements, owner, n, rule.slots)
                keys = np.zeros((n, rule.bands), np.uint64)
                banded = table[:, : rule.bands * rule.rows].reshape(n, rule.bands, rule.rows)
                for i in range(rule.rows):
                    keys = hashing.mix64(keys * np.uint64(31) + banded[:, :, i])
                keys = hashing.mix64(keys + np.arange(rule.bands, dtype=np.uint64)).view(np.int64)
                digest = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
                for i in (0, 1):
                    np.add.at(digest[i], owner, hashing.nth64(elements, 7 + i))
                sketch = (hashing.mix64(table) & np.uint64(255)).astype(np.uint8)
                buckets = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), rule.bands).cast(pa.list_(pa.int64()))
                digests = pa.FixedSizeListArray.from_arrays(
                    pa.array(np.stack(digest, axis=1).ravel().view(np.int64)), 2
                ).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), pa.array(sizes), digests, buckets,
                     pa.array([row.tobytes() for row in sketch], pa.binary())],
                    ["doc_id", "n_shingles", "digest", "buckets", "sketch"],
                )

    schema = "doc_id long, n_shingles long, digest array<long>, buckets array<long>, sketch binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id and its full set of shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, cuts in hashing.slices(batch.column("text")):
                hashes, _, _, counts = hashing.words(data, cuts)
                elements, owner = hashing.distinct(*hashing.shingles(hashes, counts, rule.width))
                ends = np.searchsorted(owner, np.arange(len(cuts)))
                sets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(elements.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(cuts) - 1), sets], ["doc_id", "set"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, set array<long>")


def _alike(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of equal slots of two arrays of sketches, row by row."""
    return (left == right).mean(axis=-1)


def _rows(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), np.uint8).reshape(len(sketches), -1)


def promising(pairs: DataFrame, heads: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (u, v) whose set sizes allow the similarity and whose sketches do not speak against it."""
    side = lambda name: heads.select(
        F.col("doc_id").alias(name), F.col("n_shingles").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch")
    )
    sized = pairs.join(side("u"), "u").join(side("v"), "v").filter(
        100 * F.least("u_n", "v_n") >= rule.percent * F.greatest("u_n", "v_n")
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                likely = _alike(_rows(batch.column("u_sketch")), _rows(batch.column("v_sketch"))) >= rule.doubt
                yield batch.select(["u", "v"]).filter(pa.array(likely))

    return sized.select("u", "v", "u_sketch", "v_sketch").mapInArrow(keep, "u long, v long")


def set_table(docs: DataFrame, asked: DataFrame, rule: Rule) -> DataFrame:
    """The full sets of the documents asked for, made of their texts."""
    # as many ids as duplicates, so no side to broadcast at scale
    texts = docs.select("doc_id", "text").join(asked.hint("merge"), "doc_id", "left_semi")
    return landed(shingle_sets(texts, rule), "sets")


def verified(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (u, v) that are similar by their full sets."""
    pairs = landed(pairs, "pairs")
    sets = set_table(docs, pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), rule)
    side = lambda name: sets.select(F.col("doc_id").alias(name), F.col("set").alias(f"{name}_set"))
    shared = F.size(F.array_intersect("u_set", "v_set"))
    return (
        pairs.join(side("u"), "u")
        .join(side("v"), "v")
        .withColumn("shared", shared)
        .filter(100 * F.col("shared") >= rule.percent * (F.size("u_set") + F.size("v_set") - F.col("shared")))
        .select("u", "v")
    )


_TILE_KEYS = ["bucket", "low", "high"]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The tiles of rows that come sorted by tile."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        keys = [held.column(n).to_numpy() for n in _TILE_KEYS]
        new = np.logical_or.reduce([np.diff(k) != 0 for k in keys])
        cuts = np.r_[0, np.flatnonzero(new) + 1] if len(held) else [0]
        for first, last in zip(cuts[:-1], cuts[1:]):
            yield held.slice(first, last - first)
        held = held.slice(cuts[-1])
    if held is not None and len(held):
        yield held


def _candidates(tile: pa.Table, rule: Rule) -> Iterator[tuple[int, np.ndarray]]:
    """(row, later rows) of a tile that may be similar, are in different components, and share no earlier band.

    So a pair is a candidate in the bucket of one band only.
    """
    tops, chunk, sizes = (tile.column(n).to_numpy() for n in ("component", "chunk", "n_shingles"))
    sketch = _rows(tile.column("sketch").combine_chunks())
    bands = np.concatenate(tile.column("buckets").to_numpy()).reshape(len(tile), -1)
    bucket, cross = tile.column("bucket")[0].as_py(), tile.column("low")[0] != tile.column("high")[0]
    for i in range(len(tile) - 1):
        rest = slice(i + 1, None)
        fit = tops[rest] != tops[i]
        fit &= 100 * np.minimum(sizes[rest], sizes[i]) >= rule.percent * np.maximum(sizes[rest], sizes[i])
        if cross:
            fit &= chunk[rest] != chunk[i]
        at = np.flatnonzero(fit) + i + 1
        at = at[_alike(sketch[at], sketch[i]) >= rule.doubt] if len(at) else at
        at = at[bands[i, (bands[at] == bands[i]).argmax(axis=1)] == bucket] if len(at) else at
        if len(at):
            yield i, at


def _suspects(rule: Rule):
    """The members of tiles that are in a candidate pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            rows = [np.r_[i, at] for i, at in _candidates(tile, rule)]
            if rows:
                yield from tile.select([*_TILE_KEYS, "doc_id"]).take(np.unique(np.concatenate(rows))).to_batches()

    return run


def _links(rule: Rule):
    """A forest of the verified links of each tile: a pair whose ends are joined already is not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            ids, sets = tile.column("doc_id").to_pylist(), tile.column("set").to_numpy()
            top = list(range(len(ids)))

            def find(x: int) -> int:
                while top[x] != x:
                    top[x] = x = top[top[x]]
                return x

            found = []
            for i, at in _candidates(tile, rule):
                for j in at.tolist():
                    if find(i) != find(j):
                        shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                        if 100 * shared >= rule.percent * (len(sets[i]) + len(sets[j]) - shared):
                            top[find(i)] = find(j)
                            found.append((ids[i], ids[j]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["u", "v"])

    return run


def links_across(buckets: DataFrame, heads: DataFrame, tops: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Links (u, v) that join all documents of a bucket that can be joined, between its components so far.

    Only buckets that still hold several components are opened.  A bucket above
    ``TILE`` members is cut into chunks by a hash, and every pair of chunks is a
    tile, so no task gets a whole hot bucket and no pair is left out.  Sketches
    tell which members of a tile may have a partner; the full sets of these
    alone are then compared, inside the tile, and only links leave it.
    """
    placed = buckets.join(tops.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    opened = (
        placed.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("first"), F.max("component").alias("last"))
        .filter("first <> last AND n > 2")
        .select("bucket", F.expr(f"cast((n - 1) div {TILE} + 1 as int)").alias("chunks"))
    )
    tiled = (
        placed.join(opened, "bucket")
        .withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
            "doc_id", "component", "chunk",
        )
    )
    tiled = landed(tiled, "tiles")
    described = tiled.join(heads.select("doc_id", "n_shingles", "sketch", "buckets"), "doc_id")
    order = [*_TILE_KEYS, "doc_id"]
    dealt = described.select(*order, "component", "chunk", "n_shingles", "sketch", "buckets").repartition(*_TILE_KEYS)
    schema = "bucket long, low int, high int, doc_id long"
    suspects = landed(dealt.sortWithinPartitions(*order).mapInArrow(_suspects(rule), schema), "suspects")
    asked = suspects.select("doc_id").distinct()
    sets = set_table(docs, asked, rule)
    held = described.join(suspects, order, "left_semi").join(sets, "doc_id")
    return (
        held.select(*order, "component", "chunk", "n_shingles", "sketch", "buckets", "set")
        .repartition(*_TILE_KEYS)
        .sortWithinPartitions(*order)
        .mapInArrow(_links(rule), "u long, v long")
    )


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text).

    Documents with equal sets are one class, and only its smallest id goes on.
    In each bucket of a band all classes are paired with the same ``HUBS``
    members, those with the least hashes; promising pairs are verified on full
    sets, and union-find makes components of the links.  Buckets that then still hold several components are compared
    in full, pairs of one component left out, and the components are made anew
    of all links.  So no link that could join two components of a bucket is
    missed, and no bucket is expanded into all its pairs.

    Empty and null texts have 0 shingles and are linked with nothing.  Rows with
    a repeated id are one node, whose links are those of all its texts; a null id
    has a null component and is kept.  No rows give none; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.filter("n > 1").isEmpty():
        return _by_unique_ids(docs, rule)
    # each row is a document of its own first; then the components of the rows of one id are joined
    rows = landed(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    by_row = rows.select(F.when(F.col("doc_id").isNotNull(), F.col("row")).alias("doc_id"), "text")
    found = landed(_by_unique_ids(by_row, rule), "by_row")
    named = landed(
        rows.filter("doc_id IS NOT NULL").select("doc_id", "row")
        .join(found.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("inner")), "row"),
        "named",
    )
    least = landed(named.groupBy("inner").agg(F.min("doc_id").alias("v")), "least")
    groups = components(named.join(least, "inner").select(F.col("doc_id").alias("u"), "v"))
    top = F.coalesce("component", "doc_id")
    return (
        named.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", top.alias("component_id"), (F.col("doc_id") == top).alias("kept"))
        .unionByName(found.filter("doc_id IS NULL"))
    )


def _by_unique_ids(docs: DataFrame, rule: Rule) -> DataFrame:
    """:func:`near_duplicates` of rows that repeat no id, nulls aside."""
    signed = landed(signatures(docs, rule), "signatures")
    known = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    # written, so that the joins with them are of two plain tables, in which Spark splits a hot key
    classes = landed(
        known.groupBy("digest", "n_shingles")
        .agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n"),
        "classes",
    )
    members = landed(
        known.select("doc_id", "digest", "n_shingles")
        .join(classes, ["digest", "n_shingles"], "left")
        .select("doc_id", F.coalesce("head", "doc_id").alias("head")),
        "members",
    )
    heads = known.join(members.filter("doc_id = head").select("doc_id"), "doc_id", "left_semi").select(
        "doc_id", "n_shingles", "sketch", "buckets"
    )
    heads = landed(heads, "heads")
    every = heads.select("doc_id", F.explode("buckets").alias("bucket"))
    least = [F.min(F.struct(F.xxhash64("doc_id", F.lit(k)), "doc_id"))["doc_id"] for k in range(HUBS)]
    shared = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.array_distinct(F.array(*least)).alias("hubs"))
    buckets = landed(every.join(landed(shared.filter("n > 1"), "shared"), "bucket"), "buckets")
    to_hubs = (
        buckets.select("doc_id", F.explode("hubs").alias("hub"))
        .filter("doc_id <> hub")
        .select(F.least("doc_id", "hub").alias("u"), F.greatest("doc_id", "hub").alias("v"))
        .distinct()
    )
    first = landed(verified(promising(to_hubs, heads, rule), docs, rule), "edges")
    tops = components(first)
    second = links_across(buckets.select("doc_id", "bucket"), heads, tops, docs, rule)
    copies = members.filter("doc_id <> head").select(F.col("head").alias("u"), F.col("doc_id").alias("v"))
    stars = tops.filter("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
    groups = components(stars.unionAll(second).unionAll(copies))
    return (
        signed.select("doc_id", "n_shingles")
        .join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
        )
    )


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` without all but the smallest id of each group of near duplicates.

    Rows that repeat an id and its text are one document, of which one row stays.
    """
    dropped = near_duplicates(docs, rule).filter("NOT kept").select("doc_id").distinct()
    left = docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
    repeated = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if repeated.isEmpty():
        return left
    return left.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]).unionByName(left.filter("doc_id IS NULL"))


#: What the query asks for: 3-word shingles, similarity 0.85.
OP6 = Rule(width=3, percent=85)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), OP6)


OP6_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
           THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT u, v FROM ways UNION SELECT r.u, b.v FROM reach r JOIN ways b ON r.v = b.u),
tops AS (SELECT u, min(v) AS v FROM reach GROUP BY u)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least(t.v, d.doc_id), d.doc_id) AS component_id,
       coalesce(least(t.v, d.doc_id), d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN tops t ON t.u = d.doc_id
"""
