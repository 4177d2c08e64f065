"""How filters of documents interact: failures read off a sparse document-term matrix, then counted for every filter order."""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.llm import hashing
from panelwright.llm.tables import read
from panelwright.session import landed

FILTERS = "ABCDE"
#: Limits of the filters: words of a text, and distinct words and capitals in a hundred.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
#: Words of a shard of the matrix, unless a single text has more.
SHARD_WORDS = 1 << 17

_POINT = (np.arange(256) & 0xC0) != 0x80
_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*|"]] = True


def sums(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(flags, dtype=np.int64)][cuts])


def csr(texts: pa.Array) -> tuple[pa.Array, Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]]:
    """The distinct words of a block of texts, and its CSR matrix over them in shards: rows, row cuts, columns, counts."""
    words = pc.ascii_split_whitespace(texts)
    offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
    coded = words.flatten()
    kept = pc.not_equal(coded, "")
    ends = np.r_[0, np.cumsum(kept.to_numpy(zero_copy_only=False))][offsets]
    coded = coded.filter(kept).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    width = max(len(coded.dictionary), 1)

    def parts() -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + SHARD_WORDS, "right")) - 1)
            rows = np.repeat(np.arange(last - first), np.diff(ends[first : last + 1]))
            cells = np.sort(rows * width + codes[ends[first] : ends[last]])
            new = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, np.int64)
            counts = np.diff(np.r_[new, len(cells)]).astype(np.int32)
            cells = cells[new]
            cuts = np.searchsorted(cells, np.arange(last - first + 1) * width)
            yield slice(first, last), cuts, (cells % width).astype(np.int32), counts
            first = last

    return coded.dictionary, parts()


def shards(docs: DataFrame) -> DataFrame:
    """Blocks of documents as CSR matrices over their own words, with what the other filters need; landed.

    ``docs`` has doc_id, text, part and digest.  A block is an Arrow batch.  Rows
    with ``doc_ids`` hold a shard of a block: its ids, parts and digests, cuts,
    columns and counts of the matrix, and a flag byte per document (filters C
    and D).  Rows with ``word`` are the block's dictionary: column ``code``
    stands for the word.
    """
    schema = (
        "block long, doc_ids array<long>, parts array<string>, digests array<binary>, flags binary, cuts binary, columns binary, "
        "counts binary, code int, word string"
    )
    fields = ["block", "doc_ids", "parts", "digests", "flags", "cuts", "columns", "counts", "code", "word"]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.binary()), *[pa.binary()] * 4, pa.int32(),
             pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = pc.fill_null(batch.column("text"), "")
            flags = []
            for _, data, cuts in hashing.slices(texts):
                capitals = 100 * sums(_CAPITAL[data], cuts) > MOST_CAPITALS * sums(_POINT[data], cuts)
                flags.append(capitals * 4 + (sums(_SYMBOL[data], cuts) > 0) * 8)
            flags = np.concatenate(flags).astype(np.uint8)
            words, parts = csr(texts)
            for at, cuts, columns, counts in parts:
                lists = [batch.column(c)[at.start : at.stop].to_pylist() for c in ("doc_id", "part", "digest")]
                binary = [x.tobytes() for x in (flags[at], cuts, columns, counts)]
                row = [[block], *[[x] for x in lists], *[[b] for b in binary], [None], [None]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], fields)
            for first in range(0, len(words), 16_384):
                part = words[first : first + 16_384]
                n = len(part)
                empty = [pa.nulls(n, t) for t in types[1:8]]
                code = pa.array(np.arange(first, first + n, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), *empty, code, part.cast(pa.string())], fields)
            block += 1

    return landed(docs.select("doc_id", "text", "part", "digest").mapInArrow(run, schema), "shards")


def numbered(blocks: DataFrame) -> DataFrame:
    """part, place, block, code, word: the entries of all blocks' dictionaries, with their words numbered; landed.

    Entries meet by word, once for each block that has it.  ``place`` counts the
    words of a task (``part``) in their order; ``word`` stands in the first entry of each.
    """
    schema = "part int, place long, block long, code int, word string"
    fields = ["part", "place", "block", "code", "word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, place = TaskContext.get().partitionId(), None, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("word")
            new = np.ones(len(words), bool)
            new[0] = words[0].as_py() != last
            new[1:] = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
            places = place + np.cumsum(new)
            last, place = words[-1].as_py(), int(places[-1])
            first = pc.if_else(pa.array(new), words, pa.scalar(None, words.type))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(words), part, np.int32)), pa.array(places), batch.column("block"), batch.column("code"), first],
                fields,
            )

    entries = blocks.filter("word IS NOT NULL").select("block", "code", "word")
    return landed(entries.repartition("word").sortWithinPartitions("word").mapInArrow(run, schema), "entries")


def dictionary(entries: DataFrame) -> DataFrame:
    """block, code, id and word of every entry: ``id`` numbers the distinct words of all documents from 0.

    ``word`` stands in one entry of each word.  The parts' counts, one row for
    each task that numbered words, are added up.
    """
    counts = entries.groupBy("part").agg((F.max("place") + 1).alias("words"))
    before = F.sum("words").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # as many rows as the shuffle has partitions
    offsets = F.broadcast(counts.select("part", F.coalesce(before, F.lit(0)).alias("offset")))
    return entries.join(offsets, "part").select("block", "code", (F.col("offset") + F.col("place")).alias("id"), "word")


def matrix(blocks: DataFrame, entries: DataFrame) -> DataFrame:
    """The document-term matrix: the blocks' CSR shards with the dictionary's ids as columns, ascending in each row; landed.

    block, doc_ids, parts, digests, flags, cuts (longs), columns (ints, or longs
    where the dictionary needs them) and counts (ints).  Only a block's own
    dictionary meets its shards, so a task holds one block, and works on one
    shard at a time.
    """
    width = np.int32 if entries.where("word IS NOT NULL").count() < 2**31 else np.int64
    named = dictionary(entries).select(F.col("block").alias("of"), "code", "id")
    whole = blocks.filter("doc_ids IS NOT NULL").drop("code", "word")
    order = whole.columns

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        codes = right.column("code").to_numpy()
        ids = np.zeros(len(codes), width)
        ids[codes] = right.column("id").to_numpy()
        out: dict[str, list[bytes]] = {"columns": [], "counts": []}
        for i in range(left.num_rows):
            cuts, columns, counts = (np.frombuffer(left.column(c)[i].as_buffer(), t)
                                     for c, t in (("cuts", np.int64), ("columns", np.int32), ("counts", np.int32)))
            terms = ids[columns]
            rank = np.lexsort((terms, np.repeat(np.arange(len(cuts) - 1, dtype=np.int32), np.diff(cuts))))
            out["columns"].append(terms[rank].tobytes())
            out["counts"].append(counts[rank].tobytes())
        found = [pa.array(out[c], left.schema.field(c).type) if c in out else left.column(c) for c in order]
        return pa.table(found, left.schema)

    return landed(whole.groupBy("block").cogroup(named.groupBy("of")).applyInArrow(run, whole.schema), "matrix")


def flagged(matrix: DataFrame) -> DataFrame:
    """doc_id, part, digest, n_words, n_distinct and mask (bit 0 for A to bit 3 for D) of every row of the matrix.

    Row sums of the counts decide A, row sums and numbers of nonzero cells B.
    """
    fields = ["doc_id", "part", "digest", "n_words", "n_distinct", "mask"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                cuts, flags = np.frombuffer(row["cuts"], np.int64), np.frombuffer(row["flags"], np.uint8)
                total, cells = sums(np.frombuffer(row["counts"], np.int32), cuts), np.diff(cuts)
                mask = (total < LEAST_WORDS) * 1 + (100 * cells < LEAST_DISTINCT * total) * 2 + flags
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["parts"], pa.string()), pa.array(row["digests"], pa.binary()),
                    pa.array(total), pa.array(cells), pa.array(mask.astype(np.int32)),
                ], fields)

    schema = "doc_id long, part string, digest binary, n_words long, n_distinct long, mask int"
    return matrix.select("doc_ids", "parts", "digests", "flags", "cuts", "counts").mapInArrow(run, schema)


def failures(docs: DataFrame, text: str = "text", key: str = "doc_id", part: str = "source") -> DataFrame:
    """doc_id, part, n_words, n_distinct and mask of every document; bit k of the mask is set if it fails filter k of ``FILTERS``.

    A: fewer than ``LEAST_WORDS`` words.  B: fewer than ``LEAST_DISTINCT``
    distinct words in a hundred.  C: more than ``MOST_CAPITALS`` of A-Z in a
    hundred code points.  D: one of ``#$%&*|``.  E: a smaller id has the same
    text; texts are compared by SHA-256.

    Null texts are empty: they fail A, and E if a smaller id has a null or empty
    one.  A row without an id fails no E and makes no other row fail it;
    repeated rows stay, and rows of one id do not make each other fail.  A null
    part is the empty string.  Other columns are not read.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    ready = docs.select(
        F.col(key).cast("long").alias("doc_id"), whole.alias("text"), F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
    )
    blocks = shards(ready)
    rows = landed(flagged(matrix(blocks, numbered(blocks))), "flagged")
    # written, so that a text with many copies is a hot key of a plain join, which Spark splits
    first = landed(rows.groupBy("digest").agg(F.min("doc_id").alias("first")), "first")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * 16
    return rows.join(first.hint("merge"), "digest").select(
        "doc_id", "part", "n_words", "n_distinct", (F.col("mask") + copy).alias("mask")
    )


def steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bits of the filters before it, bit of its filter) for all orders."""
    out = []
    for order in permutations(range(len(FILTERS))):
        name = "".join(FILTERS[i] for i in order)
        for at, i in enumerate(order):
            out.append((name, at + 1, sum(1 << j for j in order[:at]), 1 << i))
    return out


def audit(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step, with kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley.

    ``failed`` is the result of :func:`failures`; ``labels`` has doc_id,
    quality and toxic.  Documents are first counted by part and mask (at most
    32 rows a part), and the orders are worked out on these counts.  A document
    that fails k filters is removed by each of them in 1/k of the orders, which
    gives ``shapley``.  A document is good (toxic) if any of its label rows says
    so; null labels and labels without an id say nothing.  No documents give no rows.
    """
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    counted = (
        failed.join(marks.hint("merge"), "doc_id", "left")
        .groupBy("part", "mask")
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
             F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    )
    turns = json.dumps([dict(zip(("filter_order", "step", "before", "bit"), turn)) for turn in steps()])
    plan = F.explode(F.from_json(F.lit(turns), "array<struct<filter_order string, step int, before int, bit int>>"))
    opened = counted.repartition("part").select("part", "mask", "n", "good", "toxic", plan.alias("at")).select("*", "at.*")
    mask, before, bit = F.col("mask"), F.col("before"), F.col("bit")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0
    total = lambda when, what="n": F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0)).cast("long")
    share = F.col("n") * F.expr(f"{factorial(len(FILTERS))} div bit_count(mask)")
    return opened.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
        F.coalesce(F.sum(F.when(fails, share)), F.lit(0)).cast("long").alias("shapley"),
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failures(read(spark, sf_dir, "documents")), read(spark, sf_dir, "labels"))


OP13_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM docs),
failing AS (
  SELECT doc_id, part, len(ws) < {LEAST_WORDS} AS a, 100 * len(list_distinct(ws)) < {LEAST_DISTINCT} * len(ws) AS b,
         100 * len(regexp_extract_all(text, '[A-Z]')) > {MOST_CAPITALS} * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM docs JOIN words USING (r)),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT f.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
                CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS failed
  FROM failing f LEFT JOIN marks m ON f.doc_id = m.doc_id),
counted AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY ALL),
letters AS (SELECT unnest(string_split('{FILTERS}', '')) AS x),
orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
turns AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before
  FROM orders, range(1, 6) AS s(step)),
each AS (
  SELECT part, filter_order, step, x, failed, n, good, toxic, contains(failed, x) AS hit,
         failed <> '' AND regexp_matches(before, concat('[', failed, '!]')) AS gone
  FROM counted, turns),
audited AS (
  SELECT part, filter_order, step::INT AS step, x,
         coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (failed = x), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM each GROUP BY part, filter_order, step, x)
SELECT * EXCLUDE (x), (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM audited
"""
