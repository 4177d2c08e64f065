"""Log-likelihood of whole documents under word counts of the corpus and a gated recurrent model of word classes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.llm import gru, hashing
from panelwright.llm.tables import crc_mod, read
from panelwright.session import landed, scratch_path

#: Classes: the end of a document, the most frequent words one by one, and the other words by their spelling.
FREQUENT, SPELLINGS = 63, 64
CLASSES = 1 + FREQUENT + SPELLINGS
#: Rounds that deal out the training documents, after each of which the tasks' weights are averaged.
ROUNDS = 4
#: Learning rate at the first round, falling to none; parallel streams of a task, and their least windows, for small tables.
RATE, STREAMS, LEAST_WINDOWS = 0.01, 128, 16
#: Tokens of documents that a task lays end to end at a time to learn, and that it scores together.
SEQUENCE, TOGETHER = 1 << 20, 1 << 22
#: Size of the recurrent state.
HIDDEN = 32
#: Distinct words of a row of a block's word table.
CHUNK = 16_384

_END = np.uint64(0x7E5D3C1B9A78F642)


def tokens(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, spelling, tokens per text) of a slice of texts: the words with A-Z as a-z, then the end of each text.

    The spelling is a hash of the last two bytes.
    """
    hashes, starts, ends, counts = hashing.words(data, cuts)
    lengths = np.diff(counts) + 1
    total = int(lengths.sum())
    last = np.cumsum(lengths) - 1
    is_word = np.ones(total, bool)
    is_word[last] = False
    out, spelling = np.full(total, _END, np.uint64), np.zeros(total, np.uint8)
    out[is_word] = hashes
    if len(hashes):
        folded = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
        tail = folded[ends - 1] * np.uint64(256) + np.where(ends - starts > 1, folded[ends - 2], 0).astype(np.uint64)
        spelling[is_word] = hashing.mix64(tail) % np.uint64(SPELLINGS)
    return out, spelling, lengths


def coded(docs: DataFrame) -> DataFrame:
    """Blocks of documents as codes into their own tables of distinct words, in the shared folder.

    ``docs`` has doc_id, text and learn (boolean).  A block is an Arrow batch.
    Rows with ``codes`` are documents: doc_id, learn, n_tokens and their codes,
    compressed.  Rows with ``words`` are parts of a block's table from code
    ``base`` on: hash, training tokens and spelling of each word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            found = [tokens(data, cuts) for _, data, cuts in hashing.slices(batch.column("text"))]
            if not found:
                continue
            hashes, spelling, lengths = (np.concatenate(x) for x in zip(*found))
            codes, words = pd.factorize(hashes)
            learn = batch.column("learn").to_numpy(zero_copy_only=False)
            counts = np.bincount(codes, weights=np.repeat(learn, lengths), minlength=len(words)).astype(np.int64)
            shape = np.zeros(len(words), np.uint8)
            shape[codes] = spelling
            block = part * (1 << 24) + number
            ends = np.cumsum(lengths)
            packed = [
                pa.compress(codes[b - n : b].astype(np.int32).tobytes(), codec="zstd", asbytes=True)
                for n, b in zip(lengths.tolist(), ends.tolist())
            ]
            bases = list(range(0, len(words), CHUNK))
            rows, more = len(batch), len(bases)
            entries = pa.StructArray.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(counts), pa.array(shape.astype(np.int16))], ["hash", "n", "spelling"]
            )
            tables = pa.ListArray.from_arrays(pa.array([*bases, len(words)], pa.int32()), entries)
            columns = {
                "block": pa.array(np.full(rows + more, block)),
                "doc_id": pa.concat_arrays([batch.column("doc_id"), pa.nulls(more, pa.int64())]),
                "learn": pa.concat_arrays([batch.column("learn"), pa.nulls(more, pa.bool_())]),
                "n_tokens": pa.array([*lengths.tolist(), *[None] * more], pa.int64()),
                "codes": pa.array([*packed, *[None] * more], pa.binary()),
                "base": pa.array([*[None] * rows, *bases], pa.int32()),
                "words": pa.concat_arrays([pa.nulls(rows, tables.type), tables]),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = (
        "block long, doc_id long, learn boolean, n_tokens long, codes binary, base int, "
        "words array<struct<hash:long, n:long, spelling:smallint>>"
    )
    return landed(docs.select("doc_id", "text", "learn").mapInArrow(run, schema), "coded")


@dataclass
class Counts:
    """What the corpus counts say: tokens, distinct words, the frequent words, and the spelling classes."""

    tokens: int
    distinct: int
    discount: float
    frequent: list[int]
    #: By class: training tokens and distinct training words.
    class_tokens: np.ndarray
    class_words: np.ndarray


def word_counts(blocks: DataFrame) -> tuple[DataFrame, Counts]:
    """(block, code, hash, spelling, c of every block's words; the totals), from the training tokens of all blocks.

    A word's rows, one per block that has it, meet in one window; c is its count
    in all of them.
    """
    entries = blocks.filter("words IS NOT NULL").select("block", "base", F.posexplode("words").alias("pos", "word")).select(
        "block", (F.col("base") + F.col("pos")).alias("code"), "word.*"
    )
    by_word = Window.partitionBy("hash")
    first = F.row_number().over(by_word.orderBy("block")) == 1
    counted = landed(
        entries.select("block", "code", "hash", "spelling", F.sum("n").over(by_word).alias("c"), first.alias("first")), "counted"
    )
    words = counted.filter("first AND c > 0")
    totals = words.agg(
        F.sum("c"), F.count(F.lit(1)), F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1))
    ).first()
    n, v, once, twice = (x or 0 for x in totals)
    end = int(np.array(_END).view(np.int64))
    frequent = [r["hash"] for r in words.filter(F.col("hash") != end).orderBy(F.desc("c"), "hash").limit(FREQUENT).collect()]
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in words.groupBy(class_of(frequent).alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        class_tokens[row["k"]], class_words[row["k"]] = row["c"], row["v"]
    discount = once / (once + 2 * twice) if once else 0.0
    return counted, Counts(n, v, min(discount, 0.99), frequent, class_tokens, class_words)


def class_of(frequent: list[int]) -> Column:
    """The class of a word by its columns ``hash`` and ``spelling``."""
    end = int(np.array(_END).view(np.int64))
    column = F.when(F.col("hash") == end, 0)
    if frequent:
        numbers = F.create_map(*[F.lit(x) for i, h in enumerate(frequent) for x in (h, i + 1)])
        column = column.when(F.col("hash").isin(frequent), numbers[F.col("hash")])
    return column.otherwise(F.col("spelling") + 1 + FREQUENT).cast("int")


def block_classes(documents: pd.DataFrame, words: pd.DataFrame, counts: Counts) -> pd.DataFrame:
    """The documents of one block with their classes, given its words' c and classes.

    doc_id, learn, n_tokens, n_known, base_score; ``within`` (the log10
    probability of all words within their classes), ``classes`` (the class
    numbers in order, compressed), and the training round the document is dealt to.
    """
    size = int(words["code"].max()) + 1
    c, k = np.zeros(size), np.zeros(size, np.uint8)
    c[words["code"].to_numpy()] = words["c"].to_numpy()
    k[words["code"].to_numpy()] = words["k"].to_numpy()
    base = np.log10((c + 0.1) / (counts.tokens + 0.1 * (counts.distinct + 1)))
    # of the words of a class: the counted ones less a discount each, and all others as one with what is taken
    held = np.maximum(counts.class_tokens[k], 1e-9)
    known = np.maximum(c - counts.discount, 1e-9) / held
    other = np.where(counts.class_tokens[k] > 0, np.maximum(counts.discount * counts.class_words[k], 0.5) / held, 1.0)
    within = np.where(k <= FREQUENT, 0.0, np.log10(np.where(c > 0, known, np.minimum(other, 1.0))))
    lengths = documents["n_tokens"].to_numpy()
    codes = np.concatenate([
        np.frombuffer(pa.decompress(packed, 4 * n, codec="zstd", asbytes=True), np.int32)
        for packed, n in zip(documents["codes"], lengths.tolist())
    ])
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(documents)), lengths)
    add = lambda values: np.bincount(owner, weights=values[codes], minlength=len(documents))
    classes = k[codes]
    learn = documents["learn"].to_numpy(bool)
    return pd.DataFrame({
        "doc_id": documents["doc_id"].astype("Int64"),
        "learn": learn,
        "n_tokens": lengths,
        "n_known": add((c > 0).astype(float)).astype(np.int64),
        "base_score": add(base),
        "within": add(within),
        "classes": [
            pa.compress(classes[b - n : b].tobytes(), codec="zstd", asbytes=True) for n, b in zip(lengths.tolist(), ends.tolist())
        ],
        # training documents take turns
        "round": np.maximum(np.cumsum(learn) - 1, 0) % ROUNDS,
    })


def classed(blocks: DataFrame, counted: DataFrame, counts: Counts) -> DataFrame:
    """:func:`block_classes` of all blocks, in the shared folder, a directory per round."""
    words = counted.select("block", "code", "c", class_of(counts.frequent).alias("k"))
    texts = blocks.filter("codes IS NOT NULL").select("block", "doc_id", "learn", "n_tokens", "codes")

    def run(key: tuple, part: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        return block_classes(part, table, counts)

    schema = (
        "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, within double, classes binary, round int"
    )
    rows = texts.groupBy("block").cogroup(words.groupBy("block")).applyInPandas(run, schema)
    path = scratch_path(blocks.sparkSession, "classed")
    rows.write.partitionBy("round").option("compression", "zstd").parquet(path)
    return blocks.sparkSession.read.schema(schema).parquet(path)


def _unpacked(classes: pa.BinaryScalar, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(classes.as_buffer(), n, codec="zstd", asbytes=True), np.uint8)


def trained_round(documents: DataFrame, weights: gru.Weights, rate: float) -> gru.Weights:
    """The weights after every task has gone over all of its documents from the given ones, averaged by the tasks' tokens.

    ``documents`` has n_tokens and classes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, total, size = gru.Trainer(weights), 0, 0
        held: list[np.ndarray] = []
        ready: list[np.ndarray] = []

        def learn(rows: list[np.ndarray]) -> int:
            sequence = np.concatenate(rows)
            trainer.run(sequence, min(STREAMS, len(sequence) // (LEAST_WINDOWS * gru.WINDOW)), rate, rate)
            return len(sequence)

        for batch in batches:
            for n, classes in zip(batch.column("n_tokens").to_pylist(), batch.column("classes")):
                held.append(_unpacked(classes, n))
                size += n
                if size >= SEQUENCE:
                    # the one before is learned now, so that a short rest is never learned alone
                    total += learn(ready) if ready else 0
                    held, ready, size = [], held, 0
        if ready or held:
            total += learn(ready + held)
            vector = pa.array([gru.packed(trainer.weights)], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), vector], ["n_tokens", "vector"])

    done = documents.select("n_tokens", "classes").mapInArrow(run, "n_tokens long, vector array<float>")
    weighed = done.select("n_tokens", F.posexplode("vector").alias("at", "w"))
    mean = F.sum(F.col("n_tokens") * F.col("w").cast("double")) / F.sum("n_tokens")
    means = {r["at"]: r["mean"] for r in weighed.groupBy("at").agg(mean.alias("mean")).collect()}
    if not means:
        return weights
    return gru.unpacked(np.array([means[i] for i in range(len(means))], np.float32), weights)


def trained(documents: DataFrame, counts: Counts, hidden: int, passes: int) -> gru.Weights:
    """Recurrent weights fitted on all rows of :func:`classed` with ``learn``, gone over ``passes`` times.

    Each round takes its share of the documents; the weights alone come to the
    driver.  The first weights say how frequent the classes are.
    """
    weights = gru.initial(CLASSES, hidden, 1)
    if not counts.tokens:
        return weights
    shares = (counts.class_tokens + 1) / (counts.class_tokens + 1).sum()
    weights["bias"] = np.log(shares).astype(np.float32)
    for r in range(ROUNDS * passes):
        own = documents.filter((F.col("round") == r % ROUNDS) & F.col("learn"))
        weights = trained_round(own, weights, RATE * (1 - r / (ROUNDS * passes)))
    return weights


def scored(documents: DataFrame, weights: gru.Weights) -> DataFrame:
    """doc_id, learn, n_tokens, n_known, base_score and score of every row of :func:`classed`."""
    kept = ["doc_id", "learn", "n_tokens", "n_known", "base_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("n_tokens").to_numpy()
            ends = np.cumsum(lengths)
            first = 0
            while first < len(lengths):
                before = ends[first] - lengths[first]
                last = max(first + 1, int(np.searchsorted(ends, before + TOGETHER, "right")))
                part = batch.slice(first, last - first)
                own = lengths[first:last]
                line = np.concatenate([_unpacked(c, n) for c, n in zip(part.column("classes"), own.tolist())])
                score = part.column("within").to_numpy() + gru.score(weights, line, own) / np.log(10)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept), pa.array(score)], [*kept, "score"])
                first = last

    schema = "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double"
    return documents.select(*kept, "within", "classes").mapInArrow(run, schema)


def log_likelihoods(docs: DataFrame, hidden: int = HIDDEN, passes: int = 1) -> DataFrame:
    """doc_id, learn, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text, learn).

    Counts are those of all tokens of the rows with ``learn``.  The model factors
    a token's probability into that of its class after all tokens before it, by
    a gated recurrent network whose state runs through the whole document, and
    that of the word within its class, by the counts of the corpus with absolute
    discounting; words never counted share what the discount frees.  The recurrent
    weights are fitted on the same rows in rounds, ``passes`` times over: tasks learn side by side, and
    their weights are averaged, so scores depend a little on how rows are dealt to tasks.

    Documents meet the counts of their words block by block: a block is an Arrow
    batch of documents with its table of distinct words, and what is shuffled
    are these tables and the documents as codes into them.  They meet once: what
    is written there holds all that training and scoring need.

    A null or empty text is one end token.  Rows without ``learn`` or with a null
    id are scored too; repeated rows count and are scored as often as they
    are there.  Without training rows every word is unknown.  No rows give none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("learn", F.lit(False)).alias("learn"))
    blocks = coded(rows)
    counted, counts = word_counts(blocks)
    documents = classed(blocks, counted, counts)
    weights = trained(documents, counts, hidden, passes)
    return scored(documents, weights).withColumn("train_tokens", F.lit(counts.tokens).cast("long"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.coalesce(crc_mod("doc_id", 10) != 0, F.lit(False))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", learn.alias("learn"))
    return log_likelihoods(docs).select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
