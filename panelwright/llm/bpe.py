"""BPE encoding and decoding through tables of distinct words."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from panelwright.llm.tables import read

#: Words handed to the tokenizer at a time, and documents sent back to Spark at a time.
WORDS_AT_ONCE = 2_000
DOCUMENTS_AT_ONCE = 256


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, its pieces by id, and a special token to part words with (None if it has none)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    pieces = np.array([loaded.id_to_token(i) for i in range(loaded.get_vocab_size())], object)
    special = [t.content for t in loaded.get_added_tokens_decoder().values() if t.special and not (t.lstrip or t.rstrip)]
    return loaded, pieces, special[-1] if special else None


def word_table(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all distinct words in a row, and where each word's ids begin (and the last one's end).

    Words go to the tokenizer in lines, parted by a special token, which cuts a
    text before anything else happens to it.  Words that hold that token
    themselves go alone.
    """
    loaded, _, mark = tokenizer(path)
    encode = lambda text: np.array(loaded.encode(text, add_special_tokens=False).ids, np.int32)
    found: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    for first in range(0, len(words), WORDS_AT_ONCE):
        part = words[first : first + WORDS_AT_ONCE]
        if mark is None or any(mark in word for word in part):
            ids = [encode(word) for word in part]
            found.extend(ids)
            lengths.append(np.array([len(i) for i in ids]))
        else:
            line = encode(mark.join(part))
            marks = np.flatnonzero(line == loaded.token_to_id(mark))
            found.append(np.delete(line, marks))
            lengths.append(np.diff(np.r_[-1, marks, len(line)]) - 1)
    starts = np.r_[0, np.cumsum(np.concatenate(lengths))] if lengths else np.zeros(1, int)
    return np.concatenate(found) if found else np.empty(0, np.int32), starts


def encode_texts(texts: pa.Array, path: str) -> Iterator[tuple[pa.Array, pa.Array]]:
    """ids and decoded text of every text, some documents at a time.

    The words of all texts make one table of distinct words, each of which is
    encoded once; the words' positions bring the ids back into the texts, and a
    look-up of the ids in the table of pieces decodes them.
    """
    pieces = tokenizer(path)[1]
    words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = words.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    ids, starts = word_table(coded.dictionary.to_pylist(), path)
    begins = words.offsets.to_numpy() - words.offsets[0].as_py()
    for first in range(0, len(texts), DOCUMENTS_AT_ONCE):
        cuts = begins[first : first + DOCUMENTS_AT_ONCE + 1]
        part = codes[cuts[0] : cuts[-1]]
        lengths = starts[part + 1] - starts[part]
        ends = np.r_[0, np.cumsum(lengths)]
        flat = ids[np.repeat(starts[part] - ends[:-1], lengths) + np.arange(ends[-1])]
        bounds = ends[cuts - cuts[0]]
        named = pieces[flat]
        decoded = [" ".join(named[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat)), pa.array(decoded, pa.string())


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The columns of ``docs``, then ``ids`` (array of int) and ``decoded`` (string).

    ``ids`` are those of the tokenizers library for the whole text without added
    special tokens; ``decoded`` is its text of these ids, special tokens
    included.  The tokenizer must be one whose pieces never span white space and
    whose decoder joins pieces by spaces, as ``word_bpe_49k.json`` is and does:
    then the ids of a text are those of its words, and each distinct word among
    the documents of an Arrow batch is encoded once.  Rows stay in their task.

    Null and empty texts, and texts of white space, have no ids and an empty
    decoded text.  Repeated rows stay; no rows give none; input columns named
    ``ids`` or ``decoded`` are replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("ids", "decoded")]
    schema = StructType([*kept, StructField("ids", ArrayType(IntegerType(), False)), StructField("decoded", StringType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for ids, decoded in encode_texts(batch.column(text), path):
                rows = batch.slice(first, len(ids)).select(names)
                first += len(ids)
                yield pa.RecordBatch.from_arrays([*rows.columns, ids, decoded], [*names, "ids", "decoded"])

    return docs.select(*names).mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def encoded_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """:func:`digests` of all documents; the path is that of the public word-level vocabulary unless given."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return digests(encode(docs.select("doc_id", "text"), path))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_documents(read(spark, sf_dir, "documents"))
