"""Language identification by hyperdimensional letter n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from panelwright.llm.hashing import mix64, nth64
from panelwright.llm.tables import crc_mod, read

#: Dimensions of all vectors.
DIMENSIONS = 1024
#: Code points handled at a time; a longer text is handled alone, in pieces cut at spaces where there are any.
SLICE_CHARS = 1 << 20
#: Largest table of possible trigrams that is laid out in full; beyond it trigrams are sorted.
TABLE = 1 << 22
UNDETERMINED = "und"
_SPACE = 0x20


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_vectors(symbols: np.ndarray) -> np.ndarray:
    """A random vector of +1 and -1 for each symbol, the same wherever it is made."""
    seeds = mix64(symbols.astype(np.uint64) + np.uint64(0x51ED270B))
    words = np.stack([nth64(seeds, i) for i in range(DIMENSIONS // 64)], axis=1)
    return np.unpackbits(words.view(np.uint8), axis=1).astype(np.float32) * 2 - 1


def trigram_profiles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, trigram, vectors, has a letter): the trigram occurrences of some texts, and the bound vectors of the trigrams.

    Texts are lower-cased; runs of other characters than letters, and the ends,
    are one space.  A trigram binds its symbols' vectors, rotated by their place, by
    multiplication.
    """
    parts = [f" {text.lower()} " for text in texts]
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    is_letter = letters()[codes]
    symbols = np.where(is_letter, codes, _SPACE)
    kept = np.ones(len(codes), bool)
    kept[1:] = is_letter[1:] | is_letter[:-1] | (owner[1:] != owner[:-1])
    symbols, owner = symbols[kept], owner[kept]
    counts = np.bincount(symbols)
    alphabet = np.flatnonzero(counts)
    dense = np.zeros(len(counts), np.int64)
    dense[alphabet] = np.arange(len(alphabet))
    s, n = dense[symbols], len(alphabet)
    whole = owner[2:] == owner[:-2]
    whole &= symbols[1:-1] != _SPACE
    keys = ((s[:-2] * n + s[1:-1]) * n + s[2:])[whole]
    if n**3 <= TABLE:
        present = np.flatnonzero(np.bincount(keys, minlength=1))
        place = np.zeros(n**3, np.int64)
        place[present] = np.arange(len(present))
        trigram = place[keys]
    else:
        present, trigram = np.unique(keys, return_inverse=True)
    base = letter_vectors(alphabet)
    bound = np.roll(base, 2, axis=1)[present // (n * n)]
    bound *= np.roll(base, 1, axis=1)[present // n % n]
    bound *= base[present % n]
    has_letter = np.bincount(owner, weights=symbols != _SPACE, minlength=len(parts)) > 0
    return owner[2:][whole], trigram, bound, has_letter


def pieces(text: str) -> Iterator[str]:
    """A text in parts of SLICE_CHARS at most; cut at a space, the parts have the text's trigrams."""
    while len(text) > SLICE_CHARS:
        cut = text.rfind(" ", 1, SLICE_CHARS)
        cut = cut if cut > 0 else SLICE_CHARS
        yield text[:cut]
        text = text[cut:]
    yield text


def bundles(texts: list[str], groups: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the trigram vectors of each group of texts (n x DIMENSIONS), and which groups have a letter."""
    total, found = np.zeros((n, DIMENSIONS), np.float32), np.zeros(n, bool)
    parts = [(part, group) for text, group in zip(texts, groups.tolist()) for part in pieces(text)]
    first = 0
    for _, last in text_slices([part for part, _ in parts]):
        members = np.array([group for _, group in parts[first:last]])
        owner, trigram, bound, has_letter = trigram_profiles([part for part, _ in parts[first:last]])
        if len(bound):
            counts = np.bincount(members[owner] * len(bound) + trigram, minlength=n * len(bound))
            total += counts.reshape(n, len(bound)).astype(np.float32) @ bound
        np.logical_or.at(found, members, has_letter)
        first = last
    return total, found


def text_slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """First and last + 1 of consecutive texts of about SLICE_CHARS code points."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "") + 2
        if size >= SLICE_CHARS or i == len(texts) - 1:
            yield first, i + 1
            first, size = i + 1, 0


def profiles(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bundles, has a letter) of consecutive texts.  Null is empty."""
    for first, last in text_slices(texts):
        part = [t or "" for t in texts[first:last]]
        yield first, *bundles(part, np.arange(len(part)), len(part))


def prototypes(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their unit vectors from ``text``, ``lang``: the bundle of all trigrams of all texts of a language.

    Every task sums its texts per language; Spark adds the sums.  What comes to the
    driver is one vector per language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for first, last in text_slices(texts):
                names = sorted(set(langs[first:last]))
                groups = np.array([names.index(x) for x in langs[first:last]])
                vectors, _ = bundles([t or "" for t in texts[first:last]], groups, len(names))
                for name, vector in zip(names, vectors.astype(np.float64)):
                    sums[name] = sums.get(name, 0) + vector
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            ["lang", "vector"],
        )

    parts = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    added = (
        parts.mapInArrow(run, "lang string, vector array<double>")
        .select("lang", F.posexplode("vector"))
        .groupBy("lang", "pos")
        .agg(F.sum("col").alias("value"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("vector"))
        .orderBy("lang")
        .collect()
    )
    learned = [(row["lang"], np.array([x["value"] for x in row["vector"]])) for row in added]
    learned = [(lang, v / np.linalg.norm(v)) for lang, v in learned if np.linalg.norm(v) > 0]
    return [lang for lang, _ in learned], np.array([v for _, v in learned]).reshape(-1, DIMENSIONS)


def identify(docs: DataFrame, langs: list[str], vectors: np.ndarray, text: str = "text") -> DataFrame:
    """The columns of ``docs``, then ``lang_pred`` and ``score``: the closest prototype and its cosine (0 at least).

    Null texts, texts without a letter, and all texts if nothing was learned, are
    ``und`` with score 0; ties go to the first language.  Texts of any length are
    read whole.  Repeated rows stay, no rows give none, and input columns named
    ``lang_pred`` or ``score`` are replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    names = [f.name for f in kept]
    sides = vectors.T.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, found, has_letter in profiles(batch.column(text).to_pylist()):
                rows = batch.slice(first, len(found)).select(names)
                known = has_letter & bool(langs)
                if langs:
                    cosines = found @ sides / np.maximum(np.linalg.norm(found, axis=1), 1e-9)[:, None]
                    best = cosines.argmax(axis=1)
                    score = np.where(known, cosines.max(axis=1).clip(0, 1), 0.0)
                else:
                    best, score = np.zeros(len(found), int), np.zeros(len(found))
                pred = [langs[b] if k else UNDETERMINED for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(pred, pa.string()), pa.array(score.astype(float))], [*names, "lang_pred", "score"]
                )

    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.select(*names).mapInArrow(run, schema)


def predicted(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of all documents, learned from those that are not held out."""
    learned = prototypes(docs.filter(crc_mod("doc_id", 4) != 2).select("text", "lang"))
    return identify(docs.select("doc_id", "text"), *learned).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(read(spark, sf_dir, "documents"))
