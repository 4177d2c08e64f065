"""Toxicity of texts whose words may be disguised: a noisy channel, Viterbi decoding, and weights of restored words."""

from __future__ import annotations

import math
import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from panelwright.llm import hashing
from panelwright.llm.tables import crc_mod, read
from panelwright.session import landed

#: Log-likelihood ratio from which a word counts as a sign of a class, and the least documents of the class that hold it.
EVIDENCE = 20.0
LEAST_DOCUMENTS = 3
#: Strength of the prior that the summed evidence needs no scaling, in training rows.
FAITH = 5.0
#: Summed log odds beyond which more signs say no more, so that the line is fitted where the classes meet.
ENOUGH = 12.0
#: Letters from which on a sign is looked for anywhere in letters written one by one; a shorter one must be all of them.
ANYWHERE = 4

# What a written character may stand for besides itself.
DISGUISES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "{": "c", "#": "h",
    "*": "aeiou", "¡": "i", "§": "s", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s",
}
SEPARATORS = frozenset(".-_*~'`^|/\\,:;+=·•​‌‍­﻿")
#: Four or more of one character say no more than three.
_LONG_RUN = re.compile(r"(.)\1{3,}", re.DOTALL)
#: Log probabilities of the channel.
DISGUISED, SEPARATED, REPEATED, ACCENTED = -1.0, -0.5, -0.7, -1.5


@dataclass
class CharacterModel:
    """Interpolated trigram model of the letters of words; ``^`` is the start and ``$`` the end."""

    trigrams: dict[str, int]
    bigrams: dict[str, int] = field(init=False)
    contexts: dict[str, int] = field(init=False)
    singles: dict[str, int] = field(init=False)
    letters: dict[str, int] = field(init=False)

    def __post_init__(self) -> None:
        self.bigrams, self.contexts, self.singles, self.letters = {}, {}, {}, {}
        for key, n in self.trigrams.items():
            self.contexts[key[:2]] = self.contexts.get(key[:2], 0) + n
            self.bigrams[key[1:]] = self.bigrams.get(key[1:], 0) + n
            self.singles[key[1]] = self.singles.get(key[1], 0) + n
            self.letters[key[2]] = self.letters.get(key[2], 0) + n
        self.total = sum(self.letters.values())
        self.known: dict[str, float] = {}

    def log_p(self, context: str, letter: str) -> float:
        if (found := self.known.get(context + letter)) is None:
            found = self.known[context + letter] = self.estimate(context, letter)
        return found

    def estimate(self, context: str, letter: str) -> float:
        p = 0.001 / 256 + 0.049 * self.letters.get(letter, 0) / max(self.total, 1)
        p += 0.25 * self.bigrams.get(context[1] + letter, 0) / max(self.singles.get(context[1], 0), 1)
        p += 0.70 * self.trigrams.get(context + letter, 0) / max(self.contexts.get(context, 0), 1)
        return math.log(p)


def readings(char: str) -> list[tuple[str, float]]:
    """Letters that a written character may stand for, with their channel log probabilities."""
    found = [(letter, DISGUISED) for letter in DISGUISES.get(char, "")]
    if char.isalpha():
        found.append((char, 0.0 if char not in DISGUISES else DISGUISED))
        plain = unicodedata.normalize("NFD", char)[0]
        if plain != char:
            found.append((plain, ACCENTED))
    return found


def decode(word: str, model: CharacterModel, stretch: bool = True) -> str:
    """The most probable word behind a written one, by the Viterbi algorithm over the lattice of its readings.

    A state is the last two letters.  A character gives one of its readings, or
    nothing: a separator may be left out, and in a word with a long run or many
    pairs so may a repetition of the character before it, unless ``stretch`` is off.
    """
    pairs = [a == b for a, b in zip(word, word[1:])]
    stretched = stretch and (sum(pairs) >= 3 or any(a and b for a, b in zip(pairs, pairs[1:])))
    # a path is its last letter and the path before it
    states: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    for i, char in enumerate(word):
        following: dict[str, tuple[float, tuple | None]] = {}

        def offer(state: str, score: float, path: tuple | None) -> None:
            if state not in following or score > following[state][0]:
                following[state] = (score, path)

        options = readings(char)
        for state, (score, path) in states.items():
            for letter, cost in options:
                offer(state[1] + letter, score + cost + model.log_p(state, letter), (letter, path))
            if char in SEPARATORS or not options:
                offer(state, score + SEPARATED, path)
            if i and stretched and char == word[i - 1]:
                offer(state, score + REPEATED, path)
        states = following
    _, path = max(((score + model.log_p(state, "$"), path) for state, (score, path) in states.items()), key=lambda end: end[0])
    letters = []
    while path is not None:
        letter, path = path
        letters.append(letter)
    return "".join(reversed(letters))


def trimmed(token: str) -> str:
    """Lower case, compatibility forms composed, long runs cut to three, marks and plain punctuation cut off at both ends."""
    word = unicodedata.normalize("NFKC", token.lower()) if not token.isascii() else token.lower()
    word = word.strip(".,;:?\"'()[]{}<>/\\-_~`^=%&“”„«»…¿")
    word = _LONG_RUN.sub(r"\1\1\1", word)
    while len(word) > 1 and not word[-1].isalnum() and (word[-1] == word[-2] or word[-1] in "!*#+|"):
        word = word[:-1]
    while len(word) > 1 and not word[0].isalnum() and (word[0] == word[1] or word[0] in "#*+|¡"):
        word = word[1:]
    return word


def is_disguised(word: str) -> bool:
    """Letters with other characters between them, long runs of one letter, or letters of two scripts."""
    if len(word) < 3:
        return False
    if not word.isalpha():
        return sum(c.isalpha() for c in word) >= 1 and sum(c.isalpha() or c in DISGUISES for c in word) >= 3
    pairs = [a == b for a, b in zip(word, word[1:])]
    if any(a and b for a, b in zip(pairs, pairs[1:])) or sum(pairs) >= 3:
        return True
    return not word.isascii() and any(c in DISGUISES for c in word) and any(c.isascii() for c in word)


def signs(token: str, model: CharacterModel) -> set[str]:
    """The features of a token: the word as written and as restored."""
    word = trimmed(token)
    words = {word.strip("!$@*+|#¡")}
    if is_disguised(word):
        words.add(decode(word, model))
    return {w for w in words if len(w) > 1}


def spaced_signs(run: str, model: CharacterModel, wanted: dict[str, int] | None) -> set[str]:
    """The features of letters written one by one: the wanted words that the letters, or what is behind them, hold.

    Where words begin and end is not to be seen, so longer words are looked for anywhere.
    """
    if wanted is None:
        return signs(run, model)
    run = trimmed(run)
    # many words together have pairs of letters that none of them needs to be stretched for
    found = {run, decode(run, model), decode(run, model, False)} if is_disguised(run) else {run}
    return {word for word in wanted if word in found or (len(word) >= ANYWHERE and any(word in reading for reading in found))}


def token_table(texts: pa.Array) -> tuple[list[str], int, np.ndarray, np.ndarray]:
    """(distinct tokens, how many are words, text, token) of all texts.

    After the words come the runs of three or more single characters, joined.
    """
    words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = words.flatten().dictionary_encode()
    tokens, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(words).to_numpy())
    single = np.fromiter((len(t) == 1 for t in tokens), bool, len(tokens))[codes]
    # borders of runs of single characters inside one text
    borders = np.ones(len(codes) + 1, bool)
    if len(codes):
        borders[1:-1] = (single[1:] != single[:-1]) | (owner[1:] != owner[:-1])
    change = np.flatnonzero(borders) if len(codes) else np.empty(0, np.int64)
    starts = np.flatnonzero((np.diff(change) >= 3) & single[change[:-1]]) if len(change) else []
    extra: dict[str, int] = {}
    more = [
        (owner[change[i]], extra.setdefault("".join(tokens[c] for c in codes[change[i] : change[i + 1]]), len(tokens) + len(extra)))
        for i in starts
    ]
    if more:
        owner = np.concatenate([owner, np.array([o for o, _ in more], np.int32)])
        codes = np.concatenate([codes, np.array([c for _, c in more], np.int32)])
    return tokens + list(extra), len(tokens), owner, codes


def occurrences(texts: pa.Array, model: CharacterModel, wanted: dict[str, int] | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(features, text, feature): the distinct features of every text, or only those wanted."""
    tokens, words, owner, codes = token_table(texts)
    names: dict[str, int] = {} if wanted is None else wanted
    flat, lengths = array("q"), np.zeros(len(tokens), np.int32)
    for i, token in enumerate(tokens):
        found = signs(token, model) if i < words else spaced_signs(token, model, wanted)
        held = [names.setdefault(s, len(names)) for s in found] if wanted is None else [names[s] for s in found if s in names]
        if held:
            flat.extend(held)
            lengths[i] = len(held)
    features = np.frombuffer(flat, np.int64) if flat else np.empty(0, np.int64)
    some = np.flatnonzero(lengths[codes])
    owner, codes = owner[some].astype(np.int64), codes[some]
    times = lengths[codes].astype(np.int64)
    starts = (np.cumsum(lengths, dtype=np.int64) - lengths)[codes]
    ends = np.cumsum(times)
    feature = features[np.repeat(starts - (ends - times), times) + np.arange(int(times.sum()))]
    pairs = np.unique(np.repeat(owner, times) * max(len(names), 1) + feature)
    return list(names), pairs // max(len(names), 1), pairs % max(len(names), 1)


@dataclass
class Toxicity:
    """A trained model: the channel's character model, log odds of the features, and a line from their sum to log odds."""

    letters: CharacterModel
    weights: dict[str, float]
    slope: float
    intercept: float

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """The summed log odds of each text's features, up to ENOUGH; null is empty."""
        index = {name: i for i, name in enumerate(self.weights)}
        values = np.array(list(self.weights.values()))
        _, owner, feature = occurrences(texts, self.letters, index)
        summed = np.bincount(owner, weights=values[feature] if len(feature) else None, minlength=len(texts))
        return np.minimum(summed.astype(float), ENOUGH)

    def score(self, texts: pa.Array) -> np.ndarray:
        """The probability of the class 1 for each text."""
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * self.evidence(texts), -30, 30)))


def fit_line(sums: DataFrame, prior: float) -> tuple[float, float]:
    """Slope and intercept of a logistic regression on one number, by Newton steps, drawn towards (1, prior).

    ``sums`` has evidence, label and count.  Every step is one aggregation, of which five numbers come to the driver.
    """
    x, label, times = F.col("evidence"), F.col("label"), F.col("count")
    start = np.array([1.0, prior])
    line = start.copy()
    for _ in range(50):
        logit = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x * float(line[0]) + float(line[1])))
        p = 1 / (1 + F.exp(-logit))
        missed, bend = (label - p) * times, p * (1 - p) * times
        found = sums.agg(F.sum(missed * x), F.sum(missed), F.sum(bend * x * x), F.sum(bend * x), F.sum(bend)).first()
        slope, level, xx, xy, yy = found
        gradient = np.array([slope, level]) - FAITH * (line - start)
        step = np.linalg.solve(np.array([[xx, xy], [xy, yy]]) + FAITH * np.eye(2), gradient)
        line += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(line[0]), float(line[1])


def training_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """label, text of all labelled rows, one of each family of near copies: that with the least id.

    Families are told on rows without their texts, so the texts are shuffled once, to the rows chosen.
    """
    marked = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    # an id may stand for several texts
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("digest"), "text")

    def family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The least hash of a text's 3-word shingles: near copies mostly share it."""
        for batch in batches:
            least = np.zeros(len(batch), np.uint64)
            for first, data, cuts in hashing.slices(batch.column("text")):
                hashes, _, _, counts = hashing.words(data, cuts)
                values, owner = hashing.shingles(hashes, counts, 3)
                found = np.full(len(cuts) - 1, ~np.uint64(0), np.uint64)
                np.minimum.at(found, owner, values)
                least[first : first + len(found)] = found
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "digest"]).columns, pa.array(least.view(np.int64))], ["doc_id", "digest", "family"]
            )

    kinds = texts.schema
    families = texts.mapInArrow(family, StructType([kinds["doc_id"], kinds["digest"], StructField("family", LongType())]))
    chosen = (
        families.join(marked, "doc_id")
        .groupBy("family", "label").agg(F.min(F.struct("doc_id", "digest")).alias("least"))
        .groupBy("least.doc_id", "least.digest").agg(F.collect_set("label").alias("labels"))
    )
    rows = texts.join(chosen, ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
    return landed(rows.select(F.explode("labels").alias("label"), "text"), "training")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Toxicity:
    """The model of all labelled documents; ``labels`` must hold training rows only.

    Passes of Spark over the training rows count the letter trigrams and, in
    texts restored with them, the documents of each class that hold a feature; a
    third sums their evidence, and a line through it makes probabilities.
    Without rows of both classes nothing is learned and every score is the same:
    near 1 for toxic rows only, below 0.5 for clean ones or none.
    """
    rows = training_rows(docs, labels, label)

    def trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            coded = pc.value_counts(pc.ascii_split_whitespace(batch.column("text")).flatten())
            for token, n in zip(coded.field("values").to_pylist(), coded.field("counts").to_pylist()):
                word = trimmed(token)
                if word.isalpha():
                    padded = f"^^{word}$"
                    for i in range(len(padded) - 2):
                        key = padded[i : i + 3]
                        counts[key] = counts.get(key, 0) + n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"]
        )

    grams = rows.mapInArrow(trigrams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1")
    model = CharacterModel({r["gram"]: r["n"] for r in grams.collect()})

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, owner, feature = occurrences(batch.column("text"), model, None)
            toxic = batch.column("label").to_numpy()[owner] == 1
            ones = np.bincount(feature[toxic], minlength=len(names))
            zeros = np.bincount(feature[~toxic], minlength=len(names))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ones), pa.array(zeros)], ["name", "t", "c"])

    classes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = classes.get(1, 0), classes.get(0, 0)
    if not toxic or not clean:
        return Toxicity(model, {}, 0.0, math.log((toxic + 0.5) / (clean + 1)))
    share = toxic / (toxic + clean)
    t, c, n = F.col("t").cast("double"), F.col("c").cast("double"), F.col("t") + F.col("c")
    ratio = 2 * (
        F.when(t > 0, t * F.log(t / (n * share))).otherwise(0.0)
        + F.when(c > 0, c * F.log(c / (n * (1 - share)))).otherwise(0.0)
    )
    weight = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    chosen = (
        rows.mapInArrow(features, "name string, t long, c long")
        .groupBy("name")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        .filter((F.col("t") >= LEAST_DOCUMENTS) & (t / toxic > c / clean) & (ratio >= EVIDENCE))
        .select("name", weight.alias("weight"))
        .orderBy("name")
        .collect()
    )
    prior = math.log(toxic / clean)
    raw = Toxicity(model, {r["name"]: r["weight"] for r in chosen}, 1.0, prior)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(raw.evidence(batch.column("text"))), batch.column("label")], ["evidence", "label"]
            )

    # one row per distinct sum and label
    sums = rows.mapInArrow(evidence, "evidence double, label int").groupBy(F.round("evidence", 6).alias("evidence"), "label").count()
    slope, intercept = fit_line(landed(sums, "sums"), prior)
    return Toxicity(model, raw.weights, slope, intercept)


def score(docs: DataFrame, model: Toxicity, text: str = "text") -> DataFrame:
    """The columns of ``docs``, then ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Null and empty texts show no sign and get the score of such texts.  Texts are
    read whole, tokens of any length are decoded; repeated rows stay, no rows give none, and input columns named
    ``score`` or ``predicted`` are replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(names).columns, pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                [*names, "score", "predicted"],
            )

    schema = StructType([*kept, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.select(*names).mapInArrow(run, schema)


def learned(docs: DataFrame, labels: DataFrame) -> Toxicity:
    """The model of the labels that are not held out."""
    return train(docs.select("doc_id", "text"), labels.filter(crc_mod("doc_id", 5) != 0))


def scored(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with score and predicted, learned from the labels that are not held out."""
    return score(docs.select(*keep), learned(docs, labels))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), ["doc_id", "text"])
    return found.select(
        "doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted"
    )
