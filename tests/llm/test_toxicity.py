from __future__ import annotations

import math
import random

import pyarrow as pa
import pytest

from panelwright.llm import toxicity

BAD = ["moron", "idiot", "stupid", "trash", "worthless"]
CALM = "the and of that river house green walking sunny bread winter morning lamp those stones other idea plain sorted".split()


@pytest.fixture(scope="module")
def trained(documents, spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        text = [rng.choice(CALM) for _ in range(rng.randint(5, 60))]
        for _ in range(rng.randint(1, 3) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(BAD)
        rows.append((i, " ".join(text), "en", "s"))
        labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (5000, 0, 1), (3, None, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return documents(rows), table, dict((i, t) for i, _, t in labels[:600])


def test_scores(trained, documents, spark):
    docs, labels, truth = trained
    got = toxicity.scored(docs, labels, ["doc_id", "text"]).collect()
    assert len(got) == 600
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in got) / 600 > 0.99
    odd = [(1, None, "en", "s"), (2, "", "en", "s"), (3, "m0r0n", "en", "s"), (4, "you s t u p i d", "en", "s"), (5, "w0rthl3ss!!", "en", "s"),
           (6, "iiiidiooot", "en", "s"), (7, "t.r.a.s.h", "en", "s"), (8, "the " * 300_000 + "idiot", "en", "s"), (9, "river 4012 x9 $5", "en", "s"),
           (9, "river 4012 x9 $5", "en", "s"), (None, "trash", "en", "s"), (10, "7 8 9 a b c", "en", "s"),
           (11, "be a  S t U p i d one", "en", "s"), (12, "o n e w 0 r t h l 3 s s m 4 n " * 3 + "x y", "en", "s"), (13, "stupi" + "d" * 90, "en", "s")]
    more = documents(odd, ["1 AS score", "'x' AS predicted"])
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    out = toxicity.score(more, model)
    assert out.columns == [*[c for c in more.columns if c not in ("score", "predicted")], "score", "predicted"]
    found = {r["doc_id"]: r for r in out.collect()}
    assert {i for i, r in found.items() if r["predicted"]} == {3, 4, 5, 6, 7, 8, 11, 12, 13, None}
    assert found[1]["score"] == found[2]["score"] < 0.5 and out.count() == len(odd)
    assert toxicity.score(documents([]), model).collect() == []


def test_nothing_to_learn(documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents([(1, "a b c", "en", "s")])
    assert [(r["score"], r["predicted"]) for r in toxicity.scored(docs, none, ["doc_id", "text"]).collect()] == [(pytest.approx(1 / 3), 0)]
    clean = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert [r["predicted"] for r in toxicity.scored(docs, clean, ["doc_id", "text"]).collect()] == [0]


def brute_decode(word, model):
    """The best of all readings, tried one by one."""
    pairs = [a == b for a, b in zip(word, word[1:])]
    stretched = sum(pairs) >= 3 or any(a and b for a, b in zip(pairs, pairs[1:]))
    best = (-math.inf, "")

    def go(i, state, score, text):
        nonlocal best
        if i == len(word):
            best = max(best, (score + model.log_p(state, "$"), text))
            return
        options = toxicity.readings(word[i])
        for letter, cost in options:
            go(i + 1, state[1] + letter, score + cost + model.log_p(state, letter), text + letter)
        if word[i] in toxicity.SEPARATORS or not options:
            go(i + 1, state, score + toxicity.SEPARATED, text)
        if i and stretched and word[i] == word[i - 1]:
            go(i + 1, state, score + toxicity.REPEATED, text)

    go(0, "^^", 0.0, "")
    return best[1]


def test_decoding_finds_the_most_probable_reading():
    counts = {}
    for word in [*CALM, *BAD * 3]:
        padded = f"^^{word}$"
        for i in range(len(padded) - 2):
            counts[padded[i : i + 3]] = counts.get(padded[i : i + 3], 0) + 1
    model = toxicity.CharacterModel(counts)
    for written in ["m0r0n", "1d10t", "st*pid", "t.r-a.sh", "stuuupid", "w0rthl3ss", "tr@5h", "mmoorroonn", "g7een", "íd!ot", "x1", "***"]:
        assert toxicity.decode(written, model) == brute_decode(written, model)
    assert toxicity.decode("1d10t", model) == "idiot" and toxicity.decode("stuuupid", model) == "stupid"


def test_tokens_of_any_length_are_decoded():
    model = toxicity.CharacterModel({})
    long = "m...0...r...0...n" * 12
    assert toxicity.decode("x" + "-" * 5000 + "y", model) == "xy"
    assert toxicity.is_disguised(toxicity.trimmed(long)) and "moron" in toxicity.decode(toxicity.trimmed(long), model)
    wanted = {"moron": 0, "ass": 1}
    run = "a" * 30 + "mmmm0000rrrr0000nnnn" + "b" * 30
    assert toxicity.spaced_signs(run, model, wanted) >= {"moron"}
    assert toxicity.spaced_signs("ass", model, wanted) == {"ass"} and toxicity.spaced_signs("class", model, wanted) == set()


def test_features_of_texts():
    model = toxicity.CharacterModel({})
    names, owner, feature = toxicity.occurrences(pa.array(["Ab, ab. x", None, "c c c d", ""]), model, None)
    found = {(int(o), names[f]) for o, f in zip(owner, feature)}
    assert (0, "ab") in found and {o for o, _ in found} <= {0, 2} and len(found) == len(owner)


def test_all_labelled_rows_are_learned_from(spark):
    rows = 54_000
    docs = spark.range(rows).selectExpr("id AS doc_id", "concat('river ', id, ' stone ', id * 7) AS text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 3 = 0) AS toxic")
    model = toxicity.train(docs, labels)
    assert model.letters.trigrams["^^r"] == model.letters.trigrams["ne$"] == rows


def test_training_rows(documents, spark):
    near = [(i, f"{'the same words of all of them ' * 3}", "en", "s") for i in (7, 3, 5)]
    other = [(8, "one two three", "en", "s"), (8, "four five six", "en", "s"), (8, "four five six", "en", "s"), (9, None, "en", "s"),
             (None, "a b c d", "en", "s"), (10, "seven eight nine", "en", "s")]
    labels = spark.createDataFrame([(7, 1), (3, 0), (5, 0), (5, 1), (8, 1), (8, 1), (8, 0), (9, 1), (None, 1), (10, None)], "doc_id long, toxic int")
    got = sorted(tuple(r) for r in toxicity.training_rows(documents(near + other), labels, "toxic").collect())
    texts = ["four five six", "one two three", near[0][1]]
    assert got == [(label, text) for label in (0, 1) for text in texts]


def test_line(spark):
    """The line is the one of Newton steps on rows held in memory."""
    rng = random.Random(3)
    rows = [(round(rng.gauss(2.0 * y - 1, 1.5), 1), y, rng.randint(1, 9)) for y in (0, 0, 0, 1) for _ in range(60)]
    slope, intercept = toxicity.fit_line(spark.createDataFrame(rows, "evidence double, label int, count long"), -1.0)
    p = lambda x: 1 / (1 + math.exp(-(intercept + slope * x)))
    assert sum(n * (y - p(x)) * x for x, y, n in rows) == pytest.approx(toxicity.FAITH * (slope - 1), abs=1e-6)
    assert sum(n * (y - p(x)) for x, y, n in rows) == pytest.approx(toxicity.FAITH * (intercept + 1), abs=1e-6)
