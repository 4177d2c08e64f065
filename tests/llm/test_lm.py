from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from panelwright.llm import gru, lm


def test_gradients_are_those_of_differences():
    rng = np.random.default_rng(0)
    weights = {k: v.astype(float) for k, v in gru.initial(7, 4, 0).items()}
    inputs, targets = rng.integers(0, 7, (5, 3)), rng.integers(0, 7, (5, 3))
    alive, state = (inputs != 0).astype(float), rng.normal(size=(3, 4))
    gradient = gru._window_gradient(weights, state, inputs, targets, alive)[1]
    for name, w in weights.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w.shape)
            sides = []
            for move in (1e-6, -2e-6):
                w[at] += move
                sides.append(gru._window_gradient(weights, state, inputs, targets, alive)[0])
            w[at] += 1e-6
            assert (sides[0] - sides[1]) / 2e-6 == pytest.approx(gradient[name][at], abs=1e-7)


def test_scores_are_those_of_single_steps():
    rng = np.random.default_rng(1)
    weights = gru.initial(20, 8, 0)
    docs = [np.r_[rng.integers(1, 20, n), 0] for n in (70, 3, 33, 0, 64, 31, 200)]
    got = gru.score(weights, np.concatenate(docs), np.array([len(d) for d in docs]))
    for doc, value in zip(docs, got):
        state, before, total = np.zeros((1, 8), np.float32), 0, 0.0
        for c in doc:
            state = gru.step(weights, state, np.array([before]))[0]
            total += gru.log_softmax(weights, state)[0, c]
            before = c
        assert value == pytest.approx(total, abs=1e-3)
    assert len(gru.score(weights, np.empty(0, int), np.empty(0, int))) == 0


def test_scoring_holds_few_documents_at_a_time():
    rng = np.random.default_rng(4)
    weights = gru.initial(20, 8, 0)
    docs = [np.r_[rng.integers(1, 20, n), 0] for n in rng.integers(0, 90, 6 * gru.BESIDE)]
    line, lengths = np.concatenate(docs), np.array([len(d) for d in docs])
    tracemalloc.start()
    got = gru.score(weights, line, lengths)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    alone = np.concatenate([gru.score(weights, d, np.array([len(d)])) for d in docs[:: 97]])
    assert got[::97] == pytest.approx(alone, abs=1e-3)
    # a window of the states of all of them alone is more
    assert peak < len(docs) * gru.WINDOW * 9 * 4


def test_windows_share_their_arrays():
    rng = np.random.default_rng(5)
    weights = gru.initial(20, 8, 0)
    room = gru._room(weights, 6, 5)
    for _ in range(2):
        inputs, targets = rng.integers(0, 20, (6, 5)).astype(np.uint8), rng.integers(0, 20, (6, 5)).astype(np.uint8)
        given = (weights, rng.normal(size=(5, 8)).astype(np.float32), inputs, targets, (inputs != 0).astype(np.float32))
        (loss, gradient, last), (again, same, after) = gru._window_gradient(*given), gru._window_gradient(*given, room)
        assert loss == again and np.array_equal(last, after) and all(np.array_equal(gradient[n], same[n]) for n in weights)


def test_training_learns_a_pattern():
    docs = [np.array([1, 2, 3] * 20 + [0]) for _ in range(40)]
    weights = gru.train(docs, 5, hidden=8, epochs=80)
    assert gru.score(weights, docs[0], np.array([61]))[0] / 61 > -0.3
    assert gru.train([], 5, hidden=8).keys() == weights.keys()


def test_counts_and_probabilities(spark, documents):
    rng = random.Random(3)
    sides = [[f"a{i}" for i in range(60)], [f"z{i}y" for i in range(60)]]
    rows = []
    for i in range(500):
        words = sides[i % 2]
        text = " ".join(words[min(int(rng.expovariate(0.1)), 59)] for _ in range(rng.randint(1, 60)))
        rows.append((i, text.upper() if i % 7 == 0 else text, "en", "s"))
    rows += [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "never seen ÄÖ", "en", "s"), (1003, "a1 " * 50_000, "en", "s"),
             (None, "a1 a2", "en", "s"), (3, rows[3][1], "en", "s")]
    learn = {i: i is not None and i % 10 != 0 for i, *_ in rows}
    docs = documents(rows, ["doc_id % 10 <> 0 AS learn", "1 AS block", "'x' AS codes"])
    got = lm.log_likelihoods(docs.repartition(3)).collect()
    assert len(got) == len(rows)
    tokens = lambda text: [*(text or "").encode().lower().split(), None]
    counts = Counter(w for i, text, *_ in rows if learn[i] for w in tokens(text))
    n, v = sum(counts.values()), len(counts)
    texts = {i: text for i, text, *_ in rows}
    better = 0
    for r in got:
        words = tokens(texts[r["doc_id"]])
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert (r["n_tokens"], r["train_tokens"], r["learn"]) == (len(words), n, learn[r["doc_id"]])
        assert r["n_known"] == sum(counts[w] > 0 for w in words)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0
        better += r["score"] > r["base_score"]
    assert better / len(got) > 0.8


def test_the_network_learns_from_every_training_document(documents):
    rows = [(i, "b a " * 8 if i % 40 else "x", "en", "s") for i in range(2400)]
    docs = documents(rows, ["doc_id % 10 <> 3 AS learn"]).repartition(3)
    blocks = lm.coded(docs.selectExpr("doc_id", "text", "learn"))
    rows_of = lm.classed(blocks, *lm.word_counts(blocks)).filter("learn").collect()
    assert sum(r["n_tokens"] for r in rows_of) == sum(len(t.split()) + 1 for i, t, *_ in rows if i % 10 != 3)
    ends = sum(pa.decompress(r["classes"], r["n_tokens"], codec="zstd", asbytes=True).count(0) for r in rows_of)
    assert ends == 2160 and {r["round"] for r in rows_of} == set(range(lm.ROUNDS))


def test_a_round_averages_tasks_by_their_tokens(spark):
    def row(n, c):
        return n, pa.compress(bytes([c] * (n - 1) + [0]), codec="zstd", asbytes=True)

    schema = "n_tokens long, classes binary"
    rows = [row(900, 5), row(300, 9)]
    start = gru.initial(lm.CLASSES, 4, 0)
    alone = [gru.packed(lm.trained_round(spark.createDataFrame([r], schema).coalesce(1), start, 0.01)) for r in rows]
    both = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), schema)
    assert gru.packed(lm.trained_round(both, start, 0.01)) == pytest.approx(0.75 * alone[0] + 0.25 * alone[1], abs=1e-5)
    assert not np.allclose(alone[0], gru.packed(start), atol=1e-3)


def test_the_score_of_whole_documents_word_by_word(documents):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["ba", "be", "Bo", f"w{rng.randint(0, 90)}"]) for _ in range(rng.randint(0, 90))), "en", "s")
            for i in range(120)]
    docs = documents(rows, ["doc_id % 10 <> 0 AS learn"]).selectExpr("doc_id", "text", "learn").repartition(2)
    blocks = lm.coded(docs)
    counted, counts = lm.word_counts(blocks)
    placed = lm.classed(blocks, counted, counts)
    weights = lm.trained(placed, counts, 8, 1)
    got = {r["doc_id"]: r["score"] for r in lm.scored(placed, weights).collect()}
    # hash, spelling and counts of every word, one by one
    words_of = lambda text: [*(w.encode() for w in text.lower().split()), None]
    by_word, hashes, classes = Counter(), {}, {}
    for i, text, *_ in rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        found, spelling, _ = lm.tokens(data, np.array([0, len(data)]))
        for w, h, k in zip(words_of(text), found.view(np.int64).tolist(), spelling.tolist()):
            hashes[w] = h
            classes[w] = 0 if w is None else counts.frequent.index(h) + 1 if h in counts.frequent else 1 + lm.FREQUENT + k
            by_word[w] += i % 10 != 0
    members = {k: [w for w in by_word if classes[w] == k and by_word[w]] for k in set(classes.values())}
    for i, text, *_ in rows:
        state, before, total = np.zeros((1, 8), np.float32), 0, 0.0
        for w in words_of(text):
            k = classes[w]
            state = gru.step(weights, state, np.array([before]))[0]
            total += gru.log_softmax(weights, state)[0, k] / math.log(10)
            before = k
            if k > lm.FREQUENT:
                size = sum(by_word[m] for m in members[k])
                if by_word[w]:
                    total += math.log10((by_word[w] - counts.discount) / size)
                elif size:
                    total += math.log10(min(max(counts.discount * len(members[k]), 0.5) / size, 1))
        assert got[i] == pytest.approx(total, abs=1e-3, rel=1e-5)


def test_probabilities_of_a_class_sum_to_one():
    tokens, words = np.zeros(lm.CLASSES), np.zeros(lm.CLASSES)
    tokens[100], words[100] = 10, 4
    counts = lm.Counts(10, 4, 0.5, [], tokens, words)
    import pandas as pd
    import pyarrow as pa

    table = pd.DataFrame({"code": range(5), "c": [4, 3, 2, 1, 0], "k": [100] * 5})
    weights = gru.initial(lm.CLASSES, 4, 0)
    total = 0.0
    for code in range(5):
        packed = pa.compress(np.array([code], np.int32).tobytes(), codec="zstd", asbytes=True)
        doc = pd.DataFrame({"doc_id": [1], "learn": [True], "n_tokens": [1], "codes": [packed]})
        row = lm.block_classes(doc, table, counts).iloc[0]
        assert pa.decompress(row["classes"], 1, codec="zstd", asbytes=True) == bytes([100])
        total += 10 ** (row["within"] + gru.score(weights, np.array([100]), np.array([1]))[0] / np.log(10))
    of_class = np.exp(gru.score(weights, np.array([100]), np.array([1])))[0]
    assert total == pytest.approx(of_class, rel=1e-4)


def test_nothing(documents):
    assert lm.log_likelihoods(documents([], ["true AS learn"])).collect() == []
    got = lm.log_likelihoods(documents([(1, "a b", "en", "s")], ["false AS learn"])).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got] == [(3, 0, 0)]
