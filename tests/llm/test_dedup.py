from __future__ import annotations

import random

import numpy as np
import pytest

from panelwright.llm import components, dedup, hashing


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, width, percent):
    top = {i: i for i, _ in rows if i is not None}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    for a, (i, s) in enumerate(sets):
        for j, r in sets[:a]:
            if s and r and 100 * len(s & r) >= percent * len(s | r):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return {i: find(i) for i in top}


def family(rng, words, copies, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("rule", [dedup.OP6, dedup.Rule()])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, rule):
    monkeypatch.setattr(dedup, "TILE", 16)
    rng = random.Random(11)
    texts = family(rng, 60, 90, 6) + family(rng, 25, 40, 3) + family(rng, 200, 30, 14) + ["same text here"] * 50
    texts += [None, "", " \n\t ", "one", "ONE", "one two", "one  two\n", "Ä b c", "ä b c", "a b c d", "A\tB c d"] + ["long w " * 20_000]
    texts += family(rng, 30, 1, 0) * 3
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_shingles", "'x' AS component", "2 AS bucket")
    got = dedup.near_duplicates(df, rule).collect()
    assert len(got) == len(rows)
    expected = brute(rows, rule.width, rule.percent)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == expected[r["doc_id"]], r
            assert r["kept"] == (r["component_id"] == r["doc_id"])
            assert r["n_shingles"] == len(shingles(texts[r["doc_id"]], rule.width))


def test_repeated_ids_and_one_of_each(spark):
    a, b, c = "a b c d e f g", "h i j k l m n", "o p q r s t u"
    rows = [(5, a), (5, b), (7, b), (9, a), (9, a), (8, c), (8, c), (None, a), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in dedup.near_duplicates(df).collect()}
    assert got == {(5, 5), (7, 5), (9, 5), (8, 8), (None, None)}
    left = sorted(((r["doc_id"], r["text"]) for r in dedup.one_of_each(df).collect()), key=repr)
    assert left == sorted([(5, a), (5, b), (8, c), (None, a), (None, a)], key=repr)


def test_a_repeated_id_has_the_links_of_all_its_texts(spark):
    rng = random.Random(8)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(3))
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, c), (5, c + " x"), (5, ""), (5, None), (6, ""), (None, c)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        got = dedup.near_duplicates(df).collect()
        assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"] is not None) == [
            (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 4, False), (5, 4, False), (5, 4, False), (6, 6, True)
        ]
        assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]
        assert sorted(r["n_shingles"] for r in got) == [0, 0, 0, 76, 76, 76, 76, 77, 77, 77]


def test_no_documents(spark):
    assert dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_superminhash_estimates_with_less_variance_than_independent_hashes():
    rng = np.random.default_rng(4)
    m, errors = 64, []
    for _ in range(150):
        both, left, right = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (40, 20, 20))
        owner = np.repeat([0, 1], 60)
        table = dedup.superminhash(np.concatenate([both, left, both, right]), owner, 2, m)
        errors.append((table[0] == table[1]).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02
    assert np.var(errors) < 0.9 * 0.25 / m


def test_superminhash_of_few_elements_fills_all_slots():
    table = dedup.superminhash(np.array([5, 9], np.uint64), np.array([1, 1]), 3, 256)
    assert (table[1] >> np.uint64(56) < 256).all() and (table[1] != ~np.uint64(0)).all()
    assert (table[[0, 2]] == ~np.uint64(0)).all()


@pytest.mark.parametrize("per_task", [7, 500_000])
def test_components(spark, monkeypatch, per_task):
    monkeypatch.setattr(components, "EDGES_PER_TASK", per_task)
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges + edges[:10], "u long, v long")
    expected = components.union_find(*map(np.array, zip(*[e for e in edges if None not in e and e[0] != e[1]])))
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert got == expected
    assert components.components(df.limit(0)).collect() == []


def test_words_are_those_of_the_bytes():
    import pyarrow as pa

    texts = [None, "", " a\x0bB ", "É é", "x", "tail ", " lead", "a\x1cb c\x85d", "q" * 70_000, "", "AbC abc"]
    seen = {}
    for first, data, cuts in hashing.slices(pa.array(texts)):
        hashes, starts, ends, counts = hashing.words(data, cuts)
        for i in range(len(cuts) - 1):
            expected = (texts[first + i] or "").encode().lower().split()
            at = slice(counts[i], counts[i + 1])
            assert [bytes(data[a:b]).lower() for a, b in zip(starts[at], ends[at])] == expected
            for word, value in zip(expected, hashes[at].tolist()):
                assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
