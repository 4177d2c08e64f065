"""The filter audit against filters that are applied one after the other."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from panelwright.llm import audit

LABELS = "doc_id long, quality int, toxic int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def brute(rows, labels):
    rows = [(i, t or "", s or "") for i, t, _, s in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    tests = {
        "A": lambda i, t: len(words(t)) < 200,
        "B": lambda i, t: 100 * len(set(words(t))) < 50 * len(words(t)),
        "C": lambda i, t: 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
        "D": lambda i, t: any(c in "#$%&*|" for c in t),
        "E": lambda i, t: i is not None and i > first[t],
    }
    fails = [{x for x in tests if tests[x](i, t)} for i, t, _ in rows]
    out = {}
    for part in {s for _, _, s in rows}:
        mine = [(rows[k][0], fails[k]) for k in range(len(rows)) if rows[k][2] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, x in enumerate(order, 1):
                removed = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                out[part, order, step] = [
                    len(left), len(removed), sum(x in f for _, f in mine) - len(removed), sum(f == {x} for _, f in mine),
                    sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed), 0,
                ]
        for x in "ABCDE":
            keys = [(part, order, order.index(x) + 1) for order in map("".join, permutations("ABCDE"))]
            total = sum(out[k][1] for k in keys)
            for k in keys:
                out[k][6] = total
    return out, {repr((i, t, s)): "".join(sorted(f)) for (i, t, s), f in zip(rows, fails)}


def text_of(rng):
    n = rng.choice([0, 3, 199, 200, 201, 260])
    pool = rng.choice([["a"], ["a", "b"], [f"w{k}" for k in range(400)], [f"W{k}" for k in range(400)], ["é", "É", "Éa", "😀"]])
    return rng.choice(["", " ", "\n"]) + rng.choice([" ", "\t", "\n \v"]).join(rng.choices(pool, k=n)) + rng.choice(["", "#", " ", "|"])


@pytest.fixture(scope="module")
def case():
    rng = random.Random(13)
    texts = [text_of(rng) for _ in range(150)]
    rows = [(i, rng.choice(texts), "en", rng.choice(["hot", "hot", "b", None, "", "ä"])) for i in range(300)]
    rows += [(1000, None, "en", "b"), (1001, "", None, None), (1002, None, None, "b"), (None, None, None, "hot"),
             (None, texts[0], None, "hot"), (7, rows[7][1], None, "b"), (7, "other", None, "b"),
             (1003, " ".join(f"x{i}" for i in range(200_000)), "en", "long")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 300, 2)]
    labels += [(0, 1, 0), (0, 0, 1), (None, 1, 1), (9999, 1, 1)]
    return rows, labels


def test_audit_equals_filters_in_a_row(spark, documents, case):
    rows, labels = case
    expected, masks = brute(rows, labels)
    failed = audit.failures(documents(rows, ["'x' AS part", "1 AS mask", "2 AS block"]).repartition(5))
    got = audit.audit(failed, spark.createDataFrame(labels, LABELS)).collect()
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got} == expected
    assert len(got) == len(expected)
    assert len(set(masks.values())) > 8


def test_matrix_counts_every_word(documents, case):
    rows, _ = case
    docs = documents([r for r in rows if r[0] is not None][:120] + [rows[-1]]).selectExpr(
        "doc_id", "coalesce(text, '') AS text", "'p' AS part", "unhex('00') AS digest").repartition(3)
    blocks = audit.shards(docs)
    entries = audit.numbered(blocks)
    coded = audit.dictionary(entries).collect()
    ids = {r["word"]: r["id"] for r in coded if r["word"] is not None}
    assert sorted(ids.values()) == list(range(len(ids))) and len(coded) > len(ids)
    assert len([r for r in coded if r["word"] is not None]) == len(ids)
    named = {v: k for k, v in ids.items()}
    found = {}
    for row in audit.matrix(blocks, entries).collect():
        cuts = np.frombuffer(row["cuts"], np.int64)
        columns, counts = np.frombuffer(row["columns"], np.int32), np.frombuffer(row["counts"], np.int32)
        for i, a, b in zip(row["doc_ids"], cuts[:-1], cuts[1:]):
            assert (np.diff(columns[a:b]) > 0).all()
            found[i] = {named[c]: n for c, n in zip(columns[a:b].tolist(), counts[a:b].tolist())}
    for row in docs.collect():
        assert found[row["doc_id"]] == Counter(words(row["text"]))


def test_no_documents(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert audit.audit(audit.failures(documents([])), none).count() == 0
    # zeros are rows, too
    got = audit.audit(audit.failures(documents([(1, " ", "en", "s")])), none)
    assert (got.count(), got.filter("removed = 1").count(), got.filter("filter_order LIKE 'A%' AND step = 1 AND removed = 1").count()) == (600, 120, 24)
