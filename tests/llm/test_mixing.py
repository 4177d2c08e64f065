"""The mix against a brute-force schedule, word by word."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from panelwright.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute(rows, block=256, seed="mix-1:"):
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, held = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in held)
        free = [s for s in names if s not in held]
        total = sum(weight[s] for s in free)
        over = {s for s in free if rest * weight[s] / total >= 3 * sizes[s]}
        if not over:
            target = {s: 3.0 * sizes[s] if s in held else rest * weight[s] / total for s in names}
            break
        held |= over
        if len(held) == len(names):
            target = {s: 3.0 * sizes[s] for s in names}
            break
    taken = {}
    for s in names:
        mine = [(hashlib.md5(f"{seed}{'' if i is None else i}".encode()).hexdigest(), i, words(t)) for i, t, _, x in rows if x == s]
        line = [k for k, (_, _, n) in enumerate(sorted(mine, key=lambda m: (m[0], m[1] is not None, m[1] or 0, m[2]))) for _ in range(n)]
        count = [0] * len(mine)
        for at in range(round(target[s])):
            count[line[at % len(line)]] += 1
        for (_, i, n), c in zip(sorted(mine, key=lambda m: (m[0], m[1] is not None, m[1] or 0, m[2])), count):
            taken.setdefault((i, n, s), []).append(c)
    return sizes, target, {k: sorted(v) for k, v in taken.items()}


def test_mix_reads_what_the_schedule_says(documents):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        source = rng.choice(["hot"] * 6 + ["a", "b", "Ä", None, "tiny"][: 5 if i % 40 == 0 else 4])
        rows.append((i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([0, 1, 7, 60, 700]))), "en", source))
    rows += [(5, None, None, "a"), (5, "one two", None, "a"), (None, "x y z", None, None), (7, " \t\n", None, "empty")]
    sizes, target, taken = brute(rows)
    got = mixing.mix(documents(rows, ["1 AS size", "'x' AS sid", "2 AS bucket"])).collect()
    assert len(got) == len(rows)
    found = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]], abs=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        found.setdefault((r["doc_id"], r["size"], r["source"]), []).append(r["taken"])
    assert {k: sorted(v) for k, v in found.items()} == taken


def test_every_source_near_its_target_in_every_part_of_the_schedule(spark, documents):
    rows = [(i, "w " * 500, "en", s) for i, s in enumerate(["a"] * 20 + ["b"] * 20 + ["c"] * 60)]
    sources = mixing.targets(documents(rows).selectExpr("source", "500L AS size"))
    slots = mixing.schedule(sources, 100).collect()
    n = {r["sid"]: -(-round(r["target"]) // 100) for r in sources.collect()}
    by_slot = sorted(slots, key=lambda r: r["slot"])
    total = sum(n.values())
    for cut in (50, 100, 250, 400):
        first = by_slot[:cut]
        for sid, share in n.items():
            assert abs(sum(r["sid"] == sid for r in first) - cut * share / total) < 6
    for sid in n:
        assert [r["rank"] for r in by_slot if r["sid"] == sid] == list(range(n[sid]))


def test_reversal_is_its_own_inverse(spark):
    df = spark.range(64).select("id", mixing.van_der_corput(F.col("id"), 6).alias("v"))
    found = {r["id"]: r["v"] for r in df.collect()}
    assert found == {i: int(f"{i:06b}"[::-1], 2) for i in range(64)}


def test_passes_repeat_documents(documents):
    rows = [(1, "a  b\tc", "en", "s"), (2, "d", "en", "t"), (3, "e f", "en", "u"), (4, None, "en", "u"), (None, "g h", "en", "s")]
    docs = documents(rows)
    mixed = mixing.mix(docs)
    taken = {r["doc_id"]: r["taken"] for r in mixed.collect()}
    got = mixing.passes(docs, mixed)
    assert got.columns == docs.columns
    sizes = {}
    for r in got.collect():
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + words(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert sizes == {k: v for k, v in taken.items() if v}


def test_no_documents(documents):
    docs = documents([])
    mixed = mixing.mix(docs)
    assert mixed.collect() == [] and mixing.passes(docs, mixed).collect() == []
