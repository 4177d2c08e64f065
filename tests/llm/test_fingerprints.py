from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from panelwright.llm import fingerprints as fp


def keys(text):
    ((_, _, (found, _)),) = fp.digest_keys([text])
    assert len(set(found.tolist())) == len(found)
    return set(found.tolist())


def likeness(a, b):
    a, b = keys(a), keys(b)
    return 1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0


def test_all_rows_against_brute_force(spark):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.choice([1, 5, 40, 400]))) for _ in range(120)]
    texts += [None, "", "x", "ab", "abc", "abcd", "  \n ", "De " * 500, "a\nb\nc\nd\r\ne", "long words " * 20_000, "é" * 9]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(12, texts[0]), (12, texts[0]), (15, "other"), (None, "null id"), (None, "null id 2")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr("*", "1 AS part", "'f' AS fingerprint")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = fp.fingerprints(df).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = [
        (r["doc_id"], r["text"])
        for r in df.selectExpr("doc_id", "coalesce(text, '') AS text").orderBy("doc_id", F.xxhash64("text")).collect()
    ]
    assert len(got) == len(order)
    expected = []
    for i, (doc, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        edited = fp.edited_text(text, following)
        expected.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                         round(likeness(text, edited), 9), round(likeness(text, following), 9)))
    found = [(r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    prints = {}
    for r in got:
        prints.setdefault(r["edited_sha256"], set()).add(r["edited_fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_edited_text():
    assert fp.edited_text("abcdefgh", "XYZ") == "abcdefXY"
    assert fp.edited_text("abcdefghijkl", "XY") == "abcdefghiXY"
    assert fp.edited_text("abc", "XY") == "abc" and fp.edited_text("", "XY") == ""


def test_pieces_realign_after_an_insertion():
    rng = random.Random(4)
    for n, least in ((12, 0.4), (40, 0.65), (120, 0.75), (400, 0.85)):
        found = []
        for _ in range(40):
            words = [f"w{rng.randrange(2000)}" for _ in range(n)]
            at = rng.randrange(n // 4)
            found += [likeness(" ".join(words), " ".join(words[:at] + edit + words[at + 1 :])) for edit in (["new", words[at]], [])]
        assert sum(found) / len(found) > least, (n, sum(found) / len(found))
    long = "over and over " * 400
    assert likeness(long, "x " + long) > 0.8 and len(keys("same " * 3200)) < 3200 // 16


def test_a_single_row_follows_itself_and_no_rows_give_none(spark):
    one = fp.fingerprints(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["near_next"]) for r in one] == [(1, 1.0)]
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    assert fp.fingerprints(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_peeling_recovers_the_differing_digests():
    rng = np.random.default_rng(1)
    both, left, right = (rng.integers(1, 2**63, n).astype(np.uint64) for n in (5000, 9, 11))
    tables = [fp.Sketches(np.concatenate([both, x]), np.zeros(5000 + len(x), np.int64), 1, 64) for x in (left, right)]
    found, _, sign, emptied = (tables[0] - tables[1]).peel()
    assert emptied.all()
    assert set(found[sign == 1].tolist()) == set(left.tolist()) and set(found[sign == -1].tolist()) == set(right.tolist())
    small = fp.Sketches(left, np.zeros(9, np.int64), 1, 1) - fp.Sketches(right, np.zeros(11, np.int64), 1, 1)
    assert not small.peel()[3].any()
