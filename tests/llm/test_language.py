from __future__ import annotations

import random

import numpy as np
import pytest

from panelwright.llm import language

SOUNDS = {"en": ["the", "ing", "sh", "wh", "tion"], "de": ["sch", "ung", "ä", "ch", "ein"], "fr": ["eau", "é", "oi", "que", "le"]}


def words(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_held_out_accuracy_and_edges(documents, spark):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        lang = rng.choice(list(SOUNDS))
        rows.append((i, words(rng, lang, rng.choice([3, 20, 200])).upper() if i % 9 == 0 else words(rng, lang, 30), lang, "s"))
    odd = [(1000, None, "en", "s"), (1001, "", "de", "s"), (1002, "123 ?! 45", "fr", "s"), (1003, "a", None, "s"), (None, "the the", "en", "s"),
           (1005, "the " * 400_000, None, "s"), (7, words(rng, "en", 50), "en", "s")]
    docs = documents(rows + odd, ["'x' AS score", "1 AS lang_pred"])
    got = language.predicted(docs).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    right = sum(r["lang_pred"] == rows[r["doc_id"]][2] for r in held)
    assert held and right / len(held) > 0.97
    for i in (1000, 1001, 1002):
        assert (by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0)
    assert by[1005]["lang_pred"] == "en" and by[None]["lang_pred"] == "en" and not by[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in got)
    # extra and clashing columns are kept or replaced
    out = language.identify(docs, ["en"], np.ones((1, language.DIMENSIONS)))
    assert out.columns == [*[c for c in docs.columns if c not in ("lang_pred", "score")], "lang_pred", "score"]


def test_nothing_learned(documents):
    docs = documents([(1, "some text", None, "s")])
    assert [(r["lang_pred"], r["score"]) for r in language.predicted(docs).collect()] == [("und", 0.0)]
    assert language.predicted(documents([])).collect() == []


@pytest.mark.parametrize("size", [50, 1 << 20])
def test_profiles_are_sums_of_bound_letters(monkeypatch, size):
    monkeypatch.setattr(language, "SLICE_CHARS", size)
    text = "Ab é, 12 cd " * 9 + "xyz"

    def vector(c):
        return language.letter_vectors(np.array([ord(c)]))[0]

    line = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    expected = np.zeros(language.DIMENSIONS)
    for a, b, c in zip(line, line[1:], line[2:]):
        if b != " ":
            expected += np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c)
    found, has = language.bundles([text, "…"], np.array([0, 1]), 2)
    assert np.allclose(found[0], expected) and not found[1].any() and has.tolist() == [True, False]


def test_many_alphabets_fall_back_to_sorting(monkeypatch):
    texts = ["".join(chr(0x4E00 + 7 * i) for i in range(200)), "abc"]
    whole = language.bundles(texts, np.arange(2), 2)[0]
    monkeypatch.setattr(language, "TABLE", 10)
    assert np.array_equal(language.bundles(texts, np.arange(2), 2)[0], whole)
