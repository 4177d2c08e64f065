"""Line-first cleaning against a plain count, rule by rule."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from panelwright.llm import line_rules
from panelwright.llm.line_rules import fault

SPACE = " \t\n\v\f\r"
SENTENCE = "The long evening went on as it had begun."


def words(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(text):
    text = text or ""
    ws = words(text)
    windows = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    found = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if found[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if words(line)]
    lost = sum(len("".join(words(line))) for line in lines if fault(line))
    chars = sum(map(len, ws))
    failed = len(ws) < 10 or 100 * len(covered) > 20 * len(ws)
    return {
        "n_words": len(ws), "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lost_chars": lost,
        "base_failed": failed, "kept": not failed and 100 * lost <= 50 * chars,
    }


@pytest.mark.parametrize("line,rule", [
    (SENTENCE, None), ('She said "no."', None), ("(It was late.)", None), ("Où était-il ?", None), ("然后他走了。", None),
    ("What!? No.", None), ("No end to this line", "punctuation"), ("A heading:", "punctuation"), (")))", "punctuation"),
    ("BUY!! NOW!! CHEAP!!", "punctuation"), ("a*** word### of%%% noise.", "punctuation"),
    ("Home | About | Contact us.", "navigation"), ("Shop › Shoes › Red shoes.", "navigation"), ("Read more.", "navigation"),
    ("Click here to go on.", "navigation"), ("Homeward they went at last.", None),
    ("Either a | b, as the authors of the second paper would have it, or | as in the first of the two proofs.", None),
    ("Copyright (c) 2020 by us.", "boilerplate"), ("This site uses cookies.", "boilerplate"),
    ("Licensed under the Apache License.", "boilerplate"), ("A law of copyright was passed.", None),
])
def test_rules(line, rule):
    assert fault(line) == rule
    assert fault(f" \t{line}\r") == rule


def test_counts_equal_a_plain_count(documents):
    rng = random.Random(11)
    pool = ["a", "b", "c", "dé", "😀", "x|y", "e.", "No.", "wow!!", "###"]
    rows = [(i, "".join(rng.choice(pool) + rng.choice([" ", " ", " ", "\n", "\t", " \n\n", "\r\n", " "])
                        for _ in range(rng.choice([0, 1, 4, 5, 9, 10, 30, 200])))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t\v"), (1003, "one\n" * 30), (1004, (SENTENCE + "\n") * 2),
             (1005, " ".join(str(i) for i in range(400_000)) + "."), (1005, SENTENCE), (None, SENTENCE), (1006, "a b c d e a b c d e")]
    docs = documents([(i, t, "en", "s") for i, t in rows], ["'x' AS cleaned", "1 AS kept", "2 AS n_words", "3 AS extra"])
    got = line_rules.clean(docs).collect()
    assert len(got) == len(rows)
    assert {r["extra"] for r in got} == {3}
    expected = sorted(((i, t, brute(t)) for i, t in rows), key=repr)
    for row, (i, t, counts) in zip(sorted(got, key=lambda r: repr((r["doc_id"], r["text"]))), expected):
        assert (row["doc_id"], row["text"]) == (i, t)
        assert {k: row[k] for k in counts} == counts


def test_failing_lines_go_and_lossy_documents_are_rejected(documents):
    prose = "The first evening was long.\nRain fell on all roofs of the town.\nNobody came to see them before noon."
    page = f"Home | News | Contact\n\n{prose}\nAll rights reserved."
    menu = "Home | News | Contact | Imprint | Search | Archive\nRed | Green | Blue | White | Black | Grey\nA short text."
    got = {r["doc_id"]: r for r in line_rules.clean(documents([(1, page, "en", "s"), (2, menu, "en", "s")])).collect()}
    assert got[1]["cleaned"] == f"\n{prose}" and got[2]["cleaned"] == "A short text."
    assert (got[1]["n_bad_punctuation"], got[1]["n_boilerplate"], got[1]["n_navigation"]) == (1, 1, 0)
    assert (got[1]["base_failed"], got[1]["kept"]) == (False, True)
    assert (got[2]["base_failed"], got[2]["kept"]) == (False, False)


def test_no_rows(documents):
    assert line_rules.clean(documents([])).count() == 0
