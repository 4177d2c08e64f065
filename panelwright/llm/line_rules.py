"""Line-first cleaning: rules judge every line, failing lines go, and documents that lose too much text are rejected."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from panelwright.llm import hashing
from panelwright.llm.tables import WORD, read

#: A document goes if more than so many per cent of its word characters stood in removed lines.
MOST_LOST = 50
#: A document goes if it has fewer words, or if more than so many per cent of them are in repeated windows of so many words.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
#: A line with so many separators and at most so many words a segment is a menu or a trail; a line of at most so many
#: words that names a step of a site is one too.
SEPARATIONS, SEGMENT_WORDS, STEP_WORDS = 2, 3, 8
#: A line is noise if more than so many tenths of its words carry doubled marks.
MOST_MARKED = 5

# fixed values: sentence ends, what may close a quotation or bracket after them, separators of menus, doubled marks
ENDS = ".!?…。！？؟।"
CLOSERS = "\"'”’»)]"
SEPARATORS = "|›»>•·"
MARKS = r"[!?]{2,}|[#*$%&<>~^=+]{2,}"
# fixed values: phrases of menus and of legal and technical notices, in lower case
STEPS = [
    "home", "menu", "next page", "previous page", "back to top", "read more", "click here", "sign in", "sign up",
    "log in", "skip to content", "share this", "table of contents",
]
NOTICES = [
    "all rights reserved", "copyright ©", "copyright (c)", "licensed under", "released under the", "privacy policy",
    "terms of use", "terms of service", "terms and conditions", "cookies", "javascript", "lorem ipsum",
    "subscribe to our newsletter", "powered by",
]

_SPACE = " \t\n\v\f\r"
_word, _marks, _separator = re.compile(WORD), re.compile(MARKS), re.compile(f"[{SEPARATORS}]")
_step = re.compile("^(?:" + "|".join(STEPS) + r")\b")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_POINT = (np.arange(256) & 0xC0) != 0x80
_WORD_POINT = _POINT.copy()
_WORD_POINT[[ord(c) for c in _SPACE]] = False


def fault(line: str) -> str | None:
    """The first rule that a line with a word fails: punctuation, navigation or boilerplate; None if it fails none.

    * punctuation: no sentence end (closing quotes and brackets may follow it),
      or doubled marks at more than ``MOST_MARKED`` tenths of its words;
    * navigation: ``SEPARATIONS`` separators or more between segments of at most
      ``SEGMENT_WORDS`` words on average, or at most ``STEP_WORDS`` words of which
      the first name a step of a site;
    * boilerplate: a phrase of a legal or technical notice.
    """
    line = line.strip(_SPACE)
    if not line.rstrip(CLOSERS).endswith(tuple(ENDS)):
        return "punctuation"
    marks = len(_marks.findall(line))
    if marks and 10 * marks > MOST_MARKED * len(_word.findall(line)):
        return "punctuation"
    separators = len(_separator.findall(line))
    if separators >= SEPARATIONS and len(_word.findall(line)) <= SEGMENT_WORDS * (separators + 1):
        return "navigation"
    low = line.lower()
    if _step.match(low) and len(_word.findall(line)) <= STEP_WORDS:
        return "navigation"
    return "boilerplate" if any(phrase in low for phrase in NOTICES) else None


def clean_text(text: str) -> tuple[str, int, int, dict[str, int]]:
    """(text without failing lines, lines equal to an earlier one, word characters lost, failing lines by rule).

    Lines without a word stay as they are.
    """
    kept, seen = [], set()
    repeats = lost = 0
    faults = {"punctuation": 0, "navigation": 0, "boilerplate": 0}
    for line in text.split("\n"):
        if not _word.search(line):
            kept.append(line)
            continue
        repeats += line in seen
        seen.add(line)
        rule = fault(line)
        if rule is None:
            kept.append(line)
        else:
            faults[rule] += 1
            lost += sum(map(len, _word.findall(line)))
    return "\n".join(kept), repeats, lost, faults


def by_text(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many flags stand before each cut, as differences of neighbouring cuts."""
    return np.diff(np.r_[0, np.cumsum(flags, dtype=np.int64)][cuts])


def repeated_words(hashes: np.ndarray, counts: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """For each text, how many of its words lie in a window of ``width`` words that the text holds twice or more."""
    windows, text = hashing.shingles(hashes, counts, width)
    full = np.diff(counts)[text] >= width
    windows, text = windows[full], text[full]
    ranks = np.arange(len(text)) - np.searchsorted(text, text)
    first = counts[text] + ranks
    keys = windows ^ hashing.mix64(text.astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = first[order[np.r_[same, False] | np.r_[False, same]]] if len(keys) else first
    covered = np.zeros(len(hashes) + 1, np.int64)
    covered[: len(hashes)] += np.bincount(twice, minlength=len(hashes))[: len(hashes)]
    ends = np.bincount(twice + width, minlength=len(hashes) + 1)
    return by_text(np.cumsum(covered - ends[: len(hashes) + 1])[: len(hashes)] > 0, counts)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_chars",
           "n_bad_punctuation", "n_navigation", "n_boilerplate"]


def measured(texts: pa.Array) -> Iterator[tuple[int, dict[str, pa.Array]]]:
    """(first text, columns) of some texts at a time."""
    for first, data, cuts in hashing.slices(texts):
        hashes, _, _, counts = hashing.words(data, cuts, fold=False)
        raw = data.tobytes()
        lines = [clean_text(raw[a:b].decode()) for a, b in zip(cuts[:-1], cuts[1:])]
        numbers = [np.diff(counts), by_text(_WORD_POINT[data], cuts), by_text(_SYMBOL[data], cuts),
                   [x[1] for x in lines], repeated_words(hashes, counts), [x[2] for x in lines],
                   *([x[3][rule] for x in lines] for rule in ("punctuation", "navigation", "boilerplate"))]
        columns = {name: pa.array(np.asarray(n, np.int64)) for name, n in zip(_COUNTS, numbers)}
        yield first, columns | {"cleaned": pa.array([x[0] for x in lines], pa.string())}


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs``, then counts of the whole text, ``cleaned``, ``base_failed`` and ``kept``.

    ``cleaned`` is the text without the lines that fail a rule of :func:`fault`;
    ``n_lost_chars`` counts their word characters, ``n_bad_punctuation``,
    ``n_navigation`` and ``n_boilerplate`` the lines by the first rule they
    fail.  ``base_failed``: fewer than ``LEAST_WORDS`` words, or more than
    ``MOST_REPEATED`` per cent of them in repeated windows.  ``kept``: not
    ``base_failed``, and at most ``MOST_LOST`` per cent of the word characters
    lost.  Every text is judged whole and by itself, in its own task.

    Null and empty texts, and texts of white space, have no words: all counts
    are 0, ``cleaned`` is the text (empty for null), and they are not kept.
    Repeated rows stay; no rows give none; input columns with the name of a
    result are replaced.
    """
    results = [*_COUNTS, "cleaned", "base_failed", "kept"]
    fields = [f for f in docs.schema.fields if f.name not in results]
    names = [f.name for f in fields]
    schema = StructType([*fields, *(StructField(n, LongType()) for n in _COUNTS), StructField("cleaned", StringType())])
    needed = list(dict.fromkeys([*names, text]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, columns in measured(batch.column(text)):
                rows = batch.slice(first, len(columns["cleaned"])).select(names)
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns.values()], schema.names)

    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (
        docs.select(*needed)
        .mapInArrow(run, schema)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (100 * F.col("n_lost_chars") <= MOST_LOST * F.col("word_chars")))
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _among(characters: str) -> str:
    """A character class in SQL text."""
    return "[" + characters.replace("]", "\\]").replace("'", "''") + "]"


_N_WORDS = f"len(regexp_extract_all(line, '{WORD}'))"
_STARTS_A_STEP = f"regexp_matches(lower(line), '^(?:{'|'.join(STEPS)})\\b')"
_HAS_A_NOTICE = " OR ".join(f"contains(lower(line), '{phrase}')" for phrase in NOTICES)

OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT r, regexp_extract_all(text, '{WORD}') AS ws FROM docs)),
windows AS (
  SELECT r, i, concat_ws(' ', w, {", ".join(f"lead(w, {k}) OVER p" for k in range(1, WINDOW))}) AS win,
         lead(i, {WINDOW - 1}) OVER p AS last
  FROM words WINDOW p AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM windows WHERE last IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range({WINDOW}) AS s(k) GROUP BY r),
counted AS (SELECT r, count(*) AS n, sum(length(w)) AS chars FROM words GROUP BY r),
split AS (
  SELECT r, unnest(ls) AS raw, generate_subscripts(ls, 1) AS i FROM (SELECT r, string_split(text, chr(10)) AS ls FROM docs)),
lines AS (
  SELECT r, raw, i, regexp_replace(raw, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS line
  FROM split WHERE regexp_matches(raw, '{WORD}')),
judged AS (
  SELECT r, row_number() OVER (PARTITION BY r, raw ORDER BY i) > 1 AS again,
         length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars,
         NOT regexp_matches(line, '{_among(ENDS)}{_among(CLOSERS)}*$')
         OR 10 * len(regexp_extract_all(line, '{MARKS}')) > {MOST_MARKED} * {_N_WORDS}
         OR (len(regexp_extract_all(line, '{_among(SEPARATORS)}')) >= {SEPARATIONS}
             AND {_N_WORDS} <= {SEGMENT_WORDS} * (len(regexp_extract_all(line, '{_among(SEPARATORS)}')) + 1))
         OR ({_STARTS_A_STEP} AND {_N_WORDS} <= {STEP_WORDS})
         OR {_HAS_A_NOTICE} AS bad
  FROM lines),
by_line AS (SELECT r, sum(again::INT) AS again, sum(CASE WHEN bad THEN chars ELSE 0 END) AS lost FROM judged GROUP BY r),
counts AS (
  SELECT doc_id, coalesce(c.n, 0)::BIGINT AS n_words, coalesce(c.chars, 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(l.again, 0)::BIGINT AS n_dup_lines,
         coalesce(v.n, 0)::BIGINT AS n_repeat_words, coalesce(l.lost, 0) AS lost
  FROM docs LEFT JOIN counted c USING (r) LEFT JOIN by_line l USING (r) LEFT JOIN covered v USING (r)),
failing AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= {MOST_LOST} * word_chars AS kept
FROM failing
"""
