"""Document fingerprints: invertible Bloom lookup tables of paragraph digests, subtracted and peeled."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.llm import hashing
from panelwright.llm.tables import read
from panelwright.session import landed

#: First words of a line that are cut into fine pieces, and how far around it a word must be the least to open a piece there and after.
FINE_WORDS, FINE, COARSE = 32, 1, 4
#: Words of a piece at most, there and after.
FINE_MOST, COARSE_MOST = 8, 32
#: Hash functions of the sketch, its cells per function, and their growth when peeling fails.
FUNCTIONS, CELLS, GROWTH = 3, 8, 4


def least_around(hashes: np.ndarray, lines: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words have the least hash among FINE and among COARSE words before and after on their line, the first of equal ones."""
    least, found = np.ones(len(hashes), bool), {}
    for d in range(1, COARSE + 1):
        elsewhere = (lines[d:] != lines[:-d]) | (owner[d:] != owner[:-d])
        less = hashes[d:] < hashes[:-d]
        least[d:] &= less | elsewhere
        least[:-d] &= ~less | elsewhere
        found[d] = least.copy()
    return found[FINE], found[COARSE]


def _since(opening: np.ndarray) -> np.ndarray:
    """How many rows each is behind the last one that opens; the first does."""
    at = np.flatnonzero(opening)
    return np.arange(len(opening)) - np.repeat(at, np.diff(np.r_[at, len(opening)]))


def paragraph_digests(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digest, text) of the paragraph pieces of a slice of texts.

    A paragraph is a line.  It is cut into pieces of a few words, where the hash
    of a word is the least of those around it (about every third word, after the
    first words of a line every ninth).  So an edit changes the pieces next to it
    and, where words were added or removed, at the end of the finer ones; longer runs without a border
    are cut at a fixed length.  Repetitions of a piece in a
    text are numbered, so the digests of a text are distinct.  Any change of the
    white space between words is not seen, but for line breaks.
    """
    hashes, starts, _, counts = hashing.words(data, cuts, fold=False)
    owner = np.repeat(np.arange(len(cuts) - 1), np.diff(counts))
    if not len(hashes):
        return np.empty(0, np.uint64), owner
    lines = np.searchsorted(np.flatnonzero((data == 0x0A) | (data == 0x0D)), starts)
    first = np.ones(len(hashes), bool)
    first[1:] = (lines[1:] != lines[:-1]) | (owner[1:] != owner[:-1])
    place = _since(first)
    fine = place < FINE_WORDS
    opening = first | np.where(fine, *least_around(hashes, lines, owner))
    inside = _since(opening) % np.where(fine, FINE_MOST, COARSE_MOST)
    opens = np.flatnonzero(inside == 0)
    inside = _since(inside == 0)
    rotated = hashing.mix64(hashes + inside.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    digest, owner = hashing.mix64(np.add.reduceat(rotated, opens)), owner[opens]
    order = np.lexsort((digest, owner))
    digest, owner = digest[order], owner[order]
    new = np.ones(len(digest), bool)
    new[1:] = (digest[1:] != digest[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    times = np.arange(len(digest)) - np.repeat(at, np.diff(np.r_[at, len(digest)]))
    return hashing.mix64(digest + times.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), owner


class Sketches:
    """Lookup tables of several sets: per cell a count, the sum of the keys and the sum of their checks.

    Each of the functions has its own cells, of which a key takes one.  Sums are
    modulo 2**64, so tables of two sets subtract cell by cell.
    """

    def __init__(self, keys: np.ndarray, owner: np.ndarray, owners: int, cells: int):
        self.owners, self.cells = owners, cells
        size = owners * FUNCTIONS * cells
        self.count, self.key, self.check = np.zeros(size, np.int64), np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.add(keys, owner, 1)

    def places(self, keys: np.ndarray, owner: np.ndarray) -> Iterator[np.ndarray]:
        for f in range(FUNCTIONS):
            cell = ((hashing.nth64(keys, f) >> np.uint64(32)) * np.uint64(self.cells)) >> np.uint64(32)
            yield (owner * FUNCTIONS + f) * self.cells + cell.astype(np.int64)

    def add(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray | int) -> None:
        signed = np.broadcast_to(np.asarray(sign, np.int64), keys.shape)
        factor = signed.astype(np.uint64)
        checks = hashing.nth64(keys, FUNCTIONS)
        for at in self.places(keys, owner):
            np.add.at(self.count, at, signed)
            np.add.at(self.key, at, keys * factor)
            np.add.at(self.check, at, checks * factor)

    def __sub__(self, other: "Sketches") -> "Sketches":
        out = Sketches(np.empty(0, np.uint64), np.empty(0, np.int64), self.owners, self.cells)
        out.count, out.key, out.check = self.count - other.count, self.key - other.key, self.check - other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(keys, owner, sign) of the recovered differences, and which owners were emptied.  The table is used up.

        A cell is pure if its count is 1 or -1 and its check is that of its key;
        its key leaves all its cells, which may make others pure.
        """
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        per_owner = FUNCTIONS * self.cells
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            sign = self.count[look]
            keys = self.key[look] * sign.astype(np.uint64)
            pure = (np.abs(sign) == 1) & (self.check[look] * sign.astype(np.uint64) == hashing.nth64(keys, FUNCTIONS))
            owner, keys, sign = (look // per_owner)[pure], keys[pure], sign[pure]
            if not len(keys):
                break
            order = np.lexsort((keys, owner))
            owner, keys, sign = owner[order], keys[order], sign[order]
            once = np.ones(len(keys), bool)
            once[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
            owner, keys, sign = owner[once], keys[once], sign[once]
            found.append((keys, owner, sign))
            self.add(keys, owner, -sign)
            look = np.concatenate(list(self.places(keys, owner)))
            look = look[np.abs(self.count[look]) == 1]
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        emptied = ~left.reshape(self.owners, per_owner).any(axis=1)
        if not found:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), emptied
        return *(np.concatenate(x) for x in zip(*found)), emptied

    def texts(self) -> list[str]:
        """Each owner's table as base64 text: counts, keys and checks, each cell in 2 + 8 + 4 bytes."""
        n = self.owners
        cells = np.concatenate([
            (self.count & 0xFFFF).astype("<u2").reshape(n, -1).view(np.uint8),
            self.key.astype("<u8").reshape(n, -1).view(np.uint8),
            (self.check >> np.uint64(32)).astype("<u4").reshape(n, -1).view(np.uint8),
        ], axis=1)
        return [base64.b64encode(row.tobytes()).decode() for row in cells]


Keys = tuple[np.ndarray, np.ndarray]


def differences(left: Keys, right: Keys, owners: int) -> np.ndarray:
    """How many digests of each owner's two sets are in one of them only, recovered by peeling subtracted sketches.

    Owners whose sketches cannot be peeled are tried again with larger ones.
    """
    result = np.zeros(owners, np.int64)
    open_owners, cells = np.arange(owners), CELLS
    while len(open_owners):
        place = np.full(owners, -1)
        place[open_owners] = np.arange(len(open_owners))
        tables = []
        for keys, owner in (left, right):
            mine = place[owner] >= 0
            tables.append(Sketches(keys[mine], place[owner[mine]], len(open_owners), cells))
        keys, owner, _, emptied = (tables[0] - tables[1]).peel()
        recovered = np.bincount(owner, minlength=len(open_owners))
        result[open_owners[emptied]] = recovered[emptied]
        open_owners, cells = open_owners[~emptied], cells * GROWTH
    return result


def likeness(left: Keys, right: Keys, owners: int) -> np.ndarray:
    """Share of the digests of two sets that both hold: 1 for equal sets, also for empty ones, 0 for disjoint ones."""
    total = np.bincount(left[1], minlength=owners) + np.bincount(right[1], minlength=owners)
    return np.where(total, 1 - differences(left, right, owners) / np.maximum(total, 1), 1.0)


def digest_keys(texts: list[str]) -> Iterator[tuple[int, int, Keys]]:
    """(first, last + 1, digests) of slices of texts."""
    for first, data, cuts in hashing.slices(pa.array(texts, pa.large_string())):
        yield first, first + len(cuts) - 1, paragraph_digests(data, cuts)


def compared(texts: list[str], edits: list[str], following: list[str]) -> dict[str, list]:
    """Fingerprints of texts and edited texts, and the likeness of each text to its edited and its next text."""
    out: dict[str, list] = {"fingerprint": [], "edited_fingerprint": [], "near_edited": [], "near_next": []}
    for first, last, own in digest_keys(texts):
        n = last - first
        others = []
        for versions in (edits[first:last], following[first:last]):
            parts = [(a, keys) for a, _, keys in digest_keys(versions)]
            others.append((np.concatenate([k for _, (k, _) in parts]), np.concatenate([o + a for a, (_, o) in parts])))
        out["fingerprint"] += Sketches(*own, n, CELLS).texts()
        out["edited_fingerprint"] += Sketches(*others[0], n, CELLS).texts()
        out["near_edited"] += likeness(own, others[0], n).tolist()
        out["near_next"] += likeness(own, others[1], n).tolist()
    return out


def edited_text(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many first characters of the next one, or all it has."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double"
)
_NAMES = [field.split()[0] for field in _RESULT.split(", ")]


def _rows(ids: list[int | None], texts: list[str], following: list[str]) -> pa.RecordBatch:
    edits = [edited_text(t, f) for t, f in zip(texts, following)]
    found = compared(texts, edits, following)
    columns = {
        "doc_id": pa.array(ids, pa.int64()),
        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
        "fingerprint": pa.array(found["fingerprint"], pa.string()),
        "edited_fingerprint": pa.array(found["edited_fingerprint"], pa.string()),
        "near_edited": pa.array(found["near_edited"], pa.float64()),
        "near_next": pa.array(found["near_next"], pa.float64()),
    }
    return pa.RecordBatch.from_arrays([columns[n] for n in _NAMES], _NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Of every text and of its edited form (see :func:`edited_text`) the fingerprint, and how alike they are.

    The result has doc_id, n_chars (of the text), edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next: the likeness of the text to
    its edited form and to the next text, in ascending order of ids and, of one
    id, of a hash of the text; after the last comes the first.

    Rows are sorted by ranges of the id, so a task sees each row's next one.
    Only the first and the last row of a task are put together with those of its
    neighbours, in a second step over one row per task: each task's number is
    joined to the next one's, and the texts by these numbers.

    Null texts are empty; a text without words is as alike to another as both
    have no words (1) or not (0).  A null id comes first.  Repeated rows stay
    and follow each other; a single row is its own next; no rows give none.
    Other columns are not read.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    sorted_docs = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    border = ["part", "first_text", "last_id", "last_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, ids, texts = None, [], []

        def framed(rows: pa.RecordBatch, ends: list) -> pa.RecordBatch:
            n = rows.num_rows
            types = [pa.int64(), pa.string(), pa.int64(), pa.string()]
            extra = [pa.array([e] if n == 0 else [None] * n, t) for e, t in zip(ends, types)]
            own = rows.columns if n else [pa.nulls(1, c.type) for c in rows.columns]
            return pa.RecordBatch.from_arrays([*own, *extra], [*_NAMES, *border])

        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            texts += batch.column("text").to_pylist()
            if not texts:
                continue
            first = texts[0] if first is None else first
            if len(texts) > 1:
                yield framed(_rows(ids[:-1], texts[:-1], texts[1:]), [None] * 4)
                ids, texts = ids[-1:], texts[-1:]
        if texts:
            part = TaskContext.get().partitionId()
            yield framed(_rows([], [], []), [part, first, ids[0], texts[0]])

    schema = f"{_RESULT}, part long, first_text string, last_id long, last_text string"
    done = landed(sorted_docs.mapInArrow(run, schema), "fingerprints")
    ends = done.filter("part IS NOT NULL")
    # the window orders one number per task; texts meet by a join
    by_part = Window.orderBy("part")
    following = ends.select("part", F.coalesce(F.lead("part").over(by_part), F.first("part").over(by_part)).alias("next"))
    heads = ends.select(F.col("part").alias("next"), F.col("first_text").alias("following"))
    last_rows = (
        ends.select("part", F.col("last_id").alias("doc_id"), F.col("last_text").alias("text"))
        .join(following, "part").join(heads, "next").select("doc_id", "text", "following")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield _rows(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "following")))

    return done.filter("part IS NULL").select(_NAMES).unionByName(last_rows.mapInArrow(finish, _RESULT))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents").select("doc_id", "text"))
