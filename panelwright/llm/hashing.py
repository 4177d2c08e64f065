"""Hashes of the words of many texts at once, on the bytes of Arrow arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at a time; a longer text is hashed alone.
SLICE_BYTES = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def nth64(x: np.ndarray, n: int) -> np.ndarray:
    """The n-th pseudo-random word of each seed."""
    return mix64(x + np.uint64((n + 1) * int(_GOLDEN) % 2**64))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_BYTE[_SPACE] = 0
_FOLDED = _BYTE.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.r_[np.uint64(1), np.full(max(n, 4096), _POWER)], dtype=np.uint64)
    return _powers


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, cuts) of consecutive texts; text i of a slice is ``bytes[cuts[i]:cuts[i + 1]]``.  Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, cuts: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, last byte + 1) of every word of a slice, and the word counts' running sum by text.

    A word is a run of bytes other than ASCII white space inside one text; with
    ``fold``, A-Z count as a-z.  Equal words have equal hashes; different words
    share one with probability 2**-64.
    """
    empty = np.empty(0, np.int64)
    if not len(data):
        return np.empty(0, np.uint64), empty, empty, np.zeros(len(cuts), np.int64)
    space = _SPACE[data]
    opens = ~space
    opens[1:] &= space[:-1]
    edges = cuts[1:-1]
    edges = edges[edges < len(data)]
    opens[edges] = ~space[edges]
    starts = np.flatnonzero(opens)
    closes = ~space
    closes[:-1] &= space[1:]
    closes[edges[edges > 0] - 1] = ~space[edges[edges > 0] - 1]
    ends = np.flatnonzero(closes) + 1
    if not len(starts):
        return np.empty(0, np.uint64), empty, empty, np.zeros(len(cuts), np.int64)
    lengths = np.diff(np.r_[starts, len(data)])
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    place[space[starts[0] :]] = 0
    value = (_FOLDED if fold else _BYTE)[data[starts[0] :]] * powers(int((ends - starts).max()))[place]
    hashes = mix64(np.add.reduceat(value, starts - starts[0]) + (ends - starts).astype(np.uint64))
    return hashes, starts, ends, np.searchsorted(starts, cuts)


def shingles(hashes: np.ndarray, cuts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``width`` words; a shorter text that has words is one run."""
    counts = np.diff(cuts)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), runs)
    first = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs) + cuts[:-1][text]
    length = np.minimum(width, counts[text])
    total = length.astype(np.uint64) * _GOLDEN
    for i in range(width):
        inside = np.flatnonzero(length > i)
        total[inside] += nth64(hashes[first[inside] + i], i)
    return mix64(total), text


def distinct(values: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (value, group) pairs, by group, then value."""
    order = np.lexsort((values, groups))
    values, groups = values[order], groups[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (groups[1:] != groups[:-1])
    return values[new], groups[new]
