"""Words of many texts at once, as 64-bit hashes, computed on their UTF-8 bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken together up to about so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ``[^\x20\x09-\x0D]+`` as a set of bytes.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` as a set of bytes.
LETTERS_DIGITS = np.zeros(256, bool)
LETTERS_DIGITS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(max(n, 4096), _BASE)]))
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of rows; texts have no nulls."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        stop = min(stop, len(texts))
        yield row, raw[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def word_hashes(raw: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a block (lower-cased bytes), and ``bounds``: words of row i are
    ``bounds[i]:bounds[i + 1]``."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = in_word[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < n]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    number = np.cumsum(first) - 1
    place = np.arange(n) - starts[np.maximum(number, 0)]
    place[~inside] = 0
    powers = _power_table(int(place.max()) + 2)
    with np.errstate(over="ignore"):
        terms = (raw.astype(np.uint64) + np.uint64(1)) * powers[place]
        terms[~inside] = 0
        hashes = np.add.reduceat(terms, starts)
    return mixed(hashes), np.searchsorted(starts, offsets)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from every word on (shorter by k - 1)."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * _BASE + hashes[i : i + n]
    return mixed(out)
