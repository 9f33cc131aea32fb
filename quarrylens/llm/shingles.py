"""Sets of word shingles of whole texts, and their one-permutation MinHash signatures."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from quarrylens.llm.words import LOWER, NOT_BLANK, blocks, gram_hashes, mixed, word_hashes

WORDS = 5


def shingle_sets(texts: pa.Array, k: int = WORDS) -> Iterator[np.ndarray]:
    """The set of each text, as ascending 64-bit hashes: distinct shingles of ``k`` words; the whole
    sequence of a text with fewer words; empty without words."""
    for _, raw, offsets in blocks(texts):
        hashes, bounds = word_hashes(LOWER[raw], offsets, NOT_BLANK)
        grams = gram_hashes(hashes, k)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            n = hi - lo
            if n >= k:
                yield np.unique(grams[lo : hi - k + 1])
            elif n:
                yield gram_hashes(hashes[lo:hi], n) ^ np.uint64(n)
            else:
                yield np.zeros(0, np.uint64)


@functools.lru_cache(maxsize=4)
def _bins(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower edges of ``n`` equal ranges of 64-bit hashes, and for each range an order of all ranges."""
    edges = np.array([(b << 64) // n for b in range(n)], np.uint64)
    order = mixed(np.arange(n * n, dtype=np.uint64) + np.uint64(0x51ED270B)).reshape(n, n)
    return edges, np.argsort(np.argsort(order, axis=1), axis=1).astype(np.int32)


def signature(found: np.ndarray, n: int) -> np.ndarray:
    """One-permutation MinHash of an ascending set that isn't empty: the smallest hash in each of
    ``n`` ranges; an empty range takes the value of the first non-empty one in its own random
    order of all ranges (optimal densification)."""
    edges, order = _bins(n)
    at = np.searchsorted(found, edges)
    ends = np.append(at[1:], len(found))
    full = at < ends
    out = found[np.minimum(at, len(found) - 1)]
    if not full.all():
        givers, empty = np.flatnonzero(full), np.flatnonzero(~full)
        out[empty] = out[givers[np.argmin(order[np.ix_(empty, givers)], axis=1)]]
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` values; bands have keys of their own."""
    parts = mixed(sig).reshape(-1, rows)
    key = np.arange(len(parts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return key


def set_digest(found: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as two signed integers."""
    import hashlib

    digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)
