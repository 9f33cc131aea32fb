"""Content-defined cuts of texts: each window of bytes belongs to one anchor inside it.

The anchor of a window of ``length`` bytes is the leftmost of its ``gram``-byte strings with the
smallest hash. It depends on the bytes of the window alone, so equal windows have equal anchors at equal
places. Neighbouring windows mostly share their anchor; such a run is a segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from quarrylens.llm.words import mixed

_TABLE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(0xA5A5A5))


def gram_values(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place on (a power of two); shorter by ``gram - 1``."""
    values, width = _TABLE[raw], 1
    multiplier = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        while width < gram:
            values = values[:-width] * np.uint64(multiplier) + values[width:]
            multiplier = multiplier * multiplier % (1 << 64)
            width *= 2
    return mixed(values)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


#: Bits of a place within a block: blocks and pieces of long texts have fewer bytes.
PLACE_BITS, PIECE = 23, 1 << 22
#: Periods of texts whose windows are known to repeat without being sorted, and the distance of the places where they are looked for.
PERIODS, STEP = 16, 32


def periodic(raw: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Windows that equal the one at most ``PERIODS`` bytes before them in the same text: ``(first, last)`` rows of places.

    A text of one letter, or of a short pattern over and over, has an anchor for nearly every byte; its windows are
    told by comparing the text with itself, moved by each period. Where a window has a period, so has each of its bytes, so
    every ``STEP``-th byte is looked at first."""
    found = []
    for period in range(1, PERIODS + 1):
        n = len(raw) - period
        if n < length:
            break
        seen = np.flatnonzero(raw[:n:STEP] == raw[period::STEP][: -(-n // STEP)]) * STEP
        # the same of the bytes after it, up to the next place looked at
        for more in (1, 2, 3, 5, 8, 13, 21, 31):
            seen = seen[seen + more < n]
            seen = seen[raw[seen + more] == raw[seen + more + period]]
        k = 0
        while k < len(seen):
            at = int(seen[k])
            # the text's bounds; both the window and the one before it lie inside
            row = int(np.searchsorted(offsets, at, "right")) - 1
            begin, end = int(offsets[row]), int(offsets[row + 1]) - period
            if at >= end:
                k += 1
                continue
            lo = at - _run(raw[begin:at][::-1], raw[begin + period : at + period][::-1])
            hi = at + _run(raw[at:end], raw[at + period : end + period])
            k = max(k + 1, int(np.searchsorted(seen, hi)))
            if hi - lo >= length:
                found.append((lo + period, hi - length + period))
    return np.array(found, np.int64).reshape(-1, 2)


def _run(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal bytes at the beginning; looked at in growing steps."""
    at, width = 0, 256
    while at < len(a):
        differ = np.flatnonzero(a[at : at + width] != b[at : at + width])
        if len(differ):
            return at + int(differ[0])
        at, width = at + width, width * 4
    return len(a)


def segments(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, first window, last window, anchor, hash of the anchor's gram)`` of the segments of a block
    of texts; places are those in the block. Windows that :func:`periodic` knows are left out.

    A block longer than ``PIECE`` is one text; it is taken in pieces, so that memory stays bounded. Segments end at a piece's end."""
    n = len(raw)
    known = periodic(raw, offsets, length)
    for begin in range(0, max(n - length + 1, 0), PIECE):
        part = raw[begin : begin + PIECE + length - 1]
        values = gram_values(part, gram)
        bits = np.uint64(PLACE_BITS)
        ranked = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
        least = sliding_min(ranked, length - gram + 1)  # one value for each window
        windows = np.arange(begin, begin + len(least))
        row = np.searchsorted(offsets, windows, "right") - 1
        inside = windows + length <= offsets[row + 1]
        for lo, hi in known.tolist():
            inside[max(lo - begin, 0) : max(hi + 1 - begin, 0)] = False
        anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        starts, stops = inside.copy(), inside.copy()
        change = anchor[1:] != anchor[:-1]
        starts[1:] &= ~inside[:-1] | change
        stops[:-1] &= ~inside[1:] | change
        first, last = np.flatnonzero(starts), np.flatnonzero(stops)
        yield row[first], first + begin, last + begin, anchor[first] + begin, values[anchor[first]]
