"""Sorted runs of byte strings: front coding, and merging without comparing a known prefix twice."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to be equal."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (differ.bit_length() + 7) // 8


def front_coded(strings: list[bytes]) -> bytes:
    """A sorted run: for each string its length, the length of the prefix that it shares with the one
    before, and the bytes after that prefix."""
    shared = np.zeros(len(strings), "<u4")
    tails, before = [], b""
    for i, s in enumerate(strings):
        shared[i] = common_prefix(before, s)
        tails.append(s[shared[i] :])
        before = s
    sizes = np.array([len(s) for s in strings], "<u4")
    return np.uint32(len(strings)).tobytes() + sizes.tobytes() + shared.tobytes() + b"".join(tails)


def decoded(run: bytes) -> Iterator[tuple[bytes, int]]:
    """The strings of a run, each with the length of the prefix shared with the one before."""
    n = int(np.frombuffer(run, "<u4", 1)[0])
    sizes = np.frombuffer(run, "<u4", n, 4).tolist()
    shared = np.frombuffer(run, "<u4", n, 4 + 4 * n).tolist()
    at, s = 4 + 8 * n, b""
    for size, keep in zip(sizes, shared, strict=True):
        stop = at + size - keep
        s = s[:keep] + run[at:stop]
        at = stop
        yield s, keep


def merged(runs: list[bytes]) -> Iterator[tuple[bytes, int, int, int]]:
    """All strings of sorted runs in order: ``(string, prefix shared with the one before, run, place in run)``.

    A tournament of losers: inner nodes hold the loser of the match below them, with the length of the
    prefix that it shares with the winner. Of two strings with different such lengths the one that shares
    more with the last winner is smaller, so bytes are compared only from the known prefix on, and each
    byte of a string is compared at most once."""
    k = len(runs)
    streams = [decoded(r) for r in runs]
    strings: list[bytes | None] = [None] * k
    shared, places = [0] * k, [-1] * k

    def advance(i: int) -> None:
        item = next(streams[i], None)
        if item is None:
            strings[i] = None
        else:
            strings[i], shared[i] = item
            places[i] += 1

    def beats(i: int, j: int) -> bool:
        """Whether i goes first; the loser's shared prefix becomes the one with the winner."""
        a, b = strings[i], strings[j]
        if a is None or b is None:
            return b is None
        if shared[i] != shared[j]:
            return shared[i] > shared[j]
        at = common_prefix(a, b, shared[i])
        first = at == len(a) if at == len(a) or at == len(b) else a[at] < b[at]
        if at == len(a) == len(b):
            first = i < j
        shared[j if first else i] = at
        return first

    losers = [-1] * k
    for i in range(k):
        advance(i)
        shared[i] = 0
    # matches are played from the leaves k..2k-1 upwards; the first to reach a node waits there
    winner = 0
    for i in range(k):
        node, champion = (i + k) >> 1, i
        while node:
            if losers[node] < 0:
                losers[node] = champion
                champion = -1
                break
            if beats(losers[node], champion):
                losers[node], champion = champion, losers[node]
            node >>= 1
        if champion >= 0:
            winner = champion
    while strings[winner] is not None:
        i = winner
        yield strings[i], shared[i], i, places[i]
        advance(i)
        node = (i + k) >> 1
        while node:
            other = losers[node]
            if beats(other, i):
                losers[node], i = i, other
            node >>= 1
        winner = i
