"""Repeated substrings: remove each byte under a string of ``length`` bytes that also starts earlier.

A distributed merge sort of suffixes that never ships or compares what is known already.

1. *Which suffixes can repeat.* Suffixes are sampled by content (:mod:`.anchors`): equal windows of ``length`` bytes
   have the same anchor at the same place, about one anchor in 35 bytes. Only the 64-bit hash of an
   anchor's first 32 bytes is exchanged, once per batch of rows; anchors whose hash is met once are done with.
   So are later copies of a whole text (told by 128 bits of hash): all of their strings start earlier.
2. *Sorted runs.* What is sorted is a sampled suffix: the bytes from the anchor on as far as windows with that anchor reach, then
   the bytes before it backwards, then the number of the latter. Within a task these are sorted and front-coded. Equal ones are
   one string with its first place; the others are removed right away. Runs are cut by the hash of the anchor, and exchanged.
3. *Merge.* A tree of losers merges the runs, comparing strings from their known common prefix on. Equal strings come out
   next to each other, known by their shared prefix alone, and keep the first place. Strings with one anchor come out together: how far
   two of them are equal to the right of it is again the shared prefix; to the left it is found by sorting those parts once.
4. The spans found are joined back to the texts.

Earlier means a smaller id, or the same document and a smaller start; all strings are judged on the input.

What bounds it: runs of ``RUN_BYTES``; as many buckets as the suffixes found in step 1 need at ``BUCKET_BYTES`` each; an anchor with more
than ``HOT`` suffixes (at the edge of a passage that very many documents share) isn't sorted in one task: each of its windows goes to the bucket
of a 128-bit hash of its own bytes, once for a run. Windows that repeat with a period of a few bytes are found in the text itself. Long texts are taken in pieces.

Defined results: a null or empty text has no bytes, and nothing is removed; a null id comes after every id. Rows with the same
id and text are one document (each row gets its result); rows with one id and different texts are ordered by a hash of the text.
An empty table gives an empty table; other columns of ``docs``, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.anchors import periodic, segments
from quarrylens.llm.common import checkpointed, documents, looked_up, shuffle_partitions
from quarrylens.llm.string_merge import common_prefix, front_coded, merged
from quarrylens.llm.words import blocks

LENGTH, GRAM = 100, 32
#: A run is closed when its strings hold so many bytes; a bucket is meant to hold so many.
RUN_BYTES, BUCKET_BYTES = 12 << 20, 24 << 20
#: Suffixes of one anchor that are sorted in one task, and the number of anchors beyond that which are told to all tasks (the
#: most frequent ones; any others are sorted).
HOT, HOT_ANCHORS = 200_000, 1_000_000
#: Bytes of a suffix with its place, and of a window's hash with its place, about.
SUFFIX_BYTES, WINDOW_BYTES = 250, 80
#: Anchors asked about at a time.
ASKED = 1 << 20
NO_ID = (1 << 63) - 1
_META = np.dtype([("doc", "<i8"), ("version", "<i8"), ("start", "<i8"), ("left", "<u2")])


def _copies(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc, version`` of the first document of every text, and whole-text spans of all others, told by two
    64-bit hashes. Only narrow rows are shuffled."""
    keys = rows.select("doc", "version", F.xxhash64(F.lit(1), "text").alias("second"), F.octet_length("text").cast("long").alias("stop"))
    first = keys.groupBy("version", "second").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    copied = looked_up(keys, first.filter("first_doc < last_doc").drop("last_doc"), ["version", "second"], how="inner").filter("doc > first_doc")
    return first.select(F.col("first_doc").alias("doc"), "version").distinct(), copied.select("doc", "version", F.lit(0).cast("long").alias("start"), "stop")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, version, text``; the keys have no nulls."""
    rows = documents(docs, id_col, text_col)
    return rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("version"), "text")


def _suspects(rows: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """``doc, version, starts, hots``: first windows of the segments whose anchor may occur elsewhere; ``hots`` are values of
    anchors with more than ``hot`` suffixes, with their number (each is told to one document)."""

    def question(parts: list[tuple]) -> pa.RecordBatch:
        value, doc, version, start = (np.concatenate(x) for x in zip(*parts, strict=True))
        _, inverse, counts = np.unique(value, return_inverse=True, return_counts=True)
        order = np.argsort(inverse, kind="stable")
        asks = np.zeros(len(value), np.int64)
        asks[order[np.cumsum(counts) - counts]] = counts  # one of each value
        # rows that don't ask are dealt anywhere, so that a frequent value is no hot key
        dealt = np.where(asks > 0, value, (doc ^ (start << 20)) * 0x2545F491)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (dealt, asks, counts[inverse] > 1, doc, version, start)], names=["value", "asks", "several", "doc", "version", "start"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, version = (batch.column(c).to_numpy() for c in (0, 1))
            parts, size = [], 0
            for row0, raw, offsets in blocks(batch.column(2)):
                for row, first, _, _, value in segments(raw, offsets, length, gram):
                    parts.append((value.view(np.int64), doc[row + row0], version[row + row0], first - offsets[row]))
                    size += len(value)
                    if size >= ASKED:
                        yield question(parts)
                        parts, size = [], 0
            if size:
                yield question(parts)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # rows of the value at the end of the last batch
        for batch in batches:
            rows_ = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(6)]
            if held is not None:
                rows_ = [np.concatenate(x) for x in zip(held, rows_, strict=True)]
            cut = int(np.searchsorted(rows_[0], rows_[0][-1], "left")) if len(rows_[0]) else 0
            yield _met_again([x[:cut] for x in rows_], hot)
            held = [x[cut:] for x in rows_]
        if held is not None:
            yield _met_again(held, hot)

    asked = rows.mapInArrow(ask, "value long, asks long, several boolean, doc long, version long, start long")
    found = asked.repartition("value").sortWithinPartitions("value").mapInArrow(answer, "doc long, version long, start long, value long, total long")
    return found.groupBy("doc", "version").agg(F.collect_list("start").alias("starts"), F.collect_list(F.when(F.col("total") > 0, F.struct("value", "total"))).alias("hots"))


def _met_again(rows: list[np.ndarray], hot: int) -> pa.RecordBatch:
    """Places of the values that were met twice; of those that asked, in one batch or in several. A value met more than
    ``hot`` times is named, with that number, beside one of its places."""
    value, asks, several, doc, version, start = rows
    keep = several.copy()
    at = np.flatnonzero(asks)
    _, first, inverse, counts = np.unique(value[at], return_index=True, return_inverse=True, return_counts=True)
    repeated = np.zeros(len(counts), bool)
    np.logical_or.at(repeated, inverse, several[at])
    keep[at] |= (counts[inverse] > 1) | repeated[inverse]
    totals = np.bincount(inverse, weights=asks[at], minlength=len(counts)).astype(np.int64)
    total = np.zeros(len(value), np.int64)
    total[at[first]] = np.where(totals > hot, totals, 0)
    return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (doc, version, start, value, total)], names=["doc", "version", "start", "value", "total"])


class _Run:
    """Suffixes of a run, until it is sorted and front-coded."""

    def __init__(self, buckets: int, length: int):
        self.buckets, self.length = buckets, length
        self.items: dict[int, dict[bytes, tuple]] = {}
        self.windows: dict[bytes, tuple] = {}
        self.repeats: list[tuple] = []
        self.size = 0

    def add(self, text: bytes, doc: int, version: int, first: int, last: int, anchor: int, value: int) -> None:
        left = anchor - first
        string = text[anchor : last + self.length] + text[first:anchor][::-1] + left.to_bytes(2, "big")
        items = self.items.setdefault(value % self.buckets, {})
        here = (doc, version, first)
        known = items.setdefault(string, here)
        if known is here:
            self.size += len(string) + 100
            return
        if here < known:
            items[string], here = here, known
        self._repeat(here, len(string) - 2)

    def add_windows(self, text: bytes, doc: int, version: int, first: int, last: int) -> None:
        for start in range(first, last + 1):
            here = (doc, version, start)
            digest = hashlib.blake2b(text[start : start + self.length], digest_size=16).digest()
            known = self.windows.setdefault(digest, here)
            if known is here:
                self.size += 150
                continue
            if here < known:
                self.windows[digest], here = here, known
            self._repeat(here, self.length)

    def _repeat(self, here: tuple, size: int) -> None:
        self.repeats.append((*here, here[2] + size))
        self.size += 50

    def rows(self) -> Iterator[pa.RecordBatch]:
        """``bucket, strings, metadata`` of the sorted strings; ``bucket, hash, place`` of windows; and spans of repeats."""
        names = ["bucket", "strings", "meta", "doc", "version", "start", "stop"]
        buckets, strings, metas = [], [], []
        for bucket, items in self.items.items():
            ordered = sorted(items)
            buckets.append(bucket)
            strings.append(front_coded(ordered))
            metas.append(np.array([(*items[s], int.from_bytes(s[-2:], "big")) for s in ordered], _META).tobytes())
        if buckets:
            none = pa.nulls(len(buckets), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(strings, pa.binary()), pa.array(metas, pa.binary()), none, none, none, none], names=names)
        if self.windows:
            places = (pa.array(x, pa.int64()) for x in zip(*self.windows.values(), strict=True))
            digests = list(self.windows)
            dealt = pa.array([int.from_bytes(d[:8], "little") % self.buckets for d in digests], pa.int32())
            n = len(digests)
            yield pa.RecordBatch.from_arrays([dealt, pa.nulls(n, pa.binary()), pa.array(digests, pa.binary()), *places, pa.nulls(n, pa.int64())], names=names)
        if self.repeats:
            found = _joined(self.repeats)
            n = found.shape[1]
            dealt = pa.array((np.arange(n) % self.buckets).astype(np.int32))
            yield pa.RecordBatch.from_arrays([dealt, pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), *(pa.array(x) for x in found)], names=names)


def _joined(spans: list[tuple]) -> np.ndarray:
    """Spans ``(doc, version, start, stop)`` with those of a document that touch made one."""
    if not spans:
        return np.zeros((4, 0), np.int64)
    table = np.array(spans, np.int64).T
    doc, version, start, stop = table[:, np.lexsort(table[::-1])]
    # ascending starts within a document: a span begins anew where it starts behind all before it
    new = np.ones(len(doc), bool)
    group = np.concatenate([[0], np.cumsum((doc[1:] != doc[:-1]) | (version[1:] != version[:-1]))])
    reach = np.maximum.accumulate(stop + group * (1 << 40))
    new[1:] = start[1:] + group[1:] * (1 << 40) > reach[:-1]
    at = np.flatnonzero(new)
    return np.array([doc[at], version[at], start[at], np.maximum.reduceat(stop, at)])


def _runs(rows: DataFrame, suspects: DataFrame, buckets: int, hots: np.ndarray, length: int, gram: int, run_bytes: int) -> DataFrame:
    """``bucket, strings, meta, doc, version, start, stop``: runs, windows of hot anchors, and spans that need no merge."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _Run(buckets, length)
        for batch in batches:
            doc, version = (batch.column(c).to_numpy() for c in (0, 1))
            lists = batch.column(3)
            for row0, raw, offsets in blocks(batch.column(2)):
                for row, first, last, anchor, value in segments(raw, offsets, length, gram):
                    bounds = np.searchsorted(row, np.arange(len(offsets)))
                    for r in np.unique(row).tolist():
                        lo, hi, base = bounds[r], bounds[r + 1], offsets[r]
                        at = lo + np.flatnonzero(np.isin(first[lo:hi] - base, lists[row0 + r].values.to_numpy(zero_copy_only=False)))
                        text = raw[base : offsets[r + 1]].tobytes()
                        d, v = int(doc[row0 + r]), int(version[row0 + r])
                        for some in np.split(at, range(ASKED, len(at), ASKED)):
                            hot = np.isin(value[some].view(np.int64), hots, assume_unique=False).tolist()
                            for a, b, c, g, many in zip((first[some] - base).tolist(), (last[some] - base).tolist(), (anchor[some] - base).tolist(), value[some].tolist(), hot, strict=True):
                                if many:
                                    run.add_windows(text, d, v, a, b)
                                else:
                                    run.add(text, d, v, a, b, c, g)
                                if run.size >= run_bytes:
                                    yield from run.rows()
                                    run = _Run(buckets, length)
        yield from run.rows()

    joined = rows.join(suspects.filter("starts IS NOT NULL").select("doc", "version", "starts"), ["doc", "version"]).select("doc", "version", "text", "starts")
    return joined.mapInArrow(make, "bucket int, strings binary, meta binary, doc long, version long, start long, stop long")


def _merge(runs: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """``doc, version, start, stop`` of all repeats."""

    def merge_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes]] = []
        windows: dict[bytes, tuple] = {}
        last = None
        for batch in batches:
            coded, meta, stop = (batch.column(c) for c in (1, 2, 6))
            spans = batch.select([3, 4, 5, 6]).filter(stop.is_valid())
            if spans.num_rows:
                yield spans
            rest = batch.filter(meta.is_valid())
            out: list[tuple] = []
            for bucket, strings, meta_, *here in zip(*(rest.column(c).to_pylist() for c in range(6)), strict=True):
                if bucket != last:
                    yield from _resolved(held, length, gram)
                    held, windows, last = [], {}, bucket
                if strings is not None:
                    held.append((strings, meta_))
                    continue
                place = tuple(here)
                known = windows.setdefault(meta_, place)
                if known is not place:
                    if place < known:
                        windows[meta_], place = place, known
                    out.append((*place, place[2] + length))
            if out:
                yield _spans(out)
        yield from _resolved(held, length, gram)

    return runs.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(merge_all, "doc long, version long, start long, stop long")


def _resolved(runs: list[tuple[bytes, bytes]], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Spans of the repeats among the strings of a bucket's runs."""
    if not runs:
        return
    metas = [np.frombuffer(m, _META) for _, m in runs]
    columns = [tuple(m[c].tolist() for c in _META.names) for m in metas]
    out: list[tuple] = []
    group: list[list] = []  # [string, bytes left of the anchor, place, prefix shared with the one before] of one anchor
    for s, shared, run, place in merged([r for r, _ in runs]):
        docs, versions, starts, lefts = columns[run]
        here = (docs[place], versions[place], starts[place])
        if shared < gram:
            _compare(group, length, out)
            group = []
        elif shared == len(s) == len(group[-1][0]):  # equal strings come one after the other
            same = group[-1]
            earlier, later = (same[2], here) if same[2] < here else (here, same[2])
            same[2] = earlier
            out.append((*later, later[2] + len(s) - 2))
            continue
        group.append([s, lefts[place], here, shared])
        if len(out) >= 200_000:
            yield _spans(out)
            out = []
    _compare(group, length, out)
    yield _spans(out)


def _spans(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in _joined(out)], names=["doc", "version", "start", "stop"])


#: Groups up to this size are compared pair by pair.
PAIRS = 6


def _compare(group: list[list], length: int, out: list[tuple]) -> None:
    """Windows that different strings of one anchor have in common: all but the first of equal ones are repeats.

    A window that begins ``back`` bytes before the anchor is equal in two strings if they agree in ``length - back`` bytes
    from the anchor on, which the merge knows, and in ``back`` bytes before it."""
    if len(group) < 2:
        return
    rights = [len(s) - 2 - left for s, left, _, _ in group]
    lefts = [s[right:-2] for (s, _, _, _), right in zip(group, rights, strict=True)]
    places = [(doc, version, start + left) for _, left, (doc, version, start), _ in group]  # of the anchor
    if len(group) <= PAIRS:
        for i in range(len(group)):
            right = length
            for j in range(i + 1, len(group)):
                right = min(right, group[j][3])
                if right + len(lefts[i]) < length:
                    break
                least = length - min(right, rights[i], rights[j])
                most = common_prefix(lefts[i], lefts[j])
                if least <= most:
                    doc, version, anchor = max(places[i], places[j])
                    out.append((doc, version, anchor - most, anchor - least + length))
        return
    # the same for many: strings with equal numbers at a distance agree on that side
    order = sorted(range(len(group)), key=lefts.__getitem__)
    common = np.array([0, *(common_prefix(lefts[a], lefts[b]) for a, b in zip(order[:-1], order[1:], strict=True))])
    shared, n_left, n_right = np.array([g[3] for g in group]), np.array([len(x) for x in lefts]), np.array(rights)
    rank = np.argsort(np.array(sorted(range(len(group)), key=places.__getitem__)))
    for back in range(int(n_left.max()) + 1):
        to_right = np.cumsum(shared < length - back)
        to_left = np.empty(len(group), np.int64)
        to_left[order] = np.cumsum(common < back)
        have = np.flatnonzero((n_left >= back) & (n_right >= length - back))
        if len(have) < 2:
            continue
        keys = (to_right * (len(group) + 1) + to_left)[have]
        by_place = np.argsort(rank[have])
        _, first = np.unique(keys[by_place], return_index=True)
        later = np.ones(len(have), bool)
        later[by_place[first]] = False
        for k in have[later].tolist():
            doc, version, anchor = places[k]
            out.append((doc, version, anchor - back, anchor - back + length))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT, run_bytes: int = RUN_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, spans, kept``; ``spans`` are the maximal
    removed runs of bytes, ``kept`` the other bytes."""
    rows = _keyed(docs, id_col, text_col)
    firsts, copied = _copies(rows)
    asked = _suspects(rows, length, gram, hot).join(firsts.withColumn("is_first", F.lit(True)), ["doc", "version"], "left")
    suspects = checkpointed(asked.select("doc", "version", F.when(F.col("is_first"), F.col("starts")).alias("starts"), "hots").filter("starts IS NOT NULL OR size(hots) > 0"))
    # the numbers of suffixes decide on the number of buckets; the hot anchors are at most HOT_ANCHORS pairs of integers
    hots = suspects.select(F.explode("hots").alias("x")).select("x.*").groupBy("value").agg(F.max("total").alias("total")).orderBy(F.desc("total"), "value").limit(HOT_ANCHORS).collect()
    n = suspects.filter("starts IS NOT NULL").agg(F.sum(F.size("starts"))).first()[0] or 0
    n_bytes = n * SUFFIX_BYTES + sum(h.total for h in hots) * (length - gram + 1) * WINDOW_BYTES
    buckets = max(shuffle_partitions(docs.sparkSession), -(-n_bytes // bucket_bytes))
    values = np.array([h.value for h in hots], np.int64)
    found = _merge(_runs(rows, suspects, buckets, values, length, gram, run_bytes), buckets, length, gram)
    found = found.unionByName(copied.filter(F.col("stop") >= length))
    spans = found.groupBy("doc", "version").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given: list[list[tuple]] = [[(x["start"], x["stop"]) for x in found or ()] for found in batch.column(3).to_pylist()]
            for row0, raw, offsets in blocks(batch.column(2)):
                for lo, hi in periodic(raw, offsets, length).tolist():
                    row = int(np.searchsorted(offsets, lo, "right")) - 1
                    given[row0 + row].append((lo - int(offsets[row]), hi - int(offsets[row]) + length))
            doc, sizes, removed, counts, lists, kept = ([] for _ in range(6))
            for d, text, spans_ in zip(batch.column(0).to_pylist(), batch.column(2), given, strict=True):
                raw = text.as_py().encode()
                runs, out, at = [], [], 0
                for x in sorted(spans_):
                    if runs and x[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], x[1])
                    else:
                        runs.append(list(x))
                for a, b in runs:
                    out.append(raw[at:a])
                    at = b
                out.append(raw[at:])
                doc.append(None if d == NO_ID else d)
                sizes.append(len(raw))
                removed.append(sum(b - a for a, b in runs))
                counts.append(len(runs))
                lists.append([{"start": a, "stop": b} for a, b in runs])
                kept.append(b"".join(out))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (doc, sizes, removed, counts)), pa.array(lists, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    joined = rows.join(spans, ["doc", "version"], "left").select("doc", "version", "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:bigint,stop:bigint>>, kept binary")
