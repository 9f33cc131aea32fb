"""Token counts of the sections of a document, by offsets.

A document is encoded once, as a whole; the tokens are then given to its sections by an interval
join of character spans. A token covers the characters that its bytes touch. Sections are
half-open spans of characters; by default the lines of a text, each with its line feed.

A token that crosses a boundary goes to one section, by ``rule``: ``largest`` (the one that
shares most characters with it, the earlier one in a tie; default), ``first`` or ``last`` (the
section of its first or last character).

Defined results: a null or empty text has one empty section without tokens; a text that ends in a line
feed has no empty section after it; tokens outside all given spans are counted nowhere; a null id stays
null; repeated rows are counted once each; an empty table gives an empty table; other columns of ``docs``, whatever their
names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.llm import tokens
from quarrylens.llm.common import text_of

RULES = ("largest", "first", "last")
SCHEMA = "doc_id long, section long, start long, stop long, n_tokens long, n_crossing long"
SPANS = "array<struct<start:bigint,stop:bigint>>"
BATCH_ROWS = 20_000


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(x) for x in text.split("\n")]
    stops = np.cumsum(np.array(sizes) + 1)
    stops[-1] -= 1  # the last line has no line feed
    starts = np.concatenate([[0], stops[:-1]])
    keep = np.ones(len(stops), bool)
    keep[-1] = len(stops) == 1 or sizes[-1] > 0
    return starts[keep], stops[keep]


def token_spans(text: str, ids: list[int], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of every token, and the one after its last."""
    raw = np.frombuffer(text.encode(), np.uint8)
    char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
    stops = np.cumsum(lengths[np.array(ids, np.int64)]) if ids else np.zeros(0, np.int64)
    starts = np.concatenate([[0], stops[:-1]])[: len(stops)].astype(np.int64)
    return char_of[starts], char_of[stops - 1] + 1


def allot(first: np.ndarray, after: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str = "largest") -> tuple[np.ndarray, np.ndarray]:
    """Section of every token (-1: none) and whether it crosses a boundary.

    Sections are ordered and don't overlap."""
    if not len(first) or not len(starts):
        return np.full(len(first), -1), np.zeros(len(first), bool)
    lo = np.searchsorted(stops, first, "right")  # first section that ends behind the token's start
    hi = np.searchsorted(starts, after, "left") - 1  # last one that begins before its end
    none = lo > hi
    crossing = (hi > lo) | (~none & ((starts[np.minimum(lo, len(starts) - 1)] > first) | (stops[np.maximum(hi, 0)] < after)))
    chosen = lo.copy() if rule != "last" else hi.copy()
    if rule == "largest":
        for k in np.flatnonzero(hi > lo).tolist():
            shared = np.minimum(stops[lo[k] : hi[k] + 1], after[k]) - np.maximum(starts[lo[k] : hi[k] + 1], first[k])
            chosen[k] = lo[k] + int(np.argmax(shared))
    chosen[none] = -1
    return chosen, crossing & ~none


def section_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans_col: str | None = None, rule: str = "largest", vocabulary: str = tokens.RANKS) -> DataFrame:
    """One row per section. ``spans_col`` names ordered spans that don't overlap; without it, lines."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spans = docs[spans_col].cast(SPANS) if spans_col else F.lit(None).cast(SPANS)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"), spans.alias("spans"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.byte_tokens(vocabulary)
        for batch in batches:
            parts, size = [], 0
            for doc_id, text, given in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                text, given = text.as_py(), given.as_py()
                if given is None:
                    starts, stops = line_spans(text)
                else:
                    starts, stops = (np.array([x[k] for x in given], np.int64) for k in ("start", "stop"))
                first, after = token_spans(text, encoder.ids(text), encoder.lengths)
                section, crossing = allot(first, after, starts, stops, rule)
                n = len(starts)
                inside = section >= 0
                parts.append((np.full(n, -1 if doc_id is None else doc_id), np.full(n, doc_id is None), np.arange(n), starts, stops, np.bincount(section[inside], minlength=n), np.bincount(section[inside & crossing], minlength=n)))
                size += n
                if size >= BATCH_ROWS:
                    yield _batch(parts)
                    parts, size = [], 0
            if parts:
                yield _batch(parts)

    return rows.mapInArrow(count, SCHEMA)


def _batch(parts: list[tuple]) -> pa.RecordBatch:
    ids, no_id, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=no_id.astype(bool)), *(pa.array(x.astype(np.int64)) for x in rest)], names=[x.split()[0] for x in SCHEMA.split(", ")])
