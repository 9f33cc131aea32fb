"""Cutting fingerprints into batches to send: one greedy run over all files, done in parallel.

A batch ends before a file that needs another context or would make it too large, and after a file that
makes it too large or too long. So where a batch ends depends only on where it begins, and a batch has at most
``max_files + 1`` files. Files are numbered and dealt to lanes of equal length, each with as many of the next lane's files as
its last batch can reach. A lane answers for each place where its first batch can begin (one of ``max_files + 1``) how many
batches begin in it and where the next lane's first batch begins. These short answers, one row per lane, are chained in order; then
every lane cuts from its true beginning. The result is that of the sequential run.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.fixed_values import MAX_POST_BYTES, POST_FILES
from quarrylens.operators.reports import numbered
from quarrylens.session import checkpointed


def cut(sizes: list[int], contexts: list, max_bytes: int = MAX_POST_BYTES, max_files: int = POST_FILES) -> list[int]:
    """Number of the batch of each file, in one run."""
    out, number, total, count, context = [], 0, 0, 0, None
    for size, here in zip(sizes, contexts, strict=True):
        if count and (here != context or total + size >= max_bytes):
            number, total, count = number + 1, 0, 0
        context = here
        total, count = total + size, count + 1
        out.append(number)
        if count > max_files or total >= max_bytes:
            number, total, count = number + 1, 0, 0
    return out


def followers(sizes: np.ndarray, contexts: np.ndarray, max_bytes: int, max_files: int) -> np.ndarray:
    """For each file the place after the batch that begins with it."""
    n = len(sizes)
    if not n:
        return np.zeros(0, np.int64)
    sums = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(n)
    by_size = np.searchsorted(sums, sums[:-1] + max_bytes, "left") - 1
    changes = np.append(np.flatnonzero(contexts[1:] != contexts[:-1]) + 1, n)
    by_context = changes[np.searchsorted(changes, at, "right")]
    return np.maximum(at + 1, np.minimum(np.minimum(by_size, by_context), at + max_files + 1))


def batches(rows: DataFrame, lane_files: int = 10_000, max_bytes: int = MAX_POST_BYTES, max_files: int = POST_FILES) -> DataFrame:
    """``file_ord, size, context, batch_id`` in the order of ``file_ord`` (ties in the order of size and context); batches are
    numbered from 0. ``lane_files`` sets how many files a task cuts, and has no influence on the result."""
    reach = max_files + 1
    lane_files = max(lane_files, reach)
    order = ["file_ord", "size", "context"]
    placed = numbered(rows.select(*order), order, "place").withColumn("place", F.col("place") - 1)
    lane, inside = F.floor(F.col("place") / lane_files), F.col("place") % lane_files
    lanes = F.when((inside < reach) & (lane > 0), F.array(lane, lane - 1)).otherwise(F.array(lane))
    dealt = checkpointed(placed.withColumn("lane", F.explode(lanes)))

    def begun(frame: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, int]:
        frame = frame.sort_values("place", kind="stable")
        own = int((frame["place"] // lane_files == frame["lane"]).sum())
        codes = pd.factorize(frame["context"], use_na_sentinel=False)[0]
        return frame, followers(frame["size"].to_numpy(np.int64), codes, max_bytes, max_files), own

    def answers(frame: pd.DataFrame) -> pd.DataFrame:
        _, after, own = begun(frame)
        exits, counts = np.arange(own + reach + 1) - own, np.zeros(own + reach + 1, np.int64)
        for i in range(own - 1, -1, -1):
            exits[i], counts[i] = exits[after[i]], counts[after[i]] + 1
        firsts = np.minimum(np.arange(reach), own + reach)
        return pd.DataFrame({"lane": [frame["lane"].iloc[0]], "exits": [np.maximum(exits[firsts], 0).tolist()], "counts": [counts[firsts].tolist()]})

    def chained(frame: pd.DataFrame) -> pd.DataFrame:
        out, entry, before = [], 0, 0
        for number, exits, counts in frame.sort_values("lane")[["lane", "exits", "counts"]].itertuples(index=False):
            out.append((number, entry, before))
            entry, before = int(exits[entry]), before + int(counts[entry])
        return pd.DataFrame(out, columns=["lane", "entry", "before"])

    def cut_lane(frame: pd.DataFrame) -> pd.DataFrame:
        entry, before = int(frame["entry"].iloc[0]), int(frame["before"].iloc[0])
        frame, after, own = begun(frame)
        begins, at = np.zeros(len(frame), np.int64), entry
        while at < own:
            begins[at] = 1
            at = int(after[at])
        return frame.assign(batch_id=before - 1 + np.cumsum(begins)).iloc[:own][[*order, "batch_id"]]

    kind = dict(rows.select(*order).dtypes)
    answered = dealt.groupBy("lane").applyInPandas(answers, "lane long, exits array<int>, counts array<long>")
    starts = answered.groupBy().applyInPandas(chained, "lane long, entry int, before long")
    return dealt.join(starts, "lane").groupBy("lane").applyInPandas(cut_lane, ", ".join(f"{c} {kind[c]}" for c in order) + ", batch_id long")


def capped_lines(lines: DataFrame, max_bytes: int) -> DataFrame:
    """Lines of fingerprint texts that are sent under a size limit: ``path, line, size`` (bytes of a line with its end) and
    ``head`` (bytes of the text before the first line).

    A line goes if what stands before it and the line itself, without its end, have at most ``max_bytes``, and the last line of
    a text only if these are fewer; the first that doesn't go ends the text."""
    from pyspark.sql import Window

    before = Window.partitionBy("path").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.col("head") + F.sum("size").over(before) - 1
    last = F.lead("line").over(Window.partitionBy("path").orderBy("line")).isNull()
    fits = F.when(last, total < max_bytes).otherwise(total <= max_bytes)
    # sizes are positive, so totals rise: the lines that fit are those before the first that doesn't
    return lines.withColumn("fits", fits).filter("fits").drop("fits")
