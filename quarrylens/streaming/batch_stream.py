"""Batches of files as they arrive (an extension: the original batches a finished list).

Files of one ``scan`` are batched in the order in which they arrive, in a micro-batch by ``file_ord``, by the rules of :func:`.batching.cut`. The state of a scan is its open
batch: at most ``max_files + 1`` files, so it stays small however long a stream runs. A batch is given out once it ends; where no file arrives for ``idle_ms``, a timer ends it. State and timers
live in the stream's checkpoint, so a restarted stream goes on with the batch that was open. Scans are keys of their own and run side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quarrylens.functions.fixed_values import MAX_POST_BYTES, POST_FILES

BATCHES = "scan string, batch_id long, n_files int, n_bytes long, context string, files array<long>"
_OPEN = "batch_id long, n_bytes long, context string, files array<long>"
#: What a session needs for state of this kind.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Batcher(StatefulProcessor):
    """Cuts the files of a scan; gives out batches that have ended."""

    def __init__(self, max_bytes: int = MAX_POST_BYTES, max_files: int = POST_FILES, idle_ms: int | None = None):
        self.max_bytes, self.max_files, self.idle_ms = max_bytes, max_files, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _OPEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows)).sort_values(["file_ord", "size"], kind="stable")
        number, total, context, files = self.open.get() if self.open.exists() else (0, 0, None, [])
        files, ended = list(files), []

        def end() -> None:
            nonlocal number, total, files
            ended.append((key[0], number, len(files), total, context, files))
            number, total, files = number + 1, 0, []

        for file_ord, size, here in arrived[["file_ord", "size", "context"]].itertuples(index=False):
            here = None if pd.isna(here) else here
            if files and (here != context or total + size >= self.max_bytes):
                end()
            context = here
            total, files = total + int(size), [*files, int(file_ord)]
            if len(files) > self.max_files or total >= self.max_bytes:
                end()
        self.open.update((number, total, context, files))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if files:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield pd.DataFrame(ended, columns=[c.split()[0] for c in BATCHES.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, total, context, files = self.open.get()
        rows = [(key[0], number, len(files), total, context, list(files))] if files else []
        if files:
            self.open.update((number + 1, 0, context, []))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in BATCHES.split(", ")])

    def close(self) -> None:
        pass


def batches(files: DataFrame, max_bytes: int = MAX_POST_BYTES, max_files: int = POST_FILES, idle_ms: int | None = None) -> DataFrame:
    """``scan, batch_id, n_files, n_bytes, context, files`` of the batches that end, of a stream of ``scan, file_ord, size, context``."""
    rows = files.selectExpr("cast(scan as string) AS scan", "cast(file_ord as long) AS file_ord", "cast(size as long) AS size", "cast(context as string) AS context")
    return rows.groupBy("scan").transformWithStateInPandas(Batcher(max_bytes, max_files, idle_ms), BATCHES, outputMode="append", timeMode="None" if idle_ms is None else "ProcessingTime")


def start(files: DataFrame, output: str, checkpoint: str, max_bytes: int = MAX_POST_BYTES, max_files: int = POST_FILES) -> StreamingQuery:
    """Append the batches that end to Parquet, for what is there now; a later start goes on from the checkpoint. There is no timer: a stream that only takes what is there has no idle time."""
    return batches(files, max_bytes, max_files).writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
