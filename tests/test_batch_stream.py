"""Batches of a stream are those of one sequential run, also after a restart."""

import random
import time

from quarrylens.operators import batching
from quarrylens.streaming import batch_stream

LIMITS = {"max_bytes": 1000, "max_files": 5}


def made(rows):
    """Batches of one sequential run: files, bytes and context."""
    numbers = batching.cut([r[1] for r in rows], [r[2] for r in rows], **LIMITS)
    out = {}
    for number, (file_ord, size, context) in zip(numbers, rows, strict=True):
        b = out.setdefault(number, [[], 0, context])
        b[0].append(file_ord)
        b[1] += size
    return [tuple(b) for _, b in sorted(out.items())]


def test_batches_of_a_stream_with_a_restart_and_a_timer(spark, tmp_path):
    spark.conf.set(*batch_stream.STORE)
    rng = random.Random(1)
    scans = {s: [(k, rng.choice([0, 50, 150, 400, 1200]), rng.choice(["a", "a", "a", "b", None])) for k in range(60)] for s in ("x", "y")}
    schema = "scan string, file_ord long, size long, context string"
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    def arrive(part):
        rows = [(s, *r) for s, listed in scans.items() for r in listed[part * 15 : part * 15 + 15]]
        rng.shuffle(rows)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)

    for parts in ((0, 1), (2, 3)):  # two starts from one checkpoint
        for part in parts:
            arrive(part)
        batch_stream.start(stream(), str(tmp_path / "out"), str(tmp_path / "checkpoint"), **LIMITS).awaitTermination()
    found = {s: [] for s in scans}
    for r in sorted(spark.read.parquet(str(tmp_path / "out")).collect(), key=lambda r: (r.scan, r.batch_id)):
        assert r.batch_id == len(found[r.scan]) and r.n_files == len(r.files)
        found[r.scan].append((list(r.files), r.n_bytes, r.context))
    for s, rows in scans.items():
        want = made(rows)
        assert len(found[s]) in (len(want), len(want) - 1) and found[s] == want[: len(found[s])]  # the last one may be open still

    query = batch_stream.batches(stream(), **LIMITS, idle_ms=300).writeStream.format("memory").queryName("ended").option("checkpointLocation", str(tmp_path / "timed")).outputMode("append").trigger(processingTime="300 milliseconds").start()
    try:
        until = time.time() + 90
        total = lambda: sum(r.n_files for r in spark.table("ended").collect())
        while time.time() < until and total() < 120:
            time.sleep(0.5)
        assert total() == 120  # the timer has ended the open batches
    finally:
        query.stop()
