"""Sharding by a two-pass external shuffle.

The records of a table come into one random order, which is cut into shards of equal counts (at most one apart).

1. Scatter: a seeded hash of a record's id and text deals it to one of as many buckets as the table has ``bucket_bytes``, so a bucket fits
   into a task's memory whatever the size of the table. A first pass over ids and texts counts the buckets' records and bytes. Buckets
   with over four times the bytes meant (equal records repeated very often, or very large ones) are dealt once more, by where
   a record lies in its input split. There are fewer of them than a quarter of the buckets, 16 bytes each, so they are broadcast.
2. Each bucket, alone in a task, is sorted by hash, shuffled by Fisher-Yates with a seed of its own and numbered from the bucket's place in the
   order, which is the number of records in the buckets before. Only one short row per bucket meets in a task to add these up.

Ranks are cut into shards in order, so a bucket's records lie in one shard or in neighbouring ones, in order of slot: files of shards can be
written without another shuffle. For the same seed and table the order is the same however the table is split and read, but
for records that are dealt once more and for ties of id and text.

Defined results: a null text has no bytes; null and repeated ids and repeated rows are records as others; with fewer records than shards some
shards are empty; an empty table gives an empty table. All columns are carried along in a struct, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.llm.common import checkpointed, scratch_folder, text_of, written

SHARDS, SEED, BUCKET_BYTES, RECORD_BYTES = 40, 17, 16 << 20, 16
#: Buckets with over so many times the bytes meant are dealt once more.
HEAVY = 4


def shard_of(rank: np.ndarray, n: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each rank from 0 to ``n - 1``, and its place there."""
    shard = rank * shards // n
    return shard, rank - -(-shard * n // shards)


def shuffled(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``row, shard, slot``: each record of ``df`` as a struct, with its shard and its place there."""
    text = text_of(df, text_col)
    place = F.xxhash64(F.lit(seed), df[id_col], text)
    size = F.octet_length(text) + F.lit(RECORD_BYTES)
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))

    records = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), place.alias("place"), size.cast("long").alias("size"))
    # the bucket comes from a second hash of the place, so that the places of a bucket are spread over all values
    records = records.withColumn("bucket", F.pmod(F.xxhash64("place"), F.lit(buckets)))
    counted = checkpointed(records.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")))
    records = records.drop("size")
    heavy = counted.filter(F.col("bytes") > HEAVY * bucket_bytes).select("bucket")
    if not heavy.isEmpty():
        # where a record lies is looked at once, and what follows from it is kept
        again = records.join(F.broadcast(heavy), "bucket", "left_semi").withColumn("at", F.monotonically_increasing_id())
        again = again.withColumn("bucket", F.pmod(F.xxhash64("place", "at"), F.lit(buckets))).drop("at")
        again = written(again, scratch_folder(df.sparkSession, "sharding"))
        records = records.join(F.broadcast(heavy), "bucket", "left_anti").unionByName(again)
        counts = counted.join(F.broadcast(heavy), "bucket", "left_anti").select("bucket", "n").unionByName(again.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
        counted = checkpointed(counts.groupBy("bucket").agg(F.sum("n").alias("n")))
    n = counted.agg(F.sum("n")).first()[0] or 0
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = counted.select("bucket", F.coalesce(before, F.lit(0)).cast("long").alias("start"))
    schema = T.StructType([records.schema["row"], T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def permuted(bucket: pa.Table, start: pa.Table) -> pa.Table:
        order = np.argsort(bucket.column("place").to_numpy(), kind="stable")
        np.random.default_rng([seed, start.column("bucket")[0].as_py()]).shuffle(order)  # Fisher-Yates
        shard, slot = shard_of(start.column("start")[0].as_py() + np.arange(len(order)), n, shards)
        return pa.table([bucket.column("row").take(pa.array(order)), pa.array(shard, pa.int32()), pa.array(slot, pa.int64())], names=schema.names)

    return records.groupBy("bucket").cogroup(starts.groupBy("bucket")).applyInArrow(permuted, schema)


def digests(docs: DataFrame, **options) -> DataFrame:
    """Size, checksum, shard and slot of every document; shards have equal numbers of rows."""
    out = shuffled(docs.select("doc_id", "text"), **options)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    size = (F.octet_length(text) + RECORD_BYTES).cast("long")
    return out.select(F.col("row.doc_id").alias("doc_id"), size.alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(df: DataFrame, path: str, **options) -> None:
    """The records as a folder of Parquet files for each shard, with their slots; in each file slots rise."""
    out = shuffled(df, **options)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
