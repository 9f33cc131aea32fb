"""Sharding: the laws that hold, and the same order from a plain shuffle of each bucket."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylens.llm import queries, sharding


def laws(found, docs, shards):
    """Every record once, counts at most one apart, slots without gaps."""
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in ((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()))
    slots = defaultdict(list)
    for r in found:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(shards)]
    assert max(counts) - min(counts) <= 1


@pytest.mark.parametrize("table", ["odd", "real", "clashing"])
@pytest.mark.parametrize("bucket_bytes", [1 << 11, sharding.BUCKET_BYTES])
def test_laws(table, bucket_bytes, request):
    docs = request.getfixturevalue(table)
    laws(sharding.digests(docs, bucket_bytes=bucket_bytes).collect(), docs, sharding.SHARDS)


def test_query(spark, sf_dir, real):
    found = queries.op13_sharding(spark, sf_dir)
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    laws(found.collect(), real, 40)


def test_order_is_that_of_one_shuffle_a_bucket(spark, real):
    """Brute force: buckets by hash, each shuffled with its seed, one after the other, cut in equal parts."""
    seed, size = 3, 1 << 16
    keyed = real.select("doc_id", F.xxhash64(F.lit(seed), "doc_id", F.coalesce("text", F.lit(""))).alias("place"), (F.octet_length(F.coalesce("text", F.lit(""))) + 16).alias("size"))
    rows = keyed.withColumn("again", F.xxhash64("place")).collect()
    n_buckets = -(-sum(r["size"] for r in rows) // size)
    buckets = defaultdict(list)
    for r in rows:
        buckets[r.again % n_buckets].append(r)
    assert max(sum(r["size"] for r in b) for b in buckets.values()) <= sharding.HEAVY * size
    order = []
    for k in sorted(buckets):
        places = np.arange(len(buckets[k]))
        ids = [r.doc_id for r in sorted(buckets[k], key=lambda r: r.place)]
        np.random.default_rng([seed, k]).shuffle(places)
        order += [ids[p] for p in places]
    want = {}
    for s in range(7):
        for slot, doc in enumerate(order[-(-s * len(order) // 7) : -(-(s + 1) * len(order) // 7)]):
            want[doc] = (s, slot)
    for parts in (1, 5):
        found = sharding.shuffled(real.repartition(parts), shards=7, seed=seed, bucket_bytes=size).collect()
        assert {r["row"]["doc_id"]: (r.shard, r.slot) for r in found} == want
    other = sharding.shuffled(real, shards=7, seed=4, bucket_bytes=size).collect()
    assert {r["row"]["doc_id"]: (r.shard, r.slot) for r in other} != want


def test_equal_rows_are_dealt_once_more(spark, docs_of):
    rows = [(1, "a very common record of the table")] * 3000 + [(i, f"record {i}") for i in range(2000)] + [(None, None)] * 500
    docs = docs_of(rows).repartition(4)
    found = sharding.digests(docs, bucket_bytes=4096).collect()
    laws(found, docs, 40)
    assert len({r.shard for r in found if r.doc_id == 1}) == 40  # spread over the whole order


def test_few_and_no_records(spark, docs_of):
    assert sharding.digests(docs_of([])).count() == 0
    found = sharding.digests(docs_of([(1, "x"), (2, None), (2, None)])).collect()
    assert len({r.shard for r in found}) == 3 and {r.slot for r in found} == {0}


def test_shards_are_written(spark, clashing, tmp_path):
    sharding.write_shards(clashing, str(tmp_path / "out"), shards=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {r["row"]["doc_id"] for r in back.collect()} == {1, 2, 3} and set(back.columns) == {"row", "slot", "shard"}
