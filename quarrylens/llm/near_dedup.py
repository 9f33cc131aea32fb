"""Near duplicates by MinHash: documents whose sets of word shingles are alike, as components.

1. One pass makes the shingle set of every document and its one-permutation signature with optimal
   densification, of which 16 bits of each of the ``BANDS * ROWS`` values are kept (the sketch).
   Documents with the same set become one class, named after its smallest id.
2. Every class falls into a bucket for each band of its sketch. In a bucket all others are paired
   with the smallest id, its centre: star-shaped candidates, one less than the bucket has members.
3. Candidates are confirmed on the full sets of the whole texts: 100 * intersection >= 75 * union.
   They are dealt in blocks, so that a centre's text is sent once for many pairs, and a centre of very many to many tasks.
4. A star alone would lose a link between two members of which one isn't linked to the centre. So
   buckets that hold more than one star are looked through again: pairs of
   different stars (members of the largest one meet the others only), in the first such bucket that they share, whose sketches agree as those of linked sets do
   (within five standard deviations; sets of less than 20 shingles aren't tested so). What is found there is confirmed on the full sets, inside the block,
   so that rows are made for documents and not for pairs. Buckets with up to ``BIG`` members outside their largest star are looked through in blocks.
   Larger ones (pages of one template, say, that share a few minima) come after the components of all other links, whose members count as one star
   then, and are split: a member goes to a part for each of ``GROUPS`` groups of ``TAKEN`` other
   sketch values, and parts that are still large are split once more. So members of such a bucket that have nothing else in common make no pairs, and
   rows grow with the members, not with their square. A linked pair that shares a smaller bucket too is found there; at the threshold it shares none of the 48 - t
   bands that aren't large with probability 0.763 ** (48 - t), 3e-5 for t = 10, and only then the split decides, which loses 4 % of such pairs each time.
   Parts that stay large are looked through in blocks, whatever their size.
5. Bands, sketches and splits decide nothing for good: what they leave out is looked for on the full sets of all classes. A set that is linked with one of another
   component lacks at most n - ceil(0.75 * n) of its shingles there, so it holds no more than that many that no other component has. That is counted on the shingles
   whose hash lies in the lowest ``1.6 * 0.25`` of all values; sets with more are done with. The shingles of very many sets, by a sample, count as held elsewhere
   without being looked up, which leaves more sets and none out.
6. The sets that remain are joined by their prefixes, shingles that few of them hold first: of two linked sets the shingle that comes first of those in both lies among the first
   n - ceil(0.75 * n) + 1 of the one and of the other, and as many shingles as a link needs come from there on in both. Pairs for which that holds are confirmed.
   A shingle that lies in the prefixes of many is looked through in blocks, whatever its size.
7. Components of the confirmed links give the result.

So every link counts, also of two documents that share no bucket (at the threshold two pairs in a million, of sets of 3 and 4 shingles 33).
Buckets with many members are dealt to several tasks; nothing is capped.

Defined results: a document without words has an empty set and is linked with nothing; null texts count
as empty; rows that share a doc_id count as one document when they are confirmed; rows with a null id take
the component of an equal set, or none (null, kept); repeated rows are all kept or all dropped; an empty table gives
an empty table; other columns of ``docs``, whatever their names, stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrylens.llm.common import checkpointed, documents, looked_up
from quarrylens.llm.components import components
from quarrylens.llm.shingles import WORDS, set_digest, shingle_sets, signature

PERCENT, BANDS, ROWS, BLOCK = 75, 48, 5, 256
SMALL = 20
#: Buckets with more members outside their largest star are split, by ``GROUPS`` groups of ``TAKEN`` sketch values, at most ``SPLITS`` times.
BIG, GROUPS, TAKEN, SPLITS = 4096, 6, 3, 2
SIGNATURES = "doc_id long, n_shingles long, set_hi long, set_lo long, sketch binary"
BATCH = 1000
#: Up to this many ids are sent to all tasks, so that the other texts aren't exchanged.
FEW = 100_000
#: Shingles of over a hundredth of about ``SAMPLE`` sets aren't looked up in other components, the ``FREQUENT`` most frequent ones at most.
SAMPLE, FREQUENT = 5000, 20_000


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Size, digest and sketch of the set of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                sizes, his, los, sketches = [], [], [], []
                for found in shingle_sets(part.column(1), k):
                    hi, lo = set_digest(found)
                    sizes.append(len(found))
                    his.append(hi)
                    los.append(lo)
                    sketches.append(signature(found, bands * rows).astype("<u2").tobytes() if len(found) else b"")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(his, pa.int64()), pa.array(los, pa.int64()), pa.array(sketches, pa.binary())], names=[x.split()[0] for x in SIGNATURES.split(", ")])

    return documents(docs, id_col, text_col).mapInArrow(run, SIGNATURES)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two ascending sets are alike."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _members(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """Members of the buckets with at least two: ``key, band, centre, centre_n, size, rep, n_shingles``."""
    width = 2 * rows
    keys = F.array(*[F.xxhash64(F.substring("sketch", 1 + width * b, width), F.lit(b)) for b in range(bands)])
    banded = classes.select("rep", "n_shingles", F.posexplode(keys).alias("band", "key"))
    first = banded.groupBy("key").agg(F.min(F.struct("rep", "n_shingles")).alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    first = first.select("key", F.col("first.rep").alias("centre"), F.col("first.n_shingles").alias("centre_n"), "size")
    return looked_up(banded, first, ["key"], salts=4, how="inner")


def _alike_in_size(a, b, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def least_agreement(n: np.ndarray, values: int, percent: int = PERCENT) -> np.ndarray:
    """The share of sketch values in which linked sets agree at least, where the larger one has ``n`` shingles.

    Five standard deviations below the threshold; 0 for sets of less than ``SMALL`` shingles, of which one that is hidden
    in another's range changes the share itself."""
    share = percent / 100
    return np.where(n < SMALL, 0.0, share - 5 * (share * (1 - share) / values) ** 0.5)


def _star_blocks(star: DataFrame) -> DataFrame:
    """Star pairs (a, b) as blocks of at most about ``BLOCK`` members: ``key, i, j, rep, partners``. The centre lies in each of its blocks,
    so its text is sent once for a block and a centre with very many pairs is dealt to many tasks."""
    counts = star.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = looked_up(star, counts, ["a"], how="inner")
    block = [F.lit(0).alias("j"), F.col("rep").cast("long"), F.col("partners").cast("array<bigint>")]
    members = members.select(F.col("a").alias("key"), F.pmod(F.xxhash64("b"), "blocks").cast("int").alias("i"), F.col("b").alias("rep"), F.array("a").alias("partners"))
    centres = counts.select(F.col("a").alias("key"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), F.col("a").alias("rep"), F.array().cast("array<bigint>").alias("partners"))
    return members.select("key", "i", *block).unionByName(centres.select("key", "i", *block))


def _several(label: DataFrame) -> DataFrame:
    """Buckets with several stars: ``key``, the ``largest`` star, its members and those of the others."""
    sizes = label.groupBy("key", "star").agg(F.count(F.lit(1)).alias("n"))
    several = sizes.groupBy("key").agg(F.max(F.struct("n", "star")).alias("largest"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("stars")).filter("stars > 1")
    return several.select("key", F.col("largest.star").alias("largest"), F.col("largest.n").alias("n_large"), (F.col("size") - F.col("largest.n")).alias("n_others"))


def _in_blocks(inside: DataFrame, large: Column | None = None) -> DataFrame:
    """Members of buckets with several stars, once for each pair of blocks (``key, i, j``) that they take part in.

    No two members of the bucket's largest star need be compared. The others are dealt to blocks, and so is the largest star;
    each block of others meets every other such block and every block of the largest star, so that a member of that star is sent
    as often as there are blocks of others (once, if these are few). ``large`` may name other members that need not meet each other."""
    blocks_of = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / BLOCK)).cast("int")
    inside = inside.withColumns({"n_large": blocks_of("n_large"), "n_others": blocks_of("n_others")})
    large = F.col("star") == F.col("largest") if large is None else large
    # blocks of others come first, then those of the largest star
    own = F.when(large, F.col("n_others") + F.pmod(F.xxhash64("rep"), F.col("n_large"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("n_others"))).cast("int")
    met = F.when(large, F.sequence(F.lit(0), F.col("n_others") - 1)).otherwise(F.sequence(F.lit(0), F.col("n_others") + F.col("n_large") - 1))
    inside = inside.withColumn("own", own).withColumn("other", F.explode(met))
    return inside.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other", "n_large", "n_others", "largest")


def _split(inside: DataFrame, values: int, number: int) -> DataFrame:
    """Members of large buckets, once for each part of these: those that agree in a group of sketch values. Every split has groups of its own."""
    places = np.random.default_rng(number).permutation(values)[: GROUPS * TAKEN].reshape(GROUPS, -1).tolist()
    keys = F.array(*[F.xxhash64("key", F.lit(g), *[F.substring("sketch", 1 + 2 * p, 2) for p in group]) for g, group in enumerate(places)])
    return inside.drop("largest", "n_large", "n_others").withColumn("key", F.explode(keys))


def _labelled(members: DataFrame, stars: DataFrame) -> DataFrame:
    label = members.filter("size > 2").select("key", "band", "centre", "rep", "n_shingles").join(stars, "rep", "left")
    return label.withColumn("star", F.coalesce("star", "rep"))


def _small_blocks(members: DataFrame, stars: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of the buckets with several stars by blocks, see :func:`_in_blocks`; large buckets are left out."""
    label = _labelled(members, stars)
    inside = looked_up(label, _several(label).filter(F.col("n_others") <= BIG), ["key"], salts=4, how="inner").join(classes.select("rep", "sketch"), "rep")
    return _in_blocks(inside).withColumns({"big": F.lit(0).cast("long"), "deep": F.lit(False)})


def _left_out(members: DataFrame, stars: DataFrame) -> DataFrame:
    """Keys of the buckets that :func:`_small_blocks` leaves out."""
    return _several(_labelled(members.filter(F.col("size") > BIG + 1), stars)).filter(F.col("n_others") > BIG).select("key")


def _met_blocks(members: DataFrame, stars: DataFrame, classes: DataFrame, values: int = BANDS * ROWS) -> DataFrame:
    """Members of the buckets with several stars, large ones split, by blocks, see :func:`_in_blocks`. ``deep`` tells parts of
    large buckets, and ``big`` has a bit for each band in which the member lies in a large bucket."""
    label = checkpointed(_labelled(members, stars))
    several = checkpointed(_several(label))
    big = looked_up(label, several.filter(F.col("n_others") > BIG).select("key"), ["key"], salts=4, how="inner")
    bits = big.groupBy("rep").agg(F.bit_or(F.expr("shiftleft(1L, band)")).alias("big"))
    facts = classes.select("rep", "sketch").join(bits, "rep", "left").withColumn("big", F.coalesce("big", F.lit(0)))
    inside = looked_up(label, several, ["key"], salts=4, how="inner").join(facts, "rep").withColumn("deep", F.lit(False))
    out = _in_blocks(inside.filter(F.col("n_others") <= BIG))
    for number in range(SPLITS):
        parts = checkpointed(_split(inside.filter(F.col("n_others") > BIG), values, number).withColumn("deep", F.lit(True)))
        inside = looked_up(parts, _several(parts), ["key"], salts=4, how="inner")
        out = out.unionByName(_in_blocks(inside.filter(F.col("n_others") <= BIG) if number < SPLITS - 1 else inside))
    return out


def _across_stars(blocks: DataFrame, bands: int, rows: int, percent: int) -> DataFrame:
    """Members of one bucket that belong to different stars and may be linked by their sketches: ``key, i, j``
    (the blocks of a bucket), ``rep``, and ``partners`` of larger id to compare it with (none for those that only are partners)."""
    values = bands * rows
    dealt = blocks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def partners(rows_: pa.Table) -> pa.RecordBatch | None:
        key, i, j, band, deep = (rows_.column(c)[0].as_py() for c in ("key", "i", "j", "band", "deep"))
        own_, rep, n, star, centre, big = (rows_.column(c).to_numpy() for c in ("own", "rep", "n_shingles", "star", "centre", "big"))
        sketch = np.frombuffer(b"".join(rows_.column("sketch").to_pylist()), "<u2").reshape(len(rep), values)
        left, right = np.flatnonzero(own_ == i), np.flatnonzero(own_ == j)
        found: dict[int, list[int]] = {}
        for x in left.tolist():
            y = right[rep[right] > rep[x]] if i == j else right
            y = y[(star[y] != star[x]) & (100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])) & (rep[x] != centre[y]) & (rep[y] != centre[x])]
            if not len(y):
                continue
            same = sketch[y] == sketch[x]
            near = same.mean(axis=1) >= least_agreement(np.maximum(n[y], n[x]), values, percent)
            y, same = y[near], same[near].reshape(-1, bands, rows).all(axis=2)
            if len(y):
                large = (int(big[x]) >> np.arange(bands)) & 1 == 1
                small, first = (same & ~large).any(axis=1), (same & (large if deep else ~large)).argmax(axis=1)
                y = y[(first == band) & ~small] if deep else y[first == band]
            for z in rep[y].tolist():
                found.setdefault(min(z, int(rep[x])), []).append(max(z, int(rep[x])))
                found.setdefault(max(z, int(rep[x])), [])
        if not found:
            return None
        n_found = len(found)
        return pa.RecordBatch.from_arrays([pa.array([key] * n_found, pa.int64()), pa.array([i] * n_found, pa.int32()), pa.array([j] * n_found, pa.int32()), pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))], names=["key", "i", "j", "rep", "partners"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["key", "i", "j"]):
            if (out := partners(group)) is not None:
                yield out

    return dealt.mapInArrow(run, "key long, i int, j int, rep long, partners array<bigint>")


def _frequent(texts: DataFrame, reps: DataFrame, k: int) -> np.ndarray:
    """Shingles that sets of very many components hold, by a sample, ascending."""
    sampled = F.pmod(F.xxhash64("rep"), F.lit(-(-reps.count() // SAMPLE) or 1)) == 0
    listed = _listed(texts.filter(sampled).join(reps.filter(sampled).select("rep", "star").distinct(), "rep"), k)
    held = listed.select("star", F.explode("shingles").alias("key")).groupBy("key").agg(F.count_distinct("star").alias("stars")).filter(F.col("stars") > SAMPLE // 100)
    found = held.orderBy(F.desc("stars"), "key").limit(FREQUENT).select("key").toArrow().column("key").to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


def _not_alone(texts: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """``rep, star`` of the sets of ``reps`` (``rep, star, set_hi, set_lo``) that may be linked with one of another star: so few of their
    shingles are held by their own star only. ``texts`` has ``rep, text``."""
    lowest = np.uint64(min(2**64 - 1, 2**64 * 16 * (100 - percent) // 1000))
    frequent = _frequent(texts, reps, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                sets = list(shingle_sets(part.column(4), k))
                rep, star, hi, lo = (part.column(c).to_numpy() for c in range(4))
                own = np.array([set_digest(found) == x for found, x in zip(sets, zip(hi.tolist(), lo.tolist(), strict=True), strict=True)], bool)
                low = [found[: np.searchsorted(found, lowest, "right")] if x else found[:0] for found, x in zip(sets, own.tolist(), strict=True)]
                keys, of = np.concatenate(low), np.repeat(np.arange(len(low)), [len(x) for x in low])
                if len(frequent):
                    rare = frequent[np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)] != keys
                    keys, of = keys[rare], of[rare]
                n = np.array([len(found) for found in sets])
                need = np.bincount(of, minlength=len(n)) - n + (percent * n + 99) // 100
                # 40 bits will do, as keys that fall together leave more sets; a negative key stands for a set that remains without any
                free = np.flatnonzero(own & (need <= 0))
                keys, of = np.append((keys >> np.uint64(24)).astype(np.int64), -1 - (hi[free] & 0x7FFFFFFFFFFFFFFF)), np.append(of, free)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(rep[of]), pa.array(star[of]), pa.array(need[of])], names=["key", "rep", "star", "need"])

    each = texts.join(reps, "rep").select("rep", "star", "set_hi", "set_lo", "text").mapInArrow(run, "key long, rep long, star long, need long")
    sharing = Window.partitionBy("key")
    met = each.withColumns({"low": F.min("star").over(sharing), "high": F.max("star").over(sharing)}).filter("key < 0 OR low < high")
    return met.groupBy("rep", "star", "need").agg(F.count_if(F.col("key") >= 0).alias("shared")).filter("shared >= need").select("rep", "star").distinct()


def _listed(inside: DataFrame, k: int) -> DataFrame:
    """The sets of the texts of ``rep, star, text``: ``rep, star, n, digest, shingles``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH // 10):
                part = batch.slice(at, BATCH // 10)
                sets = list(shingle_sets(part.column(2), k))
                sizes = np.array([len(found) for found in sets], np.int64)
                lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int64()), pa.array(np.concatenate(sets).view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes), pa.array([set_digest(found)[0] for found in sets], pa.int64()), lists], names=["rep", "star", "n", "digest", "shingles"])

    return inside.select("rep", "star", "text").mapInArrow(run, "rep long, star long, n long, digest long, shingles array<bigint>")


def _prefixes(listed: DataFrame, percent: int) -> DataFrame:
    """The shingles of each set by which it may meet sets of other stars: ``key, rep, star, n, left``.

    Shingles are ordered by the number of sets that hold them; those of one star only come first and make no rows. ``left`` counts the set's shingles
    from this one on."""
    sets = listed.withColumn("sid", F.xxhash64("rep", "digest"))
    each = sets.select("sid", "star", F.explode("shingles").alias("key"))
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.min("star").alias("low"), F.max("star").alias("high")).filter("low < high").select("key", "held")
    ordered = looked_up(each.select("key", "sid"), shared, ["key"], salts=4, how="inner").groupBy("sid").agg(F.sort_array(F.collect_set(F.struct("held", "key"))).alias("shared"))
    ordered = ordered.join(sets.select("sid", "rep", "star", "n").distinct(), "sid").withColumn("alone", F.col("n") - F.size("shared"))
    taken = F.expr(f"CAST(greatest(0, n - ({percent} * n + 99) div 100 + 1 - alone) AS INT)")
    placed = ordered.select("rep", "star", "n", "alone", F.posexplode(F.slice("shared", 1, taken)).alias("at", "shingle"))
    return placed.select(F.col("shingle.key").alias("key"), "rep", "star", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("left"))


def _by_prefixes(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different stars that may be linked, by a shingle in the prefixes of both: none that is linked is left out.

    The smaller set of a linked pair has the shingle in a shorter prefix (``early``), so sets that have not need not meet each other, nor need those of the largest star;
    the more numerous of these two sorts is kept apart in blocks."""
    prefixes = prefixes.withColumn("early", (100 + percent) * F.col("left") >= 2 * percent * F.col("n"))
    sizes = prefixes.groupBy("key", "star").agg(F.count(F.lit(1)).alias("n"), F.count_if("early").alias("n_early"))
    facts = sizes.groupBy("key").agg(F.max(F.struct("n", "star")).alias("largest"), F.sum("n").alias("size"), F.sum("n_early").alias("n_early"), F.count(F.lit(1)).alias("stars")).filter("stars > 1 AND n_early > 0")
    facts = facts.withColumn("by_place", F.col("n_early") < F.col("size") - F.col("largest.n"))
    n_others = F.when(F.col("by_place"), F.col("n_early")).otherwise(F.col("size") - F.col("largest.n"))
    facts = facts.select("key", "by_place", F.col("largest.star").alias("largest"), (F.col("size") - n_others).alias("n_large"), n_others.alias("n_others"))
    large = F.when(F.col("by_place"), ~F.col("early")).otherwise(F.col("star") == F.col("largest"))
    blocks = _in_blocks(looked_up(prefixes, facts, ["key"], salts=4, how="inner"), large).select("key", "i", "j", "own", "rep", "star", "n", "left")
    x = blocks.filter("own = i").drop("own")
    y = blocks.filter("own = j").drop("own").withColumnsRenamed({c: f"{c}_b" for c in ("rep", "star", "n", "left")})
    pairs = x.join(y, ["key", "i", "j"]).filter("star <> star_b AND (i < j OR rep < rep_b)").filter((100 + percent) * F.least("left", "left_b") >= percent * (F.col("n") + F.col("n_b")))
    return pairs.select(F.least("rep", "rep_b").alias("a"), F.greatest("rep", "rep_b").alias("b")).distinct()


def _links_by_prefixes(inside: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """All links (a, b) between different stars of ``inside`` (``rep, star``)."""
    few = inside.count() <= FEW
    inside = checkpointed(texts.withColumnRenamed("doc_id", "rep").join(F.broadcast(inside) if few else inside, "rep"))
    prefixes = checkpointed(_prefixes(checkpointed(_listed(inside, k)), percent))
    pairs = checkpointed(_by_prefixes(prefixes, percent))
    return checkpointed(_confirmed_in_blocks(_star_blocks(pairs), inside.select(F.col("rep").alias("doc_id"), "text"), k, percent))


def _confirmed_in_blocks(blocks: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) among the members of each block, on the full sets of its documents."""
    joined = blocks.join(texts.withColumnRenamed("doc_id", "rep"), "rep").select("key", "i", "j", "rep", "partners", "text")
    dealt = joined.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["key", "i", "j"]):
            reps = group.column("rep").to_pylist()
            sets: dict[int, list[np.ndarray]] = {}  # rows that share an id are one document: any of their texts counts
            for rep, found_set in zip(reps, shingle_sets(group.column("text").combine_chunks(), k), strict=True):
                sets.setdefault(rep, []).append(found_set)
            wanted = {(a, b) for a, partners in zip(reps, group.column("partners").to_pylist(), strict=True) for b in partners}
            found = [(a, b) for a, b in wanted if any(linked(x, y, percent) for x in sets[a] for y in sets[b])]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with the same keys, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if held and a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a step go once its table is written, not when the driver's garbage is collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row."""
    texts = documents(docs, id_col, text_col)
    with _shuffles_freed(docs.sparkSession):
        signed = checkpointed(signatures(docs, id_col, text_col, k, bands, rows))
        classes = signed.filter("n_shingles > 0").groupBy("set_hi", "set_lo", "n_shingles", "sketch").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        known = classes.filter("rep IS NOT NULL")
        members = checkpointed(_members(known, bands, rows))
        star = members.filter(F.col("rep") != F.col("centre")).filter(_alike_in_size(F.col("centre_n"), F.col("n_shingles"), percent)).select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
        # b is linked with its centre a; the pairs come out as (b, a)
        links = _confirmed_in_blocks(_star_blocks(star), texts, k, percent).select(F.col("b").alias("a"), F.col("a").alias("b")).distinct()
        stars = links.groupBy(F.col("b").alias("rep")).agg(F.min("a").alias("star"))
        more = _confirmed_in_blocks(_across_stars(_small_blocks(members, stars, known), bands, rows, percent), texts, k, percent)
        # one plan up to here, so that the texts are exchanged once for all joins
        found = checkpointed(links.withColumn("by_star", F.lit(True)).unionByName(more.withColumn("by_star", F.lit(False))))
        named = components(found)
        large = checkpointed(_left_out(members, found.filter("by_star").groupBy(F.col("b").alias("rep")).agg(F.min("a").alias("star"))))
        if not large.isEmpty():
            # members of large buckets are looked through in all their buckets: the first one that a pair shares may be large
            inside = checkpointed(looked_up(members, large, ["key"], salts=4, how="inner").select("rep").distinct())
            whole = named.select(F.col("node").alias("rep"), F.col("component").alias("star"))
            blocks = _met_blocks(members.join(inside, "rep", "left_semi"), whole, checkpointed(known.join(inside, "rep", "left_semi").select("rep", "sketch")), bands * rows)
            named = components(found.select("a", "b").unionByName(_confirmed_in_blocks(_across_stars(blocks, bands, rows, percent), texts, k, percent)))

        # what bands, sketches and splits left out
        reps = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_hi", "set_lo").agg(F.min("doc_id").alias("rep"))
        reps = reps.join(named.select(F.col("node").alias("rep"), F.col("component").alias("star")), "rep", "left").withColumn("star", F.coalesce("star", "rep"))
        rest = checkpointed(_not_alone(texts.withColumnRenamed("doc_id", "rep"), checkpointed(reps), k, percent))
        if not rest.isEmpty():
            exact = _links_by_prefixes(rest, texts, k, percent)
            if not exact.isEmpty():
                named = components(exact.unionByName(named.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    special = classes.select("set_hi", "set_lo", "rep", "copies").join(named.withColumnRenamed("node", "rep"), "rep", "left")
    special = special.filter("copies > 1 OR component IS NOT NULL").select("set_hi", "set_lo", F.coalesce("component", "rep").alias("component"))
    out = looked_up(signed.select("doc_id", "n_shingles", "set_hi", "set_lo"), special, ["set_hi", "set_lo"])
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which none else in their component has a smaller id."""
    dropped = near_dedup(docs, id_col, text_col).filter("NOT kept").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(dropped, id_col, "left_anti").select(*docs.columns)
