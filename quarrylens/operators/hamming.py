"""Joins of 64-bit hashes that differ in a few bits.

Two hashes that differ in at most ``within`` bits agree in one of ``within + 1`` slices of their bits (pigeonhole), so slices are
keys of an ordinary join, and what it finds is verified by counting bits. A pair is given for the first slice in which it agrees only. Slices that very
many hashes share (``HOT_PAIRS`` pairs or more) are split: the bits outside of the slice differ in at most ``within`` bits too, so they are cut into
``within + 1`` slices again. Distinct hashes are joined; rows that share one are not multiplied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 64
HOT_PAIRS = 1_000_000


def _bits(value: str, start: str, width: str) -> str:
    return f"(shiftrightunsigned({value}, {start}) & (shiftleft(1L, {width}) - 1))"


def _rest(value: str) -> str:
    """The bits outside of the slice ``start, width``, close together."""
    return f"(({value} & (shiftleft(1L, start) - 1)) | if(start + width >= {BITS}, 0L, shiftleft(shiftrightunsigned({value}, start + width), start)))"


def _cuts(parts: int) -> str:
    """The slices of 64 bits as an array of ``slice, start, width``."""
    widths = [BITS // parts + (k < BITS % parts) for k in range(parts)]
    return f"array({', '.join(f'named_struct({chr(39)}slice{chr(39)}, {k}, {chr(39)}start{chr(39)}, {sum(widths[:k])}, {chr(39)}width{chr(39)}, {w})' for k, w in enumerate(widths))})"


def _inner(value: str, parts: int) -> str:
    """The slices of the bits outside of the slice ``start, width``, as an array."""
    size, more = f"div({BITS} - width, {parts})", f"(({BITS} - width) % {parts})"
    return f"transform(sequence(0, {parts - 1}), j -> {_bits(_rest(value), f'cast(j * {size} + least(j, {more}) as int)', f'cast({size} + if(j < {more}, 1, 0) as int)')})"


def near_hashes(left: DataFrame, right: DataFrame | None = None, within: int = 3, by: tuple[str, ...] = (), hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``by..., hash_a, hash_b, distance``: pairs of distinct hashes (column ``hash``, a long, with equal columns ``by``) that differ in
    at most ``within`` bits; of one table alone the pairs of different hashes, the smaller one first. Nulls pair with nothing."""
    if not 1 <= within < BITS // 2:
        raise ValueError("the number of bits that may differ must be between 1 and 31")
    parts, keys = within + 1, [*by, "slice", "value"]
    sides = [df.select(*by, "hash").filter("hash IS NOT NULL").distinct() for df in ((left,) if right is None else (left, right))]
    sides = [s.withColumn("s", F.explode(F.expr(_cuts(parts)))).select(*by, "hash", "s.*").withColumn("value", F.expr(_bits("hash", "start", "width"))) for s in sides]
    sizes = [s.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"n{k}")) for k, s in enumerate(sides)]
    if right is None:
        hot = sizes[0].filter(F.col("n0") * F.col("n0") >= hot_pairs)
    else:
        hot = sizes[0].join(sizes[1], keys).filter(F.col("n0") * F.col("n1") >= hot_pairs)
    hot = hot.select(*keys, F.lit(True).alias("hot"))
    split = f"transform({_inner('hash', parts)}, (bits, k) -> named_struct('part', k, 'bits', bits))"
    dealt = [s.join(hot, keys, "left").withColumn("p", F.explode(F.expr(f"if(hot, {split}, array(named_struct('part', -1, 'bits', 0L)))"))).select(*keys, "start", "width", "hash", "p.*") for s in sides]
    a, b = dealt[0].withColumnRenamed("hash", "hash_a"), dealt[-1].withColumnRenamed("hash", "hash_b").drop("start", "width")
    pairs = a.join(b, [*keys, "part", "bits"]).withColumn("differ", F.col("hash_a").bitwiseXOR(F.col("hash_b"))).withColumn("distance", F.bit_count("differ").cast("int"))
    if right is None:
        pairs = pairs.filter("hash_a < hash_b")
    # slices are equal where no bit of them differs
    first = f"array_position(transform({_cuts(parts)}, c -> {_bits('differ', 'c.start', 'c.width')} = 0), true) - 1 = slice"
    first_part = f"(part < 0 OR array_position(transform({_inner('differ', parts)}, b -> b = 0), true) - 1 = part)"
    return pairs.filter(F.col("distance") <= within).filter(f"{first} AND {first_part}").select(*by, "hash_a", "hash_b", "distance")
