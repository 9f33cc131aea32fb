"""Fingerprints of files, and their join with a knowledge base.

The join with a local knowledge base is an extension: the matching service of the original is remote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylens.functions import udfs
from quarrylens.functions.columns import opposite_eol_md5
from quarrylens.functions.fixed_values import MAX_POST_BYTES
from quarrylens.operators.filters import snippets_made


def fingerprints(files: DataFrame) -> DataFrame:
    """``path, line, ord, hash``: winnowing of every file that snippets are made for; narrow, one Arrow pass."""
    made = files.filter(snippets_made(F.col("path"), F.col("text"))).select("path", F.explode(udfs.winnow(F.encode("text", "UTF-8"))).alias("x"))
    return made.select("path", F.col("x.line").alias("line"), F.posexplode("x.hashes").alias("ord", "bits")).select("path", "line", "ord", udfs.hex8(F.col("bits")).alias("hash"))


def _within(lines: Column, head: Column, max_bytes: int) -> Column:
    """The lines (structs with ``text``) that are sent under a size limit, see :func:`.batching.capped_lines`."""
    n = F.size(lines)

    def step(a: Column, x: Column) -> Column:
        at = a["n"] + 1
        total = a["total"] + F.octet_length(x["text"])
        fits = ~a["full"] & F.when(at == n, total < max_bytes).otherwise(total <= max_bytes)
        return F.struct(at.alias("n"), F.when(fits, total + 1).otherwise(a["total"]).cast("long").alias("total"), (~fits).alias("full"), (a["kept"] + fits.cast("int")).alias("kept"))

    start = F.struct(F.lit(0).alias("n"), F.octet_length(head).cast("long").alias("total"), F.lit(False).alias("full"), F.lit(0).alias("kept"))
    return F.slice(lines, 1, F.aggregate(lines, start, step, lambda a: a["kept"]))


def wfp_blocks(
    files: DataFrame, hpsm: bool = False, strip_hpsm: tuple[str, ...] = (), strip_snippets: tuple[str, ...] = (), max_bytes: int | None = None,
    skip_headers: bool = False, header_limit: int = 0, skip_snippets: bool = False, all_extensions: bool = False, binary: Column | None = None,
) -> DataFrame:
    """``path, wfp``: the fingerprint text of each file.

    Its lines: ``file=`` with MD5, size and name; ``fh2=`` with the MD5 of the content with the other kind of line ends, if it
    has any and isn't ``binary``; where snippets are made, ``hpsm=`` on request, and the hashes of each line that has some. With
    ``max_bytes`` lines are sent as long as the text stays within it. With ``skip_headers`` the lines of a file's header go, and
    ``start_line=`` says so; at last the hashes of ``strip_snippets`` go."""
    is_binary = F.lit(False) if binary is None else F.coalesce(binary, F.lit(False))
    made = F.lit(False) if skip_snippets else snippets_made(F.col("path"), F.col("text"), all_extensions) & ~is_binary
    content = F.encode("text", "UTF-8")
    rows = files.select(
        "path", udfs.shown_name("path").alias("shown"), "text", made.alias("made"), is_binary.alias("is_binary"), udfs.winnow(F.when(made, content)).alias("snippets"),
        (udfs.hpsm(F.when(made, content)) if hpsm else F.lit(None).cast("string")).alias("hpsm"), (udfs.header_offset("path", "text") if skip_headers else F.lit(0)).alias("offset"),
    )
    if header_limit > 0:
        rows = rows.withColumn("offset", F.least("offset", F.lit(header_limit)))
    if hpsm and strip_hpsm:
        rows = rows.withColumn("hpsm", udfs.stripped_hpsm("hpsm", F.array(*map(F.lit, strip_hpsm))))
    fh2 = opposite_eol_md5(F.col("text"), F.col("is_binary"))
    tag = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}="), value, F.lit("\n")), F.lit(""))
    head = F.concat(F.lit("file="), F.md5("text"), F.lit(","), F.octet_length("text").cast("string"), F.lit(","), "shown", F.lit("\n"), tag("fh2", fh2), tag("hpsm", F.when(F.col("hpsm") != "", F.col("hpsm"))))
    text = lambda s: F.concat(s["line"].cast("string"), F.lit("="), F.array_join(F.transform(s["hashes"], udfs.hex8), ","))
    rows = rows.withColumn("head", head).withColumn("lines", F.transform("snippets", lambda s: F.struct(s["line"].alias("line"), text(s).alias("text"))))
    if max_bytes is not None:
        rows = rows.withColumn("lines", _within(F.col("lines"), F.col("head"), max_bytes))
    texts = lambda lines: F.array_join(F.transform(lines, lambda x: F.concat(x["text"], F.lit("\n"))), "")
    body = texts(F.col("lines"))
    if skip_headers:
        after = F.filter("lines", lambda x: x["line"] > F.col("offset"))
        started = F.when(F.size(after) > 0, F.concat(F.lit("start_line="), F.col("offset").cast("string"), F.lit("\n"), texts(after))).otherwise("")
        body = F.when(F.col("made") & (F.col("offset") > 0), started).otherwise(body)
    wfp = F.concat("head", body)
    if strip_snippets:
        # only where lines of hashes stand: a file without snippets is sent as it is
        wfp = F.when(F.col("made"), udfs.stripped_snippets(wfp, F.array(*map(F.lit, strip_snippets)))).otherwise(wfp)
    return rows.select("path", wfp.alias("wfp"))


def capped_blocks(files: DataFrame, max_bytes: int = MAX_POST_BYTES, **options) -> DataFrame:
    """Fingerprint texts of at most about ``max_bytes``."""
    return wfp_blocks(files, max_bytes=max_bytes, **options)


#: Rows of one hash that go to one task.
HASH_ROWS = 10_000


def _met(ours: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``ours`` (``path, hash``, ...) and of ``known`` (``kb_path, hash``, ...) with one hash; the files of a hash that very many share are dealt to several tasks."""
    # hashes of the base alone are counted, and only those that are common are salted
    common = ours.join(known.select("hash").distinct(), "hash", "left_semi").groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    common = common.select("hash", F.ceil(F.col("n") / HASH_ROWS).cast("int").alias("salts"))
    entries = known.join(common, "hash").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    dealt = ours.join(common, "hash").withColumn("salt", F.pmod(F.xxhash64("path"), F.col("salts")).cast("int")).drop("salts")
    return dealt.join(entries, ["hash", "salt"]).drop("salt")


def knowledge_hits(found: DataFrame, base: DataFrame, min_hits: int = 1) -> DataFrame:
    """``path, kb_path, hits, first_line, last_line``: files that share fingerprints with entries of ``base``
    (``hash, kb_path``). Both sides are reduced to distinct hashes first, so a hash that is common in one file is one row; the files of a
    hash that very many share are dealt to several tasks."""
    ours = found.groupBy("path", "hash").agg(F.min("line").alias("first_line"), F.max("line").alias("last_line"))
    known = base.select("hash", "kb_path").distinct()
    hits = _met(ours, known).groupBy("path", "kb_path").agg(F.count(F.lit(1)).alias("hits"), F.min("first_line").alias("first_line"), F.max("last_line").alias("last_line"))
    return hits.filter(F.col("hits") >= min_hits)


#: Lines between two hits of one range at most, and how many entries of the base a file keeps.
LINE_GAP, BEST = 8, 3


def line_matches(found: DataFrame, base: DataFrame, n_lines: DataFrame, min_hits: int = 1, min_lines: int = 1, gap: int = LINE_GAP, best: int | None = BEST) -> DataFrame:
    """``path, kb_path, hits, lines, oss_lines, matched, rank``: which lines of a file are like which of an entry of a local base.

    ``found`` has ``path, line, hash``, ``base`` has ``kb_path, line, hash``, ``n_lines`` the number of lines of each ``path``. A hash that stands several
    times in both files pairs its first place with the first one, and so on, and the rest with the last one, so hits grow with the file and not with products
    of repeated lines. Hits with one difference of lines that are at most ``gap`` lines apart make a range (gaps and islands); ranges with at least ``min_hits`` hits
    and ``min_lines`` lines stay. ``lines`` are the file's ranges, joined where they overlap or touch; ``oss_lines`` those of the entry, both as ``first-last`` in rising order; ``matched``
    is the share of the file's lines in whole percent. Of each file the ``best`` entries by hits, lines and name stay (None: all)."""
    ours = found.select("path", "line", "hash").distinct().groupBy("path", "hash").agg(F.sort_array(F.collect_list("line")).alias("at"))
    known = base.select("kb_path", "line", "hash").distinct().groupBy("kb_path", "hash").agg(F.sort_array(F.collect_list("line")).alias("there"))
    place = F.transform("at", lambda line, k: F.struct(line.alias("line"), F.element_at("there", F.least(k + 1, F.size("there"))).alias("oss_line")))
    hits = _met(ours, known).select("path", "kb_path", "hash", F.explode(place).alias("x")).select("path", "kb_path", "hash", "x.*")
    hits = hits.withColumn("apart", F.col("oss_line") - F.col("line"))
    diagonal = Window.partitionBy("path", "kb_path", "apart").orderBy("line", "hash")
    fresh = F.coalesce(F.col("line") - F.lag("line").over(diagonal) > gap, F.lit(True)).cast("int")
    islands = hits.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(diagonal.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ranges = islands.groupBy("path", "kb_path", "apart", "island").agg(F.count(F.lit(1)).alias("hits"), F.min("line").alias("first"), F.max("line").alias("last"))
    ranges = ranges.filter((F.col("hits") >= min_hits) & (F.col("last") - F.col("first") + 1 >= min_lines))
    theirs = F.sort_array(F.collect_set(F.struct((F.col("first") + F.col("apart")).alias("first"), (F.col("last") + F.col("apart")).alias("last"))))
    shown = lambda r: F.array_join(F.transform(r, lambda x: F.concat(x["first"].cast("string"), F.lit("-"), x["last"].cast("string"))), ",")
    entries = ranges.groupBy("path", "kb_path").agg(F.sum("hits").alias("hits"), shown(theirs).alias("oss_lines"))
    # ranges of several differences may overlap
    order = Window.partitionBy("path", "kb_path").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = ranges.withColumn("fresh", F.coalesce(F.col("first") > reached + 1, F.lit(True)).cast("int")).withColumn("joint", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joint = apart.groupBy("path", "kb_path", "joint").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    covered = joint.groupBy("path", "kb_path").agg(F.sum(F.col("last") - F.col("first") + 1).alias("n"), shown(F.sort_array(F.collect_list(F.struct("first", "last")))).alias("lines"))
    rows = entries.join(covered, ["path", "kb_path"]).join(n_lines.select("path", "n_lines"), "path")
    rank = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("hits"), F.desc("n"), "kb_path"))
    rows = rows.withColumn("rank", rank) if best is None else rows.withColumn("rank", rank).filter(F.col("rank") <= best)
    return rows.select("path", "kb_path", "hits", "lines", "oss_lines", F.concat(F.floor(100 * F.col("n") / F.col("n_lines")).cast("string"), F.lit("%")).alias("matched"), "rank")
