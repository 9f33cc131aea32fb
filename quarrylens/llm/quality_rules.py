"""Quality rules: distance of a text's histograms from references of its language.

Two histograms are compared with a reference of the text's language by the Jensen-Shannon distance (the root of the
divergence, base 2, 0 to 1): the classes of characters (upper case, digits, punctuation, symbols, white space, the rest) and
the common words of the language with one bin for all other words. The references are fitted (:func:`fitted`) on documents that a table of
labels calls good: those with the ``SAMPLE`` smallest ids. A language of which these have fewer than ``MIN_FITTED`` words, and every language
without labels, is compared with :func:`general` references: shares of classes in running prose, and shares of common words by Zipf's law.

A text of fewer than ``MIN_CHARS`` characters or ``MIN_WORDS`` words skips the respective comparison, because its histogram is mostly
noise; a language without a word list skips the comparison of words. Above that, the permitted divergence is larger for
shorter texts: a histogram of n items in k bins differs from its own source by about (k - 1) / (8 n ln 2), and ``NOISE`` times that is added.

Base rules: fewer than ten words, or over 20 % of the words in five-word windows that occur
again in the text. Everything is a column expression over one row: no shuffle, no Python.

Repeated windows are found on 64-bit hashes, joined from those of words by pairs. Only a text in which two windows share a hash is looked at closely:
39 bits of the hash and the position of every window are packed in a long, and sorted as primitives; windows whose hash has a
neighbour with the same bits are compared as words. In a text with more windows than ``POSITION_BITS`` bits can number, all are compared as words.

Defined results: a null or blank text has no words and fails the base rule; a null language
skips the comparison of words; every row gives one row, repeated ones too; an empty table gives an empty table; columns
of ``docs`` keep their names and values, also where they are named like those used here.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import BLANKS, free_name, text_of

MIN_WORDS_BASE, REPEAT_PERCENT, WINDOW = 10, 20, 5
MIN_CHARS, MIN_WORDS = 200, 50
#: Largest distance of classes and of words for long texts, and how many times the expected noise is permitted besides.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, NOISE = 0.2, 0.3, 2.0
#: Labelled documents that references are fitted on at most, and words of a language that these must have.
SAMPLE, MIN_FITTED = 8000, 2000
HASH_BITS, POSITION_BITS = 39, 24
COMMON_SHARE = 0.25
#: Shares of character classes in running prose.
CLASSES = {"upper": 0.015, "digit": 0.005, "punct": 0.025, "symbol": 0.0005, "space": 0.165}
#: The most common words of four languages, in falling frequency (fixed values).
COMMON = {
    "en": "the of and to a in is that it for was on with as be are",
    "fr": "de la le et les des en un du une que pour est dans qui par",
    "de": "der die und in den von zu das mit sich des auf für ist im dem",
    "es": "de la que el en y los se las del un por con una para su",
}
#: References: for a language (None: any other) the shares of classes, and of common words and all other words.
References = dict[str | None, tuple[list[float], list[float] | None]]


def general() -> References:
    """References that need no labels."""
    classes = [*CLASSES.values(), round(1 - sum(CLASSES.values()), 6)]
    out: References = {None: (classes, None)}
    for lang, listed in COMMON.items():
        n = len(listed.split())
        total = sum(1 / r for r in range(1, n + 1))
        out[lang] = classes, [*(round(COMMON_SHARE / total / r, 6) for r in range(1, n + 1)), round(1 - COMMON_SHARE, 6)]
    return out


def _divergence(counts: list[Column], total: Column, shares: list[float]) -> Column:
    """Jensen-Shannon divergence of the histogram ``counts`` from ``shares``."""
    out = F.lit(0.0)
    for count, share in zip(counts, shares, strict=True):
        p = count / total
        m = (p + share) / 2
        out = out + F.when(count > 0, p * F.log(p / m)).otherwise(0.0)
        if share > 0:
            out = out + F.lit(share) * F.log(F.lit(share) / m)
    return F.greatest(out / (2 * math.log(2)), F.lit(0.0))


def permitted(limit: float, bins: int, n: Column) -> Column:
    """Largest distance of a text with ``n`` items."""
    return F.sqrt(F.lit(limit * limit) + F.lit(NOISE * (bins - 1) / (8 * math.log(2))) / n)


def _window_hashes(words: Column) -> Column:
    """Hash of every window of five from the hashes of more than five words: of pairs, then of fours, then of fives."""
    n = F.size(words)
    joined = lambda a, i, b, k, size: F.zip_with(F.slice(a, i, size), F.slice(b, k, size), lambda x, y: F.xxhash64(x, y))
    fives = lambda pairs: joined(joined(pairs, 1, pairs, 3, n - 3), 1, words, 5, n - 4)
    return F.transform(F.array(joined(words, 1, words, 2, n - 1)), fives)[0]


def _packed(hashes: Column) -> Column:
    """Part of each hash with its position."""
    mask = F.lit((1 << HASH_BITS) - 1)
    return F.transform(hashes, lambda h, i: F.shiftleft(h.bitwiseAND(mask), POSITION_BITS).bitwiseOR(i.cast("long")))


def _doubtful(ordered: Column, n_windows: Column, position_bits: int) -> Column:
    """Positions whose part of a hash equals that of a neighbour in the ordered array; of a text with
    too many windows, all positions."""
    high = lambda i: F.shiftright(F.get(ordered, i), POSITION_BITS)
    near = F.filter(ordered, lambda x, i: (F.shiftright(x, POSITION_BITS) == F.coalesce(high(i - 1), F.lit(-1))) | (F.shiftright(x, POSITION_BITS) == F.coalesce(high(i + 1), F.lit(-1))))
    close = F.transform(near, lambda x: x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int"))
    return F.when(n_windows <= 1 << position_bits, close).otherwise(F.sequence(F.lit(0), n_windows - 1))


def _covered(starts: Column) -> Column:
    """Words under windows at the ordered starts; overlaps count once."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("at")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["at"])).cast("long").alias("n"), p.alias("at")),
        lambda a: a["n"],
    )


#: Columns of the measures and of what they are made from.
_COLUMNS = "text lang words hashes packed starts n_words word_chars n_symbols n_dup_lines n_repeat_words n_chars marked classes counts class_distance word_distance unlike".split()
#: Characters of running text that belong to none of the classes that are counted.
_PLAIN = r"[a-z\x20\x09-\x0D]++"


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with text, language, words and histograms, and the names that these have there."""
    n = {k: free_name(docs, f"q_{k}") for k in _COLUMNS}
    text, words = F.col(n["text"]), F.col(n["words"])
    df = docs.withColumn(n["text"], text_of(docs, text_col)).withColumn(n["lang"], docs[lang_col].cast("string") if lang_col in docs.columns else F.lit(None).cast("string"))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    df = df.withColumn(n["words"], F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS)))
    df = df.withColumn(n["n_words"], F.size(words).cast("long")).withColumn(n["n_chars"], F.length(text).cast("long"))
    df = df.withColumn(n["word_chars"], F.length(F.array_join(words, "")).cast("long"))
    # what is counted below is rare: most of the text goes in one pass
    df = df.withColumn(n["marked"], F.regexp_replace(text, _PLAIN, ""))
    gone = lambda pattern: (F.length(n["marked"]) - F.length(F.regexp_replace(n["marked"], pattern, ""))).cast("long")
    df = df.withColumn(n["n_symbols"], gone("[#*$%&|<>]+"))
    counted = F.array(gone(r"\p{Lu}+"), gone("[0-9]+"), gone(r"[.,;:!?'\"()-]+"), F.col(n["n_symbols"]), F.col(n["n_chars"]) - F.col(n["word_chars"]))
    df = df.withColumn(n["classes"], counted)
    common = F.filter(words, lambda w: w.isin(sorted({w for listed in COMMON.values() for w in listed.split()})))
    # bound once; each count is a loop over the few common words
    counts = F.lit(None).cast("array<long>")
    for lang, listed in COMMON.items():
        counts = F.when(F.col(n["lang"]) == lang, F.transform(F.array(common), _counts_of(listed.split()))[0]).otherwise(counts)
    return df.withColumn(n["counts"], counts), n


def _counts_of(listed: list[str]) -> Callable[[Column], Column]:
    return lambda words: F.array(*[(F.size(words) - F.size(F.array_remove(words, w))).cast("long") for w in listed])


def _with_rest(counts: str, size: int, total: str) -> list[Column]:
    """The counts of an array column, and what is left of the total."""
    each = [F.col(counts)[k].cast("double") for k in range(size)]
    rest = F.col(total).cast("double")
    for c in each:
        rest = rest - c
    return [*each, rest]


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, least: int = MIN_FITTED) -> References:
    """References from the documents that ``labels`` (``doc_id, quality``) calls good (1): those with the ``sample`` smallest ids.

    The histograms of a language are summed over its documents; a few rows of sums come back."""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("good_id")).distinct().orderBy("good_id").limit(sample)
    chosen = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"), docs[lang_col].cast("string").alias("lang"))
    chosen = chosen.join(F.broadcast(good), F.col("doc_id") == F.col("good_id"), "left_semi")  # at most ``sample`` ids
    df, n = _texts(chosen, "text", "lang")
    sums = [F.sum(F.col(n["classes"])[k]).alias(f"c{k}") for k in range(len(CLASSES))] + [F.sum(F.col(n["counts"])[k]).alias(f"w{k}") for k in range(max(len(x.split()) for x in COMMON.values()))]
    rows = df.filter(F.col(n["lang"]).isin(*COMMON)).groupBy(F.col(n["lang"]).alias("lang")).agg(F.sum(n["n_chars"]).alias("chars"), F.sum(n["n_words"]).alias("words"), *sums)
    out = general()
    for r in rows.collect():  # one row for each of the languages above
        if r.words >= least:
            share = lambda counts, total: [*(c / total for c in counts), (total - sum(counts)) / total]
            out[r.lang] = share([r[f"c{k}"] for k in range(len(CLASSES))], r.chars), share([r[f"w{k}"] for k in range(len(COMMON[r.lang].split()))], r.words)
    return out


def measured(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", references: References | None = None, position_bits: int = POSITION_BITS) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the measures of each text, and the names that these have there."""
    references = references or general()
    df, n = _texts(docs, text_col, lang_col)
    words, hashes = F.col(n["words"]), F.col(n["hashes"])
    df = df.withColumn(n["hashes"], F.when(F.size(words) > WINDOW, F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), _window_hashes)[0]))
    twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
    df = df.withColumn(n["packed"], F.when(twice, F.sort_array(_packed(hashes))))
    df = df.withColumn(n["starts"], F.when(F.col(n["packed"]).isNotNull(), _doubtful(F.col(n["packed"]), F.size(hashes), position_bits)))
    slices = F.array_sort(F.transform(F.col(n["starts"]), lambda p: F.struct(F.slice(words, p + 1, WINDOW).alias("w"), p.alias("p"))))
    df = df.withColumn(n["packed"], F.when(F.size(n["starts"]) > 0, slices))
    pairs = F.col(n["packed"])
    same = F.filter(pairs, lambda x, i: (x["w"] == F.get(pairs, i - 1)["w"]) | (x["w"] == F.get(pairs, i + 1)["w"]))
    df = df.withColumn(n["starts"], F.sort_array(F.transform(same, lambda x: x["p"])))
    lines = F.filter(F.split(F.col(n["text"]), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn(n["n_dup_lines"], F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long"))
    df = df.withColumn(n["n_repeat_words"], F.coalesce(_covered(F.col(n["starts"])), F.lit(0)).cast("long"))

    class_distance, word_distance = F.lit(None).cast("double"), F.lit(None).cast("double")
    classes = _with_rest(n["classes"], len(CLASSES), n["n_chars"])
    default = F.sqrt(_divergence(classes, F.col(n["n_chars"]).cast("double"), references[None][0]))
    for lang, (class_shares, word_shares) in references.items():
        if lang is not None:
            here = F.col(n["lang"]) == lang
            class_distance = F.when(here, F.sqrt(_divergence(classes, F.col(n["n_chars"]).cast("double"), class_shares))).otherwise(class_distance)
            words_ = _with_rest(n["counts"], len(word_shares) - 1, n["n_words"])
            word_distance = F.when(here, F.sqrt(_divergence(words_, F.col(n["n_words"]).cast("double"), word_shares))).otherwise(word_distance)
    known = F.coalesce(F.col(n["lang"]).isin(*[x for x in references if x is not None]), F.lit(False))
    df = df.withColumn(n["class_distance"], F.when(F.col(n["n_chars"]) >= MIN_CHARS, F.when(known, class_distance).otherwise(default)))
    df = df.withColumn(n["word_distance"], F.when(F.col(n["n_words"]) >= MIN_WORDS, word_distance))
    bins = max(len(x.split()) for x in COMMON.values()) + 1
    unlike = (F.col(n["class_distance"]) > permitted(MAX_CLASS_DISTANCE, len(CLASSES) + 1, F.col(n["n_chars"]))) | (F.coalesce(F.col(n["word_distance"]) > permitted(MAX_WORD_DISTANCE, bins, F.col(n["n_words"])), F.lit(False)))
    return df.withColumn(n["unlike"], F.coalesce(unlike, F.lit(False))), n


def verdicts(n: dict[str, str]) -> tuple[Column, Column]:
    """``base_failed`` and ``kept`` from the measures."""
    base = (F.col(n["n_words"]) < MIN_WORDS_BASE) | (100 * F.col(n["n_repeat_words"]) > REPEAT_PERCENT * F.col(n["n_words"]))
    return base, ~base & ~F.col(n["unlike"])


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", references: References | None = None, position_bits: int = POSITION_BITS) -> DataFrame:
    """One row per document: id, measures, distances (null where guarded) and verdicts.

    The columns come out of an explode of one row, so that a later filter on them isn't pushed
    below the projections, with the expressions of all measures copied into it."""
    df, n = measured(docs, text_col, lang_col, references, position_bits)
    base, kept = verdicts(n)
    measures = [F.col(n[k]).alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    row = F.struct(F.col(id_col).cast("long").alias("doc_id"), *measures, base.alias("base_failed"), kept.alias("kept"), F.round(n["class_distance"], 6).alias("class_distance"), F.round(n["word_distance"], 6).alias("word_distance"))
    return df.select(F.inline(F.array(row)))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", references: References | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``.

    Written as an explode of none or one row: a filter would be pushed below the projections,
    with the expressions of all measures copied into it once for each use.
    """
    df, n = measured(docs, text_col, lang_col, references)
    row = F.array(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    passed = F.when(verdicts(n)[1], row).otherwise(F.slice(row, 1, 0))
    return df.select(F.inline(passed))
