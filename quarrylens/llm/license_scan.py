"""Licence scan by diagonal voting.

All rolling hashes of ``K`` words of every document are joined with the places of the same hashes in licence
templates (a broadcast: the templates are a parameter of the operator, a few thousand words, refused above
``MAX_TEMPLATE_WORDS``). A hit votes for the diagonal *place in the document - place in the template*; hits are
aggregated by diagonal. Diagonals of one template that are at most ``SHIFT`` words apart (a word added or left out in
between) are merged to one span. A span is verified word by word: all its words and the template's are aligned (longest common
subsequence), and those that agree must make up ``DENSITY`` of the span and ``SHARE`` of the template; of a template with
fewer than ``WHOLE`` words, all of it. Of overlapping spans of different licences the one with the larger share counts, then the longer one.

The words between the first and the last hit of a document come with its own row, so that spans are aligned without a second look at the
texts. They are cut where hits are further apart than any span that passes can be long (words of the longest template / ``DENSITY``), so
no span loses a word. Only these words, hits, and one row per document are shuffled: hits are rare, and a document's words are at most its
text once more. A span whose words, in any order, are too few of the template's isn't aligned, as it can't pass.

Templates are notices of 16 licences; :func:`folder_templates` reads full texts, or any others, from a folder.

Besides, the places where fixed phrases stand are counted. Defined results: a null or empty text has no words and no
labels; a very long text is looked at whole, in a block of its own; null ids are kept; repeated rows give repeated rows (their hits count
once, so a row that is repeated very often is no large group); an empty table gives an empty table; other columns of ``docs``,
whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrylens.llm.common import documents
from quarrylens.llm.license_texts import PHRASES, TEMPLATES
from quarrylens.llm.words import LETTERS_DIGITS, LOWER, blocks, gram_hashes, word_hashes

K, SHIFT, DENSITY, SHARE, WHOLE = 4, 3, 0.75, 0.75, 20
MAX_TEMPLATE_WORDS = 200_000
#: In place of a hash: the row that stands for the document itself.
ITSELF = -(1 << 62) + 12345
_INFO = "n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,stretches:array<struct<first:bigint,words:binary>>"
SCHEMA = f"doc long, version long, grams array<struct<gram:bigint,info:struct<{_INFO}>>>"
_STRETCH = pa.struct([("first", pa.int64()), ("words", pa.binary())])
_INFO_TYPE = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("stretches", pa.list_(_STRETCH))])


def hashed_words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(LOWER[raw], np.array([0, len(raw)]), LETTERS_DIGITS)[0]


def template_places(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    """``gram, template, label, at, words`` of every place in every template, and the row for ITSELF."""
    rows, total = [(ITSELF, -1, None, 0, 0)], 0
    for number, (label, text) in enumerate((label, text) for label, texts in templates.items() for text in texts):
        words = hashed_words(text)
        total += len(words)
        rows += [(int(g), number, label, at, len(words)) for at, g in enumerate(gram_hashes(words, K).view(np.int64).tolist())]
    if total > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have {total} words, over {MAX_TEMPLATE_WORDS}: too many to broadcast")
    return spark.createDataFrame(rows, "gram long, template int, label string, at int, words int")


def phrase_places(hashes: np.ndarray, bounds: np.ndarray, phrases: dict[str, str]) -> list[tuple[np.ndarray, np.ndarray, str]]:
    """For each phrase the rows and places where its words stand, and its label."""
    out = []
    for phrase, label in phrases.items():
        words = hashed_words(phrase)
        m = len(words)
        hit = np.ones(max(0, len(hashes) - m + 1), bool)
        for i, w in enumerate(words):
            hit &= hashes[i : i + len(hit)] == w
        at = np.flatnonzero(hit)
        row = np.searchsorted(bounds, at, "right") - 1
        inside = at + m <= bounds[row + 1]
        out.append((row[inside], (at - bounds[row])[inside], label))
    return out


def _stretches(grams: np.ndarray, known: np.ndarray, hashes: np.ndarray, own: np.ndarray, place: np.ndarray, bounds: np.ndarray, longest: int) -> dict[int, list[dict]]:
    """For each document with hits its words from the first to the last one, cut where no span can go across: ``first`` is the place of the first of ``words``."""
    found = np.flatnonzero(known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams) if len(known) and len(grams) else np.zeros(0, np.int64)
    if not len(found):
        return {}
    out: dict[int, list[dict]] = {}
    cut = np.flatnonzero((np.diff(own[found]) > 0) | (np.diff(place[found]) > longest)) + 1
    for run in np.split(found, cut):
        doc, first, last = int(own[run[0]]), int(place[run[0]]), int(place[run[-1]]) + K
        out.setdefault(doc, []).append({"first": first, "words": hashes[bounds[doc] + first : bounds[doc] + last].tobytes()})
    return out


def _measured(docs: DataFrame, id_col: str, text_col: str, phrases: dict[str, str], known: np.ndarray, longest: int) -> DataFrame:
    """Grams of every document and, with the row for ITSELF, its counts and the words around hits; ``known`` are the ascending grams of the templates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row0, raw, offsets in blocks(batch.column(2)):
                hashes, bounds = word_hashes(LOWER[raw], offsets, LETTERS_DIGITS)
                n = len(offsets) - 1
                grams = gram_hashes(hashes, K).view(np.int64)
                counts = np.diff(bounds)
                n_grams = np.maximum(counts - K + 1, 0)
                ends = np.cumsum(n_grams + 1)
                values = np.full(int(ends[-1]), ITSELF, np.int64)
                # grams that cross into the next document are left out
                own = np.repeat(np.arange(n), n_grams)
                place = np.arange(len(own)) - np.repeat(np.cumsum(n_grams) - n_grams, n_grams)
                mine = grams[bounds[own] + place] if len(own) else np.zeros(0, np.int64)
                values[np.repeat(ends - n_grams, n_grams) + place] = mine
                words = _stretches(mine, known, hashes, own, place, bounds, longest)
                info = [{"n_words": int(c), "n_base": 0, "first_word": None, "last_word": None, "base_labels": set(), "stretches": words.get(k, [])} for k, c in enumerate(counts)]
                for rows, places, label in phrase_places(hashes, bounds, phrases):
                    for r, p in zip(rows.tolist(), places.tolist(), strict=True):
                        x = info[r]
                        x["n_base"] += 1
                        x["first_word"] = p if x["first_word"] is None else min(p, x["first_word"])
                        x["last_word"] = p if x["last_word"] is None else max(p, x["last_word"])
                        x["base_labels"].add(label)
                for x in info:
                    x["base_labels"] = ",".join(sorted(x["base_labels"]))
                row = np.zeros(len(values), np.int64)
                row[ends - n_grams - 1] = np.arange(n)
                infos = pa.array(info, _INFO_TYPE).take(pa.array(row, mask=values != ITSELF))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.StructArray.from_arrays([pa.array(values), infos], ["gram", "info"]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row0, n), batch.column(1).slice(row0, n), lists], names=["doc", "version", "grams"])

    rows = documents(docs, id_col, text_col).select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("version"), "text")
    return rows.mapInArrow(run, SCHEMA)


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    if len(a) > len(b):
        a, b = b, a
    row = np.zeros(len(b) + 1, np.int64)
    for word in a:
        # the best of leaving out a word of b is a running maximum
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], np.where(b == word, row[:-1] + 1, 0)))
    return int(row[-1])


def agreement(stretches: list[dict], span: dict, template: np.ndarray) -> int:
    """Words of a span that agree with the template's, in order; 0 if they are too few by their number alone."""
    size = span["stop"] - span["first"]
    if size * DENSITY > len(template):
        return 0
    for part in stretches:
        at = span["first"] - part["first"]
        if at >= 0 and at + size <= len(part["words"]) // 8:
            words = np.frombuffer(part["words"], np.uint64)[at : at + size]
            theirs = template[span["low"] : span["high"]]
            if len(words) == len(theirs) and (words == theirs).all():
                return size
            if np.isin(words, theirs).sum() < max(DENSITY * size, SHARE * len(template)):
                return 0
            return common_words(words, theirs)
    return 0  # wider apart than a span that passes


def folder_templates(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Templates from a folder of text files, each named after its label; refused above ``MAX_TEMPLATE_WORDS``."""
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]+?)(\.[A-Za-z]+)?$", 1).alias("label"), F.col("content").cast("string").alias("text"))
    if (files.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have over {MAX_TEMPLATE_WORDS} words: too many to broadcast")
    out: dict[str, list[str]] = {}
    for r in files.orderBy("label", "text").collect():
        out.setdefault(r.label, []).append(r.text)
    return out


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``
    and ``spans``, the verified ones as (label, first word, one after the last word, share of the template)."""
    templates = TEMPLATES if templates is None else templates
    words_of = [hashed_words(text) for texts in templates.values() for text in texts]
    places = template_places(docs.sparkSession, templates)
    known = np.unique(np.concatenate([np.zeros(0, np.int64), *(gram_hashes(w, K).view(np.int64) for w in words_of)]))
    longest = int(max(map(len, words_of), default=0) / DENSITY)
    measured = _measured(docs, id_col, text_col, PHRASES if phrases is None else phrases, known, longest)
    grams = measured.select("doc", "version", F.posexplode("grams").alias("place", "x")).select("doc", "version", "place", "x.*")
    hits = grams.join(F.broadcast(places), "gram").select("doc", "version", "template", "label", "words", "info", (F.col("place") - 1).cast("long").alias("place"), F.col("at").cast("long").alias("at"))
    voted = hits.groupBy("doc", "version", "template", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.any_value("info").alias("info"), F.any_value("label").alias("label"), F.any_value("words").alias("words"), F.count(F.lit(1)).alias("votes"),
        F.min("place").alias("first"), (F.max("place") + K).alias("stop"), F.min("at").alias("low"), (F.max("at") + K).alias("high"),
    )
    # neighbouring diagonals make one span: a new one begins after a gap of more than SHIFT
    order = Window.partitionBy("doc", "version", "template").orderBy("diagonal")
    fresh = (F.col("diagonal") - F.lag("diagonal").over(order) > SHIFT).cast("int")
    one = voted.withColumn("span", F.sum(F.coalesce(fresh, F.lit(0))).over(order))
    ends = [F.min("first").alias("first"), F.max("stop").alias("stop"), F.min("low").alias("low"), F.max("high").alias("high")]
    spans = one.groupBy("doc", "version", "template", "span").agg(F.any_value("info").alias("info"), F.any_value("label").alias("label"), F.any_value("words").alias("words"), F.sum("votes").alias("votes"), *ends)
    candidate = F.when(F.col("template") >= 0, F.struct("template", "label", "words", "first", "stop", "low", "high"))
    found = spans.groupBy("doc", "version").agg(F.max("info").alias("info"), F.max(F.when(F.col("template") < 0, F.col("votes"))).alias("copies"), F.collect_list(candidate).alias("candidates"))

    @F.pandas_udf("array<bigint>")
    def agreed(stretches: pd.Series, candidates: pd.Series) -> pd.Series:
        return pd.Series([[agreement(parts, c, words_of[c["template"]]) for c in listed] for parts, listed in zip(stretches, candidates, strict=True)])

    found = found.withColumn("agreed", F.when(F.size("candidates") > 0, agreed("info.stretches", "candidates")).otherwise(F.array().cast("array<bigint>")))
    share = lambda c, n: F.least(F.lit(1.0), n / c["words"])
    checked = F.zip_with("candidates", "agreed", lambda c, n: F.struct(c["label"].alias("label"), c["first"].alias("first"), c["stop"].alias("stop"), share(c, n).alias("share"), n.alias("agreed"), c["words"].alias("words")))
    good = lambda s: (s["agreed"] >= DENSITY * (s["stop"] - s["first"])) & (s["share"] >= F.when(s["words"] < WHOLE, 1.0).otherwise(SHARE))
    found = found.withColumn("spans", F.sort_array(F.transform(F.filter(checked, good), lambda s: s.dropFields("words"))))
    # licences that differ in a few words are found in each other's place: of overlapping spans the better one counts
    better = lambda t, s: (t["label"] != s["label"]) & (t["first"] < s["stop"]) & (t["stop"] > s["first"]) & (F.struct(t["share"], t["agreed"]) > F.struct(s["share"], s["agreed"]))
    best = F.filter("spans", lambda s: ~F.exists("spans", lambda t: better(t, s)))
    found = found.withColumn("spans", F.transform(best, lambda s: F.struct(s["label"].alias("label"), s["first"].alias("first"), s["stop"].alias("stop"), s["share"].alias("share"))))
    base = F.filter(F.split("info.base_labels", ","), lambda x: x != "")
    labels = F.array_sort(F.array_distinct(F.concat(base, F.transform("spans", lambda s: s["label"]))))
    return found.select(
        F.col("doc").alias("doc_id"), "info.n_words", "info.n_base", "info.first_word", "info.last_word", "info.base_labels",
        F.concat_ws(",", labels).alias("labels"), F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"), "spans",
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    ).drop("copy")
