"""The queries of the corpus operators and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quarrylens.llm import bpe, exact_dedup, html_text, license_scan, near_dedup, packing, pii, quality_rules, sharding, substring_dedup, token_counts, vector_codes, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = quality_rules.quality(docs, references=quality_rules.fitted(docs, _table(spark, sf_dir, "labels")))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_counts(_table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op8_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(_table(spark, sf_dir, "documents")).drop("spans")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(_table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encoded(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digests(_table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digests(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (
    op1_packing, op2_substring_dedup, op3_near_dedup, op4_quality, op5_token_counts, op6_html, op7_exact_dedup, op8_license, op9_pii, op10_bpe,
    op11_vector_codes, op12_whitening, op13_sharding, pipeline,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op4_quality": _quality_sql(), "op7_exact_dedup": EXACT_SQL, "op11_vector_codes": _codes_sql()}


EXACT_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d
"""


def _quality_sql() -> str:
    q = quality_rules
    n_classes, general = len(q.CLASSES) + 1, q.general()
    listed = {lang: words.split() for lang, words in q.COMMON.items()}
    counts = "CASE lang " + " ".join(f"WHEN '{lang}' THEN [{', '.join(f'len(list_filter(words, lambda w: w = {chr(39)}{w}{chr(39)}))' for w in words)}]" for lang, words in listed.items()) + " END"
    langs = ", ".join(f"('{lang}', {general[lang][0]}::DOUBLE[], {general[lang][1]}::DOUBLE[])" for lang in listed)
    gone = lambda p: f"(length(text) - length(regexp_replace(text, '{p}', '', 'g')))"

    def distance(counts: str, shares: str, total: str) -> str:
        p, m, share = f"({counts}[i] / {total}::DOUBLE)", f"(({counts}[i] / {total}::DOUBLE + {shares}[i]) / 2)", f"{shares}[i]"
        term = f"CASE WHEN {counts}[i] > 0 THEN {p} * ln({p} / {m}) ELSE 0 END + CASE WHEN {share} > 0 THEN {share} * ln({share} / {m}) ELSE 0 END"
        return f"sqrt(greatest(list_sum(list_transform(range(1, len({shares}) + 1), lambda i: {term})) / (2 * ln(2)), 0))"

    allowed = lambda limit, bins, total: f"sqrt({limit * limit} + {q.NOISE} * {bins - 1} / (8 * ln(2)) / {total})"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), g AS (
  SELECT rid, p, words[p:p+4] AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS p FROM w WHERE len(words) >= 5)
), r AS (
  SELECT rid, count(DISTINCT p + o) AS n_repeat_words
  FROM (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c > 1), range(5) t(o) GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, lang, text, words, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         {gone(r'[#*$%&|<>]')} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, length(text) AS n_chars,
         {gone(r'\p{Lu}')} AS upper, {gone('[0-9]')} AS digit, {gone(r'[.,;:!?' + "''" + r'"()-]')} AS punct, {counts} AS common
  FROM w LEFT JOIN r ON w.rid = r.rid
), c AS (
  SELECT *, [upper, digit, punct, n_symbols, n_chars - word_chars, word_chars - upper - digit - punct - n_symbols] AS classes,
         list_append(common, n_words - list_sum(common)::BIGINT) AS bins FROM m
), good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL ORDER BY doc_id LIMIT {q.SAMPLE}
), s AS (
  SELECT lang, sum(n_words) AS all_words, sum(n_chars) AS all_chars, [{', '.join(f'sum(classes[{k + 1}])' for k in range(n_classes))}] AS all_classes,
         [{', '.join(f'sum(bins[{k + 1}])' for k in range(max(map(len, listed.values())) + 1))}] AS all_bins
  FROM c WHERE doc_id IN (SELECT doc_id FROM good) GROUP BY lang
), f AS (
  SELECT g.lang, CASE WHEN all_words >= {q.MIN_FITTED} THEN list_transform(all_classes, lambda x: x / all_chars::DOUBLE) ELSE general_classes END AS class_shares,
         CASE WHEN all_words >= {q.MIN_FITTED} THEN list_transform(all_bins, lambda x: x / all_words::DOUBLE) ELSE general_bins END AS bin_shares
  FROM (VALUES {langs}) g(lang, general_classes, general_bins) LEFT JOIN s ON g.lang = s.lang
), v AS (
  SELECT c.*, CASE WHEN n_chars >= {q.MIN_CHARS} THEN {distance('classes', f'coalesce(class_shares, {general[None][0]}::DOUBLE[])', 'n_chars')} > {allowed(q.MAX_CLASS_DISTANCE, n_classes, 'n_chars')} ELSE false END
           OR CASE WHEN n_words >= {q.MIN_WORDS} AND bin_shares IS NOT NULL THEN {distance('bins', 'bin_shares', 'n_words')} > {allowed(q.MAX_WORD_DISTANCE, max(map(len, listed.values())) + 1, 'n_words')} ELSE false END AS unlike,
         n_words < {q.MIN_WORDS_BASE} OR 100 * n_repeat_words > {q.REPEAT_PERCENT} * n_words AS base_failed
  FROM c LEFT JOIN f ON c.lang = f.lang
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND NOT unlike AS kept
FROM v
"""


def _codes_sql() -> str:
    """Every part against every entry, in whole numbers that doubles hold exactly."""
    q = vector_codes
    steps = [rf"""
WITH r AS (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda c: floor({q.SCALE} * c::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), p AS (
  SELECT rid, k, x[k * len(x) // {q.PARTS} + 1 : (k + 1) * len(x) // {q.PARTS}]::DOUBLE[] AS v FROM r, range({q.PARTS}) t(k)
), seeds AS (
  SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS entry FROM r QUALIFY entry < {q.ENTRIES}
), b0 AS (SELECT k, entry, v FROM p JOIN seeds USING (rid))"""]
    for n in range(q.ROUNDS + 1):
        steps.append(rf"""a{n} AS MATERIALIZED (
  SELECT p.rid, p.k, min((list_dot_product(p.v, p.v) - 2 * list_dot_product(p.v, b.v) + list_dot_product(b.v, b.v))::BIGINT * {q.ENTRIES} + b.entry) AS best
  FROM p JOIN b{n} b ON p.k = b.k GROUP BY p.rid, p.k
)""")
        if n < q.ROUNDS:
            steps.append(rf"""m{n} AS (
  SELECT k, entry, i, sum(c) AS s, count(*) AS n
  FROM (SELECT p.k, best % {q.ENTRIES} AS entry, unnest(range(len(v))) AS i, unnest(v)::BIGINT AS c FROM p JOIN a{n} USING (rid, k)) GROUP BY k, entry, i
), b{n + 1} AS MATERIALIZED (
  SELECT k, entry, coalesce(w, v) AS v FROM b{n}
  LEFT JOIN (SELECT k, entry, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS w FROM m{n} GROUP BY k, entry) USING (k, entry)
)""")
    last = q.ROUNDS
    steps.append(rf"""books AS (
  SELECT sha256(string_agg(c::BIGINT, ',' ORDER BY k, entry, i)) AS h FROM (SELECT k, entry, unnest(range(len(v))) AS i, unnest(v) AS c FROM b{last})
), coded AS (
  SELECT rid, string_agg(printf('%02x', best % {q.ENTRIES}), '' ORDER BY k) AS code, sum(best // {q.ENTRIES})::BIGINT AS error FROM a{last} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM r JOIN coded USING (rid), books""")
    return ",\n".join(steps)
