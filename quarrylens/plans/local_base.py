"""Named queries on a local base of known files and folders, and the SQL of winnowing that they share with the fingerprint queries.

The base of the original is remote; these joins are extensions. Registered with the queries of :mod:`.catalog`.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrylens.functions.fixed_values import GRAM, WINDOW
from quarrylens.operators import fingerprints, folders, hamming, versions
from quarrylens.plans import catalog as Q
from quarrylens.plans.catalog import query
from quarrylens.plans.formats import _STEM, _WORDS, _simhash_sql
from quarrylens.session import table
from quarrylens.sources import inputs as I
from quarrylens.sources.inputs import FILES_SQL, TREE_SQL

# Winnowing by windows: bytes as rows, sums of a checksum's contributions, a moving minimum, the change to the row before


def _crc_step(value: int) -> int:
    for _ in range(8):
        value = value >> 1 ^ (0x82F63B78 if value & 1 else 0)
    return value


def _contributions(symbols: str, distance: int) -> list[int]:
    """What a byte adds (by xor) to the CRC-32C of a string that has ``distance`` bytes after it: the checksum is linear."""
    out = []
    for symbol in symbols:
        value = _crc_step(ord(symbol))
        for _ in range(distance):
            value = value >> 8 ^ _crc_step(value & 255)
        out.append(value)
    return out


def _start(size: int) -> int:
    """The checksum of so many zero bytes."""
    value = 0xFFFFFFFF
    for _ in range(size):
        value = value >> 8 ^ _crc_step(value & 255)
    return value ^ 0xFFFFFFFF


_SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyz"


def winnow_sql(source: str, name: str) -> str:
    """Common table expressions that end with ``name(path, line, ord, hash)``: the fingerprints of the rows ``path, text`` of ``source``."""
    gram = " , ".join(f"{_contributions(_SYMBOLS, k)}[lag(s, {k}) OVER w]" for k in range(GRAM))
    total = gram.split(" , ")
    xored = total[0]
    for term in total[1:]:
        xored = f"xor({xored}, {term})"
    word = "0"
    for k in range(4):
        table_ = [_contributions([chr(v)], 3 - k)[0] for v in range(256)]
        word = f"xor({word}, {table_}[((least >> {8 * k}) & 255) + 1])"
    return rf"""
{name}_c AS (SELECT path, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS i FROM (SELECT path, lower(regexp_replace(text, '[^A-Za-z0-9\n]', '', 'g')) AS t FROM {source})),
{name}_b AS (SELECT path, line, s, row_number() OVER (PARTITION BY path ORDER BY i) AS p FROM (
  SELECT path, i, c, CASE WHEN c < 'a' THEN ascii(c) - 47 ELSE ascii(c) - 86 END AS s, 1 + sum((c = chr(10))::INT) OVER (PARTITION BY path ORDER BY i) AS line FROM {name}_c) WHERE c <> chr(10)),
{name}_g AS (SELECT path, line, p, xor({xored}, {_start(GRAM)})::BIGINT AS g FROM {name}_b WINDOW w AS (PARTITION BY path ORDER BY p)),
{name}_m AS (SELECT path, line, p, min(g) OVER (PARTITION BY path ORDER BY p ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS least FROM {name}_g WHERE p >= {GRAM}),
{name}_f AS (SELECT path, line, p, least FROM (SELECT *, lag(least) OVER (PARTITION BY path ORDER BY p) AS before FROM {name}_m WHERE p >= {GRAM + WINDOW - 1}) WHERE before IS DISTINCT FROM least),
{name} AS (SELECT path, line::INT AS line, (row_number() OVER (PARTITION BY path, line ORDER BY p) - 1)::INT AS ord, printf('%08x', xor({word}, {_start(4)})::BIGINT) AS hash FROM {name}_f)"""


_MADE = f"made AS (SELECT path, text FROM files WHERE {Q._ELIGIBLE})"
_PRINTS = f"{FILES_SQL}, {_MADE}, {winnow_sql('made', 'prints')}"
_KB = f"kb AS (SELECT 'kb/' || item_id || '.py' AS path, coalesce(text, '') AS text FROM benchmark), kb_made AS (SELECT path, text FROM kb WHERE {Q._ELIGIBLE}), {winnow_sql('kb_made', 'known')}"
Q._SQL["D3_winnow_udf"] = f"WITH {_PRINTS} SELECT path, line, ord, hash FROM prints"
Q._SQL["X_kb_snippet_hits"] = f"""WITH {_PRINTS}, {_KB}, o AS (SELECT path, hash, min(line) AS first_line, max(line) AS last_line FROM prints GROUP BY path, hash), k AS (SELECT DISTINCT path AS kb_path, hash FROM known)
SELECT path, kb_path, count(*) AS hits, min(first_line) AS first_line, max(last_line) AS last_line FROM o JOIN k USING (hash) GROUP BY path, kb_path"""
Q._SQL["D4_wfp_size_cap"] = f"""WITH {_PRINTS}, h AS (SELECT path, {Q._HEAD_SQL} AS head FROM files), l AS (SELECT path, line, line || '=' || string_agg(hash, ',' ORDER BY ord) AS t FROM prints GROUP BY path, line),
 s AS (SELECT path, line, t, strlen(head) + sum(strlen(t) + 1) OVER (PARTITION BY path ORDER BY line) - 1 AS total, lead(line) OVER (PARTITION BY path ORDER BY line) IS NULL AS is_last FROM l JOIN h USING (path)),
 k AS (SELECT path, string_agg(t || chr(10), '' ORDER BY line) AS body FROM s WHERE CASE WHEN is_last THEN total < 2048 ELSE total <= 2048 END GROUP BY path)
SELECT path, head || coalesce(body, '') AS wfp FROM h LEFT JOIN k USING (path)"""


def _kb_files(spark, d):
    rows = table(spark, d, "benchmark").select(F.concat(F.lit("kb/"), F.col("item_id").cast("string"), F.lit(".py")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    return fingerprints.fingerprints(rows).withColumnRenamed("path", "kb_path")


@query("K_snippet_lines", f"""WITH {_PRINTS}, {_KB},
 o AS (SELECT path, hash, list_sort(list(DISTINCT line)) AS ours FROM prints GROUP BY path, hash), k AS (SELECT path AS kb_path, hash, list_sort(list(DISTINCT line)) AS there FROM known GROUP BY path, hash),
 hits AS (SELECT path, kb_path, hash, ours[i] AS line, there[least(i, len(there))] - ours[i] AS apart FROM o JOIN k USING (hash), range(1, 100000) t(i) WHERE i <= len(ours)),
 f AS (SELECT *, coalesce(line - lag(line) OVER w > {fingerprints.LINE_GAP}, true)::INT AS fresh FROM hits WINDOW w AS (PARTITION BY path, kb_path, apart ORDER BY line, hash)),
 s AS (SELECT *, sum(fresh) OVER (PARTITION BY path, kb_path, apart ORDER BY line, hash ROWS UNBOUNDED PRECEDING) AS island FROM f),
 r AS (SELECT path, kb_path, apart, island, count(*) AS hits, min(line) AS first, max(line) AS last FROM s GROUP BY path, kb_path, apart, island HAVING count(*) >= 2),
 e AS (SELECT path, kb_path, sum(hits)::BIGINT AS hits, string_agg(DISTINCT (first + apart) || '-' || (last + apart), ',' ORDER BY (first + apart) || '-' || (last + apart)) AS oss_lines, list(DISTINCT first) AS firsts FROM r GROUP BY path, kb_path),
 c AS (SELECT path, kb_path, unnest(range(first, last + 1)) AS line FROM r), u AS (SELECT DISTINCT path, kb_path, line FROM c), v AS (SELECT *, line - row_number() OVER (PARTITION BY path, kb_path ORDER BY line) AS run FROM u),
 y AS (SELECT path, kb_path, run, min(line) AS first, max(line) AS last FROM v GROUP BY path, kb_path, run), z AS (SELECT path, kb_path, sum(last - first + 1) AS n, string_agg(first || '-' || last, ',' ORDER BY first) AS lines FROM y GROUP BY path, kb_path)
SELECT path, kb_path, hits, lines, (floor(100 * n / n_lines)::BIGINT) || '%' AS matched, place::INT AS rank FROM (
  SELECT path, kb_path, hits, lines, n, len(string_split(text, chr(10))) AS n_lines, row_number() OVER (PARTITION BY path ORDER BY hits DESC, n DESC, kb_path) AS place FROM e JOIN z USING (path, kb_path) JOIN files USING (path)) WHERE place <= {fingerprints.BEST}""")
def _lines(spark, d):
    """Line ranges of documents that stand in passages of the benchmark, with two hits or more."""
    files = I.files(spark, d)
    n_lines = files.select("path", F.size(F.split("text", "\n")).alias("n_lines"))
    return fingerprints.line_matches(fingerprints.fingerprints(files), _kb_files(spark, d), n_lines, min_hits=2).drop("oss_lines")


# Hashes that differ in a few bits

#: Hashes of documents: those of sixteen ids share most bits.
_GROUP = "concat('group ', CAST({half} AS {T}))"


@query("K_hamming_pairs", f"""WITH h AS (SELECT DISTINCT xor(xor(('0x' || substr(md5({_GROUP.format(half='doc_id // 16', T='VARCHAR')}), 1, 15))::BIGINT, 1::BIGINT << (doc_id % 16)), 1::BIGINT << (16 + doc_id % 5)) AS v FROM documents)
SELECT a.v AS hash_a, b.v AS hash_b, bit_count(xor(a.v, b.v))::INT AS distance FROM h a JOIN h b ON a.v < b.v WHERE bit_count(xor(a.v, b.v)) <= 3""")
def _pairs(spark, d):
    """Hashes of documents that differ in at most three bits."""
    group = F.conv(F.substring(F.md5(F.expr(_GROUP.format(half="doc_id div 16", T="STRING"))), 1, 15), 16, 10).cast("long")
    flips = F.expr("shiftleft(1L, cast(doc_id % 16 as int)) ^ shiftleft(1L, cast(16 + doc_id % 5 as int))")
    return hamming.near_hashes(table(spark, d, "documents").select(group.bitwiseXOR(flips).alias("hash")), within=3)


_ABOVE_OF = "SELECT path, unnest(list_transform(range(0, len(p)), lambda n: CASE WHEN n = 0 THEN '.' ELSE array_to_string(p[1:n], '/') END)) AS dir, unnest(range(1, len(p) + 1)) AS depth FROM (SELECT path, string_split(path, '/') AS p FROM {t})"


def _folder_sql(t: str, name: str, depth: int) -> str:
    """``name(dir, depth, kind, hash)``: the two name hashes of the folders of ``t``, down to ``depth``."""
    return f"""{name}_x AS (SELECT * FROM ({_ABOVE_OF.format(t=t)}) WHERE depth <= {depth}),
 {name}_n AS (SELECT dir FROM {name}_x GROUP BY dir HAVING count(*) >= {folders.MIN_FILES} AND sum(strlen({Q._NAME})) >= {folders.MIN_NAME_BYTES}),
 {name}_s AS (SELECT DISTINCT dir, {_STEM} AS name FROM {name}_x), {name}_d AS (SELECT DISTINCT dir, name FROM (SELECT dir, unnest(string_split(path, '/')[:-2]) AS name FROM {name}_x) WHERE name NOT IN ('', '.', '..')),
 {name} AS (SELECT dir, kind, coalesce(h, 18446744073709551615::UBIGINT) AS hash FROM (
  SELECT n.dir, 'sim_hash_names' AS kind, ('0x' || simhash)::UBIGINT AS h FROM {name}_n n LEFT JOIN ({_simhash_sql(f"SELECT dir, {_WORDS.format(x='name')} FROM {name}_s", "dir")}) a ON n.dir = a.dir
  UNION ALL SELECT n.dir, 'sim_hash_dir_names', ('0x' || simhash)::UBIGINT FROM {name}_n n LEFT JOIN ({_simhash_sql(f"SELECT dir, {_WORDS.format(x='name')} FROM {name}_d", "dir")}) b ON n.dir = b.dir))"""


@query("K_folder_matches", f"""WITH {TREE_SQL}, {FILES_SQL}, {_folder_sql('tree', 'ours', 3)}, {_folder_sql('files', 'theirs', 3)},
 p AS (SELECT a.dir, b.dir AS kb_dir, count(*)::INT AS n_hashes, sum(bit_count(xor(a.hash, b.hash)))::INT AS distance FROM ours a JOIN theirs b ON a.kind = b.kind AND bit_count(xor(a.hash, b.hash)) <= 16 GROUP BY a.dir, b.dir),
 r AS (SELECT *, (n_hashes - distance / 64) / 2 AS score FROM p), k AS (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY score DESC, kb_dir)::INT AS rank FROM r WHERE score >= {folders.LEAST_SCORE}),
 best AS (SELECT * FROM k WHERE rank <= {folders.RANKS}), done AS (SELECT dir FROM best WHERE rank = 1 AND score >= {folders.RECURSIVE_SCORE})
SELECT dir, kb_dir, n_hashes, distance, rank FROM best b WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.dir <> b.dir AND (done.dir = '.' OR starts_with(b.dir, done.dir || '/')))""")
def _folders(spark, d):
    """Folders of the tree that are like folders of the plain files, by the hashes of names."""
    ours = folders.folder_simhashes(I.tree(spark, d), depth=3)
    theirs = folders.folder_simhashes(I.files(spark, d), depth=3).withColumnRenamed("dir", "kb_dir")
    return folders.folder_matches(ours, theirs, ("sim_hash_names", "sim_hash_dir_names"), within=16).select("dir", "kb_dir", "n_hashes", "distance", "rank")


# Versions in the ranges that requests ask for

_VERSION = "CAST(doc_id % 3 AS {T}) || '.' || CAST(doc_id % 5 AS {T}) || '.' || CAST(doc_id % 7 * 3 AS {T}) || CASE WHEN doc_id % 4 = 0 THEN '-rc.' || CAST(doc_id % 11 AS {T}) ELSE '' END"
_LOW = "CAST(doc_id % 2 AS {T}) || '.' || CAST(doc_id % 4 AS {T}) || '.' || CAST(doc_id % 6 * 3 AS {T})"
_ASKED = f"CASE doc_id % 8 WHEN 0 THEN '>=' || {_LOW} || ', <2' WHEN 1 THEN '^' || {_LOW} WHEN 2 THEN '~' || {_LOW} WHEN 3 THEN '>' || {_LOW} || ' !=2.1.3' WHEN 4 THEN '<=' || {_LOW} WHEN 5 THEN {_LOW} WHEN 6 THEN '<' || {_LOW} || '-rc.5' ELSE NULL END"
#: Numbers, whether it is a release, number of the pre-release.
_KEY = r"[split_part({v}, '.', 1)::INT, split_part({v}, '.', 2)::INT, regexp_extract({v}, '^\d+\.\d+\.(\d+)', 1)::INT, (NOT contains({v}, '-'))::INT, CASE WHEN contains({v}, '-') THEN regexp_extract({v}, '(\d+)$', 1)::INT ELSE 0 END]"


@query("K_versions_in_range", f"""WITH c AS (SELECT DISTINCT 'pkg:github/org/' || source AS purl, {_VERSION.format(T='VARCHAR')} AS version FROM documents),
 q AS (SELECT DISTINCT 'pkg:github/org/' || source AS purl, {_ASKED.format(T='VARCHAR')} AS requirement, doc_id % 8 AS kind, doc_id % 2 AS a, doc_id % 4 AS b, {_LOW.format(T='VARCHAR')} AS low FROM documents),
 k AS (SELECT *, {_KEY.format(v='low')} AS lk FROM q), v AS (SELECT *, {_KEY.format(v='version')} AS vk FROM c)
SELECT DISTINCT purl, requirement, version FROM k JOIN v USING (purl) WHERE CASE kind WHEN 0 THEN vk >= lk AND vk < [2, 0, 0, 1, 0] WHEN 1 THEN vk >= lk AND vk < CASE WHEN a > 0 THEN [a + 1, 0, 0, 1, 0] WHEN b > 0 THEN [0, b + 1, 0, 1, 0] ELSE [0, 0, lk[3] + 1, 1, 0] END
 WHEN 2 THEN vk >= lk AND vk < [a, b + 1, 0, 1, 0] WHEN 3 THEN vk > lk AND vk <> [2, 1, 3, 1, 0] WHEN 4 THEN vk <= lk WHEN 5 THEN vk = lk WHEN 6 THEN vk < [lk[1], lk[2], lk[3], 0, 5] ELSE true END""")
def _ranges(spark, d):
    """Versions of components that fulfil requirements of many forms."""
    docs = table(spark, d, "documents")
    purl = F.concat(F.lit("pkg:github/org/"), "source").alias("purl")
    return versions.versions_in_range(docs.select(purl, F.expr(_ASKED.format(T="STRING")).alias("requirement")), docs.select(purl, F.expr(_VERSION.format(T="STRING")).alias("version")))


@query("B9_folder_lines")
def _folder_lines(spark, d):
    """The request for a whole tree as lines."""
    return folders.folder_lines(I.tree(spark, d), depth=4)
