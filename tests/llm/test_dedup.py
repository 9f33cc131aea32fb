"""Exact, near and substring duplicates against brute force."""

import functools
import hashlib
import os
import random
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrylens.llm import anchors, components, exact_dedup, near_dedup, shingles, string_merge, substring_dedup


def text_rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def exact_brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), []).append(i)
    out = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        keep = min((x for x in groups[norm] if x is not None), default=None)
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("table", ["odd", "real", "clashing"])
def test_exact(table, request):
    docs = request.getfixturevalue(table)
    found = [tuple(r) for r in exact_dedup.exact_dedup(docs).collect()]
    assert sorted(map(repr, found)) == exact_brute(text_rows(docs))


@pytest.mark.parametrize("hot_groups", [1, 4, 1000])
def test_exact_with_and_without_hot_texts(hot_groups, docs_of):
    rng = random.Random(7)
    rows = [(rng.choice([i, i, i, None]), rng.choice(["hot text"] * 5 + [" warm  text", "warm text\n"] + [f"text {k}" for k in range(60)] + [None, ""])) for i in range(900)]
    found = exact_dedup.exact_dedup(docs_of(rows).repartition(3), hot_groups=hot_groups).collect()
    assert sorted(map(repr, map(tuple, found))) == exact_brute([(i, t or "") for i, t in rows])


def test_exact_collisions_are_told_by_bytes(docs_of, monkeypatch):
    monkeypatch.setattr(F, "md5", lambda c: F.lit("00"))  # all texts share one hash
    docs = docs_of([(1, "a"), (2, "b"), (3, "a"), (4, "c")])
    assert sorted(map(repr, (tuple(r) for r in exact_dedup.exact_dedup(docs).collect()))) == exact_brute(text_rows(docs))


def test_exact_keeps_columns(clashing, docs_of):
    kept = exact_dedup.keep_first(clashing)
    assert kept.columns == clashing.columns and {r.doc_id for r in kept.collect()} == {1, 3}
    assert exact_dedup.keep_first(docs_of([])).count() == 0


def near_brute(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets.append(frozenset(zip(*[w[j:] for j in range(5)], strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    names = list(range(len(rows)))

    def root(x):
        while names[x] != x:
            x = names[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                names[root(i)] = root(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root(k)] = min(i, low.get(root(k), i))
    return sorted(map(repr, ((i, len(sets[k]), low.get(root(k)), low.get(root(k)) == i) for k, (i, _) in enumerate(rows))))


def varied(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    bases = [[rng.choice(words) for _ in range(rng.choice([3, 6, 40, 120]))] for _ in range(6)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i * 3 % (n + 1), " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_on_edited_copies(seed, docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)  # several blocks in a bucket
    rows = varied(seed)
    assert sorted(map(repr, (tuple(r) for r in near_dedup.near_dedup(docs_of(rows)).collect()))) == near_brute(rows)


@pytest.mark.parametrize("table", ["odd", "real", "clashing"])
def test_near(table, request):
    docs = request.getfixturevalue(table)
    rows = text_rows(docs)
    assert sorted(map(repr, (tuple(r) for r in near_dedup.near_dedup(docs).collect()))) == near_brute(rows)


def test_near_keeps_columns(clashing, docs_of):
    kept = near_dedup.keep_one(clashing)
    assert kept.columns == clashing.columns and {r.doc_id for r in kept.collect()} == {1, 3}
    assert near_dedup.keep_one(docs_of([])).count() == 0


def test_sketches_of_small_linked_sets_pass():
    rng = np.random.default_rng(3)
    values = near_dedup.BANDS * near_dedup.ROWS
    lost = 0
    for shared, alone in ((3, 1), (6, 2), (9, 3), (15, 5), (30, 10)):
        for _ in range(3000):
            union = rng.integers(0, 2**64, shared + alone, np.uint64)
            a, b = np.sort(union[:shared]), np.sort(union)
            assert near_dedup.linked(a, b)
            agreed = np.mean((shingles.signature(a, values) & np.uint64(0xFFFF)) == (shingles.signature(b, values) & np.uint64(0xFFFF)))
            assert agreed >= near_dedup.least_agreement(np.array([shared + alone]), values)[0]
            lost += agreed < 0.75 - 5 * (0.75 * 0.25 / values) ** 0.5
    assert lost  # as many as one bound for all sizes would drop


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    for size in (3, 20, 400, 5000):
        both = rng.integers(1, 1 << 62, size * 2, dtype=np.uint64)
        a, b = np.unique(both[: size + size // 2]), np.unique(both[size // 2 :])
        same = np.mean(shingles.signature(a, 2000) == shingles.signature(b, 2000))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(same - true) < 0.12
    assert [len(s) for s in shingles.shingle_sets(pa.array(["", "  ", "a", "A b c d", "a b c d e", "a b c d e f"]))] == [0, 0, 1, 1, 1, 2]


def test_rows_for_a_bucket_of_many_members(spark):
    """The largest star isn't sent to all blocks: rows grow with the members, not with their square."""
    members = spark.range(20_000).selectExpr("1L AS key", "0 AS band", "0L AS centre", "id AS rep", "100L AS n_shingles", "20000L AS size")
    stars = spark.range(1, 19_900).selectExpr("id AS rep", "0L AS star")  # the last 100 are stars of their own
    classes = spark.range(20_000).selectExpr("id AS rep", "CAST('' AS BINARY) AS sketch")
    found = near_dedup._met_blocks(members, stars, classes)
    assert found.filter("star = 0").count() == 19_900
    assert found.filter("star <> 0").count() == 100 * (1 + -(-19_900 // near_dedup.BLOCK))
    assert found.groupBy("i", "j").count().agg(F.max("count")).first()[0] < 2 * near_dedup.BLOCK
    pairs = spark.range(1, 5000).selectExpr("0L AS a", "id AS b")
    blocks = near_dedup._star_blocks(pairs)
    assert blocks.filter("rep = 0").count() == 20 and blocks.count() == 4999 + 20


def test_rows_for_a_large_bucket_of_unlinked_members(spark):
    """A large bucket is split: members with nothing else in common make no rows, those of one template few."""
    n, values = 16_000, near_dedup.BANDS * near_dedup.ROWS
    rng = np.random.default_rng(4)
    sketches = rng.integers(0, 1 << 16, (n, values)).astype("<u2")
    sketches[:, :5] = 7
    members = spark.range(n).selectExpr("1L AS key", "0 AS band", "0L AS centre", "id AS rep", "100L AS n_shingles", f"{n}L AS size")
    stars = spark.createDataFrame([], "rep long, star long")
    for template in (0.0, 0.5):
        sketches[rng.random((n, values)) < template] = 9
        classes = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sketches)], "rep long, sketch binary")
        found = near_dedup._met_blocks(members, stars, classes)
        assert found.filter("NOT deep").count() == 0
        # before the split: n * n / 256, a million
        assert found.count() < (100_000 if template == 0 else 400_000)


@pytest.mark.parametrize("seed", [3, 4])
def test_near_with_split_buckets(seed, docs_of, monkeypatch):
    """Pages of one template, some with near copies, in buckets that all count as large."""
    monkeypatch.setattr(near_dedup, "BIG", 3)
    rng = random.Random(seed)
    template = [f"t{k}" for k in range(60)]
    rows = []
    for i in range(90):
        own = [f"p{rng.randrange(30)}x{k}" for k in range(rng.choice([10, 40, 60]))]
        rows.append((i, " ".join(template + own)))
        if i % 3 == 0:
            rows.append((1000 + i, " ".join(template + own[:-2] + ["an", "edit"])))
    assert sorted(map(repr, (tuple(r) for r in near_dedup.near_dedup(docs_of(rows)).collect()))) == near_brute(rows)


@pytest.mark.parametrize("lost", ["by the split", "by sketches"])
def test_near_finds_what_sketches_and_splits_leave_out(lost, docs_of, monkeypatch):
    """All documents share the smallest hash of their first band, so a pair meets in the bucket of an unlinked centre."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "BIG", 0 if lost == "by the split" else 4096)
    if lost == "by the split":
        monkeypatch.setattr(near_dedup, "GROUPS", 1)
        monkeypatch.setattr(near_dedup, "TAKEN", 2)
    else:
        monkeypatch.setattr(near_dedup, "least_agreement", lambda n, values, percent=75: np.full(np.shape(n), 1.1))
    starts = [f"m{k} t0 t1 t2 t3" for k in range(200_000)]
    template = starts[int(np.argmin([s[0] for s in shingles.shingle_sets(pa.array(starts))]))].split()
    rng = random.Random(5)
    rows = []
    for i in range(60):
        own = [f"p{i}x{k}" for k in range(rng.choice([40, 60, 90]))]
        rows.append((i, " ".join(template + own)))
        rows.append((1000 + i, " ".join(template + own[: -(len(own) // 5)] + ["an", "edit"])))
    bands = 2 if lost == "by the split" else 1
    assert sorted(map(repr, (tuple(r) for r in near_dedup.near_dedup(docs_of(rows), bands=bands, rows=1).collect()))) == near_brute(rows)


def test_pipeline_stage_drops_what_sketches_leave_out(spark, docs_of, monkeypatch):
    """As above, with few documents, by the stage of the pipeline."""
    monkeypatch.setattr(near_dedup, "least_agreement", lambda n, values, percent=75: np.full(np.shape(n), 1.1))
    monkeypatch.setattr(near_dedup, "near_dedup", functools.partial(near_dedup.near_dedup, bands=1, rows=1))
    starts = [f"m{k} t0 t1 t2 t3" for k in range(200_000)]
    start = starts[int(np.argmin([s[0] for s in shingles.shingle_sets(pa.array(starts))]))]
    rows = [(i + e, " ".join([start, *(f"p{i}x{k}" for k in range(40 - e // 500))])) for i in range(6) for e in (0, 1000)]
    assert {r.doc_id for r in corpus_pipeline.near(spark, docs_of(rows), "").collect()} == set(range(6))


def test_near_finds_what_bands_leave_out(spark, docs_of):
    """Linked texts of 7 and 8 words, of which the last shingle hides the others in most ranges of the sketch."""
    words = [[f"w{name}y{k}" for k in range(8)] for name in ("0x29259", "1x22391", "2x25740", "4x6495")]
    rows = [(10 * i + n, " ".join(text[:n])) for i, text in enumerate(words) for n in (7, 8)]
    signed = {r.doc_id: np.frombuffer(r.sketch, "<u2").reshape(near_dedup.BANDS, -1) for r in near_dedup.signatures(docs_of(rows)).collect()}
    assert not any((signed[10 * i + 7] == signed[10 * i + 8]).all(axis=1).any() for i in range(4))
    assert sorted(map(repr, (tuple(r) for r in near_dedup.near_dedup(docs_of(rows)).collect()))) == near_brute(rows)
    assert {r.doc_id for r in corpus_pipeline.near(spark, docs_of(rows), "").collect()} == {7, 17, 27, 37}


@pytest.mark.parametrize("sample", [50_000, 60])
def test_sets_that_may_be_linked_remain(sample, spark, docs_of, monkeypatch):
    """Texts about the threshold, with a part that many share; no bands have linked any."""
    monkeypatch.setattr(near_dedup, "SAMPLE", sample)
    rng = random.Random(8)
    common = [f"c{k}" for k in range(30)]
    bases = [[f"b{i}x{k}" for k in range(rng.choice([8, 30, 90]))] for i in range(40)]
    rows = []
    for i, base in enumerate(bases):
        rows.append((10 * i, " ".join(common[: rng.choice([0, 10, 30])] + base)))
        rows += [(10 * i + e, " ".join(rows[-1][1].split()[: -len(base) // rng.choice([4, 5, 6])] + [f"e{i}x{e}"])) for e in (1, 2) if i % 4]
    signed = near_dedup.signatures(docs_of(rows))
    reps = signed.selectExpr("doc_id AS rep", "doc_id div 2 AS star", "set_hi", "set_lo")
    texts = spark.createDataFrame(rows, "rep long, text string")
    assert bool(len(near_dedup._frequent(texts, reps, 5))) == (sample == 60)
    found = {r.rep for r in near_dedup._not_alone(texts, reps, 5, 75).collect()}
    sets = dict(zip([i for i, _ in rows], shingles.shingle_sets(pa.array([t for _, t in rows])), strict=True))
    wanted = {x for a in sets for b in sets if a // 2 != b // 2 and near_dedup.linked(sets[a], sets[b]) for x in (a, b)}
    assert wanted <= found < set(sets)


@pytest.mark.parametrize("seed", [6, 7])
def test_prefixes_leave_no_link_out(seed, spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(120):  # sizes and overlaps about the threshold, many with a common part
        whole = rng.permutation(40)[: rng.integers(1, 40)] + 100 * rng.integers(3)
        sets.append(np.unique(np.append(whole, np.arange(1000, 1000 + rng.choice([0, 5, 60])))))
    stars = rng.integers(0, 30, len(sets)).tolist()
    listed = spark.createDataFrame([(i, stars[i], len(s), i, s.tolist()) for i, s in enumerate(sets)], "rep long, star long, n long, digest long, shingles array<bigint>")
    found = {(r.a, r.b) for r in near_dedup._by_prefixes(near_dedup._prefixes(listed, 75), 75).collect()}
    assert found >= {(a, b) for b in range(len(sets)) for a in range(b) if stars[a] != stars[b] and near_dedup.linked(sets[a], sets[b])}
    assert all(stars[a] != stars[b] for a, b in found)


def test_prefixes_of_unlinked_members_of_one_template_make_no_pairs(spark):
    """Sets that have more than a seventh for themselves don't meet by what all hold."""
    n = 3000
    listed = spark.range(n).selectExpr("id AS rep", "id AS star", "100L AS n", "id AS digest", "concat(sequence(1L, 80L), transform(sequence(1L, 20L), x -> 1000L + 20L * id + x)) AS shingles")
    prefixes = near_dedup._prefixes(listed, 75)
    assert prefixes.count() == n * 6 and prefixes.agg(F.max("left")).first()[0] == 80
    assert near_dedup._by_prefixes(prefixes, 75).count() == 0


def test_near_of_a_long_text_and_repeated_ids(docs_of):
    long = " ".join(f"w{k * 7919 % 10007}" for k in range(40_000))
    rows = [(1, long), (2, long + " and some more words at the end"), (3, "other text of a few words only here"), (3, long), (4, long.replace("w5", "x5")), (5, "other text of a few words only here")]
    found = {(r.doc_id, r.n_shingles > 100): r.component_id for r in near_dedup.near_dedup(docs_of(rows)).collect()}
    assert found[1, True] == found[2, True] == found[3, True] == 1
    assert found[3, False] == found[5, False]


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 120)] + [(500, 501), (700, 700)], "a long, b long")
    found = {r.node: r.component for r in components.components(links).collect()}
    assert found == {**dict.fromkeys(range(121), 0), 500: 500, 501: 500}


def test_merge_never_loses_order():
    rng = random.Random(5)
    for k in (1, 2, 3, 7):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(30))) for _ in range(k)]
        found = list(string_merge.merged([string_merge.front_coded(r) for r in runs]))
        assert [s for s, *_ in found] == sorted(s for r in runs for s in r)
        before = b""
        for s, shared, run, place in found:
            assert runs[run][place] == s and shared == len(os.path.commonprefix([before, s]))
            before = s


def all_segments(raw, offsets):
    return [np.concatenate(x) for x in zip(*anchors.segments(raw, offsets, 100, 32), strict=True)]


@pytest.mark.parametrize("piece", [1 << 22, 300])
def test_anchors_depend_on_the_window_alone(piece, monkeypatch):
    monkeypatch.setattr(anchors, "PIECE", piece)
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 100, 4000).astype(np.uint8)
    offsets = np.array([0, 1500, 1550, 4000])
    row, first, last, anchor, value = all_segments(raw, offsets)
    seen = {}
    for r, a, b, c, v in zip(row, first, last, anchor, value, strict=True):
        assert offsets[r] <= a <= b <= c <= offsets[r + 1] - 32 and b + 100 <= offsets[r + 1]
        for p in range(a, b + 1):
            window = raw[p : p + 100].tobytes()
            assert seen.setdefault(window, (c - p, v)) == (c - p, v)
    assert len({p for a, b in zip(first, last, strict=True) for p in range(a, b + 1)}) == 1500 - 99 + 2450 - 99


def test_periodic_windows_are_those_that_repeat_a_few_bytes_before():
    rng = random.Random(2)
    for _ in range(60):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            parts = [bytes(rng.choice(b"abc") for _ in range(rng.choice([1, 3, 20, 150]))) for _ in range(rng.randrange(4))]
            parts += [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 19))) * rng.choice([1, 9, 40, 130]) for _ in range(rng.randrange(3))]
            rng.shuffle(parts)
            texts.append(b"".join(parts))
        raw = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        found = {p for lo, hi in anchors.periodic(raw, offsets, 100).tolist() for p in range(lo, hi + 1)}
        expected = set()
        for t, base in zip(texts, offsets.tolist(), strict=False):
            expected |= {base + j for j in range(len(t) - 99) for p in range(1, 17) if j >= p and t[j : j + 100] == t[j - p : j - p + 100]}
        assert found == expected


def test_a_long_text_of_one_letter_has_few_segments():
    raw = np.full(5_000_000, 120, np.uint8)
    assert len(all_segments(raw, np.array([0, len(raw)]))[0]) == 1
    raw = np.frombuffer(b"ab" * 2_500_000, np.uint8)
    assert len(all_segments(raw, np.array([0, len(raw)]))[0]) <= 2


def substring_brute(rows, length):
    """Documents in order of id, each with its result."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw, covered = t.encode(), bytearray(len(t.encode()))
        for p in range(len(raw) - length + 1):
            window = raw[p : p + length]
            if window in seen:
                covered[p : p + length] = b"\1" * length
            seen.add(window)
        spans = len(re.findall(b"\1+", bytes(covered)))
        kept = bytes(c for c, x in zip(raw, covered, strict=True) if not x)
        out[i] = (len(raw), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


def substring_found(docs, **options):
    rows = substring_dedup.repeats(docs, **options).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    return [(r[0], tuple(r)[1:]) for r in rows.collect()]


@pytest.mark.parametrize("options", [{}, {"run_bytes": 2000, "bucket_bytes": 1000}, {"hot": 2, "run_bytes": 3000}])
def test_substrings(options, docs_of):
    rng = random.Random(len(options))
    passages = ["".join(rng.choice("abcdé \n") for _ in range(rng.choice([30, 99, 100, 101, 400]))) for _ in range(6)] + ["ab" * 150, "x" * 260]
    rows = [(i, "".join(rng.choice(passages + ["".join(rng.choice("abcd") for _ in range(80))]) for _ in range(rng.randrange(5)))) for i in rng.sample(range(900), 40)]
    assert dict(substring_found(docs_of(rows).repartition(5), **options)) == substring_brute(rows, 100)


@pytest.mark.parametrize("options", [{}, {"hot": 20}])
def test_substrings_at_the_edges_of_a_passage_in_all_documents(options, docs_of):
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(220)
    rows = [(i, noise(60) + passage[: rng.choice([220, 150])] + noise(60)) for i in range(150)]
    assert dict(substring_found(docs_of(rows).repartition(4), **options)) == substring_brute(rows, 100)


def test_substrings_of_texts_of_one_letter(docs_of):
    rows = [(1, "x" * 5_000_000), (2, "y" * 300 + "x" * 150), (3, "xy" * 400_000)]
    found = dict(substring_found(docs_of(rows)))
    assert found[1][:3] == (5_000_000, 5_000_000 - 1, 1) and found[3][1] == 800_000 - 2
    assert found[2][:3] == (450, 449, 1)


def test_a_group_of_strings_with_one_anchor():
    """Pairs and larger groups give the windows that a table of all windows gives."""
    rng = random.Random(8)
    for size in (2, 3, 6, 7, 20):
        for _ in range(30):
            texts, strings = {}, set()
            for k in range(size):
                left, right = rng.randrange(69), rng.randrange(32, 101)
                if left + right < 100:
                    continue
                before = "".join(rng.choice("ab") if rng.random() < 0.05 else "a" for _ in range(left))
                after = "g" * 32 + "".join(rng.choice("ab") if rng.random() < 0.05 else "a" for _ in range(right - 32))
                string = (after + before[::-1]).encode() + left.to_bytes(2, "big")
                if string not in strings:
                    strings.add(string)
                    texts[string] = (before + after, left, (k * 7 % 5, 0, 1000 * k))
            group, last = [], b""
            for s in sorted(texts):
                group.append([s, texts[s][1], texts[s][2], string_merge.common_prefix(last, s)])
                last = s
            found = []
            substring_dedup._compare(group, 100, found)
            first, expected = {}, set()
            windows = [(place[0], place[2] + p, text[p : p + 100]) for text, _, place in texts.values() for p in range(len(text) - 99)]
            for doc, start, window in sorted(windows):
                if window in first and first[window] != (doc, start):
                    expected |= {(doc, start + q) for q in range(100)}
                first.setdefault(window, (doc, start))
            assert {(doc, q) for doc, _, a, b in found for q in range(a, b)} == expected


def test_substrings_of_real_documents(real):
    rows = text_rows(real)
    assert dict(substring_found(real)) == substring_brute(rows, 100)


def test_substrings_of_odd_rows(odd, clashing, docs_of):
    found = substring_found(odd)
    assert len(found) == odd.count()
    long = [x for i, x in found if i == 7][0]
    assert long[1] >= long[0] - 110 and all(x[1] == 0 for i, x in found if i in (1, 2, 3, 4, 5))
    assert len(substring_found(clashing)) == 3 and substring_found(docs_of([])) == []
    same = "the same long passage " * 10
    twice = dict(substring_found(docs_of([(None, same), (3, same), (5, same), (5, same)])))
    assert twice[3][1] < twice[5][1] == len(same) == twice[None][1]
