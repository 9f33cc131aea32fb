"""Joins with a local base against plain loops."""

import random
from collections import defaultdict

import pytest

from quarrylens.operators import fingerprints, folders, hamming

SIGNED = 1 << 63


def signed(x):
    return x - (1 << 64) if x >= SIGNED else x


def clustered(seed, n):
    """Hashes with near ones, equal ones, ones that share many bits, and nulls."""
    rng = random.Random(seed)
    out = [None, None]
    while len(out) < n:
        h = rng.getrandbits(64) if rng.random() < 0.5 else (0xABCD << 48 | rng.getrandbits(16))
        out.append(signed(h))
        for _ in range(rng.randrange(4)):
            for bit in rng.sample(range(64), rng.randrange(1, 7)):
                h ^= 1 << bit
            out.append(signed(h))
    return out + out[:20]


def bits(a, b):
    return ((a ^ b) & ((1 << 64) - 1)).bit_count()


@pytest.mark.parametrize(("within", "hot"), [(1, 1_000_000), (3, 1_000_000), (3, 40), (6, 40), (9, 1)])
def test_near_hashes(within, hot, spark):
    left, right = clustered(1, 250), clustered(2, 150) + clustered(1, 250)[5:60]
    frame = lambda rows: spark.createDataFrame([(h, "x" if k % 3 else "y") for k, h in enumerate(rows)], "hash long, kind string")
    both = hamming.near_hashes(frame(left), frame(right), within, hot_pairs=hot).collect()
    want = {(a, b, bits(a, b)) for a in set(left) - {None} for b in set(right) - {None} if bits(a, b) <= within}
    assert len(both) == len(want) and {tuple(r) for r in both} == want
    alone = hamming.near_hashes(frame(left), within=within, hot_pairs=hot).collect()
    own = sorted(set(left) - {None})
    want = {(a, b, bits(a, b)) for a in own for b in own if a < b and bits(a, b) <= within}
    assert len(alone) == len(want) and {tuple(r) for r in alone} == want
    kinds = hamming.near_hashes(frame(left), frame(right), within, by=("kind",), hot_pairs=hot).collect()
    of = lambda rows: {(h, "x" if k % 3 else "y") for k, h in enumerate(rows) if h is not None}
    assert {tuple(r) for r in kinds} == {(k, a, b, bits(a, b)) for a, k in of(left) for b, m in of(right) if k == m and bits(a, b) <= within}


def test_a_slice_that_all_share_is_split(spark):
    """Rows met are far fewer than all pairs."""
    rng = random.Random(3)
    hashes = spark.createDataFrame([(signed(0xFFFF << 48 | rng.getrandbits(48)),) for _ in range(3000)], "hash long")
    found = hamming.near_hashes(hashes, within=3, hot_pairs=10_000)
    assert found.count() <= 5
    with pytest.raises(ValueError):
        hamming.near_hashes(hashes, within=0)


def line_loop(found, base, n_lines, min_hits, min_lines, gap, best):
    ours, known = defaultdict(lambda: defaultdict(set)), defaultdict(lambda: defaultdict(set))
    for p, line, h in found:
        ours[p][h].add(line)
    for p, line, h in base:
        known[p][h].add(line)
    rows = []
    for path, hashes in ours.items():
        entries = []
        for kb, theirs in known.items():
            diagonals = defaultdict(list)
            for h in hashes.keys() & theirs.keys():
                there = sorted(theirs[h])
                for k, line in enumerate(sorted(hashes[h])):
                    diagonals[there[min(k, len(there) - 1)] - line].append(line)
            ranges = []
            for apart, lines in diagonals.items():
                runs = []
                for line in sorted(lines):
                    if runs and line - runs[-1][-1] <= gap:
                        runs[-1].append(line)
                    else:
                        runs.append([line])
                ranges += [(r[0], r[-1], apart, len(r)) for r in runs if len(r) >= min_hits and r[-1] - r[0] + 1 >= min_lines]
            if not ranges:
                continue
            covered = sorted({x for a, b, _, _ in ranges for x in range(a, b + 1)})
            joint = []
            for x in covered:
                if joint and x == joint[-1][1] + 1:
                    joint[-1][1] = x
                else:
                    joint.append([x, x])
            oss = sorted({(a + d, b + d) for a, b, d, _ in ranges})
            shown = lambda pairs: ",".join(f"{a}-{b}" for a, b in pairs)
            entries.append((-sum(r[3] for r in ranges), -len(covered), kb, shown(joint), shown(oss)))
        for rank, (hits, n, kb, lines, oss) in enumerate(sorted(entries)[:best], 1):
            rows.append((path, kb, -hits, lines, oss, f"{100 * -n // n_lines[path]}%", rank))
    return sorted(rows)


@pytest.mark.parametrize(("min_hits", "min_lines", "gap", "best"), [(1, 1, 1, None), (2, 3, 4, 2), (1, 1, 8, 1)])
def test_line_ranges(min_hits, min_lines, gap, best, spark):
    rng = random.Random(5)
    kb = [(f"kb{f}", line, f"h{rng.randrange(60)}") for f in range(6) for line in range(1, 40) if rng.random() < 0.7]
    found, n_lines = [], {}
    for f in range(12):
        path, line = f"f{f}", 1
        while line < 80:
            kind = rng.random()
            if kind < 0.5:  # lines of an entry, perhaps with some in between
                source, at = rng.choice(kb)[:2]
                for p, there, h in kb:
                    if p == source and at <= there < at + 9:
                        found.append((path, line + there - at + rng.choice([0, 0, 0, 1]), h))
                line += 10
            else:
                found += [(path, line, f"h{rng.randrange(90)}")] * rng.choice([1, 2])
                line += rng.randrange(1, 6)
        n_lines[path] = 100
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} string, line int, hash string")
    got = fingerprints.line_matches(frame(found, "path"), frame(kb, "kb_path"), spark.createDataFrame(list(n_lines.items()), "path string, n_lines int"), min_hits, min_lines, gap, best)
    assert sorted(tuple(r) for r in got.collect()) == line_loop(found, kb, n_lines, min_hits, min_lines, gap, best)


def test_line_ranges_of_repeated_lines_are_linear(spark):
    """Five hundred equal lines on either side are five hundred hits."""
    found = spark.createDataFrame([("a", k, "h") for k in range(1, 501)], "path string, line int, hash string")
    got = fingerprints.line_matches(found, found.withColumnRenamed("path", "kb_path"), spark.createDataFrame([("a", 500)], "path string, n_lines int")).first()
    assert (got.hits, got.lines, got.oss_lines, got.matched) == (500, "1-500", "1-500", "100%")
    none = fingerprints.line_matches(found, found.withColumnRenamed("path", "kb_path").selectExpr("kb_path", "line", "concat(hash, 'x') AS hash"), spark.createDataFrame([("a", 500)], "path string, n_lines int"))
    assert none.count() == 0


def test_folder_matches(spark):
    h = lambda x: f"{x:x}"
    ours = [(".", h(0xF0F0), h(1), None), ("a", h(0xFFFF), h(2), h(3)), ("a/b", h(0xFFFF), h(2), h(3)), ("c", h(1 << 63), None, None), ("d", None, None, None)]
    base = [("k1", h(0xFFFF), h(2), h(3)), ("k2", h(0xFFFE), h(3), h(3)), ("k3", h(0xF0F1), h(7), h(1 << 62)), ("k4", h((1 << 64) - 1), None, None)]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} string, sim_hash_names string, sim_hash_dir_names string, sim_hash_content string")
    got = {(r.dir, r.kb_dir): (r.n_hashes, r.distance, round(r.score, 4), r["rank"]) for r in folders.folder_matches(frame(ours, "dir"), frame(base, "kb_dir"), within=4).collect()}
    # "a" has a sure match, which answers for "a/b"; "." has none of that score; a hash alone is worth a third
    assert got == {("a", "k1"): (3, 0, 1.0, 1), ("a", "k2"): (3, 2, 0.9896, 2), (".", "k3"): (2, 3, round((2 - 3 / 64) / 3, 4), 1), (".", "k1"): (1, 2, round((1 - 2 / 64) / 3, 4), 3), (".", "k2"): (1, 1, round((1 - 1 / 64) / 3, 4), 2), ("a", "k3"): (2, 5, round((2 - 5 / 64) / 3, 4), 3)}
