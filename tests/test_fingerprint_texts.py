"""Fingerprint texts, folder hashes and batches against plain loops written here."""

import json
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quarrylens.functions import columns as C
from quarrylens.functions import codecs, udfs
from quarrylens.operators import batching, filters, fingerprints, folders
from quarrylens.plans import catalog
from quarrylens.sources import inputs


def crc_bits(data, polynomial, start, final):
    value = start
    for byte in data:
        for k in range(8):
            bit = byte >> k & 1
            value = value >> 1 ^ (polynomial if (value ^ bit) & 1 else 0)
    return value ^ final


def crc32c(data):
    return crc_bits(data, 0x82F63B78, 0xFFFFFFFF, 0xFFFFFFFF)


def plain_lines(content):
    """Hash lines of a file, byte by byte."""
    out, grams, window, last, last_line, line = [], b"", [], None, 0, 1
    for byte in content:
        line += byte == 10
        c = chr(byte).lower()
        if not (byte < 128 and c.isalnum()):
            continue
        grams = (grams + c.encode())[-30:]
        if len(grams) == 30:
            window = [*window, crc32c(grams)][-64:]
            if len(window) == 64 and min(window) != last:
                last = min(window)
                value = f"{crc32c(last.to_bytes(4, 'little')):08x}"
                if line == last_line:
                    out[-1][1].append(value)
                else:
                    out.append((line, [value]))
                last_line = line
    return [(n, f"{n}={','.join(h)}") for n, h in out]


def text_of(seed, size=900):
    rng = random.Random(seed)
    return "".join(rng.choice("abcdefghij klmnop\n.;") for _ in range(size))


def test_texts_within_a_limit_and_without_headers(spark):
    texts = {f"src/f{k}.py": ("# licence\nimport os\n\n" if k % 2 else "") + text_of(k) for k in range(4)} | {"short.py": "x\n", "l.json": text_of(9), "it's\n.py": text_of(5)}
    files = spark.createDataFrame(list(texts.items()), "path string, text string")
    run = lambda **k: {r.path: r.wfp for r in fingerprints.wfp_blocks(files, **k).collect()}
    plain, capped, headless = run(), {m: run(max_bytes=m) for m in (0, 130, 250, 400, 10**6)}, run(skip_headers=True)
    import hashlib

    for path, text in texts.items():
        raw = text.encode()
        head = f"file={hashlib.md5(raw).hexdigest()},{len(raw)},{repr(path).strip(chr(39))}\nfh2={hashlib.md5(raw.replace(b'\n', b'\r\n')).hexdigest()}\n"
        lines = plain_lines(raw) if not path.endswith("json") and len(text) > 256 else []
        assert plain[path] == head + "".join(t + "\n" for _, t in lines), path
        for limit, found in capped.items():
            expected = head
            for k, (_, t) in enumerate(lines):
                if (len(expected) + len(t) >= limit) if k == len(lines) - 1 else (len(expected) + len(t) > limit):
                    break
                expected += t + "\n"
            assert found[path] == expected, (path, limit)
        offset = 3 if text.startswith("# licence") else 0
        late = [t for n, t in lines if n > offset]
        assert headless[path] == (head + (f"start_line={offset}\n" if offset and late else "") + "".join(t + "\n" for t in late)), path


def test_hashes_are_stripped_only_where_found():
    wfp = "file=a,1,p,,q\n4=aaaa,bbbb\n5=aaaa\n"
    assert codecs.strip_snippets(wfp, ["zzzz", ""]) == wfp
    assert codecs.strip_snippets(wfp, ["aaaa"]) == "file=a,1,p,q\n4=bbbb\n"
    assert codecs.strip_snippets(wfp, ["bbbb"]) == "file=a,1,p,q\n4=aaaa\n5=aaaa\n"


def test_checksums_and_line_hashes_of_many_at_once():
    rng = random.Random(3)
    parts = [rng.randbytes(rng.choice([0, 1, 7, 8, 9, 255, 256, 257, 700])) for _ in range(60)]
    assert codecs.crc_all(parts, *codecs.CRC32C).tolist() == [crc32c(p) for p in parts]
    assert codecs.crc_all(parts, *codecs.CRC64).tolist() == [crc_bits(p, 0xC96C5795D7870F42, (1 << 64) - 1, (1 << 64) - 1) for p in parts]
    assert codecs.crc_all(parts, *codecs.CRC8).tolist() == [crc_bits(p, 0x8C, 0, 0) for p in parts]
    assert codecs.line_hashes_all([b"", b"\n", b".\n", b"\n\n", b"aB\n..\n\n\nx", b"a"]) == ["", "", "ff", "ff", f"{crc_bits(b'ab', 0x8C, 0, 0):02x}00ffff", ""]


def test_a_long_word_takes_no_more_than_its_bytes(spark):
    long = b"x" * 1_000_000
    values = codecs.fnv1_all([long, *[b"abc"] * 4000])
    assert values[0] == codecs.fnv1(long) and set(values[1:].tolist()) == {codecs.fnv1(b"abc")}
    found = spark.createDataFrame([("y" * 1_000_000 + " abc",)], "t string").select(udfs.simhash_words("t")).first()[0]
    assert found is not None


def test_shingles_of_a_long_text(spark):
    text = " ".join(f"w{zlib.crc32(str(k).encode()) % 5000}" for k in range(20_000))
    words = text.split()
    found = spark.createDataFrame([(text,), ("a b",), ("",)], "t string").select(F.size(F.array_distinct(C.shingles(C.word_features(F.col("t")), 3)))).collect()
    assert [r[0] for r in found] == [len({tuple(words[i : i + 3]) for i in range(len(words) - 2)}), 1, 0]


@pytest.mark.parametrize("lane_files", [1, 40, 1000, 10**6])
def test_batches_are_those_of_one_run(spark, lane_files):
    rng = random.Random(5)
    files = [(k * 3, rng.choice([1, 50, 300, 2000]), ["a", "b"][k // 3000 % 2] if k % 500 else None) for k in range(12_000)]
    rows = spark.createDataFrame(files, "file_ord long, size long, context string")
    for limits in ({"max_bytes": 2000, "max_files": 5}, {"max_bytes": 10**9, "max_files": 32}):
        expected = batching.cut([f[1] for f in files], [f[2] or "" for f in files], **limits)
        found = sorted((r.file_ord, r.batch_id) for r in batching.batches(rows, lane_files=lane_files, **limits).collect())
        assert [b for _, b in found] == expected


def test_batches_of_nothing(spark):
    assert batching.batches(spark.createDataFrame([], "file_ord long, size long, context string")).count() == 0


def plain_folder_hashes(files, depth):
    below = {}
    for path, text in files:
        parts = path.split("/")
        for n in range(min(depth, len(parts))):
            below.setdefault("/".join(parts[:n]) or ".", []).append((path, text))

    def simhash(words):
        values = [codecs.fnv1(w) for w in words]
        return f"{sum(1 << b for b in range(64) if sum(1 if v >> b & 1 else -1 for v in values) >= 0):x}"

    find = lambda names: re.findall(rb"[\w']+(?:\://[\w\./]+){0,1}", " ".join(sorted(names)).encode().lower())
    out = {}
    for folder, inside in below.items():
        names = [p.rpartition("/")[2] for p, _ in inside]
        if len(names) < 8 or len("".join(names).encode()) < 32:
            out[folder] = (None, None, None)
            continue
        stems = {n[: n.rindex(".")] if n.rfind(".") > 0 else n for n in names}
        dirs = {x for p, _ in inside for x in p.split("/")[:-1]} - {"", ".", ".."}
        keys = [crc_bits(t.encode(), 0xC96C5795D7870F42, (1 << 64) - 1, (1 << 64) - 1).to_bytes(8, "big") for _, t in inside]
        out[folder] = simhash(find(stems)), simhash(find(dirs)), simhash(keys)
    return out


def test_folder_hashes_by_the_loop(spark):
    trees = [
        [(f"d{k}/main.c", f"text {k}") for k in range(8)],  # one name eight times: 48 bytes in all
        [(f"src/{a}/{b}/file_{a}{b}.py", "x" * 9) for a in "ab" for b in "abcd"],  # folder names that repeat on other ways
        [(f"x{k}", "") for k in range(9)],  # too few bytes of names
        [(f"lib/some.name-{k}.tar.gz", str(k)) for k in range(9)] + [("lib/sub dir/it's://here.c", "z")],
    ]
    for tree in trees:
        rows = spark.createDataFrame([(p, t, len(t)) for p, t in tree], "path string, text string, size long")
        found = {r.dir: (r.sim_hash_names, r.sim_hash_dir_names, r.sim_hash_content) for r in folders.folder_simhashes(rows, depth=3).collect()}
        assert found == plain_folder_hashes(tree, 3)


def test_queries_on_fingerprints_by_the_loop(spark, sf_dir):
    """The queries without SQL over all small documents."""
    texts = {r.path: r.text for r in inputs.files(spark, sf_dir).collect()}
    rows = spark.createDataFrame(list(texts.items()), "path string, text string")
    made = {r.path for r in rows.filter(filters.snippets_made(F.col("path"), F.col("text"))).collect()}
    wfp = {r.path: r.wfp for r in catalog.queries()["B8_wfp_blocks"](spark, sf_dir).collect()}
    for path in sorted(texts)[:40]:
        lines = plain_lines(texts[path].encode()) if path in made else []
        assert [x for x in wfp[path].split("\n") if re.match(r"\d+=", x)] == [t for _, t in lines]
        assert ("\nhpsm=" in wfp[path]) == bool(path in made and "\n" in texts[path].lstrip("\n"))
    batches = sorted((r.first_file, r.n_files, r.n_bytes) for r in catalog.queries()["G_batches"](spark, sf_dir).collect())
    assert sum(b[1] for b in batches) == len(texts) and all(b[1] <= 33 for b in batches)


def test_folder_documents_hold_their_children(spark):
    tree = [(f"src/{a}/file_number_{a}{b}.py", "x" * b) for a in "ab" for b in range(1, 10)] + [("README", "r")]
    rows = spark.createDataFrame([(p, t, len(t)) for p, t in tree], "path string, text string, size long")
    found = {r.dir: json.loads(r.json) for r in folders.folder_documents(rows, depth=3).collect()}
    root = found["."]
    assert [c["path_id"] for c in root["children"]] == ["src"] and [c["path_id"] for c in root["children"][0]["children"]] == ["src/a", "src/b"]
    assert root["children"][0] == found["src"] and found["src/a"]["lang_extensions"] == {"py": 9} and found["src/a"]["children"] == []
    assert root["sim_hash_content"] and json.loads(folders.folder_documents(rows, depth=1).first().json)["children"] == []


def test_strips_against_loops(spark, sf_dir):
    """D7: what a strip makes of line hashes; and fingerprint texts with line hashes are those without, and a line more."""
    queries = catalog.queries

    def inverted(hashes, removed):
        for gone in removed:
            places = [k for k in range(len(hashes)) if hashes[k : k + len(gone)] == gone]
            if not places:
                continue
            low, high = places[0] // 2 * 2, -(-(places[0] + len(gone)) // 2) * 2
            piece = hashes[low:high]
            flipped, out, k = bytes(255 - x for x in bytes.fromhex(piece)).hex(), "", 0
            while k < len(hashes):
                hit = hashes[k : k + len(piece)] == piece
                out, k = (out + flipped, k + len(piece)) if hit else (out + hashes[k], k + 1)
            hashes = out
        return hashes

    plain = {r[0]: r[1] for r in queries()["D6_hpsm_lines"](spark, sf_dir).collect()}
    found = {r[0]: r[1] for r in queries()["D7_hpsm_strip"](spark, sf_dir).collect()}
    assert found == {p: inverted(h, ["ff", "00a1"]) for p, h in plain.items()} and found != plain

    texts = {r[0]: r[1] for r in queries()["B8_wfp_blocks"](spark, sf_dir).collect()}
    blocks = {r.path: r.wfp for r in fingerprints.wfp_blocks(inputs.files(spark, sf_dir)).collect()}
    assert {p: "".join(x for x in t.splitlines(True) if not x.startswith("hpsm=")) for p, t in texts.items()} == blocks


@pytest.mark.parametrize("name", ["a.py", "a.c", "a.js", "a.go", "a.rs", "a.lua", "a.java", "a.rb", "a.txt", "a", "b/.py"])
def test_header_offsets_against_a_loop(name):
    """D12: a second reading of the rules, by regular expressions on what is left of the text."""
    from quarrylens.functions.fixed_values import IMPORTS, SUFFIX_LANGUAGE

    base = name.rpartition("/")[2]
    language = SUFFIX_LANGUAGE.get(base[base.rfind(".") :].lower()) if base.rfind(".") > 0 else None
    style = {"python": "#", "ruby": "#", "perl": "#", "r": "#", "lua": "--", "haskell": "--"}.get(language, "//")
    begin, end = {"//": ("/*", "*/"), "--": ("--[[", "]]"), "#": (None, '"""')}[style]

    def offset(text):
        if language is None:
            return 0
        lines, k = text.splitlines(), 0
        comment = brackets = False
        while k < len(lines):
            line = lines[k].strip()
            if line and not (k == 0 and line.startswith("#!")):
                if comment:
                    comment = not line.endswith(end)
                elif line.startswith(style):
                    pass
                elif begin and line.startswith(begin):
                    comment = not line.endswith(end)
                elif begin is None and line.count('"""') in (1, 2):
                    comment = line.count('"""') == 1
                elif brackets:
                    brackets = not (set(line) & set(")}"))
                elif any(re.match(p, lines[k]) for p in IMPORTS[language]):
                    brackets = ("(" in line and ")" not in line) or ("{" in line and "}" not in line)
                else:
                    return k
            k += 1
        return 0

    rng = random.Random(name)
    pieces = ["#!/bin/sh", "", "  ", "# note", "// note", "-- note", "/* open", "middle", "close */", "/* one line */", "--[[ open", "close ]]", '"""doc', 'doc"""', '"""one"""', "import os", "from a import (", "  b,", ")", "import (", '"fmt"', "#include <a.h>", "use a::{", "}", "require 'x'", "local a = require(\"b\")", "import { a } from 'b';", "package x", "x = 1", "int main() {", "\tindented"]
    for _ in range(1500):
        text = rng.choice(["\n", "\n", "\r\n"]).join(rng.choice(pieces[:-3] if rng.random() < 0.85 else pieces) for _ in range(rng.randrange(14)))
        assert codecs.header_offset(name, text) == offset(text), text
        assert codecs.header_offset(name, text, 2) == min(2, offset(text))
