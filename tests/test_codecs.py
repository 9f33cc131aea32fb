import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarrylens.functions import codecs

CHECK = b"123456789"


def test_published_check_values():
    assert codecs.crc32c(CHECK) == 0xE3069283
    assert codecs.crc64(CHECK) == 0x995DC9BBDF1939FA
    assert codecs.crc8(CHECK) == 0xA1
    assert codecs.fnv1(b"foobar") == 0x340D8765A4DDA9C2
    assert codecs.fnv1_all([b"foobar", b"", b"a"]).tolist() == [codecs.fnv1(b"foobar"), codecs.FNV_BASIS, codecs.fnv1(b"a")]


def winnow_loop(content):
    """The same byte by byte."""
    out, grams, hashes, line, last = [], [], [], 1, None
    for byte in content:
        if byte == 10:
            line += 1
        c = chr(byte)
        if not (c.isascii() and c.isalnum()):
            continue
        grams.append(ord(c.lower()))
        if len(grams) >= 30:
            hashes.append(codecs.crc32c(bytes(grams[-30:])))
            if len(hashes) >= 64:
                least = min(hashes[-64:])
                if least != last:
                    out.append((line, codecs.crc32c(least.to_bytes(4, "little"))))
                    last = least
    return out


@pytest.mark.parametrize("seed", range(6))
def test_winnowing_is_that_of_a_loop(seed, monkeypatch):
    monkeypatch.setattr(codecs, "PIECE", 97)
    rng = random.Random(seed)
    alphabet = ["abcdefgh \n", "aA0\n-", "a", "xyzé\r\n_;{}"][seed % 4]
    content = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 50, 92, 93, 400, 1500]))).encode()
    lines, values = codecs.winnow(content)
    assert list(zip(lines.tolist(), values.tolist(), strict=True)) == winnow_loop(content)


def test_line_hashes():
    assert codecs.line_hashes(b"") == ""
    assert codecs.line_hashes(b"no line feed") == ""
    assert codecs.line_hashes(b"\nabc\n") == f"{codecs.crc8(b'abc'):02x}"
    assert codecs.line_hashes(b"-\nAb;c\n\n--\nrest") == "ff" + f"{codecs.crc8(b'abc'):02x}" + "ff" + "00"
    assert codecs.strip_line_hashes("00a1ff00a1", ["a1"]) == "005eff005e"
    assert codecs.strip_line_hashes("00a1", ["bb", ""]) == "00a1"


def test_snippet_strip():
    text = "file=x,1,a\n3=aaaaaaaa,bbbbbbbb\n4=aaaaaaaa\n5=cccccccc,aaaaaaaa,dddddddd\n"
    assert codecs.strip_snippets(text, ["aaaaaaaa"]) == "file=x,1,a\n3=bbbbbbbb\n5=cccccccc,dddddddd\n"


def test_line_ends():
    assert codecs.opposite_line_ends(b"abc") is None
    assert codecs.opposite_line_ends(b"a\r\nb\r\n") == b"a\nb\n"
    for mixed in (b"a\nb\n", b"a\rb\r", b"a\r\nb\n"):
        assert codecs.opposite_line_ends(mixed) == b"a\r\nb\r\n"


def test_simhash_and_shingles():
    assert codecs.simhash(np.zeros(0, np.uint64)) == (1 << 64) - 1
    assert codecs.simhash(np.array([5], np.uint64)) == 5
    words = codecs.word_features(b"It's HTTP://a.b/c now")
    assert words == [b"it's", b"http://a.b/c", b"now"]
    assert codecs.shingles(words, 2) == [b"it's http://a.b/c", b"http://a.b/c now"]
    assert codecs.shingles(words, 9) == [b"it's http://a.b/c now"]
    with pytest.raises(ValueError):
        codecs.shingles(words, 0)


@pytest.mark.parametrize(
    ("path", "text", "expected"),
    [
        ("a.py", "#!/bin/x\n# licence\n\nimport os\nfrom a import (\n  b,\n)\nx = 1\n", 7),
        ("a.py", '"""Doc.\nmore\n"""\nx = 1\n', 3),
        ("a.c", "/* licence\n more */\n#include <x.h>\nint a;\n", 3),
        ("a.go", 'package a\nimport (\n "fmt"\n)\nfunc f() {}\n', 4),
        ("a.lua", "-- c\nlocal a = require('b')\nprint(1)\n", 2),
        ("a.js", "import a from 'b';\nconst c = require('c');\nrun();\n", 2),
        ("a.unknown", "# x\ncode\n", 0),
        ("a.py", "# only comments\n", 0),
        ("noext", "code", 0),
    ],
)
def test_header_offset(path, text, expected):
    assert codecs.header_offset(path, text) == expected
    assert codecs.header_offset(path, text, limit=1) == min(expected, 1)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300))
def test_rolling_checksum_is_the_plain_one(data):
    found = codecs.rolling_crc32c(np.frombuffer(data, np.uint8), 5)
    assert found.tolist() == [codecs.crc32c(data[i : i + 5]) for i in range(max(0, len(data) - 4))]


def test_words_of_both_forms():
    assert codecs.unicode_features("É-x don't") == re.findall(r"[\w'-]+", "é-x don't")
