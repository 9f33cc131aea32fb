"""Checksums, winnowing, line hashes, simhash and header offsets on bytes, with numpy.

Pure functions, without Spark; :mod:`.udfs` makes columns of them.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np

from quarrylens.functions.fixed_values import GRAM, IMPORTS, SUFFIX_LANGUAGE, WINDOW

FNV_BASIS, FNV_PRIME = 0xCBF29CE484222325, 0x100000001B3
MASK64 = (1 << 64) - 1
#: Bytes of a text that winnowing looks at at a time; neighbouring pieces overlap by what is needed.
PIECE = 1 << 16


@functools.lru_cache(maxsize=4)
def reflected_table(polynomial: int, bits: int) -> np.ndarray:
    """Byte table of a reflected CRC of up to 64 bits."""
    table = np.arange(256, dtype=np.uint64)
    for _ in range(8):
        table = np.where(table & np.uint64(1), (table >> np.uint64(1)) ^ np.uint64(polynomial), table >> np.uint64(1))
    return table & np.uint64((1 << bits) - 1)


@functools.lru_cache(maxsize=4)
def _as_ints(polynomial: int, bits: int) -> list[int]:
    return reflected_table(polynomial, bits).tolist()


def crc(data: bytes, polynomial: int, bits: int, start: int, final: int) -> int:
    table = _as_ints(polynomial, bits)
    value = start
    for byte in data:
        value = table[(value ^ byte) & 0xFF] ^ (value >> 8)
    return value ^ final


#: Polynomial, bits, start and final value of the checksums (fixed values).
CRC32C = (0x82F63B78, 32, 0xFFFFFFFF, 0xFFFFFFFF)
CRC64 = (0xC96C5795D7870F42, 64, MASK64, MASK64)
CRC8 = (0x8C, 8, 0, 0)


def crc32c(data: bytes) -> int:
    return crc(data, *CRC32C)


def crc64(data: bytes) -> int:
    return crc(data, *CRC64)


def crc8(data: bytes) -> int:
    return crc(data, *CRC8)


#: Bytes of a column of :func:`crc_all`, strings taken at a time, and below how many strings a loop over bytes is as fast.
STRIDE, CRC_PIECE, FEW = 256, 4 << 20, 8


@functools.lru_cache(maxsize=8)
def _stride_tables(polynomial: int, bits: int) -> np.ndarray:
    """Byte tables whose sum (by xor) moves a state past ``STRIDE`` zero bytes."""
    table = reflected_table(polynomial, bits)
    states = np.concatenate([np.arange(256, dtype=np.uint64) << np.uint64(8 * k) for k in range(bits // 8)])
    for _ in range(STRIDE):
        states = table[states & np.uint64(0xFF)] ^ (states >> np.uint64(8))
    return states.reshape(bits // 8, 256)


def crc_all(parts: list[bytes], polynomial: int, bits: int, start: int, final: int) -> np.ndarray:
    """The checksum of every string.

    A CRC is linear, and zeros before a string whose state is 0 change nothing. So strings get zeros in front up to whole
    strides (with the start value added to their first bytes), all strides are done side by side, and their states are joined
    from left to right, again side by side for all strings. Strings are taken in pieces of bounded size."""
    out = np.zeros(len(parts), np.uint64)
    sizes = np.array([len(p) for p in parts], np.int64)
    width = bits // 8
    for i in np.flatnonzero(sizes < width).tolist():
        out[i] = crc(parts[i], polynomial, bits, start, final)
    at = np.flatnonzero(sizes >= width)
    piece = np.cumsum(sizes[at]) // CRC_PIECE
    for which in np.split(at, np.flatnonzero(np.diff(piece)) + 1) if len(at) else []:
        out[which] = _crc_piece([parts[i] for i in which.tolist()], polynomial, bits, start) ^ np.uint64(final)
    return out


def _crc_piece(parts: list[bytes], polynomial: int, bits: int, start: int) -> np.ndarray:
    sizes = np.array([len(p) for p in parts])
    strides = -(-sizes // STRIDE)
    ends = np.cumsum(strides)
    raw = np.zeros(int(ends[-1]) * STRIDE, np.uint8)
    width = bits // 8
    for p, end in zip(parts, (ends * STRIDE).tolist(), strict=True):
        raw[end - len(p) : end] = np.frombuffer(p, np.uint8)
        raw[end - len(p) : end - len(p) + width] ^= np.frombuffer(start.to_bytes(width, "little"), np.uint8)
    columns = np.ascontiguousarray(raw.reshape(-1, STRIDE).T).astype(np.uint64)
    table = reflected_table(polynomial, bits)
    states = np.zeros(columns.shape[1], np.uint64)
    for column in columns:
        states = table[(states ^ column) & np.uint64(0xFF)] ^ (states >> np.uint64(8))
    tables = _stride_tables(polynomial, bits)

    def moved(value):
        out = np.zeros(len(value), np.uint64)
        for k in range(width):
            out ^= tables[k][(value >> np.uint64(8 * k)) & np.uint64(0xFF)]
        return out

    rows, lists = tables.tolist(), [states[e - n : e] for e, n in zip(ends.tolist(), strides.tolist(), strict=True)]

    def moved_one(value: int) -> int:
        out = 0
        for k in range(width):
            out ^= rows[k][(value >> 8 * k) & 0xFF]
        return out

    return _folded(lists, np.zeros(len(parts), np.uint64), lambda value, x: moved(value) ^ x, lambda value, x: moved_one(value) ^ x)


def _folded(lists: list[np.ndarray], values: np.ndarray, step, step_one) -> np.ndarray:
    """``step`` over the items of every list, for all lists at once; the last ``FEW``, which are the longest, in a loop."""
    sizes = np.array([len(x) for x in lists], np.int64)
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate([lists[i] for i in order.tolist()]) if len(lists) else np.zeros(0, np.uint64)
    sizes = sizes[order]
    begins = np.cumsum(sizes) - sizes
    out = values[order]
    shared = int(sizes[FEW]) if len(sizes) > FEW else 0
    active = np.searchsorted(-sizes, -np.arange(shared), "left")
    for k in range(shared):
        n = active[k]
        out[:n] = step(out[:n], flat[begins[:n] + k])
    for i in range(min(FEW, len(sizes))):
        value = int(out[i])
        for x in flat[begins[i] + shared : begins[i] + sizes[i]].tolist():
            value = step_one(value, x)
        out[i] = value
    back = np.empty_like(out)
    back[order] = out
    return back


#: Byte to normalised byte: digits and lower-case letters as they are, upper case lowered, 0 for dropped ones.
NORMAL = np.zeros(256, np.uint8)
NORMAL[48:58] = np.arange(48, 58)
NORMAL[97:123] = np.arange(97, 123)
NORMAL[65:91] = np.arange(97, 123)


@functools.lru_cache(maxsize=32)
def _advance_tables(count: int) -> np.ndarray:
    """Four byte tables whose sum (by xor) moves a CRC-32C state past ``count`` zero bytes."""
    table = reflected_table(0x82F63B78, 32).astype(np.uint32)
    states = np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(count):
        states = table[states & np.uint32(0xFF)] ^ (states >> np.uint32(8))
    return states.reshape(4, 256)


def _advanced(states: np.ndarray, count: int) -> np.ndarray:
    tables = _advance_tables(count)
    parts = states.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    return tables[0][parts[:, 0]] ^ tables[1][parts[:, 1]] ^ tables[2][parts[:, 2]] ^ tables[3][parts[:, 3]]


def rolling_crc32c(data: np.ndarray, width: int) -> np.ndarray:
    """CRC-32C of every ``width`` neighbouring bytes.

    A CRC is linear: the state of a joined string is that of its first part, moved past as many zeros as the second part
    has bytes, plus that of the second part. So strings are doubled, and the powers of two in ``width`` are joined."""
    n = max(len(data) - width + 1, 0)
    if not n:
        return np.zeros(0, np.uint32)
    power, size = reflected_table(0x82F63B78, 32).astype(np.uint32)[data], 1
    joined, length = None, 0
    while True:
        if width & size:
            # the larger part comes first
            joined = power if joined is None else _advanced(power[: len(power) - length], length) ^ joined[size : size + len(power) - length]
            length += size
        if 2 * size > width:
            break
        power = _advanced(power[: len(power) - size], size) ^ power[size:]
        size *= 2
    return joined[:n] ^ np.uint32(crc32c(bytes(width)))


def crc32c_of_words(words: np.ndarray) -> np.ndarray:
    """CRC-32C of each 32-bit integer as four little-endian bytes."""
    return rolling_crc32c_rows(np.ascontiguousarray(words, "<u4").view(np.uint8).reshape(-1, 4))


def rolling_crc32c_rows(rows: np.ndarray) -> np.ndarray:
    table = reflected_table(0x82F63B78, 32).astype(np.uint32)
    value = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for i in range(rows.shape[1]):
        value = table[(value ^ rows[:, i]) & np.uint32(0xFF)] ^ (value >> np.uint32(8))
    return value ^ np.uint32(0xFFFFFFFF)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


def winnow(content: bytes, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Line and hash of every fingerprint, in order.

    A fingerprint is made where the smallest hash of ``window`` neighbouring grams differs from the one a byte
    before. Memory is bounded: the bytes that count are taken in overlapping pieces."""
    raw = np.frombuffer(content, np.uint8)
    normal = NORMAL[raw]
    at = np.flatnonzero(normal)
    lines, hashes, last = [], [], -1
    line_feeds = np.cumsum(raw == 10)
    need = gram + window - 1
    for start in range(0, max(len(at) - need + 1, 0), PIECE):
        part = at[start : start + PIECE + need - 1]
        grams = rolling_crc32c(normal[part], gram)
        least = _sliding_min(grams, window).astype(np.int64)
        changed = np.concatenate([[least[0] != last], least[1:] != least[:-1]])
        last = int(least[-1])
        ends = part[np.flatnonzero(changed) + need - 1]
        lines.append(line_feeds[ends] + 1)
        hashes.append(crc32c_of_words(least[changed].astype(np.uint32)))
    if not lines:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    return np.concatenate(lines), np.concatenate(hashes)


def winnow_all(raw: np.ndarray, offsets: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for many short texts at once: text, line and hash of every fingerprint, in order.

    ``raw`` holds the texts one after the other; windows that cross from one into the next don't count."""
    at = np.flatnonzero(NORMAL[raw])
    need = gram + window - 1
    if len(at) < need:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    text = np.searchsorted(offsets, at, "right") - 1
    least = _sliding_min(rolling_crc32c(NORMAL[raw[at]], gram), window)
    first, last = text[: len(least)], text[need - 1 :]
    fresh = first == last
    fresh[1:] &= (least[1:] != least[:-1]) | (first[:-1] != last[1:])
    made = np.flatnonzero(fresh)
    line_feeds = np.cumsum(raw == 10)
    before = np.concatenate([[0], line_feeds])[offsets[:-1]]
    where = last[made]
    return where, line_feeds[at[made + need - 1]] + 1 - before[where], crc32c_of_words(least[made].astype(np.uint32))


def snippet_lines(content: bytes) -> list[tuple[int, list[str]]]:
    """``(line, hashes)`` of the lines with fingerprints."""
    out: list[tuple[int, list[str]]] = []
    for line, value in zip(*(x.tolist() for x in winnow(content)), strict=True):
        if not out or out[-1][0] != line:
            out.append((line, []))
        out[-1][1].append(f"{value:08x}")
    return out


def line_hashes(content: bytes) -> str:
    """Two hex digits for each line that ends in a line feed: CRC-8 of its normalised bytes.

    A line feed right after another one gives ``ff``; one that is the very first byte gives nothing."""
    return line_hashes_all([content])[0]


def line_hashes_all(contents: list[bytes]) -> list[str]:
    """The line hashes of every text."""
    sizes = np.array([len(c) for c in contents], np.int64)
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(contents), np.uint8)
    ends = np.flatnonzero(raw == 10)
    text = np.searchsorted(starts, ends, "right") - 1
    # a text without bytes starts where the next one does: the last of those is meant
    kept = np.flatnonzero(NORMAL[raw])
    before = np.concatenate([[-1], ends[:-1]]) if len(ends) else ends
    opens = np.maximum(before + 1, starts[text]) if len(ends) else ends
    lo, hi = np.searchsorted(kept, opens), np.searchsorted(kept, ends)
    values = NORMAL[raw[kept]].astype(np.uint64)
    table = reflected_table(CRC8[0], 8)
    ints = _as_ints(CRC8[0], 8)
    full = np.flatnonzero(hi > lo)
    hashes = np.zeros(len(ends), np.uint8)
    hashes[full] = _folded([values[a:b] for a, b in zip(lo[full].tolist(), hi[full].tolist(), strict=True)], np.zeros(len(full), np.uint64), lambda v, x: table[(v ^ x) & np.uint64(0xFF)], lambda v, x: ints[(v ^ x) & 0xFF])
    # the line feed before, counted from the text's start (0 in front of the first)
    place = ends - starts[text]
    previous = np.where(before >= starts[text], before - starts[text], 0)
    hashes[(hi == lo) & (previous + 1 == place)] = 0xFF
    shown = (hi > lo) | (place > 0)
    bounds = np.searchsorted(text[shown], np.arange(len(contents) + 1))
    every = hashes[shown].tobytes()
    return [every[a:b].hex() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def strip_line_hashes(hashes: str, removed: list[str]) -> str:
    """Each of ``removed`` that occurs, widened to whole bytes, is inverted wherever it occurs."""
    for part in removed:
        at = hashes.find(part) if part else -1
        if at < 0:
            continue
        first, after = at - at % 2, at + len(part) + (at + len(part)) % 2
        found = hashes[first:after]
        hashes = hashes.replace(found, "".join(f"{int(found[k : k + 2], 16) ^ 0xFF:02x}" for k in range(0, len(found), 2)))
    return hashes


def strip_snippets(wfp: str, removed: list[str]) -> str:
    """Fingerprint text without the hashes ``removed``, and without the commas and lines that these leave empty.

    A text that has none of them stays as it is."""
    left = wfp
    for part in removed:
        left = left.replace(part, "")
    if len(left) == len(wfp):
        return wfp
    left = re.sub(",{2,}", ",", left).replace(",\n", "\n").replace("=,", "=")
    return re.sub(r"\d+=\s+", "", left)


def opposite_line_ends(content: bytes) -> bytes | None:
    """The content with the other kind of line ends; None if it has none."""
    if b"\n" not in content and b"\r" not in content:
        return None
    unix = content.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
    only_crlf = b"\r\n" in content and not re.search(rb"(?<!\r)\n|\r(?!\n)", content)
    return unix if only_crlf else unix.replace(b"\n", b"\r\n")


def fnv1(data: bytes) -> int:
    value = FNV_BASIS
    for byte in data:
        value = (value * FNV_PRIME & MASK64) ^ byte
    return value


def fnv1_all(parts: list[bytes]) -> np.ndarray:
    """FNV-1 of many byte strings at once; memory is that of the strings."""
    prime = np.uint64(FNV_PRIME)
    with np.errstate(over="ignore"):
        return _folded([np.frombuffer(p, np.uint8) for p in parts], np.full(len(parts), FNV_BASIS, np.uint64), lambda v, x: (v * prime) ^ x, lambda v, x: (v * FNV_PRIME & MASK64) ^ x)


def simhash(values: np.ndarray, weights: np.ndarray | None = None) -> int:
    """Bits that most of the 64-bit values have (with their weights); a tie sets the bit."""
    weights = np.ones(len(values), np.int64) if weights is None else weights
    out = 0
    for bit in range(64):
        on = ((values >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)
        if int(((2 * on - 1) * weights).sum()) >= 0:
            out |= 1 << bit
    return out


_WORDS = re.compile(rb"[\w']+(?:\://[\w\./]+){0,1}")


def word_features(text: bytes) -> list[bytes]:
    return _WORDS.findall(text.lower())


def unicode_features(text: str, form: str = "NFC") -> list[str]:
    return re.findall(r"[\w'-]+", unicodedata.normalize(form, text).lower())


def shingles(words: list[bytes], width: int) -> list[bytes]:
    if width < 1:
        raise ValueError("shingles have one word at least")
    width = min(width, len(words))
    return words if width <= 1 else [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]


_BLOCK_START = {"c": re.compile(r"\s*/\*"), "lua": re.compile(r"\s*--\[\[")}
_BLOCK_END = {"c": re.compile(r"\*/\s*$"), "lua": re.compile(r"\]\]\s*$"), "python": re.compile(r'"""\s*$')}
_LINE_COMMENT = {"c": re.compile(r"\s*//"), "lua": re.compile(r"\s*--"), "python": re.compile(r"\s*#")}
_STYLE = {"python": "python", "ruby": "python", "perl": "python", "r": "python", "lua": "lua", "haskell": "lua"}


@functools.lru_cache(maxsize=64)
def _import_line(language: str) -> re.Pattern:
    return re.compile("|".join(IMPORTS[language]))


def header_offset(path: str, text: str, limit: int = 0) -> int:
    """Lines of licence, comments and imports before the first line of code; at most ``limit`` if that is over 0."""
    name = path.rpartition("/")[2]
    dot = name.rfind(".")
    language = SUFFIX_LANGUAGE.get(name[dot:].lower()) if dot > 0 else None
    if language is None:
        return 0
    style = _STYLE.get(language, "c")
    in_comment = in_import = False
    for number, line in enumerate(text.splitlines()):
        bare = line.strip()
        if not bare or (number == 0 and bare.startswith("#!")):
            continue
        if in_comment:
            in_comment = not _BLOCK_END[style].search(line)
        elif _LINE_COMMENT[style].match(line):
            pass
        elif style != "python" and _BLOCK_START[style].match(line):
            in_comment = not _BLOCK_END[style].search(line)
        elif style == "python" and line.count('"""') in (1, 2):
            in_comment = line.count('"""') == 1
        elif in_import:
            in_import = ")" not in bare and "}" not in bare
        elif _import_line(language).match(line):
            in_import = ("(" in bare and ")" not in bare) or ("{" in bare and "}" not in bare)
        else:
            return min(number, limit) if limit > 0 else number
    return 0
