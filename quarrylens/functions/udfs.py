"""Codecs as Arrow-batched column functions, and their SQL names.

Whole Arrow batches go through numpy; hex digits are made in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.functions import codecs

# Types are objects, not names: names could only be read in a running session.
SNIPPETS = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("hashes", T.ArrayType(T.IntegerType()))]))
#: Texts are taken together up to so many bytes; a longer one is taken alone, in pieces.
BLOCK = 1 << 20


def _blocks(content: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of rows."""
    content = content.cast(pa.large_binary())
    if content.null_count:
        content = content.fill_null(b"")
    offsets = np.frombuffer(content.buffers()[1], np.int64)[content.offset : content.offset + len(content) + 1]
    raw = np.frombuffer(content.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(content):
        stop = min(len(content), max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1))
        yield row, raw[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


@F.arrow_udf(SNIPPETS)
def winnow(content: pa.Array) -> pa.Array:
    """Fingerprints of a file by line, as the bits of 32-bit integers; none for null."""
    texts, lines, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for row, raw, offsets in _blocks(content) if len(content) else ():
        if len(raw) > BLOCK:
            line, value = codecs.winnow(raw.tobytes())
            text = np.zeros(len(line), np.int64)
        else:
            text, line, value = codecs.winnow_all(raw, offsets)
        texts.append(text + row)
        lines.append(line)
        hashes.append(value)
    text, line, value = (np.concatenate(x) for x in (texts, lines, hashes))
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
    at = np.flatnonzero(first)
    inner = pa.ListArray.from_arrays(pa.array(np.append(at, len(text)), pa.int32()), pa.array(value.view(np.int32)))
    rows = pa.StructArray.from_arrays([pa.array(line[at], pa.int32()), inner], ["line", "hashes"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text[at], np.arange(len(content) + 1)), pa.int32()), rows)


def hex8(value: Column) -> Column:
    """Eight hex digits of the bits of a 32-bit integer."""
    return F.lower(F.lpad(F.hex(value.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))


def _bytes(content: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in content.to_pylist()]


def _with_nulls(values, content: pa.Array, kind: pa.DataType) -> pa.Array:
    return pa.array(values, kind, mask=np.asarray(content.is_null().to_numpy(zero_copy_only=False)))


@F.arrow_udf(T.StringType())
def hpsm(content: pa.Array) -> pa.Array:
    return _with_nulls(np.array(codecs.line_hashes_all(_bytes(content)), object), content, pa.string())


@F.pandas_udf(T.IntegerType())
def header_offset(path: pd.Series, text: pd.Series) -> pd.Series:
    return pd.Series([codecs.header_offset(p or "", t or "") for p, t in zip(path, text, strict=True)], dtype="int32")


@F.pandas_udf(T.StringType())
def shown_name(path: pd.Series) -> pd.Series:
    """A file's name as Python shows a string, so that it has no line ends."""
    return path.map(lambda p: repr(p).strip("'"), na_action="ignore")


@F.arrow_udf(T.LongType())
def crc64(content: pa.Array) -> pa.Array:
    return _with_nulls(codecs.crc_all(_bytes(content), *codecs.CRC64).view(np.int64), content, pa.int64())


@F.arrow_udf(T.LongType())
def crc32c(content: pa.Array) -> pa.Array:
    return _with_nulls(codecs.crc_all(_bytes(content), *codecs.CRC32C).view(np.int64), content, pa.int64())


@F.arrow_udf(T.IntegerType())
def crc8(content: pa.Array) -> pa.Array:
    return _with_nulls(codecs.crc_all(_bytes(content), *codecs.CRC8).astype(np.int32), content, pa.int32())


def _simhashes(features: list[list[bytes] | None]) -> pd.Series:
    """The simhash of each list; features of all lists are hashed, and their bits summed, together."""
    values = codecs.fnv1_all([x for f in features if f is not None for x in f])
    sizes = np.array([0 if f is None else len(f) for f in features], np.int64)
    ends = np.cumsum(sizes)
    out = np.zeros(len(features), np.uint64)
    for bit in range(64):
        on = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        # a tie sets the bit
        out |= (2 * (on[ends] - on[ends - sizes]) >= sizes).astype(np.uint64) << np.uint64(bit)
    found = pd.Series(out.view(np.int64), dtype="Int64")
    found[[f is None for f in features]] = pd.NA
    return found


@F.pandas_udf(T.LongType())
def simhash64(features: pd.Series) -> pd.Series:
    """Simhash of an array of binary features."""
    return _simhashes([None if f is None else [bytes(x) for x in f] for f in features])


@F.pandas_udf(T.LongType())
def simhash_words(text: pd.Series) -> pd.Series:
    """Simhash of the words of a text."""
    return _simhashes([None if t is None else codecs.word_features(t.encode()) for t in text])


@F.pandas_udf(T.ArrayType(T.LongType()))
def word_hashes(text: pd.Series) -> pd.Series:
    """FNV-1 of every word of a text."""
    features = [codecs.word_features((t or "").encode()) for t in text]
    values = codecs.fnv1_all([x for f in features for x in f]).view(np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(f) for f in features])])
    return pd.Series([values[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], dtype=object)


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    import unicodedata

    return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@F.pandas_udf(T.StringType())
def decoded(content: pd.Series) -> pd.Series:
    """UTF-8 text without its invalid bytes."""
    return content.map(lambda c: bytes(c).decode("utf-8", "ignore"), na_action="ignore")


@F.pandas_udf(T.StringType())
def stripped_hpsm(hashes: pd.Series, removed: pd.Series) -> pd.Series:
    return pd.Series([None if h is None else codecs.strip_line_hashes(h, list(r) if r is not None else []) for h, r in zip(hashes, removed, strict=True)])


@F.pandas_udf(T.StringType())
def stripped_snippets(wfp: pd.Series, removed: pd.Series) -> pd.Series:
    return pd.Series([None if w is None else codecs.strip_snippets(w, list(r) if r is not None else []) for w, r in zip(wfp, removed, strict=True)])


@F.udtf(returnType=T.StructType([T.StructField("line", T.IntegerType()), T.StructField("hash", T.StringType())]))
class WfpLines:
    """``wfp_lines(content)``: one row per fingerprint."""

    def eval(self, content: bytes):
        if content is not None:
            lines, hashes = codecs.winnow(bytes(content))
            for line, value in zip(lines.tolist(), np.asarray(hashes).tolist(), strict=True):
                yield int(line), f"{value:08x}"


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL."""
    for name, function in {"winnow": winnow, "hpsm": hpsm, "header_offset": header_offset, "crc64": crc64, "crc32c": crc32c, "simhash64": simhash64, "simhash_words": simhash_words}.items():
        spark.udf.register(name, function)
    spark.udtf.register("wfp_lines", WfpLines)
