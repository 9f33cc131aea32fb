"""BPE encoding by dynamic programming over prefixes, and decoding.

The ids are those of merging pairs in order of rank, but no merges are replayed. Every prefix of
a word has exactly one encoding, so it is enough to store the *last token* of each prefix:

* An automaton over the vocabulary with suffix links gives, at every position, all tokens that
  end there.
* A token may follow the encoding of the prefix before it exactly if the pair (last token of that prefix,
  token) is compatible: merging the pair's characters would never merge across their boundary.
  This is read off the merge trees of the two tokens, along the right edge of one and the left edge of the
  other, and remembered per pair.
* One token passes at each position. Back-pointers from the end of the word emit the ids.

Words are found as the vocabulary file says: NFC, lower case, split pattern, bytes as characters,
an end-of-word mark at the last one. Here that mark is part of the alphabet: a byte at the end of a
word is a character of its own. Words seen before come from a bounded cache per process.

Decoding is that of a vocabulary file without a decoder: the tokens joined by one space.

Defined results: a null or empty text has no ids and decodes to an empty text; a null id stays
null; repeated rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import json
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarrylens.llm.common import documents
from quarrylens.llm.tokens import SETTLED, vocabulary

VOCABULARY = "word_bpe_49k.json"
SCHEMA = "doc_id long, ids binary, decoded string"
CACHE_WORDS, CACHE_PAIRS, BATCH_BYTES = 150_000, 400_000, 4 << 20
#: Longer words are encoded each time they are met, so that the cache is bounded in bytes too.
LONG_WORD = 64
NEVER = 1 << 60
#: Where the characters for end-of-word bytes begin (a private area of Unicode).
END_BASE = 0xF0000
#: White space as the vocabulary's pattern library defines it.
SPACE = r"\t-\r \x85\p{Z}"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBpe:
    """Encoder for one vocabulary file."""

    def __init__(self, file: str = VOCABULARY):
        import ahocorasick
        import regex

        with open(vocabulary(file), encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        marks = byte_characters()
        self._bytes = str.maketrans({chr(b): c for b, c in enumerate(marks)})
        self._end = {c: chr(END_BASE + b) for b, c in enumerate(marks)}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._words = regex.compile(pattern.replace(r"[^\s", "[^" + SPACE))
        self._unsettled = regex.compile(f"[^{SETTLED}]")
        self._library = None
        self._file = vocabulary(file)
        self._special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self._merge_trees(model["merges"])
        self._automaton = ahocorasick.Automaton()
        for token, number in self.ids.items():
            if self._whole[number]:
                self._automaton.add_word(self._symbols(token), (number, len(self._symbols(token))))
        self._automaton.make_automaton()
        ends = marks if not self.suffix else [m + self.suffix for m in marks]
        if missing := [m for m in (*marks, *ends) if m not in self.ids]:
            raise ValueError(f"every byte must be a token, or some prefixes have no encoding; missing: {missing[:5]}")
        self._pairs: dict[int, bool] = {}
        # words of late, and those of before: a full cache becomes the older one, so frequent words stay
        self._cache: dict[str, tuple[bytes, str]] = {}
        self._older: dict[str, tuple[bytes, str]] = {}

    def _symbols(self, token: str) -> str:
        """A token over the alphabet with end-of-word characters."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            token = token[: -len(self.suffix)]
            return token[:-1] + self._end[token[-1]]
        return token

    def _merge_trees(self, merges: list) -> None:
        """For each token, the pieces along its left and its right edge, each with the rank at
        which it is merged into the next larger piece (never, for the token itself)."""
        size = max(self.ids.values()) + 1
        self._ranks: dict[int, int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(merges):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = self.ids[left], self.ids[right]
            whole = self.ids.get((left[: -len(self.suffix)] if self.suffix and left.endswith(self.suffix) else left) + right)
            if whole is None:
                continue
            self._ranks[a << 20 | b] = rank
            parts.setdefault(whole, (a, b, rank))
        self._left, self._right = [[] for _ in range(size)], [[] for _ in range(size)]
        for edge, side in ((self._left, 0), (self._right, 1)):
            for number in self.ids.values():
                at, until = number, NEVER
                while True:
                    edge[number].append((at, until))
                    if at not in parts:
                        break
                    until = parts[at][2]
                    at = parts[at][side]
        # a token of the vocabulary is whole if merging its own characters ends in it
        self._whole = [False] * size
        for token, number in self.ids.items():
            if number in parts:
                a, b, rank = parts[number]
                self._whole[number] = self._compatible_until(a, b, rank)
            else:
                self._whole[number] = len(self._symbols(token)) == 1
        for number, (a, b, _) in parts.items():
            self._whole[number] &= self._whole[a] and self._whole[b]

    def _compatible_until(self, a: int, b: int, last: int) -> bool:
        """No merge across the boundary of a and b happens before rank ``last``."""
        ranks = self._ranks
        for r, r_until in self._right[a]:
            for x, x_until in self._left[b]:
                rank = ranks.get(r << 20 | x, NEVER)
                if rank < last and rank < r_until and rank <= x_until:
                    return False
        return True

    def compatible(self, a: int, b: int) -> bool:
        known = self._pairs.get(a << 20 | b)
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            known = self._pairs[a << 20 | b] = self._compatible_until(a, b, NEVER)
        return known

    def word(self, symbols: str) -> list[int]:
        """Ids of one word over the alphabet with end-of-word characters."""
        last: list[int] = [-1] * len(symbols)
        back: list[int] = [0] * len(symbols)
        pairs, compatible = self._pairs, self.compatible
        for end, (token, length) in self._automaton.iter(symbols):
            before = end - length
            if last[end] >= 0:
                continue
            if before < 0:
                last[end], back[end] = token, before
                continue
            previous = last[before]
            known = pairs.get(previous << 20 | token)
            if compatible(previous, token) if known is None else known:
                last[end], back[end] = token, before
        out, at = [], len(symbols) - 1
        while at >= 0:
            out.append(last[at])
            at = back[at]
        return out[::-1]

    def _add(self, word: str, symbols: str | None = None) -> tuple[bytes, str]:
        """The entry of a word that the cache lacks; ``symbols`` are its bytes as characters."""
        if len(word) > LONG_WORD:
            return self._encoded(word, symbols)
        if len(self._cache) >= CACHE_WORDS:
            self._older, self._cache = self._cache, {}
        # a caller may still hold the cache of before
        found = self._cache.get(word) or self._older.get(word)
        if found is None:
            found = self._encoded(word, symbols)
        self._cache[word] = found
        return found

    def _encoded(self, word: str, symbols: str | None) -> tuple[bytes, str]:
        if symbols is None:
            symbols = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self._bytes)
        if self.suffix:
            symbols = symbols[:-1] + self._end[symbols[-1]]
        ids = self.word(symbols)
        return struct.pack(f"<{len(ids)}I", *ids), " ".join([self.names[i] for i in ids])

    def normalised(self, text: str) -> str:
        if not text.isascii():
            # letter by letter: a capital sigma gives the same small one at a word's end as elsewhere
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids of a text as little-endian unsigned 32-bit integers, and the decoded text."""
        ids, names, add = [], [], self._add
        for part, number in self._split(text):
            if number is not None:
                ids.append(np.array([number], "<u4").tobytes())
                names.append(part)
                continue
            if self._unsettled.search(part):
                for symbols in self._split_by_library(part):
                    a, b = self._cache.get("\0" + symbols) or add("\0" + symbols, symbols)
                    ids.append(a)
                    names.append(b)
                continue
            cache = self._cache
            for word in self._words.findall(self.normalised(part)):
                a, b = cache.get(word) or add(word)
                ids.append(a)
                names.append(b)
        return b"".join(ids), " ".join(names)

    def _split_by_library(self, text: str) -> list[str]:
        """Words, with bytes as characters."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._file)
        return [x for x, _ in self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))]

    def _split(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text between special tokens, and these."""
        at = 0
        if "<|" in text and self._special:
            for m in self._special.finditer(text):
                yield text[at : m.start()], None
                yield m[0], self.special[m[0]]
                at = m.end()
        yield text[at:] if at else text, None

    def decode(self, ids: bytes) -> str:
        return " ".join([self.names[i] for i in np.frombuffer(ids, "<u4").tolist()])


@functools.lru_cache(maxsize=2)
def word_bpe(file: str = VOCABULARY) -> WordBpe:
    """The encoder of this process, built once."""
    return WordBpe(file)


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", file: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids, decoded`` for every row; ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(file)

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.string()))], names=["doc_id", "ids", "decoded"])

        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, decoded = encoder.encode(text.as_py())
                rows.append((doc_id, ids, decoded))
                size += len(ids) + len(decoded)
                if size >= BATCH_BYTES:
                    yield out(rows)
                    rows, size = [], 0
            yield out(rows)

    return documents(docs, id_col, text_col).mapInArrow(run, SCHEMA)
