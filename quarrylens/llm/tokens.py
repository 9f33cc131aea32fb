"""Byte-level BPE ids of whole texts, and the byte length of every token.

The vocabulary is read from files on each worker; their paths are parameters.
"""

from __future__ import annotations

import base64
import functools
import os

import numpy as np

RANKS, FILE = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
END_OF_TEXT, END_OF_TEXT_ID = "<|endoftext|>", 50256

#: Characters that all versions of Unicode in use class alike; a text with any other one is split by
#: the vocabulary's own library, whose tables may be older or newer than those of other libraries.
SETTLED = "\\0-\u052f\u2000-\u206f\u20a0-\u20bf\u2100-\u214f\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff5e"
#: Texts on which both encoders must agree before the faster one is used.
SAMPLE = (
    "", " ", "\n\n \t x", "The quick brown fox can't jump 12345 times, they've said; it's 3.14!", "  leading and trailing  ", "Straße, naïve café — «déjà vu» … 100 €", "¿Qué? ¡Sí! años über Äpfel",
    "日本語のテキスト 한국어 텍스트", "def f(x):\n    return x**2  # comment\n", "a" * 300, "<|endoftext|>x<|endoftext|>", "\x00\x01\x7f", "http://example.org/a?b=c&d=%20",
)


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file; absolute paths are kept."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteTokens:
    """Encoder with ``ids(text)`` and ``lengths`` (bytes of each token).

    Ids are those of the vocabulary's JSON file. The rank file of the same vocabulary gives them several times faster, so it is
    used for texts of characters that all versions of Unicode class alike, and only after both have agreed on a sample when the
    encoder is made; all other texts are encoded with the JSON file."""

    def __init__(self, ranks_file: str = RANKS, file: str = FILE):
        import public_tokenizers
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        with open(vocabulary(ranks_file), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        special = {END_OF_TEXT: END_OF_TEXT_ID}
        self._special = {END_OF_TEXT}
        self._encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.lengths = np.zeros(max(*ranks.values(), END_OF_TEXT_ID) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.lengths[END_OF_TEXT_ID] = len(END_OF_TEXT)
        self._library = Tokenizer.from_file(vocabulary(file))
        self._library.no_truncation()
        self._library.no_padding()
        self._unsettled = regex.compile(f"[^{SETTLED}]")
        self._fast = all(self._by_ranks(x) == self._by_library(x) for x in SAMPLE)

    def _by_ranks(self, text: str) -> list[int]:
        if END_OF_TEXT in text:
            return self._encoding.encode(text, allowed_special=self._special, disallowed_special=())
        return self._encoding.encode_ordinary(text)

    def _by_library(self, text: str) -> list[int]:
        return self._library.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        if self._fast and (text.isascii() or not self._unsettled.search(text)):
            return self._by_ranks(text)
        return self._by_library(text)


@functools.lru_cache(maxsize=2)
def byte_tokens(ranks_file: str = RANKS) -> ByteTokens:
    """The encoder of this process, loaded once."""
    return ByteTokens(ranks_file)
