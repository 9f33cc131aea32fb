"""Personal data: anchors found by an automaton, expanded and validated by local parsers.

An Aho-Corasick automaton finds the places where personal data can be: at-signs, ``://``, digits, a plus
before a digit, and cue words of accounts and secrets. At each anchor a parser walks outwards over the characters
that its kind allows, so the cost is one pass of the automaton and a few steps for each anchor.

Base kinds (leftmost, not overlapping within a kind; a match that fails its test is dropped, without a shorter try):

* ``email``  local part, at-sign, at least two labels
* ``ip``     four groups of digits, each at most 255
* ``card``   14 to 19 digits, single spaces or hyphens between, passing Luhn's test
* ``phone``  a plus and 10 to 15 digits with spaces, dots, brackets and hyphens between

Added kinds: ``url`` (scheme, ``://`` and what follows up to white space or a quote, without closing
punctuation), ``iban`` (after the cue: country, check digits and account, passing the mod-97 test) and
``secret`` (after a cue such as ``token`` or ``password``, an ``=`` or ``:`` and a value of at least eight characters).

Positions are code points, ends exclusive. Defined results: a null or empty text has no spans; a null id
stays null; repeated rows give repeated rows; texts of any length are read as a whole;
an empty table gives an empty table; masking keeps all other columns, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import documents, text_of

KINDS = ("email", "ip", "card", "phone", "url", "iban", "secret")
N_BASE = 4
SPAN = "array<struct<kind:string,start:bigint,stop:bigint>>"
DIGITS = frozenset("0123456789")
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
LOCAL = ALNUM | frozenset("._%+-")
LABEL = ALNUM | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
URL_END = frozenset(" \t\n\v\f\r\"'<>`{}|\\^")
SECRET = ALNUM | frozenset("_-+/=.~")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key")
MIN_SECRET = 8
BATCH_ROWS = 2000


@functools.lru_cache(maxsize=1)
def _anchors():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    automaton.add_word("@", ("email", 0))
    automaton.add_word("://", ("url", 2))
    for d in "0123456789":
        automaton.add_word(d, ("digit", 0))
        automaton.add_word("+" + d, ("phone", 1))
    for cue in SECRET_CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            automaton.add_word(form, ("secret", len(form) - 1))
    for form in ("IBAN", "iban", "Iban"):
        automaton.add_word(form, ("iban", 3))
    automaton.make_automaton()
    return automaton


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``, whose local part begins at ``floor`` or later."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    stop = _run(text, at + 1, LABEL)
    if start == at or stop == at + 1:
        return None
    labels = 1
    while stop + 1 < len(text) and text[stop] == "." and text[stop + 1] in LABEL:
        stop = _run(text, stop + 1, LABEL)
        labels += 1
    return (start, stop) if labels > 1 else None


def ip_at(text: str, start: int) -> tuple[int, int] | None:
    """Four groups of digits with dots between, whatever their values."""
    stop = _run(text, start, DIGITS)
    for _ in range(3):
        if stop >= len(text) or text[stop] != "." or (after := _run(text, stop + 1, DIGITS)) == stop + 1:
            return None
        stop = after
    return start, stop


def card_at(text: str, start: int) -> tuple[int, int] | None:
    """At least two digits with single spaces or hyphens between."""
    stop, n = start + 1, len(text)
    while stop < n:
        if text[stop] in DIGITS:
            stop += 1
        elif text[stop] in " -" and stop + 1 < n and text[stop + 1] in DIGITS:
            stop += 2
        else:
            break
    return (start, stop) if stop > start + 1 else None


def phone_at(text: str, start: int) -> tuple[int, int] | None:
    """A plus, a digit, allowed characters, a digit: as far as it goes."""
    stop = _run(text, start + 2, PHONE)
    while stop > start + 3 and text[stop - 1] not in DIGITS:
        stop -= 1
    return (start, stop) if stop > start + 3 else None


def url_at(text: str, colon: int) -> tuple[int, int] | None:
    start = colon
    while start > 0 and text[start - 1] in ALNUM:
        start -= 1
    while start < colon and text[start] in DIGITS:
        start += 1
    stop = colon + 3
    while stop < len(text) and text[stop] not in URL_END:
        stop += 1
    while stop > colon + 3 and text[stop - 1] in ".,;:!?)]":
        stop -= 1
    return (start, stop) if start < colon and stop > colon + 3 else None


def iban_at(text: str, after: int) -> tuple[int, int] | None:
    start = after
    while start < len(text) and start < after + 3 and text[start] in " :=":
        start += 1
    stop, kept = start, []
    while stop < len(text) and len(kept) < 34:
        if text[stop] in ALNUM:
            kept.append(text[stop])
            stop += 1
        elif text[stop] == " " and stop + 1 < len(text) and text[stop + 1] in ALNUM and len(kept) % 4 == 0 and kept:
            stop += 1
        else:
            break
    # words may follow the account after a space: the longest run that passes the test counts
    while len(kept) >= 15:
        if _mod97("".join(kept).upper()):
            return start, stop
        kept.pop()
        stop -= 1
        while text[stop - 1] == " ":
            stop -= 1
    return None


def secret_at(text: str, after: int) -> tuple[int, int] | None:
    at = _run(text, after, frozenset("\"' \t"))
    if at >= len(text) or text[at] not in "=:" or at > after + 4:
        return None
    start = _run(text, at + 1, frozenset("\"' \t"))
    stop = _run(text, start, SECRET)
    return (start, stop) if start <= at + 5 and stop - start >= MIN_SECRET else None


def _run(text: str, at: int, allowed: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _mod97(account: str) -> bool:
    if not (account[:2].isalpha() and account[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d)
        if k % 2:
            x = x * 2 - 9 if x > 4 else x * 2
        total += x
    return total % 10 == 0


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in found.split("."))
    if kind in ("card", "phone"):
        digits = "".join(c for c in found if c in DIGITS)
        return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15
    return True


def spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, stop)`` of all spans, by start and then kind as listed."""
    found: list[tuple[int, int, int]] = []
    free = dict.fromkeys(KINDS, 0)  # where the next match of a kind may begin
    digits_end = 0  # end of the run of digits whose start was tried as an address

    def take(kind: str, match: tuple[int, int] | None) -> None:
        if match is not None:
            free[kind] = match[1]
            if _valid(kind, text[match[0] : match[1]]):
                found.append((match[0], KINDS.index(kind), match[1]))

    for end, (cue, back) in _anchors().iter(text):
        at = end - back
        if cue == "digit":
            if at >= free["card"]:
                take("card", card_at(text, at))
            if at >= digits_end:
                digits_end = _run(text, at, DIGITS)
                if at >= free["ip"]:
                    take("ip", ip_at(text, at))
        elif cue == "email":
            if at >= free["email"]:
                take("email", email_at(text, at, free["email"]))
        elif cue == "phone":
            if at >= free["phone"]:
                take("phone", phone_at(text, at))
        elif cue == "url":
            if at >= free["url"]:
                take("url", url_at(text, at))
        elif end + 1 >= free[cue]:
            take(cue, (iban_at if cue == "iban" else secret_at)(text, end + 1))
    return [(KINDS[k], start, stop) for start, k, stop in sorted(found)]


def listed(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for kind, start, stop in found)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (an array of kind, start, stop) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                rows = [[dict(zip(("kind", "start", "stop"), x, strict=True)) for x in spans(t.as_py())] for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    return documents(docs, id_col, text_col).mapInArrow(run, f"doc_id long, spans {SPAN}")


def digests(docs: DataFrame, **options) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    found = find(docs, **options)
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS[:N_BASE]))
    counts = [F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS[:N_BASE]]
    return found.select("doc_id", *counts, F.sha2(F.concat_ws(",", F.transform(base, text)), 256).alias("base_sha256"), F.concat_ws(",", F.transform("spans", text)).alias("spans"))


def _is(kind: str):
    return lambda x: x["kind"] == kind


def masked(text: str) -> str:
    """The text with each span, or each run of overlapping ones, replaced by its first kind."""
    out, at = [], 0
    for kind, start, stop in spans(text):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced by ``<KIND>``; null texts stay null.

    ``n_chars``, where it is a column of ``docs``, is counted anew."""

    @F.pandas_udf("string")
    def replaced(texts):
        return texts.map(masked, na_action="ignore")

    out = docs.withColumn(text_col, replaced(docs[text_col].cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_of(out, text_col)).cast(docs.schema["n_chars"].dataType))
    return out
