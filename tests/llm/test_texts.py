"""Packing, token counts, BPE, quality, personal data, licences and pages against brute force or libraries."""

import hashlib
import html
import math
import random
import re
import zlib

import numpy as np
import pytest
from helpers import SMALL

from quarrylens.llm import bpe, html_text, license_scan, packing, pii, quality_rules, token_counts, tokens

TABLES = ["odd", "real", "clashing"]


def text_rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def byte_library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(tokens.vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(tokens.vocabulary("word_bpe_49k.json"))


@pytest.mark.parametrize("table", TABLES)
def test_packing(table, request, byte_library, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_DOCS", 7)
    docs = request.getfixturevalue(table)
    found = packing.digests(docs).collect()
    expected = []
    for i, t in text_rows(docs):
        ids = [*byte_library.encode(t, add_special_tokens=False).ids, 0]
        expected += [(i, len(ids), a, len(ids[a : a + 1024]), zlib.crc32(np.array(ids[a : a + 1024], "<u4").tobytes())) for a in range(0, len(ids), 1024)]
    assert sorted(map(repr, ((r.doc_id, r.doc_tokens, r.start, r.length, r.ids_crc32) for r in found))) == sorted(map(repr, expected))
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 1024


def test_packing_has_little_padding(spark):
    found = packing.digests(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    used = found.groupby("sequence_id")["length"].sum()
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in used)
    assert padding < 0.02 * used.sum()


def test_packing_of_nothing(docs_of):
    assert packing.digests(docs_of([])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_first_fit_decreasing_is_that_of_a_list(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 100) for _ in range(rng.choice([1, 2, 50, 333]))]
    room, expected = [], {}
    for item in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        b = next((b for b, r in enumerate(room) if r >= lengths[item]), len(room))
        if b == len(room):
            room.append(100)
        expected[item] = (b, 100 - room[b])
        room[b] -= lengths[item]
    bins, offsets = packing.first_fit_decreasing(np.array(lengths), 100)
    assert {k: (int(bins[k]), int(offsets[k])) for k in range(len(lengths))} == expected


def test_byte_ids_are_the_library_s(byte_library):
    rng = random.Random(2)
    encoder = tokens.byte_tokens()
    for _ in range(300):
        text = "".join(chr(rng.choice([32, 10, 39, 115, rng.randrange(1, 0xD7FF), rng.randrange(0xE000, 0x1FFFF)])) for _ in range(rng.randrange(30)))
        text += rng.choice(["", "<|endoftext|>", "<|endoftext|> x"])
        assert encoder.ids(text) == byte_library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("rule", token_counts.RULES)
@pytest.mark.parametrize("table", TABLES)
def test_section_counts(rule, table, request, byte_library):
    docs = request.getfixturevalue(table)
    found = {}
    for r in token_counts.section_counts(docs, rule=rule).collect():
        found.setdefault(r.doc_id, []).append((r.section, r.start, r.stop, r.n_tokens, r.n_crossing))
    rows = text_rows(docs)
    once = [i for i, _ in rows if sum(i == j for j, _ in rows) == 1]
    for i, t in rows:
        if i not in once or len(t) > 20_000:
            continue
        starts = [0] + [k + 1 for k, c in enumerate(t) if c == "\n" and k + 1 < len(t)]
        spans = list(zip(starts, starts[1:] + [len(t)], strict=True))
        counts, crossing = [0] * len(spans), [0] * len(spans)
        for a, b in byte_library.encode(t, add_special_tokens=False).offsets:
            shared = [max(0, min(b, y) - max(a, x)) for x, y in spans]
            at = [k for k, s in enumerate(shared) if s]
            k = {"largest": shared.index(max(shared)), "first": at[0], "last": at[-1]}[rule]
            counts[k] += 1
            crossing[k] += len(at) > 1
        assert sorted(found[i]) == [(k, x, y, counts[k], crossing[k]) for k, (x, y) in enumerate(spans)]


def test_given_sections(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(1, "alpha beta gamma")]).withColumn("parts", F.expr("array(named_struct('start', 0L, 'stop', 5L), named_struct('start', 8L, 'stop', 11L))"))
    found = token_counts.section_counts(docs, spans_col="parts").collect()
    assert [(r.start, r.stop) for r in found] == [(0, 5), (8, 11)] and all(r.n_tokens >= 1 for r in found)
    with pytest.raises(ValueError):
        token_counts.section_counts(docs, rule="other")


@pytest.mark.parametrize("table", TABLES)
def test_word_ids(table, request, word_library):
    docs = request.getfixturevalue(table)
    found = sorted(map(repr, ((r.doc_id, list(np.frombuffer(bytes(r.ids), "<u4")), r.decoded) for r in bpe.encoded(docs).collect())))
    expected = []
    for i, t in text_rows(docs):
        ids = word_library.encode(t, add_special_tokens=False).ids
        expected.append(repr((i, list(np.array(ids, "<u4")), word_library.decode(ids, skip_special_tokens=False))))
    assert found == sorted(expected)


def test_word_ids_of_odd_texts(word_library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 50)
    rng, encoder = random.Random(4), bpe.WordBpe()
    alphabet = "aaabbcdeethinst  \n\t''sdréßΣσİ1234<>|!?.,-_=\xa0　\x1c\x85你好😀ａ²՘Ᲊ"
    for k in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) + "<|endoftext|>x" * (k % 40 == 0)
        ids, decoded = encoder.encode(text)
        expected = word_library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert decoded == encoder.decode(ids) == word_library.decode(expected, skip_special_tokens=False)


def test_long_words_stay_out_of_the_cache(word_library):
    encoder = bpe.WordBpe()
    word = "supercalifragilistic" * 500
    ids, _ = encoder.encode(f"a {word} b {word}")
    assert np.frombuffer(ids, "<u4").tolist() == word_library.encode(f"a {word} b {word}", add_special_tokens=False).ids
    assert all(len(w) <= bpe.LONG_WORD + 1 for w in encoder._cache)


def test_one_row_very_often_is_no_large_group(docs_of):
    docs = docs_of([(None, "")] * 3000 + [(7, "some words")] * 3000)
    deals = packing.pieces(docs).groupBy("deal").count().collect()
    assert len(deals) > 1000
    packed = packing.digests(docs).collect()
    sizes = {r.doc_id: r.doc_tokens for r in packed}
    assert len(packed) == 6000 and sum(r.length for r in packed) == 3000 * (sizes[None] + sizes[7])


def test_a_long_scheme_is_taken_whole():
    text = "see averyveryverylongscheme1://host/x now"
    assert pii.url_at(text, text.index("://")) == (4, text.index(" now"))


def quality_brute(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, covered = {}, set()
    for k in range(len(words) - 4):
        seen.setdefault(tuple(words[k : k + 5]), []).append(k)
    for places in seen.values():
        if len(places) > 1:
            covered |= {p + o for p in places for o in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words)


@pytest.mark.parametrize("table", TABLES)
def test_quality_measures(table, request):
    docs = request.getfixturevalue(table)
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.quality(docs).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, ((i, *quality_brute(t)) for i, t in text_rows(docs))))


def distance_brute(counts, shares):
    total, out = sum(counts), 0.0
    for c, share in zip(counts, shares, strict=True):
        p = c / total
        out += sum(x * math.log2(x / ((p + share) / 2)) / 2 for x in (p, share) if x > 0)
    return math.sqrt(max(out, 0))


def test_quality_verdicts(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    references = quality_rules.fitted(docs, labels)
    judged = quality_rules.quality(docs, references=references).join(labels, "doc_id").toPandas()
    judged = judged[~judged.base_failed]
    assert judged[judged.quality == 1].kept.mean() > 0.99
    assert judged[judged.quality == 0].kept.mean() < 0.1
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.keep_good(docs_of([])).count() == 0
    # references and distances by plain counting
    good = set(labels.filter("quality = 1").toPandas().doc_id)
    texts = [(r.doc_id, r.lang, r.text or "") for r in docs.collect()]
    classes = lambda t: (lambda c: [*c, len(t) - sum(c)])([len(re.findall(p, t)) for p in (r"[^\W\d_a-zß-öø-ÿœ]", "[0-9]", r"[.,;:!?'\"()-]", r"[#*$%&|<>]", r"[\x20\x09-\x0D]")])
    bins = lambda lang, t: (lambda w, c: [*c, len(w) - sum(c)])(re.findall(r"[^\x20\x09-\x0D]+", t), [re.findall(r"[^\x20\x09-\x0D]+", t).count(x) for x in quality_rules.COMMON[lang].split()])
    for lang in quality_rules.COMMON:
        for which, count in enumerate((lambda t, lang=lang: classes(t), lambda t, lang=lang: bins(lang, t))):
            sums = np.sum([count(t) for i, x, t in texts if x == lang and i in good], axis=0)
            assert np.allclose(references[lang][which], sums / sums.sum(), atol=1e-3 if which == 0 else 1e-9)
    found = {r.doc_id: r for r in quality_rules.quality(docs, references=references).collect()}
    for i, lang, t in texts[:300]:
        assert found[i].word_distance is None if len(t.split()) < 50 else abs(found[i].word_distance - distance_brute(bins(lang, t), references[lang][1])) < 1e-5
        assert (found[i].class_distance is None) == (len(t) < 200)


def test_quality_without_labels_or_language(docs_of, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = docs_of([(1, "some words of a text that is written in no known language at all " * 9, "xx"), (2, "!!! $$$ %%% " * 40, None), (3, None, None)])
    assert quality_rules.fitted(docs, none) == quality_rules.general()
    found = {r.doc_id: r for r in quality_rules.quality(docs, references=quality_rules.fitted(docs, none)).collect()}
    assert found[1].word_distance is None and found[1].class_distance < 0.2 < found[2].class_distance and found[3].class_distance is None


@pytest.mark.parametrize("bits", [24, 3])
def test_quality_repeats_of_a_long_text_with_and_without_positions(bits, docs_of):
    rng = random.Random(bits)
    rows = [(1, " ".join(f"w{k % 40}" for k in range(3000))), *((k, " ".join(rng.choice("ab") + str(rng.randrange(3)) for _ in range(rng.choice([4, 5, 6, 9, 12, 60])))) for k in range(2, 40))]
    found = {r.doc_id: r.n_repeat_words for r in quality_rules.quality(docs_of(rows), position_bits=bits).collect()}
    assert found == {i: quality_brute(t)[4] for i, t in rows}


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def pii_brute(t):
    out = []
    for k, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = sum(sum(divmod(int(d) * 2, 10)) if n % 2 else int(d) for n, d in enumerate(digits[::-1]))
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (14 <= len(digits) <= 19 and doubled % 10 == 0) or kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_base_spans_on_noise():
    rng = random.Random(9)
    for _ in range(20_000):
        text = "".join(rng.choice(rng.choice(["0123456789", "@.-+ ()%_ab", "12+ -.@", "é\n(.) 00"])) for _ in range(rng.randrange(60)))
        assert [s for s in pii.spans(text) if s[0] in KINDS] == pii_brute(text)


@pytest.mark.parametrize("table", TABLES)
def test_pii_digests(table, request):
    docs = request.getfixturevalue(table)
    found = [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.digests(docs).collect()]
    expected = []
    for i, t in text_rows(docs):
        spans = pii_brute(t)
        expected.append((i, *(sum(s[0] == k for s in spans) for k in KINDS), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()))
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_added_kinds_and_mask(docs_of):
    text = 'see https://u:p@x.example.com/a?b=c. IBAN: GB82 WEST 1234 5698 7654 32 then token = "04dbebab91ab85687d33" and 4111 1111 1111 1111, a@b.co'
    kinds = [k for k, *_ in pii.spans(text)]
    assert kinds == ["url", "email", "iban", "secret", "card", "email"]
    masked = pii.masked(text)
    assert "04dbebab" not in masked and "4111" not in masked and "GB82" not in masked and masked.startswith("see <URL>. IBAN: <IBAN> then token")
    docs = docs_of([(1, text), (2, None)])
    rows = {r.doc_id: r for r in pii.mask(docs).collect()}
    assert rows[1].text == masked and rows[1].n_chars == len(masked) and rows[2].text is None
    assert pii.mask(docs).columns == docs.columns and pii.mask(docs_of([])).count() == 0


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def license_brute(t):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    hits = [(k, label) for phrase, label in PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in hits]
    return len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits}))


NOTICE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy'


def test_licenses(docs_of, odd, real, clashing):
    mine = docs_of([(1, "Some text. Licensed under CC BY-NC 4.0. More."), (2, "MIT License and mit-license, CC by\nGNU General Public License"), (3, f"x {NOTICE} y"), (4, "licensed under the GNU General Public License, version 3, and so on"), (5, "nothing")])
    for docs in (mine, odd, real, clashing):
        found = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan.scanned(docs).collect()]
        assert sorted(map(repr, found)) == sorted(map(repr, ((i, *license_brute(t)) for i, t in text_rows(docs))))
    labels = {r.doc_id: (r.labels, round(r.score, 3)) for r in license_scan.scanned(mine).collect()}
    assert labels == {1: ("cc-by,cc-by-nc-4.0", 1.0), 2: ("cc-by,gpl,mit", 0.0), 3: ("apache,apache-2.0", 1.0), 4: ("gpl,gpl-3.0", 1.0), 5: ("", 0.0)}
    assert license_scan.scanned(docs_of([])).count() == 0


def test_license_with_words_changed(docs_of):
    text = license_scan.TEMPLATES["mit"][2]
    changed = text.replace("free of charge", "wholly free of any charge").replace("sublicense, ", "")
    found = license_scan.scanned(docs_of([(1, f"before {changed} after")])).first()
    assert found.labels == "mit" and found.score > 0.75
    assert license_scan.scanned(docs_of([(1, text[: len(text) // 3])])).first().labels == ""
    with pytest.raises(ValueError):
        license_scan.scanned(docs_of([]), templates={"x": ["a b c d e"] * 100_000})


def labels_brute(text, templates):
    """Labels and score by comparing words, without hashes."""
    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    doc, spans = words_of(text), []
    for label, template in ((x, words_of(t)) for x, texts in templates.items() for t in texts):
        hits = sorted((p - a, p, a) for p in range(len(doc) - 3) for a in range(len(template) - 3) if doc[p : p + 4] == template[a : a + 4])
        groups = []
        for h in hits:
            if not groups or h[0] - groups[-1][-1][0] > 3:
                groups.append([])
            groups[-1].append(h)
        for g in groups:
            first, last, low, high = min(p for _, p, _ in g), max(p for _, p, _ in g) + 4, min(a for _, _, a in g), max(a for _, _, a in g) + 4
            x, y = doc[first:last], template[low:high]
            table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
            for i in range(len(x)):
                for j in range(len(y)):
                    table[i + 1][j + 1] = table[i][j] + 1 if x[i] == y[j] else max(table[i][j + 1], table[i + 1][j])
            agreed = table[-1][-1]
            share = min(1.0, agreed / len(template))
            if agreed >= 0.75 * (last - first) and share >= (1.0 if len(template) < 20 else 0.75):
                spans.append((label, first, last, share, agreed))
    best = [s for s in spans if not any(t[0] != s[0] and t[1] < s[2] and t[2] > s[1] and t[3:] > s[3:] for t in spans)]
    return sorted({s[0] for s in best}), max((s[3] for s in best), default=0.0)


def test_labels_and_scores_by_comparing_words(docs_of, real):
    rng = random.Random(6)
    texts = [t for listed in license_scan.TEMPLATES.values() for t in listed]
    rows = []
    for k in range(120):
        words = rng.choice(texts).split()
        for _ in range(rng.choice([0, 0, 1, 3, 8, 20])):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1, 1])] = rng.choice([["other"], [], ["two", "more"], [words[at]]])
        rows.append((k, " ".join(["lead"] * rng.randrange(3) + words + ["the", "end"] + (rng.choice(texts).split() if k % 5 == 0 else []))))
    docs = docs_of(rows)
    for table in (docs, real.filter("text LIKE '%icense%'")):
        expected = {i: labels_brute(t, license_scan.TEMPLATES) for i, t in text_rows(table)}
        for r in license_scan.scanned(table).collect():
            base = set(filter(None, r.base_labels.split(",")))
            assert (sorted(set(filter(None, r.labels.split(","))) - base), round(r.score, 9)) == (sorted(set(expected[r.doc_id][0]) - base), round(expected[r.doc_id][1], 9)), r.doc_id
    named = {label: license_scan.scanned(docs_of([(1, texts[-1] + " .")])).first().labels for label, texts in license_scan.TEMPLATES.items() if label in ("gpl-2.0", "gpl-3.0", "lgpl-2.1", "agpl-3.0", "bsd-3-clause", "bsd-2-clause", "isc")}
    assert all(label in labels.split(",") and len([x for x in labels.split(",") if x != "gpl"]) == 1 for label, labels in named.items()), named


def test_license_spans_are_aligned_whole(docs_of, spark, tmp_path):
    """Words far from any hit count as they are, and words changed in a row don't."""
    template = [f"t{k}" for k in range(120)]
    templates = {"own": [" ".join(template)], "long": [" ".join(f"u{k}" for k in range(6000))]}
    fourth = template[:20] + [f"x{k}" if k % 4 == 3 else w for k, w in enumerate(template[20:100])] + template[100:]
    gone = template[:20] + [f"x{k}" for k in range(80)] + template[100:]
    long = [f"u{k}" if k < 8 or k > 5990 or k % 4 else "y" for k in range(6000)]
    far = template[:60] + ["z"] * 9000 + template[60:]
    docs = docs_of([(1, " ".join(template)), (2, " ".join(gone)), (3, " ".join(["a", "b", *fourth, "c"])), (4, " ".join(long)), (5, " ".join(far)), (6, " ".join([*fourth, *far, *template]))])
    found = {r.doc_id: (r.labels, round(r.score, 2), [(s.first, s.stop) for s in r.spans]) for r in license_scan.scanned(docs, templates=templates).collect()}
    assert found[1] == ("own", 1.0, [(0, 120)]) and found[2] == ("", 0.0, [])
    assert found[3] == ("own", 0.83, [(2, 122)]) and found[4] == ("long", 0.75, [(0, 6000)]) and found[5][0] == ""
    assert found[6] == ("own", 1.0, [(0, 120), (9240, 9360)])
    for name, texts in templates.items():
        (tmp_path / f"{name}.txt").write_text(texts[0])
    assert license_scan.folder_templates(spark, str(tmp_path)) == {k: templates[k] for k in sorted(templates)}


def test_one_row_with_a_notice_very_often(docs_of):
    """Equal rows share their hits, and each has its result."""
    docs = docs_of([(None, f"x {NOTICE} y")] * 3000 + [(2, "nothing")] * 3).repartition(4)
    found = license_scan.scanned(docs).collect()
    assert len(found) == 3003 and {(r.doc_id, r.labels, r.score, len(r.spans)) for r in found} == {(None, "apache,apache-2.0", 1.0, 1), (2, "", 0.0, 0)}


def test_license_of_many_documents_at_once(docs_of):
    """A phrase and a notice that every document has."""
    docs = docs_of([(k, f"Document {k}. Released under the MIT License. " * (1 + k % 3)) for k in range(2000)] + [(-1, "MIT License " * 50_000)])
    found = {r.doc_id: (r.n_base, r.labels) for r in license_scan.scanned(docs).collect()}
    assert found[-1] == (50_000, "mit") and all(found[k] == (1 + k % 3, "mit") for k in range(2000))


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a> Site name</header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div class="cookie-notice">We use cookies &amp; more to make this site work for you and others.</div>
<article><header class="entry-header"><h1>The   title</h1></header><p>First &lt;b&gt; para with <a href=x>a link</a> and&nbsp;more<br>text<p>Second one<!-- not <p>this</p> -->.
<aside>Read also: other story</aside><div class='ad'>Buy now!</div><p>Short.</p><article class="comment"><p>I liked this very much, thank you all for writing it down here.</p></article><ul><li>Item one<li>Item two</ul></article>
<section id="comments"><p>A reader's comment that is rather long and has no links in it at all, really.</p></section>
<form><p>Subscribe to our newsletter today and get all the best stories of the week.</p></form><footer>&copy; me</footer></body></html>"""


def test_page():
    tree = html_text.grown(*html_text.labelled())
    assert html_text.main_text(PAGE, tree) == "\n\n".join(["The title", "First <b> para with a link and more text", "Second one.", "Short.", "Item one", "Item two"])
    assert html_text.main_text("", tree) == ""
    assert html_text.main_text("<p>" * 3000, tree) == ""
    assert "1 < 2" in html_text.main_text("<article><p>if 1 < 2 then stop here now</p>", tree)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<video-js id=v></video-js><article><p>all text</p></article>", "all text"),
        ("<audio-player/><svg-icon class=x></svg-icon><article><p>all text</p></article>", "all text"),
        ('<article><p>one <svg class="i"/> two</p><p>three</p>', "one two\n\nthree"),
        ("<article><p>one <math/> two</p><p>three</p>", "one two\n\nthree"),
        ("<article><p>one <svg class=i> two</p><p>three</p>", "one two\n\nthree"),
        ("<article><p>one <svg class=i> two</p><p>three <svg><path/></svg> four</p>", "one two\n\nthree four"),
        ("<article><p>one <svg>a<svg>b</svg>c</svg > two</p>", "one two"),
        ("<article><svg>a<!-- </svg> -->b</svg><p>one</p>", "one"),
        *((f"<article><p>one</p><{name}><p>two</p>", "one\n\ntwo") for name in sorted(html_text.RAW - {"script", "style"})),
        *((f"<article><p>one</p><{name} a=b><p>two</p></{name}\n><p>three", "one\n\nthree") for name in sorted(html_text.RAW)),
        *((f"<article><p>one</p><{name}><p>two</p>", "one") for name in ("script", "style")),
        ("<title>The <script> element</title><article><p>one</p>", "one"),
        ("<article><script>a='<svg>'</script><p>one</p><svg>x</svg><p>two</p>", "one\n\ntwo"),
    ],
)
def test_raw_elements_end_where_they_end(page, text):
    assert html_text.main_text(page, html_text.grown(*html_text.labelled())) == text


def test_many_open_raw_elements_take_linear_time():
    page = "<article>" + "<svg><iframe><p>word</p>" * 50_000
    assert len(html_text.text_blocks(page)) == 50_000


LONG = "This paragraph has quite a few words and no links in it, as the main text of a page has, sentence after sentence."
LINKS = "<ul>" + "<li><a href=x>Some page</a></li>" * 4 + "</ul>"


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        (f"<div>{LINKS}</div><div><h1>A title</h1><p>{LONG}</p><h2>Part two</h2><p>Short one.</p><p>{LONG}</p></div><div>{LINKS}</div>", ["A title", LONG, "Part two", "Short one.", LONG]),
        (f"<div><p>{LONG}</p><ul><li>Item one<li>Item two<li><ul><li>Inner</ul><li>Item three</ul><p>{LONG}</p></div>", [LONG, "Item one", "Item two", "Inner", "Item three", LONG]),
        (f"<div><p>{LONG}</p><p>The end.</p></div><div>{LINKS}</div>", [LONG, "The end."]),
        (f"<div>{LINKS}</div><div>Follow us</div><div>{LINKS}</div><div>Copyright me</div>", []),
        (f"<div><p>{LONG}</p>{LINKS}<p>{LONG}</p></div>", [LONG, LONG]),
        *((f"<div class='{name}'><article><h1>A title</h1><p>Short.</p><p>Shorter.</p></article></div>", ["A title", "Short.", "Shorter."]) for name in ("with-sidebar", "page has-ads", "content-sidebar-wrap", "no-comments")),
        *((f"<div class='{name}'><h1>A title</h1><p>{LONG}</p><p>{LONG}</p></div>", ["A title", LONG, LONG]) for name in ("with-sidebar", "content-sidebar-wrap", "header-fixed")),
        (f"<form id=aspnetForm><div><h1>A title</h1><p>{LONG}</p><p>{LONG}</p></div><article><p>Short.</p><p>Shorter.</p></article></form>", ["A title", LONG, LONG, "Short.", "Shorter."]),
        ("<div class='page menu'><p>Not this.</p><main><p>Short.</p><p>Shorter.</p></main></div>", ["Short.", "Shorter."]),
        *((f"<div class='{name}'><p>{LONG}</p><p>{LONG}</p><article><p>{LONG}</p></article></div>", []) for name in ("sidebar", "related-posts", "cookie-notice", "comments-with-ads")),
        (f"<aside><p>{LONG}</p></aside><div>Close</div><nav>{LINKS}</nav><div>Follow us</div>", []),
    ],
)
def test_pages_without_articles_and_wrappers(page, texts):
    assert html_text.main_text(page, html_text.grown(*html_text.labelled())).split("\n\n") == (texts or [""])


def test_tree_splits_on_neighbours():
    tree = html_text.grown(*html_text.labelled())
    names = html_text.FEATURES
    row = dict.fromkeys(names, 0.0) | {"words": 4.0}
    share = lambda **k: html_text.main_text_share(tree, html_text.with_prose(html_text.np.array([[(row | k)[n] for n in names[:-1]]]))[0].tolist())
    assert share(words_before=40.0, words_after=40.0) == share(words_after=40.0) == share(words_before=40.0) == 1
    assert share() == share(words_before=40.0, links_before=90.0) == share(words_after=3.0) == 0


def test_tree_fits_its_table():
    x, y = html_text.labelled()
    tree = html_text.grown(x, y)
    assert [html_text.main_text_share(tree, row) >= 0.5 for row in x.tolist()] == [bool(v) for v in y]


def test_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extracted(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)
        body = re.sub("<footer>.*", "", body[1] if body else "", flags=re.S).replace("<br>", " ")
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body))
        assert found[r.page_id] == "\n\n".join(p for p in parts if p)
    odd = spark.createDataFrame([(1, None, None), (None, "u", "<p>x")], "page_id long, url string, html string")
    assert {(r.page_id, r.url) for r in html_text.extracted(odd).collect()} == {(1, None), (None, "u")}


P30, P4 = " ".join(f"word{k}" for k in range(30)) + ".", "A short one here."


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        (f'<html><body><form id="aspnetForm"><div class="nav"><a href=/>Home</a> <a>x</a></div><p>{P30}</p><p>{P4}</p><p>{P30}</p><div class="footer">copyright 2020</div></form></body></html>', [P30, P4, P30]),
        (f"<form id='aspnetForm'><p>{P4}</p><p>{P30}</p><p>{P4}</p></form>", [P4, P30, P4]),
        (f"<body><div class='page search'><p>{P30}</p><p>{P30}</p></div></body>", [P30, P30]),
        (f"<body><div class='page search'><form><div class='x comments'><p>{P30}</p></div><p>{P30}</p></form></div></body>", [P30]),
        ("<html><body><p>The shop is closed.</p></body></html>", ["The shop is closed."]),
        ("<nav><a>Home</a></nav><div><h2>News</h2><p>The shop is closed.</p><p>Open</p></div><footer>Copyright me and all others there.</footer>", ["News", "The shop is closed."]),
        (f"<div class='post'><p>{P30}</p><p>{P4}</p><p>{P4}</p><p>{P4}</p></div><div class='a comments'><p>{P30}</p><p>{P30}</p></div>", [P30, P4, P4, P4]),
        (f"<nav><a>a b c</a></nav><footer>{P30}</footer>", []),
        ("<div>Close</div><div>Next page</div>", []),
    ],
)
def test_pages_in_wrappers_and_of_one_sentence(page, texts):
    assert html_text.main_text(page, html_text.grown(*html_text.labelled())).split("\n\n") == (texts or [""])


@pytest.mark.parametrize(("body", "article"), [("<body>", "<div>"), ("<body>", '<div class="page search">'), ('<body><form id="aspnetForm">', "<div>"), ('<body class="comments"><div class="site has-sidebar share" id="w1"><form action="/">', '<div class="c2">')])
def test_pages_of_the_table_without_articles(spark, body, article):
    """Pages whose article is a bare element in a wrapper: no text from elsewhere, and nearly all the texts."""
    tree, same, total = html_text.grown(*html_text.labelled()), 0, 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", r.html or "", re.S)
        inside = re.sub("<footer>.*", "", inside[1] if inside else "", flags=re.S).replace("<br>", " ")
        parts = [p for p in (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inside)) if p]
        found = html_text.main_text((r.html or "").replace("<body>", body).replace("<article>", article).replace("</article>", "</div>"), tree).split("\n\n")
        assert set(found) <= {*parts, ""}
        same, total = same + (found == (parts or [""])), total + 1
    assert same >= 0.95 * total


@pytest.mark.parametrize("piece", ["<a b ", "<div>", "<div></span></p>", "<a \"'", "<a b='", "<", "</script x", "<svg x", "<svg>", "<!-- <", "<ul><li>x"])
def test_a_megabyte_of_broken_markup_takes_a_moment(piece):
    import time

    tree = html_text.grown(*html_text.labelled())
    began = time.perf_counter()
    html_text.main_text(piece * (1_000_000 // len(piece)), tree)
    html_text.main_text("<svg><article>" + piece * (1_000_000 // len(piece)) + ">", tree)
    assert time.perf_counter() - began < 12


def test_pages_repeated_clashing_and_none(spark):
    long = "<html><body><div>" + "".join(f"<p>Paragraph {k} of a long page with quite a few words in each of its paragraphs.</p>" for k in range(20_000)) + "</div></body></html>"
    rows = [(1, "u", "<p>" + "some words of a paragraph that is long enough to stay " * 2 + "</p>"), (1, "u", "<p>" + "some words of a paragraph that is long enough to stay " * 2 + "</p>"), (None, None, None), (2, "v", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url AS text", "url AS n_chars")
    found = sorted((r.page_id or 0, r.text) for r in html_text.extracted(pages).collect())
    assert found[0] == (0, "") and found[1] == found[2] and found[1][1].startswith("some words")
    assert found[3][1].count("\n\n") == 19_999
    assert html_text.extracted(pages.filter("false")).count() == 0
