"""Every query with SQL gives the rows of that SQL; the others run and are held against loops elsewhere."""

import pytest
from helpers import rows_of

from quarrylens.plans import catalog

SQL = catalog.oracle_sql()
PLAIN = sorted(set(catalog.queries()) - set(SQL))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(name, spark, sf_dir, duck):
    ours, theirs = catalog.queries()[name](spark, sf_dir).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


@pytest.mark.parametrize("name", PLAIN)
def test_runs(name, spark, sf_dir):
    assert catalog.queries()[name](spark, sf_dir).count() >= 0


def test_codec_queries_are_those_of_plain_functions(spark, sf_dir):
    from quarrylens.functions import codecs
    from quarrylens.sources import inputs

    run = lambda name: {r[0]: r[1] for r in catalog.queries()[name](spark, sf_dir).collect()}
    texts = {r.path: r.text.encode() for r in inputs.files(spark, sf_dir).collect()}
    plain = {
        "D6_hpsm_lines": codecs.line_hashes,
        "D14_crc32c": lambda t: f"{codecs.crc32c(t):08x}",
        "D15_crc64": lambda t: f"{codecs.crc64(t):016x}",
        "D9_simhash_words": lambda t: f"{codecs.simhash(codecs.fnv1_all(codecs.word_features(t))):X}".lower(),
        "D7_hpsm_strip": lambda t: codecs.strip_line_hashes(codecs.line_hashes(t), ["ff", "00a1"]),
    }
    for name, function in plain.items():
        assert run(name) == {p: function(t) for p, t in texts.items()}, name
    found = {}
    for r in catalog.queries()["D3_winnow_udf"](spark, sf_dir).collect():
        found.setdefault(r.path, []).append((r.line, r.ord, r.hash))
    for path, rows in found.items():
        assert sorted(rows) == [(n, k, h) for n, hashes in codecs.snippet_lines(texts[path]) for k, h in enumerate(hashes)]


def test_entry_point_without_optional_parts(spark, monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setattr(entry, "find_spec", lambda name: None)
    assert set(entry.queries()) == set(catalog.queries())
    assert set(entry.oracle_sql()) == set(SQL)
    assert entry.entry(spark).count() > 0
