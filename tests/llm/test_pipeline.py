import ast
import zlib

import numpy as np
import pytest
import test_dedup
import test_texts

import corpus_pipeline
from quarrylens.llm import tokens


@pytest.fixture(scope="module")
def byte_library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(tokens.vocabulary("byte_bpe_50k.json"))


def parsed(row: str):
    return ast.literal_eval(row)


def test_stages_by_brute_force(spark, real, sf_dir, tmp_path, byte_library):
    """Every stage against plain functions on what its predecessor kept."""
    docs = real
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        old, new = {r.doc_id: r for r in before.collect()}, docs.collect()
        if name == "packing":
            break
        assert docs.columns == before.columns
        kept = {r.doc_id for r in new}
        rows = [(i, r.text or "") for i, r in old.items()]
        if name == "quality":
            passed = {i for i, t in rows if not test_texts.quality_brute(t)[5]}
            good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").collect()} & passed
            assert kept <= passed and len(good - kept) <= 0.01 * len(good) and passed - kept
        if name == "exact_dedup":
            assert kept == {x[0] for x in map(parsed, test_dedup.exact_brute(rows)) if x[3]}
        if name == "near_dedup":
            assert kept == {x[0] for x in map(parsed, test_dedup.near_brute(rows)) if x[3]}
        if name == "pii":
            assert kept == set(old) and sum(bool(test_texts.pii_brute(r.text or "")) for r in old.values()) > 0
            for r in new:
                assert test_texts.pii_brute(r.text) == [] and r.n_chars == len(r.text)
                if r.text == (old[r.doc_id].text or ""):
                    assert test_texts.pii_brute(r.text) == []
        else:
            assert all(r == old[r.doc_id] for r in new)
    pieces, room = {}, {}
    for r in new:
        pieces.setdefault(r.doc_id, []).append(r)
        room.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(old)
    for i, found in pieces.items():
        ids = np.array([*byte_library.encode(old[i].text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    for found in room.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_run_is_the_stages(spark, sf_dir, tmp_path):
    assert corpus_pipeline.run(spark, sf_dir, str(tmp_path / "x")).count() > 0
    assert len(corpus_pipeline.STAGES) == 5


def test_odd_tables(spark, odd, clashing, docs_of):
    """Nulls, ties, repeated rows, a long text, columns named like those of the operators, and no rows: the results that the docstrings name."""
    expected = {
        "quality": (set(), set(), set()), "exact_dedup": ({1, 3, 4, 6, 7, None}, {1, 3}, set()), "near_dedup": ({1, 2, 3, 4, 6, None}, {1, 3}, set()),
        "pii": ({1, 2, 3, 4, 5, 6, 7, None}, {1, 2, 3}, set()), "packing": ({1, 2, 3, 4, 5, 6, 7, None}, {1, 2, 3}, set()),
    }
    for number, table in enumerate((odd, clashing, docs_of([]))):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, table, "")
            assert name == "packing" or found.columns == table.columns
            ids = {r.doc_id for r in found.collect()}
            if name == "quality":
                # short texts fail the base rules; the long ones repeat no window
                assert ids <= {6, 7, None}
            else:
                assert ids == expected[name][number], (name, number, ids)


def test_queries_and_sql(spark, sf_dir, duck):
    from helpers import rows_of

    from quarrylens.llm import queries

    for name, sql in queries.oracle_sql().items():
        assert rows_of(queries.queries()[name](spark, sf_dir).toPandas()) == rows_of(duck.sql(sql).df()), name
    for name, query in queries.queries().items():
        assert query(spark, sf_dir).count() >= 0, name
