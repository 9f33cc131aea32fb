"""Readers of trees and of large documents against the plain readers."""

import json
import os
import random

import pytest

from quarrylens.operators import dependencies
from quarrylens.sources import inputs, readers, records, walks, writers


@pytest.fixture(scope="module")
def tree(tmp_path_factory, spark, sf_dir):
    root = tmp_path_factory.mktemp("tree")
    for r in inputs.tree(spark, sf_dir).collect():
        file = root / r.path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(r.text, newline="")
    (root / "venv" / "deep" / "deeper").mkdir(parents=True)
    (root / "venv" / "deep" / "deeper" / "a.py").write_text("x = 1")
    (root / "empty").mkdir()
    return root


def rows(df):
    return sorted((r.path, r["size"], bytes(r.content)) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"patterns": ("*.js", "src1/**/*.py", "build/")}, {"skip_size": 300}, {"folder_hash": True}])
def test_walked_tree_has_the_files_of_the_listed_one(tree, spark, options):
    assert rows(walks.scanned_tree(spark, str(tree), **options)) == rows(readers.source_tree(spark, str(tree), **options))


def test_skipped_folders_are_not_entered(tree, spark, monkeypatch):
    # entries below a folder come from listing it
    listed = {r.path.rpartition("/")[0] for r in walks.walked(spark, str(tree)).collect()}
    assert "src1" in listed and not any(x.split("/")[0] == "venv" or "/.hidden" in x or ".egg-info" in x for x in listed)
    everything = {r.path.rpartition("/")[0] for r in walks.walked(spark, str(tree), everything=True).collect()}
    assert "venv/deep/deeper" in everything
    assert walks.walked(spark, f"file://{tree}").count() == walks.walked(spark, str(tree)).count()
    assert walks.walked(spark, str(tree / "missing")).count() == 0 and walks.walked(spark, str(tree / "empty")).count() == 0


def test_links_to_folders_are_not_followed(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "f.py").write_text("x = 1")
    os.symlink(tmp_path, tmp_path / "a" / "loop")
    os.symlink(tmp_path / "a" / "f.py", tmp_path / "g.py")
    os.symlink(tmp_path / "gone", tmp_path / "h.py")
    assert sorted(r.path for r in walks.walked(spark, str(tmp_path)).collect()) == ["a", "a/f.py", "g.py"]


def test_many_levels_and_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(walks, "FOLDERS", 3)
    for k in range(40):
        folder = tmp_path / f"a{k % 7}" / "/".join(f"d{j}" for j in range(k % 9))
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f{k}.py").write_text(str(k) * 20)
    assert rows(walks.scanned_tree(spark, str(tmp_path))) == rows(readers.source_tree(spark, str(tmp_path)))


def wfp(n):
    return "".join(f"file={k:032x},{k},dir {k % 3}/f,{k}.py\n" + "".join(f"{n}={k * n:08x},{n:08x}\n" for n in range(1, 1 + k * 7 % 23)) + ("fh2=ab\n" if k % 4 == 0 else "") for k in range(n))


@pytest.mark.parametrize(("split", "ends", "n"), [(1 << 20, "\n", 60), (2000, "\r\n", 60), (311, "\n", 12), (64, "\r\n", 5), (17, "\n", 4)])
def test_fingerprint_records_of_any_split(spark, tmp_path, split, ends, n):
    WFP = wfp(n)
    (tmp_path / "a.wfp").write_text(("before=1\n" + WFP).replace("\n", ends), newline="")
    (tmp_path / "b.wfp").write_text(WFP[: len(WFP) // 2].rstrip("\n"))
    (tmp_path / "c.wfp").write_text("")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        found = {(r.doc_path.rpartition("/")[2], r.record): r.wfp for r in records.wfp_pieces(spark, str(tmp_path)).collect()}
        fields = records.wfp_records(spark, f"{tmp_path}/a.wfp").drop("doc_path", "record").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {}
    for name, text in (("a.wfp", WFP), ("b.wfp", WFP[: len(WFP) // 2].rstrip("\n") + "\n")):
        for number, record in enumerate(text.split("file=")[1:]):
            want[name, number] = "file=" + record
    assert found == want
    plain = readers.wfp_records(spark, f"{tmp_path}/a.wfp").collect() if ends == "\n" else None
    if plain:
        shown = lambda listed: sorted((r.path, r.md5, r["size"], r.fh2, str(r.snippets)) for r in listed)
        assert shown(fields) == shown(plain)
    assert [r.path for r in sorted(fields, key=lambda r: r["size"])] == [f"dir {k % 3}/f,{k}.py" for k in range(n)]


def parts_of(text, sizes):
    rng, at = random.Random(len(text)), 0
    while at < len(text):
        n = rng.choice(sizes)
        yield text[at : at + n]
        at += n


@pytest.mark.parametrize("sizes", [[1], [1, 2, 3, 50], [4000]])
@pytest.mark.parametrize("indent", [None, 2])
def test_json_entries_of_any_chunks(sizes, indent):
    rng = random.Random(1)
    value = lambda d: rng.choice([rng.randrange(10**9), -1.5e-7, True, None, 'a "quoted\\   ü\n{[', "", *([[value(d - 1) for _ in range(rng.randrange(4))], {f"k,{k}": value(d - 1) for k in range(rng.randrange(4))}] if d else [])])
    data = {f'path "{k}"/é': value(4) for k in range(60)}
    text = json.dumps(data, indent=indent)
    assert [(k, json.loads(v)) for k, v in records.json_entries(parts_of(text, sizes))] == list(data.items())
    listed = {"head": value(3), "files": [value(3) for _ in range(40)], "files2": [1], "tail": 5}
    text = " " + json.dumps(listed, indent=indent, ensure_ascii=False) + "\n"
    assert [json.loads(v) for _, v in records.json_entries(parts_of(text, sizes), "files")] == listed["files"]


@pytest.mark.parametrize("text", ["[]", '{"a": 1', '{"a" 1}', '{"a": }', '{"a": 1} x', '{"a": 1,}', "{1: 2}", '{"a": tru}', "nothing"])
def test_json_that_is_none(text):
    with pytest.raises(ValueError):
        list(records.json_entries(iter([text])))


def test_json_without_entries_and_what_is_held():
    assert list(records.json_entries(iter([]))) == list(records.json_entries(iter([" \n"]))) == list(records.json_entries(iter(["{ }"]))) == []
    most = 0

    def chunks():
        yield "{"
        for k in range(20_000):
            yield f'{"," if k else ""}"file {k}": [{{"id": "none", "lines": "{"x" * (k % 50)}"}}]'
        yield "}"

    class Watched(records._Text):
        def more(self):
            nonlocal most
            out = super().more()
            most = max(most, len(self.text))
            return out

    plain, records._Text = records._Text, Watched
    try:
        assert sum(1 for _ in records.json_entries(chunks())) == 20_000
    finally:
        records._Text = plain
    assert most < 2000  # of 1.5 MB


def test_results_and_inventories_of_large_documents(spark, sf_dir, tmp_path, monkeypatch):
    matches = inputs.matches(spark, sf_dir)
    texts = [r.json for r in writers.result_json(matches).collect()]
    (tmp_path / "r.json").write_text("{" + ",\n".join(t[1:-1] for t in texts) + "}")
    plain, ours = (f(spark, f"{tmp_path}/r.json").drop("doc_path") for f in (readers.scan_results, records.scan_results))
    assert ours.columns == plain.columns
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect())) and ours.count() == matches.count()
    files = [{"path": f"p{k}", "type": "file", "package_data": [{"dependencies": [{"purl": f"pkg:npm/a{k}@1", "scope": "dev"}]}] if k % 2 else [], "packages": [{"dependencies": [{"purl": f"pkg:npm/b{k}"}]}]} for k in range(30)]
    (tmp_path / "i.json").write_text(json.dumps({"headers": [{"tool": "x"}], "files": files}, indent=1))
    shown = lambda f: sorted(map(str, dependencies.flattened(f(spark, f"{tmp_path}/i.json")).collect()))
    assert shown(records.inventory) == shown(readers.inventory) and len(shown(records.inventory)) == 30
