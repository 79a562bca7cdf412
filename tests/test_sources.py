import os
from pathlib import Path

import pytest

from tests.conftest import rows
from wordgraph import bag_files, edge_list, url_pairs, write_tuples
from wordgraph.operators.overlap import overlap_edges

FILE_LINES = ["# c", "", "5", "x y", " 3 4", "1 2 9", "1 2\r", "7\t8"]


def write(path, lines, newline="\n"):
    with open(path, "w", newline="") as f:
        f.write(newline.join(lines) + newline)


@pytest.fixture()
def workdir(tmp_path):
    return tmp_path


def test_edge_list_permissive(spark, workdir):
    p = workdir / "e.txt"
    write(p, FILE_LINES)
    got = rows(edge_list(spark, str(p), permissive=True))
    assert got == [(1, 2), (1, 2), (7, 8)]


@pytest.mark.parametrize("bad", ["5", "x y", " 3 4"])
def test_edge_list_strict_raises(spark, workdir, bad):
    p = workdir / "e.txt"
    write(p, ["1 2", bad])
    with pytest.raises(Exception):
        edge_list(spark, str(p)).collect()


def test_edge_list_strict_ok(spark, workdir):
    p = workdir / "e.txt"
    write(p, ["# header", "", "1 2 9", "3\t4", "0 0"], newline="\r\n")
    assert rows(edge_list(spark, str(p))) == [(0, 0), (1, 2), (3, 4)]


def test_url_pairs(spark, workdir):
    p = workdir / "u.txt"
    write(p, ["# c", "a b", "a b", "x y", "1 2 9"])
    assert rows(url_pairs(spark, str(p))) == [("#", "c"), ("1", "2"), ("a", "b"), ("x", "y")]
    write(p, ["a b", ""])
    with pytest.raises(Exception):
        url_pairs(spark, str(p)).collect()
    write(p, ["a b", "", "5", " 3 4"])
    assert rows(url_pairs(spark, str(p), permissive=True)) == [("a", "b")]


def test_bag_files(spark, workdir):
    d = workdir / "bags"
    d.mkdir()
    content = {
        "f0": ["apple", "banana", "apple", "cherry"],
        "f1": ["apple", "date"],
        "f2": ["date", "egg", "fig", "egg"],
        "f3": ["zebra"],
        "f5": ["kiwi lime", "kiwi"],
        "f6": ["kiwi", ""],
        "f7": ["apple", "Apple"],
    }
    for name, lines in content.items():
        write(d / name, lines)
    (d / "f4").write_text("")
    write(d / "_hidden", ["apple"])
    (d / "sub").mkdir()
    write(d / "sub" / "g", ["apple"])
    vertices, postings = bag_files(spark, str(d))
    assert vertices.count() == 8
    paths = {r["v"]: os.path.basename(r["path"]) for r in vertices.collect()}
    assert paths == {i: f"f{i}" for i in range(8)}
    assert postings.where("v = 4").count() == 0
    assert rows(postings.where("v = 6"), "w") == [("",), ("kiwi",)]
    assert rows(postings.where("v = 5"), "w") == [("kiwi",), ("kiwi lime",)]
    assert overlap_edges(postings).count() == 10
    _, counts = bag_files(spark, str(d), counts=True)
    assert rows(counts.where("v = 0")) == [(0, "apple", 2), (0, "banana", 1), (0, "cherry", 1)]


def test_write_tuples(spark, workdir):
    df = spark.createDataFrame([(1, 0.5), (2, 1.0)], "id bigint, rank double")
    out = workdir / "out"
    write_tuples(df, str(out))
    lines = sorted(l for f in out.glob("part-*") for l in f.read_text().splitlines())
    assert lines == ["(1,0.5)", "(2,1.0)"]
    with pytest.raises(Exception):
        write_tuples(df, str(out))


def test_empty_bag_directory(spark, workdir):
    d = workdir / "none"
    d.mkdir()
    (d / "only_empty").write_text("")
    vertices, postings = bag_files(spark, str(d))
    assert vertices.count() == 1 and postings.count() == 0


def test_url_pairs_trailing_blanks(spark, tmp_path):
    import pytest

    from wordgraph.sources.text import url_pairs

    (tmp_path / "good.txt").write_text("a b \nc d\n")
    (tmp_path / "bad.txt").write_text("a b\nc \n   \n")
    good, bad = str(tmp_path / "good.txt"), str(tmp_path / "bad.txt")
    assert sorted(map(tuple, url_pairs(spark, good).collect())) == [("a", "b"), ("c", "d")]
    assert url_pairs(spark, bad, permissive=True).collect() == [("a", "b")]
    with pytest.raises(Exception):
        url_pairs(spark, bad).collect()


def test_string_ids_in_components(spark):
    from wordgraph.operators.components import components_from_edges

    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("y", "x")], "src string, dst string")
    got = {tuple(r) for r in components_from_edges(edges.selectExpr("src as v"), edges).collect()}
    assert got == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}


def test_bag_files_of_equal_hash_are_told_apart(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from wordgraph.sources import text

    for name, lines in {"a": "x\ny\nx\n", "b": "x\n", "c": "", "d": "y\n\n"}.items():
        (tmp_path / name).write_text(lines)
    right = text._file_key
    monkeypatch.setattr(text, "_file_key", lambda path, seed: F.lit(1).cast("bigint") + F.length(path) * 0
                        if seed < 2 else right(path, seed))
    vertices, counts = text.bag_files(spark, str(tmp_path), counts=True)
    assert [(r["v"], r["path"][-1]) for r in vertices.orderBy("v").collect()] == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]
    assert rows(counts) == [(0, "x", 2), (0, "y", 1), (1, "x", 1), (3, "", 1), (3, "y", 1)]


def test_bags_of_documents_are_written_by_few_tasks(spark, tmp_path):
    from wordgraph.plans import registry

    docs = [(i, f"Word{i // 64} two\ttwo") for i in range(64 * 40)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    path = registry._written_bags(spark, str(tmp_path))
    folders = sorted(Path(path.removeprefix("file:")).glob("bag=*"))
    assert [len(list(f.glob("part-*"))) for f in folders] == [1] * 41
    # The task's number is part of a file's name.
    assert len({p.name.split("-")[1] for f in folders[1:] for p in f.glob("part-*")}) <= 8
    vertices, counts = registry.T.bag_files(spark, path, counts=True)
    assert vertices.count() == 41
    assert rows(counts.where("v in (0, 1, 11)")) == [
        (1, "two", 128), (1, "word0", 64), (11, "two", 128), (11, "word10", 64)]
