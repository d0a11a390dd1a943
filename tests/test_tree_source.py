"""The tree as a data source: which folders it opens."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, StringStartsWith

from pairloom.sources.listing import list_tree
from pairloom.sources.tree_source import TASKS, TreeReader, tree_files

FILES = ["top.txt", "a/one.tar", "a/b/two.tar", "a/b/c/d/three.tar", "a/bc/four.tar", "other/five.tar", "other/deep/er/six.tar"]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for i, f in enumerate(FILES):
        (root / f).parent.mkdir(parents=True, exist_ok=True)
        (root / f).write_bytes(b"x" * i)
    (root / "empty").mkdir()
    return str(root)


def listed(root, filters, levels, monkeypatch):
    """Paths that a reader gives, and the folders it opened for them."""
    opened, reader = [], TreeReader({"path": root, "levels": str(levels)})
    list_one = TreeReader._list
    monkeypatch.setattr(TreeReader, "_list", lambda self, folder, recursive=False: opened.append((folder, recursive)) or list_one(self, folder, recursive))
    assert reader.pushFilters(filters) == filters
    rows = [p for part in reader.partitions() for batch in reader.read(part) for p in batch.column("path").to_pylist()]
    monkeypatch.undo()
    return sorted(rows), opened


@pytest.mark.parametrize("levels", [0, 1, 2, 5])
def test_only_folders_of_the_prefix_are_opened(root, monkeypatch, levels):
    rows, opened = listed(root, [], levels, monkeypatch)
    assert rows == sorted(FILES)
    for prefix in ("a/b/", "a/b", "other/", "a/b/c/d/three", "nowhere/x", "top"):
        rows, opened = listed(root, [StringStartsWith(("path",), prefix), GreaterThan(("size",), 0)], levels, monkeypatch)
        assert [p for p in rows if p.startswith(prefix)] == [p for p in sorted(FILES) if p.startswith(prefix)]
        start = prefix.rpartition("/")[0]
        assert all(f == start or f.startswith(start + "/") or not start for f, _ in opened), (prefix, opened)
        if start == "a/b":
            assert not [f for f, _ in opened if f.startswith(("other", "a/bc"))]
    rows, opened = listed(root, [EqualTo(("path",), "a/b/two.tar")], levels, monkeypatch)
    assert "a/b/two.tar" in rows and not [f for f, _ in opened if not f.startswith("a/b")]
    assert listed(root, [StringStartsWith(("path",), "a/b/"), StringStartsWith(("path",), "other/")], levels, monkeypatch)[0] == []


def test_tree_in_spark(spark, root):
    want = {r.path: r["size"] for r in list_tree(spark, root).collect()}
    assert {r.path: r["size"] for r in tree_files(spark, root).collect()} == want and len(want) == len(FILES)
    some = tree_files(spark, root).filter(F.col("path").startswith("a/b/") & (F.col("size") > 2))
    assert [r.path for r in some.collect()] == ["a/b/c/d/three.tar"]
    got = sorted(r.path for r in tree_files(spark, root, ["a/b", "a/b/c", "other/deep/"]).collect())
    assert got == sorted(f for f in FILES if f.startswith(("a/b", "other/deep/")))
    assert tree_files(spark, root + "/nowhere").count() == 0


def test_filters_reach_the_source(spark, root):
    """The planned partitions follow the filter: one folder less makes one task less."""
    everything = tree_files(spark, root).rdd.getNumPartitions()
    some = tree_files(spark, root, ["other/"]).rdd.getNumPartitions()
    assert everything == 4 and some == 2


def test_many_folders_share_tasks(spark, tmp_path):
    """Neither tasks nor the folders opened for the plan grow with the tree."""
    want = [f"top/d{i}/{name}" for i in range(2 * TASKS + 1) for name in ("a.png", "deep/b.png")]
    for f in want:
        (tmp_path / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f).write_bytes(b"x")
    reader = TreeReader({"path": str(tmp_path), "levels": "3"})
    opened, list_one = [], reader._list
    reader._list = lambda folder, recursive=False: opened.append(folder) or list_one(folder, recursive)
    reader.pushFilters([StringStartsWith(("path",), "top/")])
    parts = reader.partitions()
    assert len(parts) == TASKS and opened == ["top"]
    assert sorted(p for part in parts for batch in reader.read(part) for p in batch.column("path").to_pylist()) == sorted(want)
    assert tree_files(spark, str(tmp_path), ["top/"], levels=3).count() == len(want)
