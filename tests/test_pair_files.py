"""Pair files of different layouts in one folder."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pairloom.operators.pairs import emit_pairs
from pairloom.plans.flows import explore
from pairloom.sources import pair_files as pf


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("data set+1")
    folder = root / "Parquet"
    folder.mkdir()
    nested = pa.array([[["a/1.png"]], [["a/2.png"], ["x"]]], pa.list_(pa.list_(pa.string())))
    pq.write_table(pa.table({"input_images": nested, "output_images": nested, "prompt": ["p", "q"]}), folder / "add_part0.parquet")
    flat = pa.array([["b/1.png"], ["b/2.png"]])
    pq.write_table(pa.table({"output_images": flat, "input_images": flat, "Caption": ["r", None]}), folder / "b.parquet")
    turns = pa.array([[{"input_images": ["c/1.png"], "output_images": ["c/2.png"], "prompt": " s "}] * 2, None])
    pq.write_table(pa.table({"data": turns, "input_images": flat}), folder / "content.parquet")
    pq.write_table(pa.table({"Original_Path": ["d/1.png", " "], "edited": ["d/2.png", "d/3.png"]}), folder / "d.parquet")
    pq.write_table(pa.table({"source_img": [b"1"], "target_img": [b"2"]}), folder / "embed.parquet")
    pq.write_table(pa.table({"id": [1, 2, 3]}), folder / "other.parquet")
    (folder / "multi.parquet").mkdir()
    for n in (0, 1):
        pq.write_table(pa.table({"input_images": flat, "output_images": flat, "prompt": ["m", "n"]}), folder / "multi.parquet" / f"part-{n}.parquet")
    (folder / "_SUCCESS").touch()
    (folder / "notes.txt").touch()
    return str(root)


@pytest.fixture(scope="module")
def scanned(spark, root):
    return pf.scan_pairs(spark, pf.column_catalog(spark, pf.list_pair_files(root)))


def test_layouts(scanned):
    got = {r.file: (r.layout, r.input_col, r.output_col, r.text_col) for r in scanned[1].collect()}
    assert got == {
        "add_part0.parquet": ("lists", "input_images", "output_images", "prompt"),
        "b.parquet": ("lists", "input_images", "output_images", "Caption"),
        "content.parquet": ("multiturn", None, None, "prompt"),
        "d.parquet": ("path", "Original_Path", "edited", None),
        "embed.parquet": ("embed", "source_img", "target_img", None),
        "multi.parquet": ("lists", "input_images", "output_images", "prompt"),
        "other.parquet": ("unknown", None, None, None),
    }


def test_rows_and_pairs(scanned):
    rows = scanned[0]
    counts = {r.file: r["count"] for r in rows.groupBy("file").count().collect()}
    assert counts == {"add_part0.parquet": 2, "b.parquet": 2, "content.parquet": 2, "d.parquet": 2, "embed.parquet": 1, "multi.parquet": 4}
    pairs = sorted((r.file, r.part, r.row_index, r.turn_pos, r.input_path, r.prompt) for r in emit_pairs(rows).collect())
    assert pairs == [
        ("add_part0.parquet", "", 0, 0, "a/1.png", "p"),
        ("b.parquet", "", 0, 0, "b/1.png", "r"),
        ("b.parquet", "", 1, 0, "b/2.png", ""),
        ("content.parquet", "", 0, 0, "c/1.png", "s"),
        ("content.parquet", "", 0, 1, "c/1.png", "s"),
        ("d.parquet", "", 0, 0, "d/1.png", ""),
        *[("multi.parquet", f"part-{n}.parquet", i, 0, f"b/{i + 1}.png", "mn"[i]) for n in (0, 1) for i in (0, 1)],
    ]


def test_profile(spark, root):
    profile = pf.profile_files(pf.column_catalog(spark, pf.list_pair_files(root)))
    got = {r.file: (r.rows, r["columns"], r.names, r.types) for r in profile.collect()}
    assert got["other.parquet"] == (3, 1, ["id"], ["int64"])
    assert got["multi.parquet"][:2] == (4, 3)


def test_file_filter(root):
    assert [f[0] for f in pf.list_pair_files(root, only=" d.parquet ,nope.parquet")] == ["d.parquet"]
    with pytest.raises(FileNotFoundError):
        pf.list_pair_files(root, only="nope.parquet")


def test_exploration_report(spark, scanned):
    listing = spark.createDataFrame([("Singleturn/xa/1.png",), ("Singleturn/results_b.tar",)], "path string")
    report = explore(*scanned, listing)
    total = report["totals"].first()
    assert (total.files, total.rows_total, total.strict_pairs) == (7, 13, 10)
    # a and b occur inside segments, c is a letter of none, d is nowhere.
    assert sorted((r.file, r.root) for r in report["missing_roots"].collect()) == [("content.parquet", "c"), ("d.parquet", "d")]
    files = {r.file: r for r in report["files"].collect()}
    assert files["other.parquet"].rows_total is None
    assert files["content.parquet"].rows_with_many_pairs == 1 and files["content.parquet"].rows_without_pairs == 1
