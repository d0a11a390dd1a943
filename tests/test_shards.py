"""Numbers, shards, gates and the reports that depend on them."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairloom.operators import shards, slices, verify


@pytest.fixture(scope="module")
def kept(spark):
    """Pairs of three files, one of them with most rows, with gaps and several turns."""
    return spark.range(5000).selectExpr(
        "CASE WHEN id % 10 < 7 THEN 'big.parquet' WHEN id % 10 < 9 THEN 'a.parquet' ELSE 'z.parquet' END AS file",
        "IF(id % 10 < 7, concat('part-', id div 2000), '') AS part",
        "id AS row_index",
        "explode(sequence(0, CAST(id % 3 AS INT))) AS turn_pos",
    ).selectExpr("*", "concat('p', row_index) AS prompt").filter("row_index % 11 <> 5")


@pytest.mark.parametrize("block", [7, 1 << 20])
@pytest.mark.parametrize("per_file", [False, True])
def test_numbers_equal_a_global_window(kept, monkeypatch, block, per_file):
    monkeypatch.setattr(shards, "BLOCK_ROWS", block)
    order = W.orderBy("file", "part", "row_index", "turn_pos")
    order = order.partitionBy("file") if per_file else order
    want = kept.withColumn("pair_index", F.row_number().over(order) - 1)
    got = shards.pair_index(kept, per_file)
    assert got.select(want.columns).exceptAll(want).isEmpty()
    assert got.count() == want.count()


def test_shards_are_full_but_the_last(kept):
    samples = shards.assign_shards(shards.pair_index(kept), 97, prefix=" x ")
    sizes = {r.shard_id: (r.shard_name, r.samples) for r in shards.shard_sizes(samples).collect()}
    total, n = kept.count(), len(sizes)
    assert n == -(-total // 97)
    assert [sizes[i][1] for i in range(n)] == [97] * (n - 1) + [total - 97 * (n - 1)]
    assert sizes[3][0] == "x-shard-00003.tar"
    assert samples.select("key").distinct().count() == total


def test_existing_shards_keep_their_numbers(spark, kept):
    samples = shards.assign_shards(shards.pair_index(kept), 1000)
    existing = spark.createDataFrame([("shard-00000.tar",), ("shard-00000.tar",), ("other.tar",)], "shard_name string")
    left = shards.skip_existing(samples, existing)
    assert left.agg(F.min("pair_index")).first()[0] == 1000
    assert left.count() == kept.count() - 1000


def test_statuses(spark):
    rows = [(1, True, 1, True), (None, None, 1, True), (0, None, 1, True), (1, False, 1, True), (1, True, 1, None), (0, None, 1, False)]
    df = spark.createDataFrame(rows, "input_size long, input_valid boolean, output_size long, output_valid boolean")
    got = [r.status for r in shards.build_status(df).collect()]
    assert got == ["kept", "missing_file", "missing_file", "bad_image", "unchecked", "missing_file"]


def test_limited_stats(spark):
    """Two files of 600 rows; every second pair is kept."""
    rows = spark.range(1200).selectExpr("IF(id < 600, 'a.parquet', 'b.parquet') AS file", "'' AS part", "id % 600 AS row_index")
    built = rows.selectExpr("*", "0 AS turn_pos", "'' AS prompt", "IF(row_index % 2 = 0, 'kept', 'bad_image') AS status")
    numbered = shards.pair_index(built.filter("status = 'kept'"))

    def stats(n, size):
        found = shards.limited_stats(rows, built, numbered, n, size).collect()
        return sorted((r.file, r.rows, r.pairs_emitted, r.kept, r.bad_image) for r in found)

    # The tenth kept pair is row 18, in the first batch of 256 rows.
    assert stats(2, 5) == [("a.parquet", 256, 19, 10, 9)]
    assert stats(1, 310) == [("a.parquet", 600, 600, 300, 300), ("b.parquet", 256, 19, 10, 9)]
    assert stats(9, 1000) == [("a.parquet", 600, 600, 300, 300), ("b.parquet", 600, 600, 300, 300)]


def test_gate_reasons(spark):
    audit = spark.createDataFrame(
        [("a", "unknown", 0, 0, None), ("b", "lists", 0, 0, None), ("c", "lists", 4, 1, 0.75), ("d", "lists", 4, 0, 1.0), ("e", "lists", 4, 0, 1.0)],
        "file string, layout string, strict_pairs long, broken_pairs long, resolve_rate double",
    )
    build = spark.createDataFrame([("d", 0), ("e", 4)], "file string, kept long")

    def reasons(**limits):
        return [r.reason for r in slices.slice_gate(audit, build, **limits).orderBy("file").collect()]

    assert reasons() == ["unknown_layout", "no_strict_pairs", "low_resolve_rate", "nothing_kept", None]
    assert reasons(min_rate=0.75) == ["unknown_layout", "no_strict_pairs", None, "nothing_kept", None]
    assert reasons(allow_zero_pairs=True, allow_empty=True) == ["unknown_layout", None, "low_resolve_rate", None, None]
    totals = slices.run_summary(slices.slice_gate(audit, build)).first()
    assert (totals.success, totals.skipped, totals.failed) == (1, 4, 0)


def test_triplets(spark):
    names = {
        "good": ["k.jpg", "k.jpg2", "k.txt", "k.json", "README", "dir.x/no"],
        "missing": ["a.jpg", "a.txt", "b.jpg2", "c.x.jpg", "d.txt", "e.jpg", "e.jpg2", "e.txt"],
        "short": ["k.jpg", "k.jpg2", "k.txt"],
        "twice": ["k.jpg", "k.jpg", "k.jpg2", "k.txt"],
    }
    members = spark.createDataFrame([(s, m) for s, ms in names.items() for m in ms], "shard_name string, member string")
    expected = spark.createDataFrame([("good", 1), ("missing", 1), ("short", 2), ("twice", 1), ("gone", 3)], "shard_name string, samples long")
    got = {r.shard_name: r for r in verify.verify_shards(members, expected).collect()}
    assert [got[s].problem for s in ("good", "missing", "short", "twice", "gone")] == [None, "incomplete_keys", "wrong_count", "wrong_count", "wrong_count"]
    assert got["missing"].bad_keys == 4 and got["missing"].examples == ["a", "b", "c.x"]


def test_settings_per_slice(spark):
    settings = slices.PathSettings(rules=[("old", "new")], subdirs={"*": "d", "s1": "Singleturn/x'y"}, hybrid_stems=["h"])
    paths = [("s1.parquet", "a.png"), ("s2.parquet", "./a.png"), ("h.parquet", "results_compose_old/a"), ("hybrid_part9.parquet", "results_compose/old/old"), ("s3.parquet", "results_compose/a"), ("s4.parquet", " none "), ("s5.parquet", "old/none")]
    df = spark.createDataFrame(paths, "file string, input_path string").selectExpr("*", "'x/null' AS output_path")
    refs = {r.file: r.input_ref for r in slices.rewrite_pairs(df, settings).collect()}
    assert refs == {
        "s1.parquet": "Singleturn/x'y/a.png",
        "s2.parquet": "d/a.png",
        "h.parquet": "results_hybrid_new/a",
        "hybrid_part9.parquet": "results_hybrid/new/old",
        "s3.parquet": "results_compose/a",
        # The subfolder comes first, so a bare null word becomes a path.
        "s4.parquet": "d/none",
        "s5.parquet": "new/none",
    }
    off = slices.PathSettings(auto_hybrid=False)
    assert slices.rewrite_pairs(df, off).filter("file = 'hybrid_part9.parquet'").first().input_ref == "results_compose/old/old"
    assert slices.rewrite_pairs(df, off).filter("file = 's4.parquet'").first().input_ref is None
