"""Skewed keys give the same rows, and plans keep the shape they need at scale."""

import re

import pytest
from compare import entry
from pyspark.sql import functions as F

from pairloom.operators import resolve, skew
from pairloom.operators.audit import audit_examples, audited_pairs
from pairloom.operators.pairs import emit_pairs
from pairloom.operators.slices import PathSettings, rewrite_pairs
from pairloom.plans import inputs, registry


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot_rows", [1, 50, 1 << 17])
def test_skewed_join_equals_plain_join(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    left = spark.range(3000).selectExpr(
        "id", "CAST(id % 2 AS INT) AS kind", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN 'none' WHEN id % 7 = 0 THEN NULL ELSE CAST(id AS STRING) END AS key"
    )
    right = spark.range(0, 3000, 5).selectExpr("0 AS kind", "CAST(id AS STRING) AS key", "id AS a", "CAST(NULL AS INT) AS b")
    right = right.union(spark.createDataFrame([(0, "hot", -1, 7)], "kind int, key string, a long, b int"))
    counts = left.groupBy("kind", "key").agg(F.count("*").alias("n"))
    hot = skew.hot_keys(counts.filter("key IS NOT NULL"), ["kind", "key"])
    got = skew.skew_left_join(left, right, ["kind", "key"], hot, ["id"])
    want = left.join(right, ["kind", "key"], "left").select(got.columns)
    assert got.count() == 3000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def one_image_in_a_third_of_all_pairs(spark):
    pairs = "array(struct(0 AS turn_pos, IF(id % 3 = 0, 'results_a/same/original.png', concat('results_q/t', id, '/x.png')) AS input_path, concat('results_q/t', id % 50, '/y.PNG') AS output_path))"
    rows = spark.range(6000).selectExpr("'f.parquet' AS file", "'' AS part", "id AS row_index", f"{pairs} AS pairs", "array('') AS prompts")
    files = spark.range(6000).selectExpr("explode(array(concat('Singleturn/results_b/t', id, '/x.png'), concat('Singleturn/results_b/t', id, '/y.png'), 'Singleturn/results_a/same/original.png')) AS path", "1L AS size")
    return rows, resolve.file_manifest(files)


@pytest.mark.parametrize("hot_rows", [20, 1 << 17])
def test_hot_references_resolve_alike(spark, monkeypatch, hot_rows):
    """With and without the join for hot keys, on shuffles instead of broadcasts."""
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(resolve, "SAMPLE", 2)
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1")
    try:
        rows, manifest = one_image_in_a_third_of_all_pairs(spark)
        audited = audited_pairs(rows, manifest)
        assert audited.count() == 6000
        assert audited.filter("input_ok AND output_ok").count() == 6000
        pairs = rewrite_pairs(emit_pairs(rows), PathSettings())
        refs = resolve.reference_paths(pairs)
        found = resolve.resolve_paths(refs, manifest)
        assert refs.filter("n = 2000").count() == 1
        assert found.count() == refs.count() == 4051
        plan = plan_of(resolve.resolve_pairs(pairs, found.select("ref", "path"), refs))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)


@pytest.mark.parametrize("name", ["resolve_paths", "resolve_pairs", "missing_roots", "audit_stats", "build_stats", "match_globs", "pair_index", "skip_existing", "verify_shards"])
def test_no_pairwise_joins(spark, sf, name):
    plan = plan_of(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_path_steps_do_not_read_prompts(spark, sf):
    rows = inputs.list_rows(spark, sf)
    manifest = inputs.files_on_disk(spark, sf)
    slim = rewrite_pairs(emit_pairs(rows, prompts=False), PathSettings())
    for df in (slim, resolve.reference_paths(slim), audited_pairs(rows, manifest)):
        read = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(df))
        assert read and not any("text:" in r for r in read)


def test_examples_are_cut_before_the_shuffle(spark, sf):
    audited = audited_pairs(inputs.list_rows(spark, sf), inputs.files_on_disk(spark, sf))
    plan = plan_of(audit_examples(audited))
    assert plan.count("WindowGroupLimit") == 2


def test_references_are_aggregated_before_the_shuffle(spark, sf):
    plan = plan_of(resolve.reference_paths(rewrite_pairs(emit_pairs(inputs.list_rows(spark, sf)), PathSettings())))
    assert "partial_count" in plan


def test_numbering_never_windows_over_all_rows(spark, sf):
    plan = plan_of(entry.queries()["pair_index"](spark, sf))
    windows = [w for w in plan.splitlines() if re.search(r"\bWindow \[row_number", w)]
    assert windows and all("[file" in w and "block" in w for w in windows)


def test_run_summary_checks_split_parts_once(spark, sf):
    """Both uses of the checked parts read the staged table, not the lines again."""
    assert not [f for f in registry.QUERIES["run_summary"](spark, sf).inputFiles() if "lineitem" in f]
