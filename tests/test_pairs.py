"""Strict pairs from nested cells."""

import pytest

from pairloom.operators.pairs import emit_pairs, read_rows

LISTS = "file string, part string, row_index long, input_images array<array<string>>, output_images array<string>, prompt string"


def pairs_of(df, *args):
    return sorted((r.row_index, r.turn_pos, r.input_path, r.output_path, r.prompt) for r in emit_pairs(read_rows(df, *args)).collect())


def test_list_layout(spark):
    cells = [
        ([["a"]], ["b"], " p "),
        ([["a"], ["c"]], ["b"], "two slots"),
        ([None, ["a"]], ["b"], "two slots, one of them null"),
        ([["a", None, " "]], [" b\n"], None),
        ([["a", "c"]], ["b"], "two paths"),
        (None, ["b"], "no input"),
        ([[]], ["b"], "empty"),
        ([["a"]], [], "no output"),
    ]
    df = spark.createDataFrame([("f", "", i, *c) for i, c in enumerate(cells)], LISTS)
    assert pairs_of(df, "lists") == [(0, 0, "a", "b", "p"), (3, 0, "a", "b", "")]


def test_scalar_cells_of_the_list_layout(spark):
    df = spark.createDataFrame([("f", "", 0, " a", "b"), ("f", "", 1, " ", "b"), ("f", "", 2, None, "b")], "file string, part string, row_index long, input_images string, output_images string")
    assert pairs_of(df, "lists") == [(0, 0, "a", "b", "")]


def test_turn_layout(spark):
    turn = "struct<input_images:array<array<string>>,output_images:array<string>,prompt:string>"
    data = [
        ([["a"]], ["b"], "one"),
        ([None, ["a"]], ["b"], "a null slot is ignored in a turn"),
        (None, None, "instruction only"),
        ([["a"], ["c"]], ["b"], "two"),
        ([["d"]], ["e"], None),
        None,
    ]
    df = spark.createDataFrame([("f", "", 0, data), ("f", "", 1, None), ("f", "", 2, [])], f"file string, part string, row_index long, data array<{turn}>")
    assert pairs_of(df, "multiturn") == [
        (0, 0, "a", "b", "one"),
        (0, 1, "a", "b", "a null slot is ignored in a turn"),
        (0, 4, "d", "e", ""),
    ]


def test_turns_that_are_no_list_give_nothing(spark):
    df = spark.createDataFrame([("f", "", 0, "x")], "file string, part string, row_index long, data string")
    assert pairs_of(df, "multiturn") == []


def test_column_layout(spark):
    rows = [(0, " a ", ["b"], "t"), (1, "", ["b"], "t"), (2, "a", ["b", "c"], "t"), (3, "a", None, "t"), (4, "a", ["b", " "], None)]
    df = spark.createDataFrame([("f", "", *r) for r in rows], "file string, part string, row_index long, src string, dst array<string>, caption string")
    assert pairs_of(df, "path", "src", "dst", "caption") == [(0, 0, "a", "b", "t"), (4, 0, "a", "b", "")]


@pytest.mark.parametrize("layout", ["embed", "mixed_embed_orig", "mixed_embed_edit"])
def test_embedded_layouts_give_no_pairs(spark, layout):
    df = spark.createDataFrame([("f", "", 0, b"x", b"y")], "file string, part string, row_index long, source_img binary, target_img binary")
    assert pairs_of(df, layout, "source_img", "target_img") == []
    assert read_rows(df, layout, "source_img", "target_img").count() == 1
