"""Text, path and naming functions against Python's own."""

import hashlib
import posixpath
import re
import unicodedata
from pathlib import PurePosixPath

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st

from pairloom.functions import naming, paths, text
from pairloom.functions import text_literal as lit


def evaluate(spark, values, expr):
    """``expr`` of column x for each value, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string").selectExpr("i", f"{expr} AS y")
    return [r.y for r in sorted(df.collect())]


def code_points():
    skip = range(0xD800, 0xE000)
    return [chr(c) for c in range(0x110000) if c not in skip and unicodedata.category(chr(c)) != "Cn"]


def test_strip_matches_python(spark):
    values = [c + "a" + c for c in code_points()]
    assert evaluate(spark, values, text.strip("x")) == [v.strip() for v in values]


def test_nfc_and_casefold_match_python(spark):
    values = [c + "́A" for c in code_points()]
    assert evaluate(spark, values, text.nfc("x")) == [unicodedata.normalize("NFC", v) for v in values]
    assert evaluate(spark, values, text.casefold("x")) == [v.casefold() for v in values]
    assert evaluate(spark, [None], text.nfc("x")) == [None]


@pytest.mark.parametrize("value", ["", "a'b\\n", "日本\u0000\t", "${x}%s", "😀→x"])
def test_literals_survive(spark, value):
    assert spark.range(1).selectExpr(f"{lit(value)} AS v").first().v == value


segment = st.sampled_from(["a", "b c", ".", "..", "", "é", "Singleturn", "MULTITURN", "x.png", ".hid", "\\w", " "])
any_path = st.lists(segment, min_size=1, max_size=7).map("/".join)


# Shrinking would run a Spark job per step.
quick = settings(max_examples=4, deadline=None, phases=[Phase.generate])


@quick
@given(st.lists(any_path, min_size=200, max_size=200))
def test_path_algebra(spark, values):
    plain = evaluate(spark, values, paths.canonical_path("x"))
    for v, got in zip(values, plain):
        # Two leading slashes are special to POSIX, but not to a listing.
        want = posixpath.normpath(re.sub("^/+", "/", v)) if v else ""
        assert got == ("" if want in (".", "/") else want), v
    for v, got in zip(values, evaluate(spark, values, paths.normalize_path("x"))):
        slashes = unicodedata.normalize("NFC", v.strip()).replace("\\", "/")
        assert got == re.sub("/+", "/", slashes).lstrip("./")
    for v, found in zip(values, evaluate(spark, values, paths.path_variants("x"))):
        assert len(set(found)) == len(found) and "" not in found
        assert v.strip() == "" or v.strip() in found


def test_variants_strip_turn_prefixes(spark):
    got = evaluate(spark, ["./Singleturn//MULTITURN/singleturn/Multiturn/Singleturn/a", "singleturn/"], paths.path_variants("x"))
    assert got[0] == [
        "Singleturn/MULTITURN/singleturn/Multiturn/Singleturn/a",
        "./Singleturn//MULTITURN/singleturn/Multiturn/Singleturn/a",
        "MULTITURN/singleturn/Multiturn/Singleturn/a",
        "singleturn/Multiturn/Singleturn/a",
        "Multiturn/Singleturn/a",
        "Singleturn/a",
    ]
    assert got[1] == ["singleturn/"]


def test_leading_dots(spark):
    values = ["../a", ".x/a", "a/./b", "/abs"]
    assert evaluate(spark, values, paths.normalize_path("x")) == ["a", "x/a", "a/./b", "abs"]


def test_substitution_is_first_occurrence_in_rule_order(spark):
    rules = [("ab", "ba"), ("", "x"), ("b", ""), ("a'", "\\")]
    values = ["abab", "xx", "aab", "a'b"]
    want = []
    for v in values:
        for old, new in rules:
            if old and new:
                want_v = v.replace(old, new, 1)
                v = want_v
        want.append(v)
    assert evaluate(spark, values, paths.substitute_paths("x", rules)) == want


def test_parse_rules():
    assert paths.parse_rules(["a:b:c"]) == [("a", "b:c")]
    for bad in ("abc", ":x"):
        with pytest.raises(ValueError):
            paths.parse_rules([bad])


@quick
@given(st.lists(any_path.filter(lambda p: not p.strip().startswith("/")), min_size=100, max_size=100))
def test_prepend_subdir_touches_bare_names_only(spark, values):
    got = evaluate(spark, values, paths.prepend_subdir("x", "' S//p1/ '"))
    for v, g in zip(values, got):
        p = PurePosixPath(v.strip())
        bare = p.parent == PurePosixPath(".")
        assert g == (str(PurePosixPath("S//p1/") / p.name) if bare else v), repr(v)
    assert evaluate(spark, values, paths.prepend_subdir("x", "'  '")) == values


def test_roots_and_suffixes(spark):
    values = ["/a/b", "./a/b", "x\\y", "img.JPEG", "/img.gif/", "a/img.png", "noext"]
    assert evaluate(spark, values, paths.root_prefix("x")) == ["a", ".", "x\\y", "img.JPEG", "img.gif", "a", "noext"]
    assert evaluate(spark, values, paths.is_basename_only("x")) == [False, False, False, True, True, False, False]


def test_null_words(spark):
    assert evaluate(spark, [" NONE", "Null\n", " ", None, "none.png"], paths.null_path("x")) == [None] * 4 + ["none.png"]


@pytest.mark.parametrize("pattern", ["a/*.tar", "a?[!x-z]*", "[ab]*[", "[]]x", "[[a]b", "a.b+c$", "*é[&~|]", "[!]]q"])
def test_globs_match_fnmatch(spark, pattern):
    from fnmatch import fnmatchcase

    values = ["a/b.tar", "a/b/c.tar", "abw", "abx1", "b[", "]x", "[b", "ab", "a.b+c$", "aXb+c$", "zé&", "zé~", "xq", "]q", "a\n.tar"]
    got = evaluate(spark, values, f"x RLIKE {lit(paths.glob_to_regex(pattern))}")
    assert got == [fnmatchcase(v, pattern) for v in values]


def test_sample_keys(spark):
    values = ["", "prompt", "é\n日本 " * 50]
    got = evaluate(spark, values, naming.sample_key("'s_1'", "123456789L", "x"))
    for v, key in zip(values, got):
        digest = hashlib.sha256(f"s_1\0{123456789}\0{v}".encode()).hexdigest()
        assert key == f"s_1_123456789_{digest[:20]}"
    assert evaluate(spark, [" p "], naming.shard_name("123456L", "x")) == ["p-shard-123456.tar"]
    assert evaluate(spark, [" "], naming.shard_name("7L", "x")) == ["shard-00007.tar"]
    assert evaluate(spark, ["s"], naming.slice_layout("gs://b/x/", "x")) == ["gs://b/x/s/"]
