"""Roots that no listed path holds."""

import random

import pytest

from pairloom.operators import explore


def words(rng, n, longest):
    return sorted({"".join(rng.choice("abÉ日\n ") for _ in range(rng.randint(1, longest))) for _ in range(n)})


@pytest.mark.parametrize("per_block", [3, 1000])
def test_roots_inside_segments(spark, per_block):
    rng = random.Random(9)
    roots, segments = words(rng, 60, 5), words(rng, 25, 9)
    got = explore.roots_inside(spark.createDataFrame([(r,) for r in roots], "root string"), spark.createDataFrame([(s,) for s in segments] + [(None,)], "segment string"), per_block)
    want = [r for r in roots if any(r in s for s in segments)]
    assert sorted(r.root for r in got.collect()) == want and 0 < len(want) < len(roots)


def test_missing_roots(spark):
    rng = random.Random(10)
    roots = words(rng, 80, 5)
    paths = ["/".join(rng.choices(words(rng, 40, 6), k=3)) for _ in range(20)]
    histogram = spark.createDataFrame([(f"f{i % 3}", r, i) for i, r in enumerate([*roots, "bare.png"])], "file string, root string, paths long")
    got = explore.missing_roots(histogram, spark.createDataFrame([(p,) for p in paths], "path string"))
    want = [(f"f{i % 3}", r, i) for i, r in enumerate(roots) if not any(r in p for p in paths)]
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
    assert explore.missing_roots(histogram.limit(0), spark.createDataFrame([("a/b",)], "path string")).count() == 0


def test_no_piece_of_a_segment_is_shuffled(spark):
    """One long segment of many pieces: what leaves the search is a row a root and task at most."""
    rng = random.Random(11)
    segment = "".join(rng.choice("ab") for _ in range(200_000))
    roots = spark.createDataFrame([("a" * 40,), ("ab",), ("ba",), (segment[5:60],)], "root string")
    segments = spark.createDataFrame([(segment,)], "segment string").repartition(3)
    inside = segments.mapInArrow(explore._search(spark.sparkContext.broadcast([r.root for r in roots.collect()])), "root string")
    assert sorted(r.root for r in inside.collect()) == sorted(["ab", "ba", segment[5:60]])
