"""Exploration report: pair counts, path roots and roots nobody published."""

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.paths import is_basename_only, root_prefix
from pairloom.runtime import stage

ROOTS_PER_BLOCK = 100_000


def explore_stats(rows: DataFrame) -> DataFrame:
    """Per file: rows, strict pairs, rows without and with several pairs."""
    bare = f"{is_basename_only('p.input_path')} OR {is_basename_only('p.output_path')}"
    return rows.groupBy("file").agg(
        F.count("*").alias("rows_total"),
        F.expr("sum(size(pairs))").alias("strict_pairs"),
        F.expr("count_if(size(pairs) = 0)").alias("rows_without_pairs"),
        F.expr("count_if(size(pairs) > 1)").alias("rows_with_many_pairs"),
        F.expr(f"bool_or(exists(pairs, p -> {bare}))").alias("has_basename_only"),
    )


def root_histogram(rows: DataFrame) -> DataFrame:
    """Per file: how often each path root occurs, inputs and outputs together."""
    both = f"array({root_prefix('p.input_path')}, {root_prefix('p.output_path')})"
    return (
        rows.selectExpr("file", f"explode(flatten(transform(pairs, p -> {both}))) AS root")
        .filter("root <> ''")
        .groupBy("file", "root")
        .agg(F.count("*").alias("paths"))
    )


def missing_roots(histogram: DataFrame, listing: DataFrame) -> DataFrame:
    """Per file: roots that occur nowhere inside the listed paths.

    A root holds no slash, so it can only occur inside one path segment. Roots
    that equal a segment leave by an equi-join. For the rest, the distinct segments are
    read by an automaton that knows all of them, see ``roots_inside``.
    """
    histogram = stage(histogram, "histogram")
    roots = histogram.select("root").distinct().filter(f"NOT {is_basename_only('root')}")
    segments = stage(listing.selectExpr("explode(split(path, '/')) AS segment").distinct(), "segments")
    unmatched = stage(roots.join(segments, F.col("root") == F.col("segment"), "left_anti"), "unmatched")
    missing = unmatched.join(roots_inside(unmatched, segments), "root", "left_anti")
    return histogram.join(missing, "root", "left_semi").select("file", "root", "paths")


def roots_inside(roots: DataFrame, segments: DataFrame, per_block: int = ROOTS_PER_BLOCK) -> DataFrame:
    """The ``root`` values that are part of any ``segment``; both hold no slash.

    An Aho-Corasick automaton finds all roots of a block in one pass over the segments, so its memory is bounded by the
    block. A task sends each root it has seen once; no piece of a segment is made.
    """
    spark = roots.sparkSession
    rows, found = roots.toLocalIterator(), []
    while block := [r.root for r in islice(rows, per_block)]:
        words = spark.sparkContext.broadcast(block)
        found.append(stage(segments.select("segment").mapInArrow(_search(words), "root string").distinct(), "inside"))
        words.destroy()
    return reduce(DataFrame.union, found, spark.createDataFrame([], "root string"))


def _search(words: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ahocorasick import Automaton

        automaton, seen = Automaton(), set()
        for word in words.value:
            automaton.add_word(word, word)
        automaton.make_automaton()
        for batch in batches:
            text = "/".join(batch.column("segment").drop_null().to_pylist())  # no root goes on over a slash
            seen.update(word for _, word in automaton.iter(text))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.string())], names=["root"])

    return run


def explore_totals(stats: DataFrame, files: DataFrame) -> DataFrame:
    """Files, rows and strict pairs; files of unknown layout count as files only."""
    n_files = files.select("file").distinct().agg(F.count("*")).scalar()
    sums = stats.agg(
        F.expr("coalesce(sum(rows_total), 0)").alias("rows_total"),
        F.expr("coalesce(sum(strict_pairs), 0)").alias("strict_pairs"),
    )
    return sums.withColumn("files", n_files)
