"""Joins that stay balanced when a few keys hold much of the rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is hot. There are at most rows / HOT_ROWS such
# keys, which bounds what is broadcast: 100,000 of them for 13 billion rows.
HOT_ROWS = 1 << 17

# Hot keys may be found from one part in so many, as a missed one costs time but no
# row. The part must be chosen by hash and the keys staged, so that all uses agree.
SAMPLE = 1024


def hot_keys(counts: DataFrame, on: Sequence[str], weight: int = 1) -> DataFrame:
    """Keys whose ``n`` rows, each standing for ``weight``, are more than one task should take."""
    return counts.filter(f"n * {weight} > {HOT_ROWS}").select(*on)


def skew_left_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], hot: DataFrame, spread_by: Sequence[str]
) -> DataFrame:
    """Left join to a ``right`` that is unique by ``on``; the last key is a string.

    Rows of hot keys meet their few matches by broadcast where they are. In the
    shuffle they and rows without a key get keys of their own, made from
    ``spread_by``, that match nothing.
    """
    *first, key = on
    values = [c for c in right.columns if c not in on]
    packed = right.select(*on, F.struct(*values).alias("_far"))
    flagged = hot.withColumn("_hot", F.lit(True))
    few = packed.join(F.broadcast(flagged.drop("_hot")), list(on)).withColumnRenamed("_far", "_near")
    near = flagged.join(few, list(on), "left")
    apart = f"concat('\\u0000', xxhash64({', '.join(spread_by)}))"
    marked = left.join(F.broadcast(near), list(on), "left")
    spread = marked.selectExpr("*", f"IF(_hot OR {key} IS NULL, {apart}, {key}) AS _on")
    joined = spread.join(packed.withColumnRenamed(key, "_on"), [*first, "_on"], "left")
    found = joined.selectExpr(*left.columns, "coalesce(_near, _far) AS _found")
    return found.selectExpr(*left.columns, *[f"_found.{c} AS {c}" for c in values])
