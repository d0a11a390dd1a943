"""Connected components of a graph given as an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.runtime import stage


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges(a, b)``; the component is its smallest id.

    Large-star and small-star steps by turns: each links nodes to the smallest
    neighbour known, until all edges lead straight to the smallest id. Minima are
    aggregated before the join, so a node with very many links is no bottleneck.
    No edges give no rows.
    """
    edges = stage(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    while not _flat(edges):
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").selectExpr("v AS a", "m AS b").distinct()
        large = stage(large.where("a <> b"), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").selectExpr("b AS a", "m AS b").union(low.selectExpr("a", "m AS b"))
        edges = stage(small.where("a <> b").distinct(), "edges")
    return edges.selectExpr("a AS id", "b AS component").union(edges.selectExpr("b", "b").distinct())


def _flat(edges: DataFrame) -> bool:
    """Whether every edge leads from a node of one edge to a node without one to a smaller id."""
    ends = edges.groupBy("a").agg(F.count("*").alias("n"), F.lit(1).alias("above")).union(edges.select("b").distinct().select("b", F.lit(0), F.lit(0)))
    return ends.groupBy("a").agg(F.sum("n").alias("n"), F.sum("above").alias("above"), F.count("*").alias("sides")).where("n > 1 OR (above = 1 AND sides > 1)").isEmpty()
