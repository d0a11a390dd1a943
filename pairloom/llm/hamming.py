"""Exact top-k search of binary codes by incremental multi-index hashing.

A code is cut into segments, and each segment indexes it. In round r a query looks
into all buckets that differ from its segments in exactly r bits. After it, every
code within distance ``segments * (r + 1) - 1`` has been seen, so a query ends as
soon as its k-th verified distance is no larger.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.runtime import stage

BITS = 64
SEGMENTS = 4
K = 10


def sign_codes(vectors: DataFrame, seed: int = 17) -> DataFrame:
    """(vec_id, code): signs of 64 random projections of ``embedding`` as one long.

    Projections are made for each dimension from the seed alone. Null values count
    as 0, and a null or empty embedding has the code of the zero vector.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.zeros((0, BITS))
        for batch in batches:
            codes = []
            for v in batch.column("embedding").to_pylist():
                v = np.nan_to_num(np.array([x or 0.0 for x in v or []], dtype=float))
                if len(v) > len(planes):
                    planes = np.random.default_rng(seed).standard_normal((len(v), BITS))
                codes.append(np.packbits(v @ planes[: len(v)] > 0).view(np.int64)[0])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(codes, pa.int64())], names=["vec_id", "code"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id long, code long")


def masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in chosen) for chosen in combinations(range(width), radius)]


def _segment(code: Column, i: int, width: int) -> Column:
    return F.shiftright(code, i * width).bitwiseAND((1 << width) - 1).cast("int")


def nearest(codes: DataFrame, queries: DataFrame, k: int = K, segments: int = SEGMENTS) -> DataFrame:
    """(query_id, rank, vec_id, distance): the k nearest rows of ``codes(vec_id, code)`` by distance, then vec_id.

    Rows with one code are one entry of the index, and bring their k smallest
    ids, which are all that can count; so copies neither fill a bucket nor are lost.
    Repeated queries share one search. A row is its own neighbour if it is in
    ``codes``. Fewer than k rows give as many. Repeated vec_ids count each; rows
    without a vec_id or code are no neighbours, and queries without a code find nothing.
    """
    width = BITS // segments
    usable = codes.where("vec_id IS NOT NULL AND code IS NOT NULL")
    ranked = usable.selectExpr("code", "vec_id", "row_number() OVER (PARTITION BY code ORDER BY vec_id) AS place")
    members = stage(ranked.where(F.col("place") <= k).drop("place"), "members")
    entries = members.groupBy("code").agg(F.count("*").alias("copies"))
    total = members.count()

    def cut(c: str) -> Column:
        return F.explode(F.array(*[F.struct(F.lit(i).alias("segment"), _segment(F.col(c), i, width).alias("bucket")) for i in range(segments)])).alias("at")

    index = stage(entries.select("code", "copies", cut("code")).select("at.segment", "at.bucket", "code", "copies"), "index")
    open_ = stage(queries.where("code IS NOT NULL").select(F.col("code").alias("query"), F.lit(BITS).alias("bound")).distinct(), "open")
    best, radius = None, -1
    while radius < width and not open_.isEmpty():
        radius += 1
        apart = [F.bit_count(_segment(F.col("query").bitwiseXOR(F.col("code")), i, width)) for i in range(segments)]
        # a pair is met in its first segment of smallest distance, and in the round of that distance, so once only
        first = F.array_position(F.array(*apart), F.lit(radius)) - 1
        fresh = (F.least(*apart) == radius) & (F.col("segment") == first)
        probes = open_.select("query", "bound", cut("query")).select("query", "bound", "at.*", F.explode(F.array(*map(F.lit, masks(width, radius)))).alias("flip"))
        probes = probes.selectExpr("query", "bound", "segment", "bucket ^ flip AS bucket")
        distance = F.bit_count(F.col("query").bitwiseXOR(F.col("code")))
        hits = probes.hint("merge").join(index.hint("merge"), ["segment", "bucket"]).where(fresh & (distance <= F.col("bound"))).select("query", "code", "copies", distance.alias("distance"))
        if best is not None:
            hits = hits.unionByName(best.join(open_, "query", "left_semi"))
        hits = stage(hits, "hits")
        counts = hits.groupBy("query", "distance").agg(F.sum("copies").alias("n"))  # 65 rows a query at most
        sums = counts.selectExpr("query", "distance", "sum(n) OVER (PARTITION BY query ORDER BY distance) AS upto", "n")
        bounds = sums.where(F.col("upto") - F.col("n") < k).groupBy("query").agg(F.max("distance").alias("last"), F.max("upto").alias("rows"))
        bounds = open_.select("query").join(bounds, "query", "left").selectExpr("query", f"rows >= {min(k, total)} AS enough", "last")
        bounds = stage(bounds.selectExpr("query", f"IF(enough, last, {BITS}) AS bound", "enough", "last"), "bounds")
        kept = hits.join(bounds, "query").where(F.col("distance") <= F.col("bound")).select("query", "code", "copies", "distance")
        best = stage(kept if best is None else kept.unionByName(best.join(open_, "query", "left_anti")), "best")
        covered = segments * (radius + 1) - 1
        open_ = stage(bounds.where(f"NOT coalesce(enough AND last <= {covered}, false)").select("query", "bound"), "open")
    if best is None:
        return codes.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, distance int")
    rows = best.join(members, "code").selectExpr("query", "vec_id", "distance", "row_number() OVER (PARTITION BY query ORDER BY distance, vec_id) AS rank").where(F.col("rank") <= k)
    named = queries.select(F.col("vec_id").alias("query_id"), F.col("code").alias("query"))
    return named.join(rows, "query").select("query_id", "rank", "vec_id", "distance")
