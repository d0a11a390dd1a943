"""Approximate nearest neighbours by cosine: stable projections in kd-trees and a chi-square stopping test.

Vectors of length one are projected by Gaussian directions to few dimensions. The squared projected
distance of two vectors at distance d is d*d times a chi-square variable, so a neighbour nearer than the k-th
best found lies, with probability ``PROOF``, within a known projected radius. Neighbours are verified by
growing projected distance, until the next one is beyond that radius.

The upper levels of one kd-tree cut the projected space into cells, which Spark deals out; each cell has a tree
of its own. Queries visit cells by growing distance, in rounds: the nearest, then ``GROWTH`` times as many, and
so on, each with the k-th best of the rounds before, until the test holds for the next cell.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.runtime import stage

K = 5
DIMENSIONS = 16  # even, so that the chi-square distribution has a closed form
PROOF = 0.95
SEED = 11
SAMPLE = 20_000  # projected vectors that place the upper levels' cuts
CELL = 4096  # vectors aimed at in a cell, and at most about so many in one of its blocks
LEAF = 64
QUERIES = 2048  # queries that a task compares with a block at once
GROWTH = 8
VERIFIED = 64  # candidates verified before the first test, and twice as many before each later one


def chi_square(x: float, dimensions: int) -> float:
    """Distribution function for an even number of dimensions."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(dimensions // 2))


def radius_factor(proof: float, dimensions: int) -> float:
    """The value below which a chi-square variable stays with probability ``proof``."""
    low, high = 0.0, 16.0 * dimensions + 1000
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, dimensions) < proof else (low, middle)
    return high


def units(vectors: list, width: int | None = None) -> np.ndarray:
    """Vectors scaled to length one, short ones filled up with zeros."""
    out = np.zeros((len(vectors), width or max(map(len, vectors), default=0)))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    out /= np.maximum(np.abs(out).max(axis=1, keepdims=True, initial=0), 1e-300)  # squares of very large or small numbers would be lost
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def project(unit: np.ndarray, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    return unit @ np.random.default_rng(seed).standard_normal((unit.shape[1], dimensions))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN counts as larger than infinity
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


class Tree:
    """A kd-tree over points: each level halves all parts at the median of their widest dimension."""

    def __init__(self, points: np.ndarray, leaves: int):
        self.cuts: list[list[tuple[int, float]]] = []
        parts = [np.arange(len(points))]
        while len(parts) < leaves:
            level, halves = [], []
            for part in parts:
                own = points[part]
                dim = int(np.argmax(own.max(axis=0) - own.min(axis=0))) if len(part) else 0
                cut = float(np.median(own[:, dim])) if len(part) else 0.0
                below = own[:, dim] < cut
                level.append((dim, cut))
                halves += [part[below], part[~below]]
            self.cuts.append(level)
            parts = halves
        self.parts = parts

    def leaf(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        for level in self.cuts:
            dims, cuts = np.array([d for d, _ in level]), np.array([c for _, c in level])
            at = 2 * at + (points[np.arange(len(points)), dims[at]] >= cuts[at])
        return at


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d, None]
        out += np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0) ** 2
    return out


def search(unit: np.ndarray, ids: list, queries: list[tuple], k: int, factor: float, dimensions: int) -> Iterator[tuple]:
    """(query number, id, cosine) of each query's k best among the entries, as far as the test asks for them.

    An entry is a vector and its smallest ids. ``queries`` are (number, own id, unit vector, squared distance of the k-th best
    found elsewhere).
    """
    points = project(unit, dimensions)
    tree = Tree(points, max(1, 1 << max(0, (len(unit) // LEAF).bit_length() - 1)))
    parts = [p for p in tree.parts if len(p)]
    low, high = np.array([points[p].min(axis=0) for p in parts]), np.array([points[p].max(axis=0) for p in parts])
    asked = np.array([q[2] for q in queries])
    projected = project(asked, dimensions)
    boxes = box_distance(projected, low, high)
    sizes = np.array([len(p) for p in parts])
    for row, (number, own, vector, bound) in enumerate(queries):
        found: list[tuple] = []  # (-cosine, id)
        leaves = np.argsort(boxes[row], kind="stable")
        reach = boxes[row][leaves]
        first, step = 0, VERIFIED
        while first < len(leaves) and reach[first] <= bound * factor:
            # the next leaves, enough for a step, with their points in order; the test is made again and again on the way
            last = min(first + int(np.searchsorted(np.cumsum(sizes[leaves[first:]]), step)) + 1, len(leaves))
            last = min(last, int(np.searchsorted(reach, bound * factor, side="right")))
            near = np.concatenate([parts[i] for i in leaves[first:last]])
            distance = ((points[near] - projected[row]) ** 2).sum(axis=1)
            near = near[np.argsort(distance, kind="stable")]
            distance.sort()
            first, done = last, 0
            while done < len(near) and distance[done] <= bound * factor:
                some = near[done : done + step]
                done += len(some)
                step *= 2
                cosine = (unit[some] * vector).sum(axis=1)
                if len(found) >= k:
                    some, cosine = some[cosine >= -found[k - 1][0]], cosine[cosine >= -found[k - 1][0]]
                elif len(some) > k + 1:
                    worst = -np.partition(-cosine, k)[k]  # the query itself may be among the first
                    some, cosine = some[cosine >= worst], cosine[cosine >= worst]
                fresh = [(-c, i) for e, c in zip(some.tolist(), cosine.tolist(), strict=True) for i in ids[e] if i != own]
                if fresh:
                    found = sorted(found + fresh)[:k]
                    if len(found) >= k:
                        bound = min(bound, max(0.0, 2 + 2 * found[k - 1][0]) + 1e-12)
        for minus, i in found:
            yield number, i, -minus


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, dimensions: int = DIMENSIONS, proof: float = PROOF, cell: int = CELL) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row of ``queries``, the k rows of ``vectors`` with the largest cosine found.

    Both have (vec_id, embedding) and perhaps other columns. A query's own id is no candidate. Ties go to the smaller
    vec_id; fewer than k candidates are all found. Equal vectors are one entry with their k + 1 smallest ids, which are all that
    can count, so copies neither fill a cell nor are lost; rows that repeat id and vector count once. Vectors that
    are null, zero or hold null or non-finite values, and rows without vec_id, take no part. Vectors of different lengths are
    compared as if filled up with zeros. An id with several vectors is a query for each; its rows follow one another by ``rank``.
    """
    spark = vectors.sparkSession
    kept = "query_id long, rank int, vec_id long, score double"
    ranked = usable(vectors).selectExpr("v", "vec_id", "dense_rank() OVER (PARTITION BY v ORDER BY vec_id) AS place").where(F.col("place") <= k + 1)
    entries = stage(ranked.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")), "entries")
    asked = usable(queries).groupBy("vec_id", "v").agg(F.lit(1).alias("n")).drop("n")
    asked = stage(asked.select(F.col("vec_id").alias("own"), "v", F.xxhash64("vec_id", "v").alias("query")), "asked")
    total, width = entries.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(width or 0, asked.agg(F.max(F.size("v"))).first()[0] or 0)
    if not total or not width:
        return spark.createDataFrame([], kept)

    sample = [r.v for r in entries.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").collect()]
    cells = 1 << max(0, min((total // cell).bit_length(), (len(sample) // 16).bit_length() - 1))
    top = Tree(project(units(sample, width), dimensions), cells)
    del sample

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = project(units(batch.column("v").to_pylist(), width), dimensions)
                corners = pa.array(list(points), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(top.leaf(points)), corners], names=["v", "ids", "cell", "point"])

    placed = stage(entries.mapInArrow(place, "v array<double>, ids array<long>, cell long, point array<double>"), "placed")
    sides = [f(F.col("point")[d]).alias(f"{f.__name__}{d}") for f in (F.min, F.max) for d in range(dimensions)]
    boxes = placed.groupBy("cell").agg(F.count("*").alias("rows"), *sides).orderBy("cell").collect()  # at most SAMPLE / 16 rows
    names = np.array([b.cell for b in boxes])
    low, high = (np.array([[b[f"{s}{d}"] for d in range(dimensions)] for b in boxes]) for s in ("min", "max"))
    blocks = {b.cell: -(-b.rows // (2 * cell)) for b in boxes}
    factor = radius_factor(proof, dimensions)
    by_cell = F.create_map(*[F.lit(x) for b in blocks.items() for x in b])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("v", F.lit(1)), by_cell[F.col("cell")]).cast("int")).drop("point")

    def visits(first: int, last: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                points = project(units(batch.column("v").to_pylist(), width), dimensions)
                away = box_distance(points, low, high)
                order = np.argsort(away, axis=1, kind="stable")[:, first:last]
                bound = batch.column("bound").to_numpy(zero_copy_only=False)
                near = np.take_along_axis(away, order, 1) <= bound[:, None] * factor
                row, column = np.nonzero(near)
                seen = names[order[row, column]]
                many = np.array([blocks[c] for c in seen.tolist()], np.int64)
                inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                taken = batch.take(pa.array(np.repeat(row, many)))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.repeat(seen, many)), pa.array(inner.astype(np.int32))], names=[*batch.schema.names, "cell", "block"])

        return run

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            unit = units(left.column("v").to_pylist(), width)
            vectors = units(right.column("v").to_pylist(), width)
            rows = zip(right.column("query").to_pylist(), right.column("own").to_pylist(), vectors, right.column("bound").to_pylist(), strict=True)
            found = list(search(unit, left.column("ids").to_pylist(), list(rows), k, factor, dimensions))
        columns = zip(*found, strict=True) if found else ([], [], [])
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query", "vec_id", "score"])

    best, first, last = None, 0, 1
    open_ = asked.withColumn("bound", F.lit(math.inf))
    while first < len(names):
        going = stage(open_.mapInArrow(visits(first, last), "own long, v array<double>, query long, bound double, cell long, block int"), "visits")
        if first and going.isEmpty():
            break
        counts = going.groupBy("cell", "block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("shares"))
        key = ["cell", "block", "share"]
        there = placed.join(counts.toDF("cell", "block", "shares"), key[:2]).selectExpr("v", "ids", *key[:2], "explode(sequence(0, shares - 1)) AS share")
        here = going.join(counts.toDF("cell", "block", "shares"), key[:2]).selectExpr("own", "v", "query", "bound", *key[:2], "CAST(pmod(xxhash64(query, 1), shares) AS INT) AS share")
        hits = there.groupBy(*key).cogroup(here.groupBy(*key)).applyInArrow(compare, "query long, vec_id long, score double")
        hits = hits if best is None else hits.unionByName(best)
        order = "row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank"
        best = stage(hits.selectExpr("*", order).where(F.col("rank") <= k).drop("rank"), "best")
        kth = best.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("worst"))
        bound: Column = F.when(F.col("n") >= k, F.greatest(2 - 2 * F.col("worst"), F.lit(0.0)) + 1e-12).otherwise(math.inf)
        open_ = stage(asked.join(kth, "query", "left").select("own", "v", "query", bound.alias("bound")), "open")
        first, last = last, last * GROWTH
    rows = asked.select("query", F.col("own").alias("query_id")).join(best, "query")
    order = "CAST(row_number() OVER (PARTITION BY query_id ORDER BY query, score DESC, vec_id) AS INT) AS rank"
    return rows.selectExpr("query_id", order, "vec_id", "score")
