"""Periodic runs and approximate neighbours against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import queries, runs, stable_tree

DOCS = "doc_id long, text string"
VECTORS = "vec_id long, embedding array<double>"


def brute_runs(words, least):
    """Every maximal stretch of every period, by comparing words one period apart."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q) and not any(words[i : j + q - d] == words[i + d : j + q] for d in range(1, q)):
                out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(1500):
        words = [rng.randint(1, rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 45))]
        least = rng.choice([2, 3, 5, 12])
        want = brute_runs(words, least)
        assert [tuple(r) for r in runs.text_runs(words, least).tolist()] == want, (words, least)
        assert [tuple(r) for r in runs.runs_of(words, least).tolist()] == want, (words, least)


def test_suffix_tree_agreement():
    rng = random.Random(6)
    text = [rng.randint(1, 2) for _ in range(200)]
    tree = runs.SuffixTree(text)
    assert tree.order.tolist() == sorted(range(201), key=lambda i: text[i:])
    a, b = np.array([rng.sample(range(201), 2) for _ in range(400)]).T
    want = [next((k for k in range(201) if text[x + k : x + k + 1] != text[y + k : y + k + 1] or x + k >= 200 or y + k >= 200)) for x, y in zip(a, b, strict=True)]
    assert tree.common(a, b).tolist() == want


def test_long_and_nested_runs():
    rng = random.Random(7)
    block = [b"%d" % rng.randint(0, 10**6) for _ in range(5000)]
    assert runs.text_runs(block * 4).tolist() == [[0, 20_000, 5000]]
    assert runs.text_runs([b"a"] * 30_000).tolist() == [[0, 30_000, 1]]
    inner = [b"x"] * 14 + [b"y"]
    assert runs.text_runs(inner * 3).tolist() == [[0, 14, 1], [0, 45, 15], [15, 14, 1], [30, 14, 1]]


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words, 12)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    line = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (line, kept)]
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, *digest)


def test_runs_query(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit("x").alias("runs"), F.lit(1).alias("collapsed"), F.lit(2).alias("row"))
    short = docs.where(F.size(F.split("text", " ")) < 400)
    odd = [(10**9, None), (10**9 + 1, ""), (10**9 + 2, " \t\n"), (None, "go " * 15), (None, None), (10**9 + 3, "é b c\u0085d " * 9), (10**9 + 4, "A a " * 8), (10**9 + 4, "A a " * 8)]
    rows = short.unionByName(spark.createDataFrame(odd, DOCS), allowMissingColumns=True)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_lyndon_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [brute_row(r.doc_id, r.text) for r in rows.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 10


def test_runs_of_no_rows(spark):
    assert runs.periodic_runs(spark.createDataFrame([], DOCS), ["doc_id"]).collect() == []


def brute_nearest(rows, asked, k):
    rows = [(i, np.array(v, float) / max(map(abs, v))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in rows:
        if asked(q):
            found = {}
            for i, w in rows:
                if i != q:
                    m = max(len(v), len(w))
                    a, b = np.pad(v, (0, m - len(v))), np.pad(w, (0, m - len(w)))
                    found[i] = a @ b / np.linalg.norm(a) / np.linalg.norm(b)
            out[q] = sorted(((-round(s, 9), i) for i, s in found.items()))[:k]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((-round(r.score, 9), r.vec_id))
        assert len(out[r.query_id]) == r["rank"]
    return out


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, None]), (None, [1.0, 1.0]), (10, [-1.0, 0.0]), (10, [-1.0, 0.0]), (11, [1e-200, 1e-200]), (12, [1e200, 1e200]), (13, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, VECTORS).withColumn("cell", F.lit("x")).withColumn("v", F.lit(None).cast("int")).withColumn("own", F.lit(3))
    asked = lambda i: i is not None and i % 2 == 0
    for k in (2, 5, 50):
        got = collected(stable_tree.nearest(frame, frame.where("vec_id % 2 = 0"), k=k))
        assert got == brute_nearest(rows, asked, k)


def test_no_neighbours(spark):
    none = spark.createDataFrame([], VECTORS)
    one = spark.createDataFrame([(7, [1.0, 2.0])], VECTORS)
    assert stable_tree.nearest(none, none).collect() == []
    assert stable_tree.nearest(one, none).collect() == stable_tree.nearest(none, one).collect() == stable_tree.nearest(one, one).collect() == []


def test_many_copies_and_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 400)] + [(1000 + i, rng.standard_normal(3).tolist()) for i in range(300)]
    frame = spark.createDataFrame(rows, VECTORS)
    got = collected(stable_tree.nearest(frame, frame.where("vec_id % 50 = 0"), cell=20, proof=0.9999))
    assert got == brute_nearest(rows, lambda i: i % 50 == 0, 5)


@pytest.mark.parametrize("cell", [64, 4096])
def test_recall(spark, cell):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    got = collected(stable_tree.nearest(rows, rows.where("vec_id % 50 = 0"), cell=cell))
    want = brute_nearest([tuple(r) for r in rows.collect()], lambda i: i % 50 == 0, 5)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_stopping_test():
    for m in (2, 8, 16):
        assert stable_tree.chi_square(stable_tree.radius_factor(0.95, m), m) == pytest.approx(0.95)
    drawn = (np.random.default_rng(1).standard_normal((20_000, 16)) ** 2).sum(axis=1)
    assert (drawn <= stable_tree.radius_factor(0.95, 16)).mean() == pytest.approx(0.95, abs=0.01)
