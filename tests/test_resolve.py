"""The resolver against a brute-force search over a set of files."""

import posixpath
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from pairloom.operators import resolve as res
from pairloom.operators import skew
from pairloom.operators.resolve import file_manifest, resolve_paths

PLACES = ["", "Singleturn", "Multiturn", "Parquet", "", "Singleturn", "Multiturn"]


def spellings(ref):
    first = re.sub("/+", "/", unicodedata.normalize("NFC", ref.strip()).replace("\\", "/")).lstrip("./")
    found, rest = [first, ref.strip()], first
    for _ in range(4):
        head, _, tail = rest.partition("/")
        if head.lower() in ("singleturn", "multiturn") and "/" in rest:
            rest = tail.lstrip("/")
            found.append(rest)
    return [s for s in dict.fromkeys(found) if s]


def search(ref, files):
    """First file by rank; a folded match takes the smallest name."""

    def look(path):
        if path in files:
            return path
        folder, name = posixpath.split(path)
        same = [f for f in files if posixpath.split(f)[0] == folder and posixpath.basename(f).casefold() == name.casefold()]
        return min(same, default=None)

    if ref.startswith("/"):
        return look(posixpath.normpath(ref))
    for s in spellings(ref):
        for n, place in enumerate(PLACES):
            path = posixpath.normpath(posixpath.join(place, s if n < 4 else s.lstrip("./")))
            if not path.startswith("..") and (hit := look(path)):
                return hit
    for s in spellings(ref):
        parts = [p for p in s.split("/") if p not in ("", ".")]
        if len(parts) >= 2 and ".." not in parts[-2:]:
            tasks = {f.split("/")[1] for f in files if f.startswith("Singleturn/results_") and f.count("/") >= 2}
            hits = [h for t in tasks if (h := look(f"Singleturn/{t}/{parts[-2]}/{parts[-1]}"))]
            if len(hits) == 1:
                return hits[0]
    return None


def resolve(spark, refs, files):
    refs = spark.createDataFrame([(r,) for r in refs], "ref string")
    manifest = file_manifest(spark.createDataFrame([(f, len(f)) for f in files], "path string, size long"))
    found = resolve_paths(refs, manifest).collect()
    exists = {r.ref for r in resolve_paths(refs, manifest, locate=False).collect()}
    assert exists == {r.ref for r in found}
    assert all(r.size == len(r.path) for r in found)
    return {r.ref: r.path for r in found}


@pytest.mark.parametrize("seed", range(4))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    tops = ["Singleturn/results_a", "Singleturn/results_b", "Multiturn/results_a", "Parquet", "results_a", "other", ".hid", "Singleturn"]
    names = ["x.png", "X.png", "x.PNG", "straße.png", "STRASSE.png", "café.png", "..y.png"]
    files = {"/".join(filter(None, [rng.choice(tops), rng.choice(["", "d1", "D1", "d2"]), rng.choice(names)])) for _ in range(60)}
    files |= {"top.png", "/abs/x.png"}
    heads = ["", "", "./", "Singleturn/", "singleturn//MULTITURN/", "../", "a/../", "a/../../", "results_zz/", "/abs/", " ", "\\", "Singleturn/./"]
    middles = ["results_a/d1/", "results_a\\d2\\", "results_b//D1/", "d1/", "", "results_q/d1/", ".hid/", "Parquet/../results_a/"]
    refs = {rng.choice(heads) + rng.choice(middles) + rng.choice([*names, "café.png", "TOP.png", "none.gif"]) for _ in range(700)}
    refs = {r.strip() for r in refs if r.strip()}
    want = {r: hit for r in refs if (hit := search(r, files))}
    assert resolve(spark, refs, files) == want
    assert len(want) > 100


def test_siblings_must_be_unique(spark):
    files = ["Singleturn/results_a/t/x.png", "Singleturn/results_b/t/x.png", "Singleturn/results_b/u/x.png", "Singleturn/results_b/u/X.png", "Singleturn/other/v/x.png"]
    got = resolve(spark, ["results_q/t/x.png", "results_q/u/x.png", "results_q/v/x.png", "results_q/deep/u/x.PNG"], files)
    assert got == {"results_q/u/x.png": "Singleturn/results_b/u/x.png", "results_q/deep/u/x.PNG": "Singleturn/results_b/u/X.png"}


def test_folders_do_not_fold(spark):
    assert resolve(spark, ["Dir/a.PNG", "dir/a.PNG"], ["dir/a.png"]) == {"dir/a.PNG": "dir/a.png"}


def test_exact_spelling_wins_among_many(spark):
    files = [f"d/{n}" for n in ("A.png", "a.PNG", "a.Png", "a.png")]
    got = resolve(spark, ["d/a.Png", "d/a.pNg"], files)
    assert got == {"d/a.Png": "d/a.Png", "d/a.pNg": "d/A.png"}


def test_absolute_references_below_the_root(spark):
    files = spark.createDataFrame([("a/B.png", 1), ("Singleturn/a/c.png", 2)], "path string, size long")
    refs = spark.createDataFrame([("/data/set/a/b.png",), ("/data/set/a/c.png",), ("/data/sets/a/b.png",), ("/data/set//a/./B.png",), ("a/c.png",)], "ref string")
    found = {r.ref: r.path for r in res.resolve_paths(refs, files, root="/data/set").collect()}
    assert found == {"/data/set/a/b.png": "a/B.png", "/data/set//a/./B.png": "a/B.png", "a/c.png": "Singleturn/a/c.png"}
    assert {r.ref for r in res.resolve_paths(refs, files).collect()} == {"a/c.png"}


def test_hot_lookup_keys_lose_nothing(spark, monkeypatch):
    """References are not staged, and their plan gives another order at every evaluation."""
    monkeypatch.setattr(res, "SAMPLE", 4)
    monkeypatch.setattr(skew, "HOT_ROWS", 16)
    files = spark.createDataFrame([(f"Singleturn/results_a/t{i}/x.png", 1) for i in range(5)], "path string, size long")
    refs = spark.range(4000).selectExpr("concat('results_', id, '/t', id % 5, '/x.png') AS ref").orderBy(F.rand())
    assert res.resolve_paths(refs, files).count() == 4000
    assert res.resolve_paths(refs, files, locate=False).count() == 4000


def test_references_are_staged_for_all_cores(spark):
    """A few MB of references make work for every core, not for the one task that their bytes would make."""
    pairs = spark.range(5000).selectExpr("concat('a/', id % 700, '.png') AS input_ref", "IF(id % 3 = 0, NULL, concat('b/', id)) AS output_ref")
    refs = res.staged_references(pairs)
    counted = res.reference_paths(pairs)
    assert refs.exceptAll(counted).isEmpty() and refs.count() == counted.count()
    assert refs.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
