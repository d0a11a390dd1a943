"""Parts of split archives that come in any order, over several runs."""

import random
import tarfile

import pandas as pd
import pytest

from pairloom.sources import archives
from pairloom.sources.listing import list_tree
from pairloom.streaming import arrivals
from pairloom.streaming.arrivals import ingest_archives, landed_archives, whole_archives

LISTED = [(f"d/{a}.tar.split.{i:0{w}d}", 10 + i) for a, n, w in (("one", 1, 1), ("five", 5, 3), ("late", 4, 2)) for i in range(n)]
LISTED += [("d/torn.tar.split.0", 1), ("d/torn.tar.split.2", 1), ("d/twice.tar.split.0", 1), ("d/twice.tar.split.00", 1), ("d/plain.tar", 5)]


def arrive(spark, folder, rows, n):
    spark.createDataFrame(rows, "path string, size long").coalesce(1).write.mode("append").parquet(f"{folder}/{n}")


@pytest.mark.parametrize("seed", [1, 2])
def test_archives_are_released_once_when_whole(spark, tmp_path, seed):
    listing = spark.createDataFrame(LISTED, "path string, size long")
    rng, out = random.Random(seed), str(tmp_path / "out")
    last = ("d/late.tar.split.03", 13)
    rows = [r for r in LISTED if r != last] + [("d/unknown.tar.split.0", 1), ("d/late.tar.split.03", 12)]  # the last has another size: it is not all there
    rows += rng.sample([r for r in LISTED if r != last], 5)  # some arrive twice
    rng.shuffle(rows)
    for n in range(6):
        arrive(spark, tmp_path / "in", rows[n::6], n)

    def run():
        stream = spark.readStream.schema("path string, size long").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        ingest_archives(spark, stream, listing, out, str(tmp_path / "offsets"))
        return sorted((r.archive, [(int(p.idx), p.path, p["size"]) for p in r.parts]) for r in landed_archives(spark, out).collect())

    def parts(name, n, width):
        return (f"d/{name}.tar", [(i, f"d/{name}.tar.split.{i:0{width}d}", 10 + i) for i in range(n)])

    assert run() == [parts("five", 5, 3), parts("one", 1, 1)]
    arrive(spark, tmp_path / "in", [last, LISTED[0]], 6)
    done = [parts("five", 5, 3), parts("late", 4, 2), parts("one", 1, 1)]
    assert run() == done
    arrive(spark, tmp_path / "in", LISTED, 7)  # all once more
    assert run() == done


def test_released_archives_can_be_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(40):
        (tmp_path / f"m{i}.txt").write_text(f"text {i}\n" * 50)
    with tarfile.open(tmp_path / "x.tar", "w") as tar:
        for i in range(40):
            tar.add(tmp_path / f"m{i}.txt", f"m{i}.txt")
    data = (tmp_path / "x.tar").read_bytes()
    for i in range(0, len(data), 7000):
        (tmp_path / "in" / f"x.tar.split.{i // 7000:03d}").write_bytes(data[i : i + 7000])
    root = str(tmp_path / "in")
    listing = list_tree(spark, root).select("path", "size")
    # the file source tells path and length; contents are not read
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", 2).load(root)
    arrivals = files.selectExpr("substring_index(path, '/', -1) AS path", "length AS size")
    ingest_archives(spark, arrivals, listing, str(tmp_path / "out"), str(tmp_path / "offsets"))
    found = archives.index_archives(landed_archives(spark, str(tmp_path / "out")), root).filter("state = 'file'")
    assert sorted(r.member for r in found.collect()) == sorted(f"m{i}.txt" for i in range(40))


def test_state_is_kept_by_archive(spark, tmp_path):
    listing = spark.createDataFrame(LISTED, "path string, size long")
    arrive(spark, tmp_path / "in", LISTED[:1], 0)
    stream = spark.readStream.schema("path string, size long").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    assert whole_archives(stream, listing).columns == ["archive", "idx", "path", "size"]


def test_calls_to_the_store_do_not_grow_with_parts():
    calls, kept = [], {}

    class Value:
        def exists(self):
            calls.append("exists")
            return "v" in kept

        def get(self):
            calls.append("get")
            return kept["v"]

        def update(self, value):
            calls.append("update")
            kept["v"] = value

    class Handle:
        def getValueState(self, name, schema):
            return Value()

    processor = arrivals._gathered()
    processor.init(Handle())
    rows = pd.DataFrame({"idx": [str(i) for i in range(500)], "path": [f"p{i}" for i in range(500)], "size": range(500), "wanted": 500})
    assert list(processor.handleInputRows(("a",), iter([rows[:300]]), None)) == []
    (out,) = processor.handleInputRows(("a",), iter([rows[200:]]), None)
    assert sorted(out.path) == sorted(rows.path) and sorted(out["size"]) == list(range(500))
    assert list(processor.handleInputRows(("a",), iter([rows]), None)) == []
    assert len(calls) <= 9


def test_state_does_not_have_a_key_for_each_archive(spark, tmp_path):
    listed = [(f"d/a{a}.tar.split.{i}", a + i) for a in range(2500) for i in range(1 + a % 3)]
    listing = spark.createDataFrame(listed, "path string, size long")
    held_back = {f"d/a{a}.tar.split.0" for a in range(0, 2500, 10)}
    rows = [r for r in listed if r[0] not in held_back]
    random.Random(3).shuffle(rows)
    for n in range(2):
        arrive(spark, tmp_path / "in", rows[n::2], n)

    def run():
        stream = spark.readStream.schema("path string, size long").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = ingest_archives(spark, stream, listing, str(tmp_path / "out"), str(tmp_path / "offsets"))
        found = [r.archive for r in landed_archives(spark, str(tmp_path / "out")).collect()]
        assert len(set(found)) == len(found)
        return set(found), [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]

    found, keys = run()
    assert found == {f"d/a{a}.tar" for a in range(2500) if a % 10}
    assert keys and max(keys) <= arrivals.KEYS
    arrive(spark, tmp_path / "in", [r for r in listed if r[0] in held_back] + rows[:500], 2)
    assert run()[0] == {f"d/a{a}.tar" for a in range(2500)}


@pytest.mark.parametrize("seed", [4, 5])
def test_archives_of_one_key_are_kept_apart(seed):
    """Rows of many archives in one processor, against a plain count of each."""
    calls, kept, rng = [], {}, random.Random(seed)

    class Value:
        def exists(self):
            return "v" in kept

        def get(self):
            calls.append("get")
            return kept["v"]

        def update(self, value):
            calls.append("update")
            kept["v"] = value

    class Handle:
        def getValueState(self, name, schema):
            return Value()

    parts = [(f"a{a}", str(i), f"a{a}.{i}", i, n) for a in range(60) for n in [1 + a % 5] for i in range(n)]
    coming = parts + rng.sample(parts, 80)
    rng.shuffle(coming)
    seen, told = {}, []
    for at in range(0, len(coming), 40):
        processor = arrivals._gathered()
        processor.init(Handle())
        batch = [pd.DataFrame(coming[x : x + 20], columns=["archive", "idx", "path", "size", "wanted"]) for x in (at, at + 20) if coming[x : x + 20]]
        got = [r for out in processor.handleInputRows((7,), iter(batch), None) for r in out[["archive", "idx", "path", "size"]].itertuples(index=False, name=None)]
        before = {a for a, p in seen.items() if len(p) == 1 + int(a[1:]) % 5}
        for a, idx, path, size, _ in coming[at : at + 40]:
            seen.setdefault(a, set()).add((a, idx, path, size))
        now = {a for a, p in seen.items() if len(p) == 1 + int(a[1:]) % 5} - before
        assert sorted(got) == sorted(p for a in now for p in seen[a])
        told += got
    assert sorted(told) == sorted(p[:4] for p in parts)
    assert len(calls) <= 2 * -(-len(coming) // 40)
