"""Whole runs over small trees: build, verify, resume, slices and the stream."""

import bz2
import gzip
import hashlib
import io
import json
import lzma
import pickle
import shutil
import tarfile
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_images import png

from pairloom.operators.slices import PathSettings
from pairloom.plans import flows, schedule
from pairloom.runtime import new_folder, scratch, shared_dir, stage
from pairloom.sources import archives
from pairloom.sources import pair_files as pf
from pairloom.sources.listing import list_tree, match_globs, whole_file
from pairloom.sources.tar_sink import TarShardWriter, list_shards, write_shards
from pairloom.streaming.ingest import ingest_slices, published
from pairloom.streaming.snapshots import Snapshots

PAIRS = {
    # stem: (folder in the pair file, pairs, numbers whose output is missing, bad or empty)
    "add_part0": ("results_add", 25, {3: "missing", 7: "bad", 11: "empty"}),
    "hybrid_part1": ("results_compose_x", 12, {}),
    "zero": ("results_zero", 0, {}),
}


def write_pairs(root, stem, folder, n, prompt="édit {}\n"):
    mark = folder.removeprefix("results_")[0]
    paths = pa.array([[[f"{folder}/{mark}{i:03d}/original.png"]] for i in range(n)], pa.list_(pa.list_(pa.string())))
    edits = pa.array([[[f"{folder}/{mark}{i:03d}/edited.png"]] for i in range(n)], pa.list_(pa.list_(pa.string())))
    (root / "Parquet").mkdir(exist_ok=True, parents=True)
    table = pa.table({"input_images": paths, "output_images": edits, "prompt": [prompt.format(i) for i in range(n)]})
    pq.write_table(table, root / "Parquet" / f"{stem}.parquet", row_group_size=5)


def images_of(stem, n, flaws):
    for i in range(n):
        for side in ("original", "edited"):
            data = png(i + 1, 3, rows=None)
            flaw = flaws.get(i) if side == "edited" else None
            if flaw != "missing":
                data = {"bad": data[:-20], "empty": b""}.get(flaw, data)
                folder = PAIRS[stem][0]
                mark = folder.removeprefix("results_")[0]
                yield f"Singleturn/{folder.replace('compose', 'hybrid')}/{mark}{i:03d}/{side}.png", data


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for stem, (folder, n, flaws) in PAIRS.items():
        write_pairs(root, stem, folder, n)
        for path, data in images_of(stem, n, flaws):
            (root / path).parent.mkdir(parents=True, exist_ok=True)
            (root / path).write_bytes(data)
    return root


@pytest.fixture(scope="module")
def packed(tmp_path_factory):
    """The same images inside archives, one of them split."""
    root = tmp_path_factory.mktemp("packed")
    (root / "Singleturn").mkdir()
    for stem, (folder, n, flaws) in PAIRS.items():
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w") as tar:
            for path, data in images_of(stem, n, flaws):
                info = tarfile.TarInfo(path.removeprefix("Singleturn/"))
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        data, name = out.getvalue(), f"{folder.replace('compose', 'hybrid')}.tar"
        if stem == "add_part0":
            for i in range(0, len(data), 9999):
                (root / "Singleturn" / f"{name}.split.{i // 9999:03d}").write_bytes(data[i : i + 9999])
        else:
            (root / "Singleturn" / name).write_bytes(data)
    return root


def scan(spark, root):
    return pf.scan_pairs(spark, pf.column_catalog(spark, pf.list_pair_files(str(root))))


def tree_manifest(spark, root):
    return list_tree(spark, str(root)).selectExpr("*", f"{whole_file('path')} AS segments")


def archive_manifest(spark, packed):
    found = archives.list_archives(list_tree(spark, str(packed)))
    return archives.archive_manifest(archives.index_members(found, str(packed), 4096))


def read_tars(folder):
    found = {}
    for path in sorted(Path(folder).rglob("*.tar")):
        with tarfile.open(path) as tar:
            found[str(path.relative_to(folder))] = [(m.name, tar.extractfile(m).read()) for m in tar]
    return found


def expected_shards(per_shard, per_file=False):
    samples, n = [], 0
    for stem, (_, count, flaws) in sorted(PAIRS.items()):
        n = 0 if per_file else n
        for i in range(count):
            if i not in flaws:
                prompt = f"édit {i}"
                digest = hashlib.sha256(f"{stem}\0{n}\0{prompt}".encode()).hexdigest()[:20]
                name = f"shard-{n // per_shard:05d}.tar"
                name = f"{stem}/{name}" if per_file else name
                samples.append((name, f"{stem}_{n:08d}_{digest}", png(i + 1, 3), prompt))
                n += 1
    shards = {}
    for name, key, image, prompt in samples:
        members = [(f"{key}.jpg", image), (f"{key}.jpg2", image), (f"{key}.txt", f"{prompt}\n".encode())]
        shards.setdefault(name, []).extend(members)
    return shards


@pytest.mark.parametrize(("source", "per_file"), [("tree", False), ("archives", True)])
def test_build_and_verify(spark, root, packed, tmp_path, source, per_file):
    rows, layouts = scan(spark, root)
    manifest = tree_manifest(spark, root) if source == "tree" else archive_manifest(spark, packed)
    out = str(tmp_path / "out")
    result = flows.build(rows, manifest, out, layouts=layouts, root=str(root), samples_per_shard=10, per_file=per_file)
    assert read_tars(out) == expected_shards(10, per_file)
    stats = {r.file: (r.rows, r.pairs_emitted, r.kept, r.missing_file, r.bad_image) for r in result.stats.collect()}
    assert stats == {"add_part0.parquet": (25, 25, 22, 2, 1), "hybrid_part1.parquet": (12, 12, 12, 0, 0), "zero.parquet": (0, 0, 0, 0, 0)}
    checked = flows.verify(spark, out, result.sizes).collect()
    assert len(checked) == len(expected_shards(10, per_file))
    assert all(r.ok and r.unreadable == 0 and r.members_read == 3 * min(3, r.samples) for r in checked)


def test_resume_writes_only_what_is_missing(spark, root, tmp_path):
    rows, _ = scan(spark, root)
    manifest, out = tree_manifest(spark, root), tmp_path / "out"
    flows.build(rows, manifest, str(out), root=str(root), samples_per_shard=10, max_shards=2)
    assert sorted(r.shard_name for r in list_shards(spark, str(out)).collect()) == ["shard-00000.tar", "shard-00001.tar"]
    (out / "shard-00000.tar").write_bytes(b"left alone")
    flows.build(rows, manifest, str(out), root=str(root), samples_per_shard=10, skip_written=True)
    assert (out / "shard-00000.tar").read_bytes() == b"left alone"
    want = expected_shards(10)
    assert {p.name for p in out.glob("*.tar")} == set(want)
    assert not list(out.glob(".*"))
    with tarfile.open(out / "shard-00003.tar") as tar:
        assert [m.name for m in tar] == [n for n, _ in want["shard-00003.tar"]]
    # Existing shards are replaced on request only.
    flows.build(rows, manifest, str(out), root=str(root), samples_per_shard=10)
    assert (out / "shard-00000.tar").read_bytes() == b"left alone"
    flows.build(rows, manifest, str(out), root=str(root), samples_per_shard=10, overwrite="true")
    assert read_tars(out) == want


def test_same_input_gives_same_bytes(spark, root, tmp_path):
    rows, _ = scan(spark, root)
    manifest = tree_manifest(spark, root)
    for n in (1, 2):
        flows.build(rows, manifest, str(tmp_path / str(n)), root=str(root), prefix="p", samples_per_shard=13)
    for path in (tmp_path / "1").glob("*.tar"):
        assert path.name.startswith("p-shard-")
        assert path.read_bytes() == (tmp_path / "2" / path.name).read_bytes()


def test_lost_image_fails_the_write(spark, root, tmp_path):
    rows, _ = scan(spark, root)
    gone = tree_manifest(spark, root).withColumn(
        "segments", F.expr("IF(path LIKE '%/c010/%', transform(segments, s -> struct(concat(s.file, 'x') AS file, s.offset, s.length)), segments)")
    )
    result = flows.build(rows, gone, str(tmp_path / "o"), root=str(root))
    assert {r.file: r.bad_image for r in result.stats.collect()}["hybrid_part1.parquet"] == 1


def test_damaged_shard_is_reported(spark, root, tmp_path):
    rows, _ = scan(spark, root)
    out = tmp_path / "out"
    result = flows.build(rows, tree_manifest(spark, root), str(out), root=str(root), samples_per_shard=20)
    with tarfile.open(out / "shard-00001.tar") as tar:
        kept = [(m, tar.extractfile(m).read()) for m in tar]
    with tarfile.open(out / "shard-00001.tar", "w") as tar:
        for m, data in kept[1:]:
            data = b"\xff" * 4 if m.name.endswith("txt") else data
            m.size = len(data)
            tar.addfile(m, io.BytesIO(data))
    got = {r.shard_name: (r.problem, r.bad_keys, r.unreadable) for r in flows.verify(spark, str(out), result.sizes).collect()}
    assert got == {"shard-00000.tar": (None, 0, 0), "shard-00001.tar": ("incomplete_keys", 1, 3)}


def test_audit_gate_and_reports(spark, root, tmp_path):
    rows, layouts = scan(spark, root)
    report = flows.audit(rows, layouts, tree_manifest(spark, root))
    files = {r.file: (r.strict_pairs, r.both_exist, r.resolve_rate) for r in report["files"].collect()}
    # An empty file exists for the audit.
    assert files == {"add_part0.parquet": (25, 24, 24 / 25), "hybrid_part1.parquet": (12, 12, 1.0), "zero.parquet": (0, 0, None)}
    examples = report["examples"].collect()
    assert [(r.input, r.reason) for r in examples] == [("results_add/a003/original.png", "missing_output")]
    verdicts = {r.stem: (r.verdict, r.reason) for r in flows.gate(report["files"]).collect()}
    assert verdicts == {"add_part0": ("SKIPPED", "low_resolve_rate"), "hybrid_part1": ("SUCCESS", None), "zero": ("SKIPPED", "no_strict_pairs")}
    flows.write_reports(report, str(tmp_path / "report"))
    lines = [json.loads(x) for p in (tmp_path / "report/files").glob("*.json") for x in p.read_text().splitlines()]
    assert {x["file"]: x["rows"] for x in lines} == {"add_part0.parquet": 25, "hybrid_part1.parquet": 12, "zero.parquet": 0}


def test_stream_takes_each_file_once(spark, root, tmp_path):
    out, folder = str(tmp_path / "out"), tmp_path / "in"
    manifest = tree_manifest(spark, root).select("path", "size")
    write_pairs(folder, "hybrid_part1", "results_compose_x", 12)

    def run(per_batch=1000):
        schema = spark.read.parquet(str(folder / "Parquet")).schema
        ingest_slices(
            spark, str(folder / "Parquet"), schema, "lists", lambda: manifest, out, str(tmp_path / "offsets"),
            samples_per_shard=5, min_rate=0.9, files_per_batch=per_batch, root=str(root),
        ).awaitTermination()
        verdicts = sorted((r.file, r.verdict) for r in published(spark, out, "verdicts").collect())
        samples = published(spark, out, "samples")
        return verdicts, sorted((r.shard_name, r.pair_index) for r in samples.collect())

    first = [(f"hybrid_part1/shard-{i // 5:05d}.tar", i) for i in range(12)]
    assert run() == ([("hybrid_part1.parquet", "SUCCESS")], first)
    assert run() == ([("hybrid_part1.parquet", "SUCCESS")], first)
    write_pairs(folder, "add_part0", "results_add", 25)
    write_pairs(folder, "gone", "results_gone", 3)
    verdicts, samples = run(per_batch=1)
    assert verdicts == [("add_part0.parquet", "SUCCESS"), ("gone.parquet", "SKIPPED"), ("hybrid_part1.parquet", "SUCCESS")]
    # The truncated and the empty image are no samples.
    assert samples == sorted(first + [(f"add_part0/shard-{i // 5:05d}.tar", i) for i in range(22)])


@pytest.mark.parametrize("per_batch", [1, 2, 1000])
def test_part_files_of_one_slice_in_several_batches(spark, root, tmp_path, per_batch):
    """Verdict and samples come from the whole slice, however many parts a batch takes, and equal the batch flow's."""
    out, folder = str(tmp_path / "out"), tmp_path / "in"
    for stem, names in {"hybrid_part1": ["whole"], "broken": ["whole", "gone"]}.items():
        write_pairs(folder, "whole", "results_compose_x", 12)
        write_pairs(folder, "gone", "results_gone", 12)
        parts = folder / "Sliced" / f"{stem}.parquet"
        parts.mkdir(parents=True)
        for k, name in enumerate(names):
            whole = pq.read_table(folder / "Parquet" / f"{name}.parquet")
            for i in (0, 1, 2):
                pq.write_table(whole.slice(4 * i, 4), parts / f"part-{3 * k + i}.parquet")
    schema = spark.read.parquet(str(folder / "Sliced" / "broken.parquet")).schema
    manifest = tree_manifest(spark, root)
    settings = PathSettings(rules=[("results_compose", "results_hybrid")])
    ingest_slices(
        spark, str(folder / "Sliced"), schema, "lists", lambda: manifest, out, str(tmp_path / "offsets"),
        settings=settings, min_rate=0.8, files_per_batch=per_batch, root=str(root),
    ).awaitTermination()
    verdicts = {r.file: (r.verdict, r.reason, r.strict_pairs) for r in published(spark, out, "verdicts").collect()}
    assert verdicts == {"hybrid_part1.parquet": ("SUCCESS", None, 12), "broken.parquet": ("SKIPPED", "low_resolve_rate", 24)}
    samples = published(spark, out, "samples").select("file", "part", "row_index", "pair_index", "key", "prompt").collect()
    assert {r.file for r in samples} == {"hybrid_part1.parquet"} and sorted(r.pair_index for r in samples) == list(range(len(samples)))
    rows = spark.read.parquet(f"{out}/rows").drop("batch")
    layouts = rows.select("file").distinct().selectExpr("file", "'lists' AS layout")
    ran = flows.run_slices(rows, layouts, manifest, settings, str(root), min_rate=0.8)
    assert sorted(samples) == sorted(ran.samples.select("file", "part", "row_index", "pair_index", "key", "prompt").collect())


def test_publications_are_whole_and_write_new_slices_only(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    log = Snapshots(spark, out)

    def tables(version, *files):
        samples = spark.createDataFrame([(f, f"{f}-{version}-{i}") for f in files for i in range(3)], "file string, key string")
        verdicts = spark.createDataFrame([(f, version) for f in files], "file string, n int")
        return {"samples": samples.filter("file <> 'empty.parquet'"), "verdicts": verdicts, "batches": spark.createDataFrame([(version,)], "batch int")}

    def held():
        return {r.file: r.n for r in log.read("verdicts").collect()}, sorted(r.key for r in log.read("samples").collect())

    def bytes_written():
        return {p: p.stat().st_size for p in Path(out).rglob("*.parquet") if p.is_file()}

    assert log.read("samples") is None and log.history("batches") is None
    log.publish(tables(1, "a.parquet", "b.parquet", "empty.parquet"))
    first = ({"a.parquet": 1, "b.parquet": 1, "empty.parquet": 1}, [f"{f}.parquet-1-{i}" for f in "ab" for i in range(3)])
    assert held() == first
    old, before = log.read("samples"), bytes_written()

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(Snapshots, "_point", stop)  # all tables are written, the pointer is not
    with pytest.raises(KeyboardInterrupt):
        log.publish(tables(2, "b.parquet", "c.parquet"))
    assert held() == first
    monkeypatch.undo()
    torn = tables(2, "b.parquet", "c.parquet")
    torn["verdicts"] = torn["verdicts"].selectExpr("file", "CAST(raise_error('stopped between two tables') AS INT) AS n")
    with pytest.raises(Exception, match="between two tables"):
        log.publish(torn)
    assert held() == first
    before = before | bytes_written()
    log.publish(tables(3, "b.parquet", "c.parquet"))
    assert held() == ({"a.parquet": 1, "b.parquet": 3, "c.parquet": 3, "empty.parquet": 1}, sorted([f"a.parquet-1-{i}" for i in range(3)] + [f"{f}.parquet-3-{i}" for f in "bc" for i in range(3)]))
    assert sorted(r.batch for r in log.history("batches").collect()) == [1, 3]
    after = bytes_written()
    assert all(after[p] == n for p, n in before.items())  # nothing is written anew
    assert {p.parent.name for p in after.keys() - before.keys() if "/samples/" in str(p)} == {"file=b.parquet", "file=c.parquet"}
    assert sorted(r.key for r in old.collect()) == first[1]  # who reads the old one goes on with it
    with pytest.raises(RuntimeError, match="another writer"):
        log._point(2, "x")


def test_gated_run_writes_passed_slices_only(spark, root, tmp_path):
    rows, layouts = scan(spark, root)
    out = str(tmp_path / "shards")
    failures = spark.createDataFrame([("lost.parquet", "missing_pair_file")], "file string, reason string")
    ran = flows.run_slices(rows, layouts, tree_manifest(spark, root), root=str(root), out=out, samples_per_shard=5, failures=failures, min_rate=1.0)
    verdicts = {r.file: r.verdict for r in ran.verdicts.collect()}
    assert verdicts["lost.parquet"] == "FAILED" and "SKIPPED" in verdicts.values() and "SUCCESS" in verdicts.values()
    passed = {f.removesuffix(".parquet") for f, v in verdicts.items() if v == "SUCCESS"}
    assert {Path(p).parts[0] for p in read_tars(out)} == passed
    assert {r.state for r in ran.built.written.collect()} == {"written"}
    totals = ran.built.totals().first()
    assert totals.samples_written == totals.kept == ran.samples.count() and totals.samples_skipped == 0
    again = flows.run_slices(rows, layouts, tree_manifest(spark, root), root=str(root), out=out, samples_per_shard=5, min_rate=1.0)
    assert {r.state for r in again.built.written.collect()} == {"skipped"}
    assert again.built.totals().first().samples_written == 0
    assert not [p for p in Path(out).rglob(".*") if ".tar." in p.name]


def test_failed_shards_leave_no_parts(spark, root, tmp_path):
    rows, _ = scan(spark, root)
    gone = tree_manifest(spark, root).selectExpr("path", "size", f"{whole_file('path')} AS segments")
    copy = tmp_path / "copy"
    shutil.copytree(root, copy)
    built = flows.build(rows, gone, str(tmp_path / "first"), root=str(copy), samples_per_shard=5)
    next(iter(sorted(copy.rglob("edited.png")))).unlink()
    with pytest.raises(Exception, match="can no longer be read"):
        write_shards(built.samples, str(tmp_path / "second"), built.sizes.count(), root=str(copy))
    assert not [p for p in (tmp_path / "second").rglob(".*") if ".tar." in p.name and not p.name.endswith(".crc")]


def test_shard_limit_per_file(spark, root, tmp_path):
    rows, _ = scan(spark, root)
    built = flows.build(rows, tree_manifest(spark, root), str(tmp_path / "x"), root=str(root), samples_per_shard=5, per_file=True, max_shards=1)
    kept = {r.file: r.kept for r in built.stats.collect()}
    assert kept == {f: n for f, n in built.samples.groupBy("file").count().collect()} | {f: n for f, n in kept.items() if n == 0}
    assert all(n <= 5 for n in kept.values())


@pytest.mark.parametrize("per_file", [False, True])
def test_a_shard_limit_ends_decoding(spark, root, tmp_path, monkeypatch, per_file):
    """Images read follow the shards asked for, and the counts are those of a build that reads everything."""
    rows, layouts = scan(spark, root)
    manifest, read, check = tree_manifest(spark, root), [], flows.image_validity

    def counted(located, folder=""):
        read.append(located.count())
        return check(located, folder)

    monkeypatch.setattr(flows, "image_validity", counted)
    monkeypatch.setattr(flows, "BATCH_ROWS", 2)
    whole = stage(flows.build_pairs(rows, manifest, root=str(root)), "whole")
    numbered = flows.pair_index(whole.filter("status = 'kept'"), per_file)
    everything = read.pop()
    for n, size in ((1, 4), (2, 4), (3, 5), (1, 20), (9, 10)):
        want = flows.limited_stats(rows, whole, numbered, n, size, per_file=per_file)
        got = flows.build(rows, manifest, str(tmp_path / f"{n}-{size}"), root=str(root), samples_per_shard=size, per_file=per_file, max_shards=n)
        assert sorted(got.stats.collect()) == sorted(want.collect()), (n, size)
        keys = sorted(r.key for r in got.samples.collect())
        assert keys == sorted(r.key for r in flows.assign_shards(flows.with_prompts(numbered, rows), size, "", per_file).filter(f"shard_id < {n}").collect())
        runs = 2 if per_file else 1
        assert sum(read) <= min(everything, 2 * runs * (2.5 * n * size + 2)), (n, size, read)
        read.clear()


def test_a_repeated_task_knows_its_own_shards(spark, root, tmp_path):
    rows, _ = scan(spark, root)
    built = flows.build(rows, tree_manifest(spark, root), str(tmp_path / "a"), root=str(root), samples_per_shard=100)
    samples = built.samples.orderBy("pair_index").collect()
    options = {"path": str(tmp_path / "b"), "root": str(root)}
    job, other = TarShardWriter(options), TarShardWriter(options)
    attempts = [job.write(iter(samples)), pickle.loads(pickle.dumps(job)).write(iter(samples)), other.write(iter(samples))]
    assert [[s[1:] for s in a.shards] for a in attempts] == [[(len(samples), state)] for state in ("written", "written", "skipped")]
    job.commit(attempts[:1])
    assert [p.name for p in (tmp_path / "b").iterdir()] == ["shard-00000.tar"]


def test_compressed_archives_give_the_same_pairs(spark, root, packed, tmp_path):
    """The same archives plain, and as gzip, bzip2 and xz; a torn one is told apart."""
    rows, _ = scan(spark, root)
    want = None
    for mode in ("", "gz", "bz2", "xz"):
        folder = tmp_path / f"in{mode}"
        (folder / "Singleturn").mkdir(parents=True)
        for part in sorted((packed / "Singleturn").iterdir()):
            data = part.read_bytes()
            if mode and part.suffix == ".tar":
                data = {"gz": gzip, "bz2": bz2, "xz": lzma}[mode].compress(data)
            (folder / "Singleturn" / part.name).write_bytes(data)
        if mode == "gz":
            (folder / "Singleturn" / "torn.tar").write_bytes(gzip.compress(b"x" * 10_000)[:-20])
        index = archives.index_archives(archives.list_archives(list_tree(spark, str(folder))), str(folder), 4096)
        assert index.filter("state = 'unreadable'").count() == (mode == "gz")
        out = str(tmp_path / f"out{mode}")
        flows.build(rows, archives.archive_manifest(index), out, root=str(folder), samples_per_shard=5)
        found = read_tars(out)
        want = want or found
        assert found == want and found


def test_no_prompt_before_the_numbers(spark, root):
    rows, _ = scan(spark, root)
    pairs = flows.build_pairs(rows, tree_manifest(spark, root), root=str(root))
    assert "prompt" not in pairs.columns
    scans = [x for x in pairs._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in x and "input_images" in x]
    assert scans and not [x for x in scans if "prompt" in x.rpartition("ReadSchema")[2]]


def test_standard_slices(spark):
    slices = schedule.standard_slices()
    assert len(slices) == 32 and len({s.stem for s in slices}) == 32
    settings = schedule.path_settings(slices)
    assert settings.subdirs["action_part3"] == "Singleturn/part3" and len(settings.subdirs) == 4
    assert settings.hybrid_stems == ("hybrid_part0", "hybrid_part2", "hybrid_part6")
    names = ["Singleturn/results_remove_part0.tar.split.000", "Singleturn/results_remove_part0.tar", "Singleturn/action_part2.tar.split.1"]
    listing = spark.createDataFrame([(n,) for n in names], "path string")
    got = sorted((r.stem, r.path) for r in schedule.slice_archives(spark, listing, slices).collect())
    assert got == [("action_part2", names[2]), ("remove_part0", names[0])]


def test_glob_tiers(spark):
    files = ["A/x.tar", "a/x.tar", "./a/y.tar", "b\\z.tar", "C/ß.tar", "lit[1].tar"]
    listing = spark.createDataFrame([(f,) for f in files], "path string")
    patterns = ["a/*.tar", "A/Y.tar", "b/*", "c/SS.tar", "lit[[]1].tar", "./a/?.tar", "none*", "b\\z*"]
    got = sorted((r.pattern, r.path, r.tier) for r in match_globs(listing, patterns).collect())
    assert got == [
        ("./a/?.tar", "./a/y.tar", 1),
        ("./a/?.tar", "a/x.tar", 1),
        ("A/Y.tar", "./a/y.tar", 2),
        ("a/*.tar", "./a/y.tar", 1),
        ("a/*.tar", "a/x.tar", 1),
        ("b/*", "b\\z.tar", 1),
        ("b\\z*", "b\\z.tar", 1),
        ("c/SS.tar", "C/ß.tar", 2),
        ("lit[[]1].tar", "lit[1].tar", 1),
    ]


def test_tree_listing(spark, root):
    want = {str(p.relative_to(root)): p.stat().st_size for p in root.rglob("*") if p.is_file()}
    for levels in (0, 1, 3, 6):
        assert {r.path: r["size"] for r in list_tree(spark, str(root), levels=levels).collect()} == want
    assert list_tree(spark, str(root / "nowhere")).count() == 0


def test_shared_folder_comes_from_the_session(spark):
    def session(master, **conf):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert shared_dir(session("yarn", **{"spark.checkpoint.dir": "hdfs://n/c/"})) == "hdfs://n/c"
    with pytest.raises(RuntimeError):
        shared_dir(session("yarn"))
    assert shared_dir(spark) == shared_dir(spark) and new_folder(spark, "x") != new_folder(spark, "x")
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5 and shared_dir(spark) in staged.inputFiles()[0]


def test_scratch_is_cleared(spark, root, tmp_path):
    def folders():
        return {p.name for p in Path(shared_dir(spark).removeprefix("file:")).iterdir()}

    rows, _ = scan(spark, root)
    kept, before = stage(spark.range(3), "kept"), folders()
    with scratch(spark):
        flows.build(rows, tree_manifest(spark, root), str(tmp_path / "out"), root=str(root), samples_per_shard=10)
        assert len(folders()) > len(before) + 2
    assert {f.rpartition("-")[0] for f in folders() - before} <= {"report"}
    assert kept.count() == 3 and read_tars(str(tmp_path / "out")) == expected_shards(10)
    with pytest.raises(ZeroDivisionError), scratch(spark):
        stage(spark.range(3), "lost")
        1 / 0
    assert not [f for f in folders() if f.startswith("lost-")]


def test_settings_reach_the_audit(spark, tmp_path):
    paths = pa.array([[["a.png"]], [["old/b.png"]]])
    (tmp_path / "Parquet").mkdir()
    pq.write_table(pa.table({"input_images": paths, "output_images": paths, "prompt": ["", ""]}), tmp_path / "Parquet" / "s.parquet")
    manifest = spark.createDataFrame([("Singleturn/part1/a.png", 1), ("Multiturn/new/b.png", 1)], "path string, size long")
    settings = PathSettings(rules=[("old", "new")], subdirs={"s": "Singleturn/part1"})
    rows, layouts = scan(spark, tmp_path)
    assert flows.audit(rows, layouts, manifest, settings)["files"].first().both_exist == 2
    assert flows.audit(rows, layouts, manifest)["files"].first().both_exist == 0
