"""Archives indexed in ranges, compared with the standard library reading them whole."""

import io
import random
import tarfile
from pathlib import Path

import pytest

from pairloom.runtime import shared_dir
from pairloom.sources import archives
from pairloom.sources.listing import list_tree


def add(tar, name, data, **fields):
    info = tarfile.TarInfo(name)
    info.size = len(data)
    for k, v in fields.items():
        setattr(info, k, v)
    tar.addfile(info, io.BytesIO(data))


def make_tar(members, fmt=tarfile.PAX_FORMAT, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode, format=fmt) as tar:
        for name, data in members:
            add(tar, name, data)
    return out.getvalue()


def plain_members(seed, count=60):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 511, 512, 513, 5000, 20000]) for _ in range(count)]
    return [(f"dir/{i}_{'n' * rng.choice([1, 90, 150, 300])}é.png", rng.randbytes(s)) for i, s in enumerate(sizes)]


def split(folder, name, data, cuts, first=0, width=3):
    cuts = [0, *cuts, len(data)]
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        (folder / f"{name}.split.{first + i:0{width}d}").write_bytes(data[lo:hi])


def scan(spark, root, **kw):
    found = archives.list_archives(list_tree(spark, str(root)))
    rows = archives.scan_tar_members(found, str(root), **kw).collect()
    return sorted((r.archive, r.member, bytes(r.payload)) for r in rows), found


@pytest.mark.parametrize("fmt", [tarfile.PAX_FORMAT, tarfile.GNU_FORMAT])
@pytest.mark.parametrize("range_bytes", [7000, 1 << 30])
def test_split_archive_in_ranges(spark, tmp_path, fmt, range_bytes):
    members = plain_members(1)
    data = make_tar(members, fmt)
    (tmp_path / "Singleturn").mkdir()
    split(tmp_path / "Singleturn", "a.tar", data, [100, 777, 30000, 30001, len(data) - 5], first=9, width=1)
    (tmp_path / "b.tar").write_bytes(data)
    got, _ = scan(spark, tmp_path, range_bytes=range_bytes)
    assert got == sorted([("Singleturn/a.tar", *m) for m in members] + [("b.tar", *m) for m in members])


def test_archives_inside_archives(spark, tmp_path):
    inner = make_tar(plain_members(2, 30))
    members = [("one.png", b"1" * 700), ("inner.tar", inner), ("two.png", b"2" * 9000), ("again.tar", inner), ("last.png", b"3")]
    (tmp_path / "a.tar").write_bytes(make_tar(members))
    for size in (4096, 10240):
        assert scan(spark, tmp_path, range_bytes=size)[0] == sorted(("a.tar", *m) for m in members)


def test_end_of_archive_is_respected(spark, tmp_path):
    """Members behind the end marker are not read, nor are ones behind a broken header."""
    data = make_tar([("a", b"x" * 2000)])
    (tmp_path / "a.tar").write_bytes(data + make_tar([("hidden", b"y")]))
    middle = bytearray(make_tar([("a", b"x" * 2000), ("b", b"y" * 2000), ("c", b"z")]))
    at = middle.find(b"b\0\0\0\0")
    middle[at : at + 8] = b"\xff" * 8
    (tmp_path / "b.tar").write_bytes(bytes(middle))
    want = sorted((n, m, d) for n, m, d in [("a.tar", "a", b"x" * 2000), ("b.tar", "a", b"x" * 2000)])
    for size in (1024, 1 << 20):
        assert scan(spark, tmp_path, range_bytes=size)[0] == want


def test_old_headers_without_magic(spark, tmp_path):
    out = io.BytesIO(make_tar([(f"m{i}", bytes([i]) * 3000) for i in range(9)], tarfile.USTAR_FORMAT))
    data = bytearray(out.getvalue())
    for at in range(0, len(data), 512):
        if data[at + 257 : at + 262] == b"ustar":
            data[at + 257 : at + 265] = bytes(8)
            data[at + 148 : at + 156] = b" " * 8
            data[at + 148 : at + 156] = b"%06o\0 " % sum(data[at : at + 512])
    (tmp_path / "old.tar").write_bytes(bytes(data))
    got, _ = scan(spark, tmp_path, range_bytes=2048)
    assert [m for _, m, _ in got] == [f"m{i}" for i in range(9)]


def test_compressed_and_unreadable(spark, tmp_path):
    members = plain_members(3, 10)
    for mode in ("gz", "bz2", "xz"):
        (tmp_path / f"{mode}.tar").write_bytes(make_tar(members, mode=f"w:{mode}"))
    (tmp_path / "junk.tar").write_bytes(b"no archive" * 500)
    (tmp_path / "empty.tar").write_bytes(b"")
    (tmp_path / "cut.tar").write_bytes(make_tar([("a", b"x" * 600), ("b", b"y" * 6000)])[:3000])
    got, found = scan(spark, tmp_path, range_bytes=1024)
    want = sorted((f"{m}.tar", *x) for m in ("gz", "bz2", "xz") for x in members)
    assert got == sorted([*want, ("cut.tar", "a", b"x" * 600)])
    states = {(r.archive, r.state) for r in archives.index_members(found, str(tmp_path), 1024).collect()}
    assert {("junk.tar", "unreadable"), ("empty.tar", "unreadable"), ("cut.tar", "unreadable"), ("gz.tar", "compressed")} <= states


def test_only_files_are_members(spark, tmp_path):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        add(tar, "d", b"", type=tarfile.DIRTYPE)
        add(tar, "link", b"", type=tarfile.SYMTYPE, linkname="d/x")
        add(tar, "d/x", b"data")
    (tmp_path / "a.tar").write_bytes(out.getvalue())
    got, found = scan(spark, tmp_path)
    assert got == [("a.tar", "d/x", b"data")]
    manifest = archives.archive_manifest(archives.index_members(found, str(tmp_path)))
    assert [(r.path, r.size) for r in manifest.collect()] == [("d/x", 4)]


def test_part_indices(spark):
    names = {"full": ["0", "1", "2"], "gap": ["0", "2"], "late": ["5", "6"], "twice": ["1", "01"], "wide": ["0009", "10"], "hole_and_twice": ["1", "1", "3"]}
    rows = [(f"x/{n}.tar.split.{i}", 10) for n, ids in names.items() for i in ids] + [("x/full.tar", 1), ("x/full.tar.split.a", 1)]
    parts = archives.split_parts(spark.createDataFrame(rows, "path string, size long"))
    got = {r.base: (r.complete, r.bytes) for r in archives.check_split_parts(parts).collect()}
    assert got == {"full.tar": (True, 30), "gap.tar": (False, 20), "late.tar": (True, 20), "twice.tar": (False, 20), "wide.tar": (True, 20), "hole_and_twice.tar": (False, 30)}


def test_last_unpacked_member_wins(spark, tmp_path):
    split(tmp_path, "z.tar", make_tar([("x", b"1"), ("./x", b"22"), ("y", b"1")]), [700])
    (tmp_path / "a.tar").write_bytes(make_tar([("y", b"333"), ("w", b"1")]))
    (tmp_path / "b.tar").write_bytes(make_tar([("w", b"4444")]))
    found = archives.list_archives(list_tree(spark, str(tmp_path)))
    manifest = archives.archive_manifest(archives.index_members(found, str(tmp_path)))
    assert sorted((r.path, r["size"]) for r in manifest.collect()) == [("w", 4), ("x", 2), ("y", 3)]


def test_large_members_are_not_searched(spark, tmp_path, monkeypatch):
    """Ranges inside one large member read little more than themselves."""
    data = make_tar([("a.txt", b"x"), ("large.bin", bytes(random.Random(1).randbytes(8 << 20))), ("z.txt", b"y")])
    (tmp_path / "one.tar").write_bytes(data)
    parts = [{"idx": 0, "path": "one.tar", "size": len(data)}]
    read, found = [], []
    whole_read = archives._Joined.read

    def counted(self, size=-1):
        got = whole_read(self, size)
        read.append(len(got))
        return got

    monkeypatch.setattr(archives._Joined, "read", counted)
    for lo in range(0, len(data), 1 << 18):
        f = archives._Joined(str(tmp_path), parts)
        found += [m.name for m, _ in archives._walk(f, lo, min(lo + (1 << 18), len(data)))]
    assert found == ["a.txt", "large.bin", "z.txt"]
    assert sum(read) <= 2 * len(data)


def test_small_ranges_share_tasks(spark, tmp_path):
    """The tasks that walk headers follow the bytes, not the number of ranges."""
    members = plain_members(3, 300)
    (tmp_path / "a.tar").write_bytes(make_tar(members))
    found = archives.list_archives(list_tree(spark, str(tmp_path)))
    before = set(Path(shared_dir(spark).removeprefix("file:")).glob("members-*"))
    index = archives.index_members(found, str(tmp_path), range_bytes=4096)
    (walked,) = set(Path(shared_dir(spark).removeprefix("file:")).glob("members-*")) - before
    assert len(list(walked.glob("part-*.parquet"))) <= spark.sparkContext.defaultParallelism
    assert sorted(r.member for r in index.collect()) == sorted(n for n, _ in members)
