"""Tar archives, whole or split into parts, as tables of members.

A member is described by where its bytes lie, so plain archives are never
unpacked: later steps read the byte ranges they need. Compressed ones have no
such ranges and are decompressed, once and front to back, into plain archives in
the shared folder. One archive is indexed by many
tasks. Each walks the headers that start in its byte range, beginning at the
first header it can find there. A file inside the archive may look like a
header, so neighbours are compared afterwards: a walk must end exactly where
the next one began. Archives that fail this test, and compressed ones, are
walked again from the start by one task.
"""

import bz2
import gzip
import io
import lzma
import shutil
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairloom.functions.paths import base_name, canonical_path, dir_name
from pairloom.runtime import new_folder, spread, stage
from pairloom.sources.files import SEGMENTS, SegmentReader, batches_of, join_path, open_fs

# Fixed value: end of the name of one part of a split archive.
SPLIT_NAME = r"r'[^/]\.tar\.split\.[0-9]+\z'"

BLOCK = 512
RANGE_BYTES = 256 << 20
TASK_BYTES = 4 * RANGE_BYTES
# What it takes to open a range, in bytes of headers and files walked over.
OPENING = 2 << 20
# Room before a range in which the headers of a long member name may start.
LOOK_BACK = 64 << 10
# Headers are read with some of what follows, so that small members need no request each.
READ_AHEAD = 32 << 10
COMPRESSED = (b"\x1f\x8b", b"BZh", b"\xfd7zXZ\x00")
OPENERS = dict(zip(COMPRESSED, (gzip.open, bz2.open, lzma.open)))

PARTS = "array<struct<idx:decimal(38,0),path:string,size:bigint>>"
MEMBER = f"archive string, whole boolean, member string, size long, segments {SEGMENTS}, range_no long, start long, next long, state string"


def split_parts(listing: DataFrame) -> DataFrame:
    """Parts of split archives: folder, archive name and index."""
    parts = listing.filter(f"path RLIKE {SPLIT_NAME}").selectExpr(
        "substring_index(path, '.split.', -1) AS idx", "path", "size"
    )
    parts = parts.selectExpr("left(path, length(path) - length(idx) - 7) AS tar", "idx", "path", "size")
    return parts.selectExpr(
        f"{dir_name('tar')} AS dir", f"{base_name('tar')} AS base", "CAST(idx AS DECIMAL(38, 0)) AS idx", "path", "size"
    )


def check_split_parts(parts: DataFrame) -> DataFrame:
    """Per split archive: are the indices contiguous and unique, and how large is it?"""
    by_index = parts.groupBy("dir", "base", "idx").agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes")
    )
    return (
        by_index.groupBy("dir", "base")
        .agg(
            F.min("idx").cast("bigint").alias("first"),
            F.max("idx").cast("bigint").alias("last"),
            F.sum("n").alias("parts"),
            F.count("*").alias("indices"),
            F.sum("bytes").alias("bytes"),
        )
        .withColumn(
            "complete",
            (F.col("last") - F.col("first") + 1 == F.col("parts")) & (F.col("parts") == F.col("indices")),
        )
    )


def list_archives(listing: DataFrame) -> DataFrame:
    """Readable archives with their ordered parts; incomplete splits are left out."""
    parts = split_parts(listing)
    complete = check_split_parts(parts).filter("complete").select("dir", "base")
    one = F.struct("idx", "path", "size")
    split = (
        parts.join(complete, ["dir", "base"], "left_semi")
        .groupBy(F.concat("dir", "base").alias("archive"))
        .agg(F.sort_array(F.collect_list(one)).cast(PARTS).alias("parts"))
        .withColumn("whole", F.lit(False))
    )
    whole = listing.filter(F.col("path").endswith(".tar")).select(
        F.col("path").alias("archive"),
        F.array(F.struct(F.lit(0).alias("idx"), "path", "size")).cast(PARTS).alias("parts"),
        F.lit(True).alias("whole"),
    )
    return split.unionByName(whole)


class _Joined(io.RawIOBase):
    """The parts of one archive as a single seekable file."""

    def __init__(self, root: str, parts) -> None:
        self._parts, at = [], 0
        for p in parts:
            self._parts.append((at, int(p["size"]), join_path(root, p["path"])))
            at += int(p["size"])
        self.size, self._at, self._open = at, 0, (None, None)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        base = {io.SEEK_SET: 0, io.SEEK_CUR: self._at, io.SEEK_END: self.size}[whence]
        self._at = base + offset
        return self._at

    def pieces(self, offset: int, length: int) -> list[dict]:
        """Where a byte range lies in the parts."""
        found = []
        for start, size, path in self._parts:
            lo, hi = max(offset, start), min(offset + length, start + size)
            if lo < hi:
                found.append({"file": path, "offset": lo - start, "length": hi - lo})
        return found

    def read(self, size: int = -1) -> bytes:
        left = self.size - self._at if size < 0 else size
        out = []
        for piece in self.pieces(self._at, max(0, left)):
            path = piece["file"]
            if self._open[0] != path:
                files, inner = open_fs(path)
                self._open = (path, files.open_input_file(inner))
            out.append(self._open[1].read_at(piece["length"], piece["offset"]))
        data = b"".join(out)
        self._at += len(data)
        return data

    def readinto(self, buffer) -> int:
        data = self.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def _first_header(f: _Joined, at: int, end: int) -> int | None:
    """Offset of the first block from ``at`` up to ``end`` that is a valid tar header."""
    at = -(-at // BLOCK) * BLOCK
    while at < end:
        f.seek(at)
        data = f.read(min(BLOCK << 11, -(-(end - at) // BLOCK) * BLOCK))
        for i in range(0, len(data) - BLOCK + 1, BLOCK):
            if data[i + 257 : i + 262] == b"ustar":
                try:
                    tarfile.TarInfo.frombuf(data[i : i + BLOCK], "utf-8", "surrogateescape")
                    return at + i
                except tarfile.HeaderError:
                    pass
        at += len(data) or BLOCK
    return None


def _walk(f: _Joined, lo: int, hi: int) -> Iterator[tuple[tarfile.TarInfo | None, int | None]]:
    """Members whose headers start in [lo, hi), each with the offset of the next member."""
    first = 0 if lo == 0 else _first_header(f, max(0, lo - LOOK_BACK), hi)
    if first is None:
        return
    ahead = io.BufferedReader(f, READ_AHEAD)
    ahead.seek(first)
    with tarfile.TarFile(fileobj=ahead, mode="r") as tar:
        member = tar.next()
        while member is not None and member.offset < hi:
            tar.members.clear()
            after = tar.next()
            if member.offset >= lo:
                yield member, after.offset if after else None
            member = after


def _text(name: str) -> str:
    return name.encode("utf-8", "surrogateescape").decode("utf-8", "replace")


def _index(root: str, limit: int = 20_000):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MEMBER.split(", ")]
        for batch in batches:
            for task in batch.to_dict("records"):
                f, rows = _Joined(root, task["parts"]), []
                of = [task["archive"], task["whole"]]
                mark = [*of, None, None, None, task["range_no"], None, None]
                f.seek(0)
                if f.read(6).startswith(COMPRESSED):
                    if task["lo"] == 0:
                        yield pd.DataFrame([[*mark, "compressed"]], columns=names)
                    continue
                try:
                    for m, after in _walk(f, task["lo"], task["hi"]):
                        at = f.pieces(m.offset_data, m.size) if m.isreg() and not m.issparse() else None
                        state = "file" if at is not None else "other"
                        rows.append(
                            [*of, _text(m.name), m.size, at, task["range_no"], m.offset, after, state]
                        )
                        if len(rows) >= limit:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                except (tarfile.TarError, OSError):
                    rows.append([*mark, "unreadable"])
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return run


def index_members(archives: DataFrame, root: str = "", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Members of uncompressed archives with the location of their bytes.

    ``state`` is file, other (folders, links), compressed or unreadable; the
    last two stand for a whole archive and have no member.
    """
    spark = archives.sparkSession
    total = F.aggregate("parts", F.lit(0).cast("bigint"), lambda acc, p: acc + p["size"])
    tasks = archives.withColumn("total", total)
    n = F.greatest(F.ceil(F.col("total") / range_bytes), F.lit(1)).cast("bigint")
    ranges = tasks.withColumn("range_no", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
    ranges = ranges.select(
        "archive",
        "whole",
        F.transform("parts", lambda p: F.struct(p["path"].alias("path"), p["size"].alias("size"))).alias("parts"),
        "range_no",
        (F.col("range_no") * range_bytes).alias("lo"),
        F.least((F.col("range_no") + 1) * range_bytes, F.greatest("total", F.lit(1))).alias("hi"),
    )
    # One range is reading behind a short row, so tasks are counted by the bytes of the ranges, however small these are.
    work = ranges.agg(F.coalesce(F.sum(F.col("hi") - F.col("lo") + OPENING), F.lit(0))).first()[0]
    width = max(spark.sparkContext.defaultParallelism, -(-work // TASK_BYTES))
    walked = stage(
        ranges.repartition(width, "archive", "range_no").mapInPandas(_index(root), MEMBER), "members"
    )
    chain = (
        walked.groupBy("archive", "range_no")
        .agg(
            F.min("start").alias("first"),
            F.max_by("next", "start").alias("next"),
            F.bool_or(F.col("state") == "unreadable").alias("broken"),
        )
        .withColumn("expected", F.lag("next").over(W.partitionBy("archive").orderBy("range_no")))
        .withColumn("later", F.lead("first").over(W.partitionBy("archive").orderBy("range_no")))
    )
    torn = chain.filter(
        (F.col("range_no") > 0) & ~F.col("first").eqNullSafe(F.col("expected"))
        | (F.col("next").isNotNull() & F.col("later").isNull())
        | (F.col("broken") & (F.col("range_no") > 0))
    )
    torn = torn.select("archive").distinct()
    again = (
        tasks.join(torn, "archive", "left_semi")
        .select("archive", "whole", "parts", F.lit(0).cast("bigint").alias("range_no"), F.lit(0).cast("bigint").alias("lo"), F.col("total").alias("hi"))
        .repartition(width, "archive")
        .mapInPandas(_index(root), MEMBER)
    )
    kept = walked.join(torn, "archive", "left_anti").unionByName(again)
    path = f"concat({dir_name('archive')}, member) AS path"
    return kept.selectExpr("archive", "whole", path, "member", "size", "segments", "start AS offset", "state")


def _decompress(root: str, folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for task in batch.to_dict("records"):
                source = io.BufferedReader(_Joined(root, task["parts"]), 4 << 20)
                opener = next(o for magic, o in OPENERS.items() if source.peek(6).startswith(magic))
                path = f"{folder}/{uuid.uuid4().hex}.tar"
                files, inner = open_fs(path)
                try:
                    with files.open_output_stream(inner) as out, opener(source) as plain:
                        shutil.copyfileobj(plain, out, 4 << 20)
                    rows.append((task["archive"], task["whole"], path, files.get_file_info(inner).size))
                except (OSError, EOFError, zlib.error, lzma.LZMAError):
                    files.delete_file(inner)
                    rows.append((task["archive"], task["whole"], None, 0))
            yield pd.DataFrame(rows, columns=["archive", "whole", "path", "size"])

    return run


def index_archives(archives: DataFrame, root: str = "", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``index_members`` with the members of compressed archives, whose bytes lie in plain copies.

    Archives are decompressed one a task; a copy that a lost task has left is
    never named. Members keep the paths they have in the archive.
    """
    spark = archives.sparkSession
    archives = stage(archives, "archives")
    index = index_members(archives, root, range_bytes)
    packed = stage(archives.join(index.filter("state = 'compressed'").select("archive"), "archive", "left_semi"), "packed")
    count = packed.count()
    if not count:
        return index
    folder = new_folder(spark, "unpacked")
    files, inner = open_fs(folder)
    files.create_dir(inner, recursive=True)
    folder = inner if folder.startswith("file:") else folder
    plain = packed.repartitionByRange(count, "archive").mapInPandas(_decompress(root, folder), "archive string, whole boolean, path string, size long")
    plain = stage(plain, "unpacked-index")
    copies = plain.filter("path IS NOT NULL").select(
        "archive", "whole", F.array(F.struct(F.lit(0).alias("idx"), "path", "size")).cast(PARTS).alias("parts")
    )
    torn = index.filter("state = 'compressed'").join(plain.filter("path IS NULL").select("archive"), "archive", "left_semi")
    torn = torn.withColumn("state", F.lit("unreadable"))
    return index.filter("state <> 'compressed'").unionByName(index_members(copies, "", range_bytes)).unionByName(torn)


MEMBER_BYTES = ["archive", "member", "size", "payload"]


def _stream(root: str, task) -> Iterator[tuple]:
    f = _Joined(root, task["parts"])
    try:
        with tarfile.open(fileobj=io.BufferedReader(f, 4 << 20), mode="r|*") as tar:
            for m in tar:
                if m.isreg():
                    data = tar.extractfile(m).read()
                    yield task["archive"], _text(m.name), len(data), data
    except (tarfile.TarError, OSError, EOFError):
        return


def _unpack(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for task in batch.to_dict("records") for row in _stream(root, task))
        yield from batches_of(rows, MEMBER_BYTES)

    return run


def scan_compressed(archives: DataFrame, index: DataFrame, root: str = "") -> DataFrame:
    """Members and bytes of compressed archives; each can only be read front to back."""
    packed = index.filter("state = 'compressed'").select("archive")
    packed = stage(archives.join(packed, "archive", "left_semi"), "packed")
    # One archive is a lot of reading behind a short row.
    spread_out = packed.repartitionByRange(max(1, packed.count()), "archive")
    return spread_out.mapInPandas(_unpack(root), "archive string, member string, size long, payload binary")


def _payload(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = SegmentReader(root)
        rows = (
            (r.archive, r.member, r.bytes, reader.read(r.segments))
            for batch in batches
            for r in batch.rename(columns={"size": "bytes"}).itertuples(index=False)
        )
        yield from batches_of(rows, MEMBER_BYTES)

    return run


def scan_tar_members(archives: DataFrame, root: str = "", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Archive, member, size and bytes of every regular member."""
    archives = stage(archives, "archives")
    index = stage(index_members(archives, root, range_bytes), "index")
    files = spread(index.filter("state = 'file'"), "size", "archive", "offset")
    schema = "archive string, member string, size long, payload binary"
    read = files.select("archive", "member", "size", "segments").mapInPandas(_payload(root), schema)
    return read.unionByName(scan_compressed(archives, index, root))


def archive_manifest(index: DataFrame) -> DataFrame:
    """Members as manifest rows: path as if unpacked next to the archive, size, location.

    Of members with one path the last to be unpacked counts: split archives
    come before whole ones, each sorted by name, and members in order.
    """
    member = F.struct("whole", "archive", "offset", "size", "segments")
    last = index.filter("state = 'file'").groupBy(F.expr(canonical_path("path")).alias("path"))
    return last.agg(F.max(member).alias("m")).select("path", "m.size", "m.segments")
