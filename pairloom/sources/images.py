"""Decode checks of image files and archive members, read inside the tasks."""

import io
import re
import struct
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.runtime import new_folder, stage
from pairloom.sources import jpeg
from pairloom.sources.files import SegmentReader, batches_of
from pairloom.sources.listing import list_tree

try:
    from PIL import Image
except ImportError:
    Image = None

MAX_SIDE = 2048
CHECKED = "path string, valid boolean, width int, height int, checked_by string"


def _png(data: bytes) -> tuple[int, int] | None:
    """Size of a PNG whose chunks are intact and whose pixels all unpack."""
    at, size, unpack, pixels = 8, None, zlib.decompressobj(), 0
    while at + 12 <= len(data):
        (length,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + length]
        at += 12 + length
        if at > len(data) or zlib.crc32(kind + body) != struct.unpack_from(">I", data, at - 4)[0]:
            return None
        if kind == b"IHDR":
            w, h, depth, color, _, _, interlace = struct.unpack(">IIBBBBB", body)
            bits = depth * {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
            size, need = (w, h), (1 + (w * bits + 7) // 8) * h
        elif kind == b"IDAT":
            pixels += len(unpack.decompress(body))
        elif kind == b"IEND":
            whole = unpack.eof and (interlace or pixels >= need)
            return size if whole and w and h else None
    return None


UNCHECKED = "unchecked"
_OTHER_FORMATS = (b"BM", b"GIF8", b"RIFF", b"II*\0", b"MM\0*")


def image_size(data: bytes) -> tuple[tuple[int, int] | None, str]:
    """Size of a valid image, else None, and how it was checked.

    Without Pillow PNGs are fully unpacked, and the scans of JPEGs walked to
    their last block. Arithmetic, lossless and hierarchical JPEGs, and other
    formats, come back as ``unchecked``: they may decode or not.
    """
    try:
        if Image is not None:
            with Image.open(io.BytesIO(data)) as im:
                im.convert("RGB")
                return im.size, "pillow"
        if data.startswith(b"\x89PNG\r\n\x1a\n"):
            return _png(data), "png"
        if data.startswith(b"\xff\xd8"):
            try:
                return jpeg.walk(data), "jpeg"
            except jpeg.Broken:
                return None, "jpeg"
            except jpeg.NotWalked:
                return None, UNCHECKED
        if data.startswith(_OTHER_FORMATS):
            return None, UNCHECKED
    except Exception:
        return None, "failed"
    return None, "unsupported"


def _check(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = SegmentReader(root)
        for batch in batches:
            rows = []
            for path, segments in zip(batch.path, batch.segments):
                data = reader.read(segments)
                size, how = image_size(data) if data else (None, "missing")
                width, height = size or (None, None)
                rows.append((path, None if how == UNCHECKED else size is not None, width, height, how))
            out = pd.DataFrame(rows, columns=["path", "valid", "width", "height", "checked_by"])
            yield out.astype({"valid": "boolean", "width": "Int32", "height": "Int32"})

    return run


def image_validity(located: DataFrame, root: str = "") -> DataFrame:
    """Does the image at each (path, segments) decode, and how large is it?

    Bytes are read and dropped inside the task; only the verdict leaves it.
    ``valid`` is null where nobody could decode the format; ``decode_unchecked``
    settles plain files among these.
    """
    return located.select("path", "segments").mapInPandas(_check(root), CHECKED)


def _read(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = SegmentReader(root)
        rows = ((p, reader.read(s) or None) for batch in batches for p, s in zip(batch.path, batch.segments))
        yield from batches_of(rows, ["path", "content"])

    return run


def scan_image_bytes(located: DataFrame, root: str = "") -> DataFrame:
    """Bytes of each (path, segments); null where a file is missing, unreadable or empty."""
    return located.select("path", "segments").mapInPandas(_read(root), "path string, content binary")


# Files that are read as images where a folder also holds archives and tables.
IMAGE_NAMES = "*.{jpg,JPG,jpeg,JPEG,bmp,BMP,gif,GIF,webp,WEBP,tif,TIF,tiff,TIFF}"


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTED = "spark.sql.hive.filesourcePartitionFileCacheSize"


@contextmanager
def _listing_tasks(spark: SparkSession):
    """Folders that are listed in a job share four tasks a core, unless the session wants fewer; Spark keeps no listing for later."""
    before, kept = int(spark.conf.get(LISTING)), spark.conf.get(LISTED)
    spark.conf.set(LISTING, str(min(before, 4 * spark.sparkContext.defaultParallelism)))
    spark.conf.set(LISTED, "0")
    try:
        yield
    finally:
        spark.conf.set(LISTING, str(before))
        spark.conf.set(LISTED, kept)


FILES_AT_ONCE = 32_768  # Spark's listing of so many is on the driver at a time, with a few KB for each

# Fixed value: what Spark's own file sources leave out, in any folder or name.
_HIDDEN = "_(?!metadata|common_metadata)[^/=]*|[.][^/]*|(?!_metadata|_common_metadata)[^/]*[.]_COPYING_"


def _shown_files(spark: SparkSession, folder: str, names: str) -> DataFrame:
    """Paths below ``folder`` that a file source would read: files with bytes, whose names fit the glob, in no hidden folder."""
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(names).compiled().pattern()
    fits = F.substring_index("path", "/", -1).rlike(rf"(?s)\A(?:{glob})\z")
    shown = ~F.col("path").rlike(rf"(?:\A|/)(?:{_HIDDEN})(?:/|\z)")
    return list_tree(spark, folder).filter(F.col("size") > 0).filter(fits & shown).select("path")


def _decoded(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Spark's image source over single files. They cross to the JVM at once, and no name is taken for a glob."""
    split = spark.sparkContext._jvm.java.util.regex.Pattern.compile("\0").split("\0".join(paths))
    reader = spark.read.format("image").option("recursiveFileLookup", True).option("__globPaths__", False)
    return DataFrame(reader._jreader.load(split), spark)


def decode_folder(spark: SparkSession, folder: str, names: str = "*") -> DataFrame:
    """Decode check of a plain folder by Spark's own image source, all on the JVM; the verdicts are staged.

    The source hides empty files and names that start with ``_`` or ``.``. It keeps what it lists on the driver, so the tree
    is listed in tasks, and the source reads ``FILES_AT_ONCE`` files or so at a time.
    """
    files = stage(_shown_files(spark, folder, names), "shown")
    rounds = -(-files.count() // FILES_AT_ONCE)
    dealt, out = new_folder(spark, "dealt"), new_folder(spark, "decoded")
    nth = F.pmod(F.xxhash64("path"), F.lit(max(rounds, 1))).cast("int")
    files.withColumn("round", nth).repartition("round").write.partitionBy("round").parquet(dealt)
    files, tasks = spark.read.schema("path string, round int").parquet(dealt), 4 * spark.sparkContext.defaultParallelism
    for i in range(rounds):
        paths = [f"{folder.rstrip('/')}/{r.path}" for r in files.filter(F.col("round") == i).select("path").collect()]
        if paths:
            with _listing_tasks(spark):
                _verdicts(_decoded(spark, paths)).coalesce(tasks).write.mode("append").parquet(out)
    if not rounds:
        return spark.createDataFrame([], CHECKED)
    return spark.read.schema(CHECKED).parquet(out)


def _verdicts(image: DataFrame) -> DataFrame:
    path = F.url_decode(F.replace(F.col("image.origin"), F.lit("+"), F.lit("%2B")))
    ok = F.col("image.height") > 0
    return image.select(
        path.alias("path"),
        ok.alias("valid"),
        F.when(ok, F.col("image.width")).alias("width"),
        F.when(ok, F.col("image.height")).alias("height"),
        F.lit("jvm").alias("checked_by"),
    )


def decode_unchecked(spark: SparkSession, checked: DataFrame, root: str) -> DataFrame:
    """``checked`` with the verdict of Spark's own decoder for plain files that are unchecked.

    Members of archives stay unchecked; the decoder reads files only. Without
    unchecked rows the folder is not read.
    """
    open_ = checked.filter("valid IS NULL")
    if not root or open_.isEmpty():
        return checked
    at = F.regexp_replace("path", "^(file:)?/+", "/")
    base = "/" + re.sub("^(file:)?/+", "", root).rstrip("/") + "/" if "://" not in root else root.rstrip("/") + "/"
    own = decode_folder(spark, root, IMAGE_NAMES).select(at.alias("full"), F.struct("valid", "width", "height", "checked_by").alias("d"))
    own = own.filter(F.startswith("full", F.lit(base))).select(F.expr(f"substring(full, {len(base) + 1})").alias("path"), "d")
    settled = checked.join(own, "path", "left").withColumn("use", F.col("valid").isNull() & F.col("d").isNotNull())
    return settled.select("path", *[F.when(F.col("use"), F.col(f"d.{c}")).otherwise(F.col(c)).alias(c) for c in ("valid", "width", "height", "checked_by")])


def image_fit(width: str, height: str, max_side: int = MAX_SIDE) -> tuple[str, str]:
    """Size after shrinking the longest edge to ``max_side``; 0 or less switches it off.

    The short edge is the floor or ceiling that changes the aspect least, at least 1.
    Takes and gives SQL expressions.
    """
    if max_side <= 0:
        return width, height
    wide = f"{width} >= {height}"
    ideal = f"({max_side} * least({width}, {height}) / greatest({width}, {height}))"

    def off(n: str) -> str:
        landscape = f"IF({n} = 0, 0, abs({width} / {height} - try_divide({max_side}, {n})))"
        return f"IF({wide}, {landscape}, abs({width} / {height} - {n} / {max_side}))"

    low, high = f"floor({ideal})", f"ceil({ideal})"
    near = f"greatest(1, IF({off(low)} <= {off(high)}, {low}, {high}))"

    def edge(size: str, is_long: str) -> str:
        fits = f"greatest({width}, {height}) <= {max_side}"
        return f"CAST(CASE WHEN {fits} THEN {size} WHEN {is_long} THEN {max_side} ELSE {near} END AS INT)"

    return edge(width, wide), edge(height, f"NOT ({wide})")


def to_jpeg(data: bytes, quality: int, max_side: int) -> bytes:
    """Image as an RGB JPEG no larger than ``max_side``; needs Pillow."""
    if Image is None:
        raise RuntimeError("re-encoding needs Pillow on the executors")
    with Image.open(io.BytesIO(data)) as im:
        rgb = im.convert("RGB")
    if max_side > 0:
        rgb.thumbnail((max_side, max_side), Image.Resampling.LANCZOS)
    out = io.BytesIO()
    rgb.save(out, "JPEG", quality=quality)
    return out.getvalue()
