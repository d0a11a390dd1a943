"""Inputs derived from the given tables, for the registered queries.

Every table is used whole: each document becomes one row of a pair file and
two files, each conversation one multi-turn row, each page one plain-path row.
Missing files are listed under an unfinished download's name.
"""

import io
import math
import struct
import tarfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.pairs import read_rows
from pairloom.operators.slices import PathSettings
from pairloom.plans import flows
from pairloom.runtime import new_folder
from pairloom.sources.files import join_path, open_fs
from pairloom.sources.listing import whole_file
from pairloom.sources.tar_sink import list_shards

SETTINGS = PathSettings(subdirs={"*": "Singleturn/part1"})

FILE = """concat(CASE lang WHEN 'en' THEN 'add_part' WHEN 'fr' THEN 'hybrid_part' WHEN 'de' THEN 'remove_part'
 ELSE 'reference_replace_part' END, substring(source, 4), '.parquet')"""
FOLDER = """CASE doc_id % 5 WHEN 0 THEN 'results_compose_part2/' WHEN 1 THEN 'Singleturn/results_add/'
 WHEN 2 THEN './results_remove//' WHEN 3 THEN 'results_gone/' ELSE '' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    def path(tail: str, bare: str) -> str:
        tail = f"CASE WHEN doc_id % 5 = 4 THEN '{bare}' ELSE '{tail}' END"
        return f"concat({FOLDER}, 'd', CAST(doc_id AS STRING), {tail}, '.png')"

    return table(spark, sf_dir, "documents").selectExpr(
        f"{FILE} AS file",
        "'' AS part",
        "doc_id AS row_index",
        f"{path('/original', '')} AS in_path",
        f"{path('/edited', '_e')} AS out_path",
        "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END AS prompt",
        "n_chars",
    )


def list_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List layout, with every accepted and rejected shape."""
    return pairs_base(spark, sf_dir).selectExpr(
        "file",
        "part",
        "row_index",
        """CASE WHEN file LIKE 'reference_replace%' THEN array(array(in_path), array('ref.png'))
           WHEN row_index % 11 = 0 THEN array(array(in_path), array('x.png'))
           WHEN row_index % 11 = 1 THEN NULL
           WHEN row_index % 11 = 2 THEN array(array(concat('  ', in_path, ' ')))
           WHEN row_index % 11 = 3 THEN array(array(in_path, CAST(NULL AS STRING)))
           ELSE array(array(in_path)) END AS input_images""",
        "array(array(out_path)) AS output_images",
        "prompt",
    )


def turn_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-turn layout: one row per conversation."""
    name = "concat('c', CAST(conv_id AS STRING), '_', CAST(turn AS STRING)"
    turns = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id",
        f"""struct(turn,
            CASE WHEN turn % 4 = 3 THEN array() ELSE array(array({name}, '.png'))) END AS input_images,
            CASE WHEN role = 'system' THEN array() ELSE array(array({name}, '_e.png'))) END AS output_images,
            text AS prompt) AS t""",
    )
    data = F.expr("transform(sort_array(collect_list(t)), x -> struct(x.input_images, x.output_images, x.prompt))")
    return (
        turns.groupBy("conv_id")
        .agg(data.alias("data"))
        .selectExpr("'content_memory_part2.parquet' AS file", "'' AS part", "conv_id AS row_index", "data")
    )


def column_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain layout: a scalar input and a list output per page."""
    site = "regexp_replace(url, '^https?://', '')"
    return table(spark, sf_dir, "pages").selectExpr(
        "'pages_part0.parquet' AS file",
        "'' AS part",
        "page_id AS row_index",
        f"CASE WHEN url LIKE '%#top' THEN '  ' ELSE concat(' ', {site}, '\\t') END AS original_path",
        f"""CASE WHEN url LIKE 'http:%' THEN array({site}, 'second.png')
            ELSE array(concat({site}, '_e'), '') END AS edited_path""",
        "html AS caption",
    )


def list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_rows(list_table(spark, sf_dir), "lists")


def turn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_rows(turn_table(spark, sf_dir), "multiturn")


def column_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_rows(column_table(spark, sf_dir), "path", "original_path", "edited_path", "caption")


def all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        list_rows(spark, sf_dir).unionByName(turn_rows(spark, sf_dir)).unionByName(column_rows(spark, sf_dir))
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files on disk: path, size, and the image each of them holds."""
    return (
        pairs_base(spark, sf_dir)
        .selectExpr("row_index AS id", "n_chars", "explode(array('original.png', 'edited.png')) AS f")
        .selectExpr(
            """concat(CASE id % 5
                WHEN 0 THEN concat('Singleturn/results_hybrid_part2/d', id, '/', f)
                WHEN 1 THEN concat('Singleturn/results_add/d', id, '/', CASE WHEN id % 4 = 0 THEN upper(f) ELSE f END)
                WHEN 2 THEN concat('Singleturn/results_remove/d', id, '/', f)
                WHEN 3 THEN concat('Singleturn/results_moved/d', id, '/', f)
                ELSE concat('Singleturn/part1/d', id, CASE WHEN f = 'edited.png' THEN '_e' ELSE '' END, '.png') END,
               CASE WHEN id % 7 = 0 THEN '.part' ELSE '' END) AS path""",
            "CAST(CASE WHEN id % 17 = 0 THEN 0 ELSE 100 + id END AS BIGINT) AS size",
            "id % 19 <> 0 OR f = 'edited.png' AS valid",
            "CAST(n_chars AS INT) AS width",
            "CAST(1 + id % 61 AS INT) AS height",
        )
    )


def files_on_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir).select("path", "size")


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return files_on_disk(spark, sf_dir).unionByName(
        pages.selectExpr("concat('pages/', regexp_replace(url, '^https?://', '')) AS path", "length(html) AS size")
    )


def split_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as split archives, their lines as parts; returned lines are unfinished downloads."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        """concat('Singleturn/results_s', l_suppkey, '/a', l_orderkey, '.tar.split.',
            CASE WHEN l_linestatus = 'O' THEN '00' ELSE '' END, l_linenumber,
            CASE WHEN l_returnflag = 'R' THEN '.part' ELSE '' END) AS path""",
        "CAST(l_quantity AS BIGINT) AS size",
    )


def order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive a customer, an order a part; some parts are listed but never come."""
    return table(spark, sf_dir, "orders").selectExpr(
        """concat('Singleturn/results_c', o_custkey % 7, '/c', o_custkey, '.tar.split.',
            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) AS path""",
        "CAST(1 + o_orderkey % 1000 AS BIGINT) AS size",
        "o_orderkey % 97 = 5 AS lost",
    )


def column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per document whose columns depend on it; covers all layouts."""
    names = """CASE doc_id % 9
        WHEN 0 THEN array('data', 'prompt', 'input_images')
        WHEN 1 THEN array('input_images', 'output_images', 'Caption', 'prompt')
        WHEN 2 THEN array('Input_Images', 'Output_Images', 'TEXT')
        WHEN 3 THEN array('source_img', 'edited_img', 'instruction')
        WHEN 4 THEN array('original', 'source_path', 'Result_Path', 'edited')
        WHEN 5 THEN array('original_img', 'target_path')
        WHEN 6 THEN array('input_path', 'output_img', 'edit_instruction', 'text')
        WHEN 7 THEN array('id', source, lang)
        ELSE array('edited_path', 'ORIGINAL_PATH', 'original_path') END"""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('f', doc_id, '.parquet') AS file", f"posexplode({names}) AS (position, column_name)"
    )


def shard_members(samples: DataFrame) -> DataFrame:
    """Members of the shards of ``samples``; some samples are damaged."""
    return samples.selectExpr(
        "shard_name",
        """explode(array(
            concat(key, CASE WHEN row_index % 29 = 0 THEN '.jpeg' ELSE '.jpg' END),
            concat(key, '.jpg2'), concat(key, '.txt'),
            concat(key, CASE WHEN row_index % 31 = 0 THEN '.x.txt' ELSE '.json' END),
            replace(key, '_', ''))) AS member""",
    )


# The standard code of brightness levels, by code length and in order of the codes.
LEVEL_COUNTS = bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0])
LEVEL_SIZES = bytes(range(12))


def gray_jpeg(width: int, height: int, levels: bytes, interval: int = 0) -> bytes:
    """A gray JPEG whose blocks of 8 x 8 pixels are even, with the brightness that ``levels`` says by turns."""
    codes, code, at = {}, 0, 0
    for length, count in enumerate(LEVEL_COUNTS, 1):
        for _ in range(count):
            codes[LEVEL_SIZES[at]] = (code, length)
            code, at = code + 1, at + 1
        code <<= 1
    words, lengths = np.zeros(12, np.int64), np.zeros(12, np.int64)
    for size, (word, n) in codes.items():
        words[size], lengths[size] = word, n
    blocks = -(-width // 8) * -(-height // 8)
    level = np.resize(np.frombuffer(levels, np.uint8), blocks).astype(np.int64) - 128 if levels else np.zeros(blocks, np.int64)
    scan = bytearray()
    for first in range(0, blocks, interval or blocks):
        step = np.diff(level[first : first + (interval or blocks)], prepend=0)
        size = np.ceil(np.log2(np.abs(step) + 1)).astype(np.int64)  # bits of the difference
        low = np.where(step > 0, step, step + (1 << size) - 1)
        word, n = ((words[size] << size | low) << 1), lengths[size] + size + 1  # one bit ends the block
        end = np.cumsum(n)
        bit = np.arange(int(end[-1]))
        of = np.repeat(np.arange(len(n)), n)
        data = np.packbits(word[of] >> (end[of] - 1 - bit) & 1)
        if pad := -int(end[-1]) % 8:
            data[-1] |= (1 << pad) - 1
        data = data.tobytes().replace(b"\xff", b"\xff\0")
        scan += data if not first else bytes([0xFF, 0xD0 + (first // interval - 1) % 8]) + data

    def segment(marker: int, body: bytes) -> bytes:
        return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body

    head = segment(0xDB, b"\0" + b"\x08" * 64) + segment(0xC0, struct.pack(">BHHB", 8, height, width, 1) + b"\x01\x11\0")
    head += segment(0xC4, b"\0" + LEVEL_COUNTS + LEVEL_SIZES) + segment(0xC4, b"\x10" + bytes([1] + [0] * 15) + b"\0")
    head += segment(0xDD, struct.pack(">H", interval)) if interval else b""
    return b"\xff\xd8" + head + segment(0xDA, b"\x01\x01\0\0\x3f\0") + bytes(scan) + b"\xff\xd9"


def _write_images(root: str):
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    def png(width: int, height: int) -> bytes:
        head = struct.pack(">IIBBBBB", width, height, 1, 0, 0, 0, 0)
        rows = zlib.compress(bytes((1 + (width + 7) // 8) * height), 1)
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", rows) + chunk(b"IEND", b"")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = open_fs(root)
        made = set()
        for batch in batches:
            for row in batch.itertuples(index=False):
                data = b"" if row.size == 0 else png(row.width, row.height)
                path = join_path(base, row.path)
                folder = path.rpartition("/")[0]
                if folder not in made:
                    files.create_dir(folder, recursive=True)
                    made.add(folder)
                with files.open_output_stream(path) as f:
                    f.write(data if row.valid else data[: len(data) // 2])
            yield pd.DataFrame({"written": [len(batch)]})

    return run


_made: dict[tuple, str] = {}


def once(spark: SparkSession, sf_dir: str, label: str, make) -> str:
    """Folder that ``make`` fills, made once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _made:
        folder = new_folder(spark, label).removeprefix("file:")
        make(folder)
        _made[key] = folder
    return _made[key]


def image_tree(spark: SparkSession, sf_dir: str) -> str:
    """Folder with all files of ``manifest`` as PNGs; some empty, some cut short."""

    def make(folder: str) -> None:
        folder_key = F.regexp_extract("path", "/(d[0-9]+)", 1)  # a folder's files are one task's
        work = manifest(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism, folder_key)
        work.mapInPandas(_write_images(folder), "written long").agg(F.sum("written")).collect()

    return once(spark, sf_dir, "images", make)


def _pack_texts(root: str):
    def picture(doc_id: int, text: str | None) -> bytes:
        levels = (text or "").encode()
        across = max(1, math.ceil(math.sqrt(len(levels))))
        data = gray_jpeg(8 * across, 8 * max(1, -(-len(levels) // across)), levels, 40 if doc_id % 5 == 0 else 0)
        if doc_id % 7 == 0:  # the end is missing
            return data[: -(len(data) // 3)]
        if doc_id % 11 == 0:  # the end marker is there, half the scan is not
            scan = data.index(b"\xff\xda") + 10
            return data[: (scan + len(data) - 2) // 2] + data[-2:]
        return data

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = open_fs(root)
        for batch in batches:
            if not len(batch):
                continue
            path = f"{base}/pictures-{batch.doc_id.iloc[0]}.tar"  # a repeated task makes the same file again
            with files.open_output_stream(f"{path}.tmp") as out, tarfile.open(fileobj=out, mode="w|") as tar:
                for doc_id, text in zip(batch.doc_id, batch.text):
                    data = picture(doc_id, text)
                    info = tarfile.TarInfo(f"{doc_id}.jpg")
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
            files.move(f"{path}.tmp", path)
            yield pd.DataFrame({"written": [len(batch)]})

    return run


def picture_archives(spark: SparkSession, sf_dir: str) -> str:
    """Folder of tars with a JPEG a document, whose blocks are as bright as the bytes of its text; some are damaged."""

    def make(folder: str) -> None:
        open_fs(folder)[0].create_dir(open_fs(folder)[1], recursive=True)
        work = table(spark, sf_dir, "documents").select("doc_id", "text").repartition(spark.sparkContext.defaultParallelism, "doc_id").sortWithinPartitions("doc_id")
        work.mapInPandas(_pack_texts(folder), "written long").agg(F.sum("written")).collect()

    return once(spark, sf_dir, "pictures", make)


SAMPLES_PER_SHARD = 100
PART_BYTES = 50_000


def written_shards(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the shards of all list rows over ``image_tree``."""

    def make(out: str) -> None:
        flows.build(
            list_rows(spark, sf_dir),
            located_manifest(files_on_disk(spark, sf_dir)),
            out,
            SETTINGS,
            root=image_tree(spark, sf_dir),
            samples_per_shard=SAMPLES_PER_SHARD,
        )

    return once(spark, sf_dir, "shards", make)


def _split(source: str, target: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch.shard_name:
                files, path = open_fs(join_path(source, name))
                with files.open_input_stream(path) as f:
                    n = 0
                    while data := f.read(PART_BYTES):
                        out_fs, out = open_fs(join_path(target, f"Singleturn/{name}.split.{n:03d}"))
                        out_fs.create_dir(out.rpartition("/")[0], recursive=True)
                        with out_fs.open_output_stream(out) as part:
                            part.write(data)
                        n += 1
            yield pd.DataFrame({"done": [len(batch)]})

    return run


def split_shards(spark: SparkSession, sf_dir: str) -> str:
    """The written shards, each cut into numbered parts."""
    source = written_shards(spark, sf_dir)

    def make(folder: str) -> None:
        names = list_shards(spark, source).select("shard_name")
        names.mapInPandas(_split(source, folder), "done long").agg(F.sum("done")).collect()

    return once(spark, sf_dir, "splits", make)


def located_manifest(listing: DataFrame) -> DataFrame:
    return listing.selectExpr("*", f"{whole_file('path')} AS segments")


def pair_file_tree(spark: SparkSession, sf_dir: str) -> str:
    """Dataset root with the list rows as one pair-file folder per slice."""

    def make(folder: str) -> None:
        df = list_table(spark, sf_dir).drop("part")
        # Rows are ordered inside and across the part files of each slice.
        df = df.repartitionByRange(8, "file", "row_index").sortWithinPartitions("file", "row_index")
        df.write.partitionBy("file").parquet(f"{folder}/Parquet")

    return once(spark, sf_dir, "pairs", make)
