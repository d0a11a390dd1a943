"""Tar shards as a Spark data source writer."""

import io
import json
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from pairloom.runtime import new_folder
from pairloom.sources.files import SegmentReader, open_fs
from pairloom.sources.images import MAX_SIDE, to_jpeg
from pairloom.sources.listing import list_tree

# Members of a sample, in the order they are written.
IMAGES = (("input", "jpg"), ("output", "jpg2"))
TEXT_SUFFIX = "txt"
JPEG_QUALITY = 95


REPORT = "shard_name string, samples long, state string"
WRITTEN, LEFT_ALONE = "written", "skipped"


@dataclass
class Written(WriterCommitMessage):
    shards: list[tuple[str, int, str]]


class TarShardWriter(DataSourceWriter):
    """Writes one tar per shard; rows arrive grouped by shard and in index order.

    A shard is written under a temporary name and then renamed, and one that
    exists is left alone unless ``overwrite`` is set. The same rows give the
    same bytes, so it does not matter which attempt of a task wrote a shard. Before
    the renaming a hidden mark of the job is left beside it, by which a later attempt
    knows the job's own shards; the marks go when the job ends.
    What every task did goes into the file ``report``, one line a shard.
    """

    def __init__(self, options: dict) -> None:
        self.out = options["path"].rstrip("/")
        self.root = options.get("root", "")
        self.overwrite = options.get("overwrite", "false") == "true"
        self.reencode = options.get("reencode", "false") == "true"
        self.quality = int(options.get("quality", JPEG_QUALITY))
        self.max_side = int(options.get("maxside", MAX_SIDE))
        self.report = options.get("report", "")
        self.job = uuid.uuid4().hex

    def write(self, rows: Iterator[Row]) -> Written:
        reader, shards = SegmentReader(self.root), []
        for name, samples in groupby(rows, lambda r: r.shard_name):
            files, path = open_fs(f"{self.out}/{name}")
            folder, _, base = path.rpartition("/")
            mark = f"{folder}/.{base}.{self.job}.done"
            if not self.overwrite and files.get_file_info(path).type == fs.FileType.File:
                own = files.get_file_info(mark).type == fs.FileType.File
                shards.append((name, sum(1 for _ in samples), WRITTEN if own else LEFT_ALONE))
                continue
            files.create_dir(folder, recursive=True)
            part, count = f"{folder}/.{base}.{self.job}.{uuid.uuid4().hex}", 0
            with files.open_output_stream(part) as sink, tarfile.open(fileobj=sink, mode="w|") as tar:
                for sample in samples:
                    self._add(tar, sample, reader)
                    count += 1
            with files.open_output_stream(mark):
                pass
            files.move(part, path)
            shards.append((name, count, WRITTEN))
        return Written(shards)

    def _add(self, tar: tarfile.TarFile, sample: Row, reader: SegmentReader) -> None:
        members = []
        for side, suffix in IMAGES:
            data = reader.read(sample[f"{side}_segments"])
            if not data:
                raise OSError(f"{sample.key}: the {side} image can no longer be read")
            if self.reencode:
                data = to_jpeg(data, self.quality, self.max_side)
            members.append((suffix, data))
        members.append((TEXT_SUFFIX, (sample.prompt + "\n").encode()))
        for suffix, data in members:
            info = tarfile.TarInfo(f"{sample.key}.{suffix}")
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))

    def commit(self, messages) -> None:
        if self.report:
            files, path = open_fs(self.report)
            files.create_dir(path.rpartition("/")[0], recursive=True)
            with files.open_output_stream(path) as out:
                for message in messages:
                    for shard in message.shards if message else ():
                        out.write((json.dumps(dict(zip(("shard_name", "samples", "state"), shard))) + "\n").encode())
        self._remove_parts()

    def abort(self, messages) -> None:
        self._remove_parts()

    def _remove_parts(self) -> None:
        """Remove marks of this job and what its failed attempts have left, under its own temporary names."""
        files, path = open_fs(self.out)
        found = files.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        for info in found:
            if info.base_name.startswith(".") and f".{self.job}." in info.base_name:
                files.delete_file(info.path)


class TarShards(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def writer(self, schema, overwrite: bool) -> TarShardWriter:
        return TarShardWriter(dict(self.options))


def list_shards(spark: SparkSession, out: str) -> DataFrame:
    """Names of the finished shards below ``out``."""
    hidden = F.substring_index("path", "/", -1).startswith(".")
    shards = list_tree(spark, out).filter(F.col("path").endswith(".tar") & ~hidden)
    return shards.select(F.col("path").alias("shard_name"), "size")


def write_shards(
    samples: DataFrame, out: str, shards: int, shards_per_task: int = 4, root: str = "", **options
) -> DataFrame:
    """Write every sample into the tar of its shard; returns what was written and what left alone, by shard.

    Only keys, prompts and byte locations are shuffled; image bytes go straight
    from where they lie into the tar. The number of tasks follows the number of
    shards, because the rows are far smaller than the data behind them.
    """
    spark = samples.sparkSession
    spark.dataSource.register(TarShards)
    report = f"{new_folder(spark, 'report')}/shards.json"
    tasks = max(1, -(-shards // shards_per_task))
    (
        samples.select(
            "shard_name", "pair_index", "key", "prompt", "input_segments", "output_segments"
        )
        .repartition(tasks, "shard_name")
        .sortWithinPartitions("shard_name", "pair_index")
        .write.format("tar_shards")
        .options(root=root, report=report, **options)
        .mode("append")
        .save(out)
    )
    return spark.read.schema(REPORT).json(report)

