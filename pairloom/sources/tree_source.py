"""A directory tree as a Spark data source: folders are planned as partitions, and only those that the filters ask for are opened."""

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, StringStartsWith

from pairloom.sources.files import join_path, open_fs

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
ROWS = 10_000
TASKS = 256  # beyond that folders share tasks, and none is opened to find more


@dataclass
class Folders(InputPartition):
    """What a task lists: folders, each with all below it or only the files in it."""

    folders: list[tuple[str, bool]]


class TreeReader(DataSourceReader):
    """Plans folders as partitions, up to ``levels`` below the folder that the filters lead to; of more than ``TASKS``, each has several."""

    def __init__(self, options: dict) -> None:
        self.root = options["path"]
        self.levels = int(options.get("levels", 1))
        self.prefixes: list[str] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, StringStartsWith | EqualTo) and f.attribute == ("path",) and f.value is not None:
                self.prefixes.append(f.value)
        return filters  # Spark tests the names in a folder itself

    def _wanted(self, folder: str) -> bool:
        """Whether a path below ``folder`` can have every prefix."""
        return all(f"{folder}/".startswith(p) or p.startswith(f"{folder}/") for p in self.prefixes)

    def _list(self, folder: str, recursive: bool = False) -> list[tuple[str, int, bool]]:
        files, base = open_fs(self.root)
        base = base.rstrip("/")
        found = files.get_file_info(fs.FileSelector(join_path(base, folder), allow_not_found=True, recursive=recursive))
        return [(i.path[len(base) + 1 :], i.size or 0, i.type == fs.FileType.Directory) for i in found]

    def partitions(self) -> Sequence[InputPartition]:
        start = max((p.rpartition("/")[0] for p in self.prefixes), key=len, default="")
        if start and not self._wanted(start):  # the prefixes exclude each other
            return []
        planned, open_ = [], [start]
        for _ in range(self.levels):
            if len(open_) > TASKS:  # enough for all tasks; they go deeper themselves
                break
            inner = [path for folder in open_ for path, _, is_dir in self._list(folder) if is_dir and self._wanted(path)]
            planned += [(f, False) for f in open_]
            open_ = inner
        planned += [(f, True) for f in open_]
        return [Folders(planned[i::TASKS]) for i in range(min(TASKS, len(planned)))]

    def _files(self, folders: list[tuple[str, bool]]) -> Iterator[tuple[str, int]]:
        for folder, recursive in folders:
            yield from ((path, size) for path, size, is_dir in self._list(folder, recursive) if not is_dir)

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        rows = self._files(partition.folders)
        while some := list(islice(rows, ROWS)):
            paths, sizes = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "size"])


class TreeFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tree_files"

    def schema(self) -> str:
        return "path string, size long"

    def reader(self, schema) -> TreeReader:
        return TreeReader(dict(self.options))


def tree_files(spark: SparkSession, root: str, under: Sequence[str] = (), levels: int = 1) -> DataFrame:
    """(path, size) of all files below ``root``, or of those whose paths begin with one of ``under``.

    Filters on ``path`` (equality, or a beginning) keep other folders shut, too. ``levels`` folders deep the tree is listed where
    the plan is made, until there are folders for ``TASKS`` tasks; those found there are dealt to the tasks.
    """
    spark.dataSource.register(TreeFiles)
    spark.conf.set(PUSHDOWN, "true")

    def tree() -> DataFrame:  # each a source of its own, as filters are pushed into its reader
        return spark.read.format("tree_files").option("levels", levels).load(root)

    tops = sorted(u for u in set(under) if not any(u != v and u.startswith(v) for v in under))
    parts = [tree().filter(F.col("path").startswith(u)) for u in tops]
    return reduce(DataFrame.unionByName, parts) if parts else tree()
