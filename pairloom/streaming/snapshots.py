"""A log of publications: tables whose slices are replaced without rewriting the others.

Every publication writes its slices into folders of its own, ``<table>/version=<v>/file=<slice>``, which never change.
Then a pointer file is renamed into ``log``; from that moment its slices count. What no
pointer names does not exist for readers, so a run that stops half-way leaves the last snapshot as it
was. One writer at a time is assumed, as a stream's checkpoint allows no more.
"""

import json
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.sources.files import open_fs

LOG, VERDICTS = "log", "verdicts"


def exists(path: str) -> bool:
    files, inner = open_fs(path)
    return files.get_file_info(inner).type == fs.FileType.Directory


@dataclass
class Snapshots:
    """Tables below ``out`` with one row or more a slice (``file``). ``VERDICTS`` has every slice and so tells the newest version of each."""

    spark: SparkSession
    out: str

    def _pointers(self) -> list[str]:
        files, inner = open_fs(f"{self.out}/{LOG}")
        found = files.get_file_info(fs.FileSelector(inner, allow_not_found=True))
        return sorted(i.base_name for i in found if i.base_name.endswith(".json") and not i.base_name.startswith("."))

    def _versions(self, table: str) -> DataFrame:
        """All rows of ``table`` that a pointer names, with their version."""
        named = self.spark.read.schema("version string").json(f"{self.out}/{LOG}")
        return self.spark.read.parquet(f"{self.out}/{table}").join(F.broadcast(named), "version", "left_semi")

    def read(self, table: str) -> DataFrame | None:
        """The table as the last publication left it; None before the first.

        Folders of versions that were replaced are pruned by the few rows that tell each slice's newest.
        """
        if not self._pointers():
            return None
        newest = self._versions(VERDICTS).groupBy("file").agg(F.max("version").alias("version"))
        rows = self.spark.read.parquet(f"{self.out}/{table}")
        return rows.join(F.broadcast(newest), ["file", "version"], "left_semi").drop("version")

    def history(self, table: str) -> DataFrame | None:
        """All rows of all publications, those that were replaced too."""
        return self._versions(table).drop("version") if self._pointers() else None

    def publish(self, tables: dict[str, DataFrame]) -> str:
        """Writes the slices of ``tables`` as a version and makes it count; returns the version."""
        number = len(self._pointers()) + 1
        version = f"v{number:09d}-{uuid.uuid4().hex}"
        for name, rows in tables.items():
            keys = ["file"] if "file" in rows.columns else []
            spread = rows.hint("rebalance", *keys) if keys else rows
            spread.write.partitionBy(*keys).parquet(f"{self.out}/{name}/version={version}")
        self._point(number, version)
        return version

    def _point(self, number: int, version: str) -> None:
        files, inner = open_fs(f"{self.out}/{LOG}")
        files.create_dir(inner, recursive=True)
        name = f"{number:09d}.json"
        if files.get_file_info(f"{inner}/{name}").type != fs.FileType.NotFound:
            raise RuntimeError(f"{self.out} has another writer: publication {number} is there already")
        part = f"{inner}/.{name}.{uuid.uuid4().hex}"
        with files.open_output_stream(part) as f:
            f.write((json.dumps({"version": version}) + "\n").encode())
        files.move(part, f"{inner}/{name}")
