"""The resolver's index of a manifest, kept between runs as bucketed tables.

Building the index shuffles the manifest. Kept in buckets by lookup key, and the files by path, it is
joined where it lies: audits, builds and later publications shuffle their references only.
"""

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pairloom.operators.resolve import PAIR_DIR, file_index
from pairloom.sources.files import open_fs

ROWS_PER_BUCKET = 1 << 20
ENTRIES, FILES = "entries", "files"
KEYS = {ENTRIES: ("kind", "key"), FILES: ("path",)}


@dataclass
class SavedIndex:
    """An index that takes a manifest's place in ``resolve_paths`` and the flows.

    ``entries`` is what ``file_index`` gives, ``files`` the manifest. It holds what the manifest held
    when it was saved, for one ``pair_dir``; save anew, into another folder, when files have come or gone.
    """

    entries: DataFrame
    files: DataFrame
    pair_dir: str

    @property
    def columns(self) -> list[str]:
        return self.files.columns

    @property
    def sparkSession(self) -> SparkSession:
        return self.files.sparkSession


def save_index(manifest: DataFrame, folder: str, pair_dir: str = PAIR_DIR, buckets: int = 0) -> SavedIndex:
    """Write the index of ``manifest`` (path and more) to ``folder``, which must not exist, and open it.

    Buckets hold about ``ROWS_PER_BUCKET`` files each unless their number is given.
    """
    spark = manifest.sparkSession
    buckets = buckets or max(1, -(-manifest.count() // ROWS_PER_BUCKET))
    told = {"buckets": buckets, "pair_dir": pair_dir, "tables": {}}
    for name, rows in ((FILES, manifest), (ENTRIES, file_index(manifest, pair_dir))):
        keys = KEYS[name]
        table = _table(folder, name)
        writer = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        writer.option("path", f"{folder}/{name}").saveAsTable(table)
        told["tables"][name] = rows.schema.json()
    files, inner = open_fs(f"{folder}/index.json")
    with files.open_output_stream(inner) as f:
        f.write(json.dumps(told).encode())
    return open_index(spark, folder)


def open_index(spark: SparkSession, folder: str) -> SavedIndex:
    """The index that an earlier run, perhaps with another catalog, has saved in ``folder``."""
    files, inner = open_fs(f"{folder}/index.json")
    with files.open_input_stream(inner) as f:
        told = json.loads(f.read())
    opened = {}
    for name, schema in told["tables"].items():
        table, keys = _table(folder, name), ", ".join(f"`{k}`" for k in KEYS[name])
        if not spark.catalog.tableExists(table):
            columns = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in StructType.fromJson(json.loads(schema)))
            where = f"{folder}/{name}".replace("'", "\\'")
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {told['buckets']} BUCKETS LOCATION '{where}'")
        opened[name] = spark.table(table)
    return SavedIndex(opened[ENTRIES], opened[FILES], told["pair_dir"])


def _table(folder: str, name: str) -> str:
    return f"pairloom_{name}_{hashlib.sha256(folder.rstrip('/').encode()).hexdigest()[:16]}"
