"""Session settings, shared scratch space and staged tables."""

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, read from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="pairloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_staged: list[str] = []  # folders that stage() has written, in order


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Staged tables that are made inside are deleted at the end, also after an error.

    Write what is to last before; frames that were made inside can no longer be read.
    """
    before = len(_staged)
    try:
        yield
    finally:
        gone = _staged[before:]
        del _staged[before:]
        for folder in gone:
            _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result is needed twice. The table survives the loss of
    executors, is read with column pruning and has known size, none of which
    holds for cached or checkpointed rows.
    """
    path = new_folder(df.sparkSession, label)
    _staged.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Shuffle files go when the statement ends that made them, in place of when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_alone(df: DataFrame, label: str) -> DataFrame:
    """``stage`` for large shuffles that nothing else reads: they leave the executors' disks once the table is written."""
    with cleanup(df.sparkSession):
        return stage(df, label)


@contextmanager
def staged_halves(df: DataFrame, label: str, test: Column) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Rows where ``test`` holds and the others, staged in one pass; the others are deleted at the end."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    _staged.append(path)
    with cleanup(spark):
        marked = df.withColumn("kept", F.coalesce(test, F.lit(False)))
        marked.write.partitionBy("kept").parquet(path)
    read = spark.read.schema(marked.schema).parquet(path)
    try:
        yield read.where("kept").drop("kept"), read.where("NOT kept").drop("kept")
    finally:
        _delete(spark, f"{path}/kept=false")


@contextmanager
def cleanup(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def spread(df: DataFrame, size: str, *keys: str, bytes_per_task: int = 256 << 20) -> DataFrame:
    """Repartition rows that stand for ``size`` bytes each, for tasks that read them.

    Spark sizes tasks by the rows it shuffles, which are tiny beside the data
    they point to. Neighbours by ``keys`` stay together, as they share files.
    Stage ``df`` first: its bytes are added up in a job of its own.
    """
    total = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // bytes_per_task))
    return df.repartitionByRange(tasks, *keys)


# Texts are long: batches for Python workers are bounded by their bytes, on both sides, unless the session says otherwise.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever the driver runs, and their batches small."""
    context = spark.sparkContext
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(*BATCH_BYTES)
    if any("pairloom-src" in name for name in context._python_includes):
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="pairloom-src-")) / f"pairloom-src-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(here.rglob("*.py")):
            archive.write(source, f"pairloom/{source.relative_to(here)}")
    context.addPyFile(str(target))
