"""Incremental slices: new pair files land once, then whole slices are gated and published."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pairloom.operators.pairs import read_rows
from pairloom.operators.shards import SAMPLES_PER_SHARD
from pairloom.operators.slices import PathSettings
from pairloom.plans.flows import run_slices
from pairloom.runtime import stage
from pairloom.sources.listing import whole_file
from pairloom.sources.pair_files import file_keys
from pairloom.streaming.snapshots import VERDICTS, Snapshots, exists


def ingest_slices(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    layout: str,
    manifest: Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    columns: tuple[str | None, str | None, str | None] = ("input_images", "output_images", "prompt"),
    settings: PathSettings = PathSettings(),
    samples_per_shard: int = SAMPLES_PER_SHARD,
    min_rate: float = 1.0,
    files_per_batch: int = 1000,
    root: str = "",
) -> StreamingQuery:
    """Land all pair files in ``folder`` that no earlier run has finished, then publish their slices.

    The stream only lands rows, so ``files_per_batch`` sets its pace and nothing
    else. Verdict and numbers of a slice come from all its parts, landed now or
    before, as in ``run_slices``. A batch that is repeated replaces what it
    landed; slices that were landed but not published are published by the next run.
    Returns the finished query.
    """
    source = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(folder)
    )
    rows = read_rows(source, layout, *columns, file_keys())

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    query = rows.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    publish(spark, out, layout, manifest, settings, samples_per_shard, min_rate, root)
    return query


def publish(
    spark: SparkSession,
    out: str,
    layout: str,
    manifest: Callable[[], DataFrame],
    settings: PathSettings,
    samples_per_shard: int,
    min_rate: float,
    root: str,
) -> None:
    """Gate and build all slices with rows that landed since the last publication.

    The new publication holds these slices only; it counts as a whole or not at all.
    """
    if not exists(f"{out}/rows"):
        return
    log = Snapshots(spark, out)
    landed = spark.read.parquet(f"{out}/rows")
    batches, earlier = landed.select("batch").distinct(), log.history("batches")
    if earlier is not None:
        batches = batches.join(earlier, "batch", "left_anti")
    batches = stage(batches, "batches")
    if batches.isEmpty():
        return
    files = stage(landed.join(F.broadcast(batches), "batch", "left_semi").select("file").distinct(), "files")
    rows = landed.drop("batch").join(files, "file", "left_semi")
    found = manifest()
    if "segments" not in found.columns:  # of a SavedIndex they must be part
        found = found.selectExpr("*", f"{whole_file('path')} AS segments")
    ran = run_slices(rows, files.withColumn("layout", F.lit(layout)), found, settings, root, samples_per_shard=samples_per_shard, min_rate=min_rate)
    log.publish({"samples": ran.samples, VERDICTS: ran.verdicts, "batches": batches})


def published(spark: SparkSession, out: str, table: str) -> DataFrame | None:
    """``samples`` or ``verdicts`` of all slices, as last published; None before the first publication."""
    return Snapshots(spark, out).read(table)
