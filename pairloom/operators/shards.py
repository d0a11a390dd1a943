"""Build status, dense pair numbers and shards."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairloom.functions import text_literal
from pairloom.functions.naming import sample_key, shard_name, stem_of
from pairloom.runtime import stage

# Fixed values.
SAMPLES_PER_SHARD = 1000
BATCH_ROWS = 256

# Rows of a pair file numbered together by one task.
BLOCK_ROWS = 1 << 20
ORDER = ["file", "part", "row_index", "turn_pos"]

KEPT, MISSING, BAD, UNCHECKED = "kept", "missing_file", "bad_image", "unchecked"


def build_status(pairs: DataFrame) -> DataFrame:
    """First reason, in order, that keeps a pair out: no file, no bytes, no image, no verdict on the image.

    Needs the size and validity of both sides; validity is null where a file
    is missing or nobody could decode it.
    """
    sides = ("input", "output")
    usable = " AND ".join(f"coalesce({s}_size, 0) > 0" for s in sides)
    valid = " AND ".join(f"coalesce({s}_valid, true)" for s in sides)
    judged = " AND ".join(f"{s}_valid IS NOT NULL" for s in sides)
    status = f"""CASE WHEN NOT ({usable}) THEN '{MISSING}' WHEN NOT ({valid}) THEN '{BAD}'
        WHEN NOT ({judged}) THEN '{UNCHECKED}' ELSE '{KEPT}' END"""
    return pairs.selectExpr("*", f"{status} AS status")


def build_stats(rows: DataFrame, built: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Per file: rows, pairs, kept, missing, bad and unchecked. Unknown layouts get a note."""
    statuses = (KEPT, MISSING, BAD, UNCHECKED)
    counts = built.groupBy("file").agg(
        F.count("*").alias("pairs_emitted"),
        *[F.expr(f"count_if(status = '{s}')").alias(s) for s in statuses],
    )
    stats = rows.groupBy("file").agg(F.count("*").alias("rows")).join(counts, "file", "left")
    note = "CAST(NULL AS STRING)"
    if files is not None:
        stats = files.select("file", "layout").join(stats, "file", "left")
        note = "IF(layout = 'unknown', 'skipped_unknown_schema', NULL)"
    numbers = [f"coalesce({c}, 0) AS {c}" for c in ("rows", "pairs_emitted", *statuses)]
    return stats.selectExpr("file", *numbers, f"{note} AS note")


def pair_index(kept: DataFrame, per_file: bool = False, staged: bool = True) -> DataFrame:
    """Dense 0-based number of each kept pair in file, row and turn order.

    Blocks of rows are counted, the few counts are summed up in order, and each
    block is numbered on its own; no window spans all rows or a whole file.
    With ``per_file`` every file starts at 0, as when each slice is one run.
    """
    if staged:
        kept = stage(kept, "kept")
    kept = kept.selectExpr("*", f"row_index div {BLOCK_ROWS} AS block")
    unit = ["file", "part", "block"]
    counts = kept.groupBy(*unit).agg(F.count("*").alias("n"))
    earlier = W.orderBy("part", "block").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*unit, F.sum("n").over(earlier.partitionBy("file")).alias("start"))
    if per_file:
        starts = starts.selectExpr(*unit, "coalesce(start, 0) AS start")
    else:
        # One row per pair file: the only step that sees all files at once.
        files = counts.groupBy("file").agg(F.sum("n").alias("n"))
        before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
        files = files.select("file", F.sum("n").over(before).alias("offset"))
        starts = starts.join(files, "file").selectExpr(
            *unit, "coalesce(start, 0) + coalesce(offset, 0) AS start"
        )
    nth = F.row_number().over(W.partitionBy(*unit).orderBy("row_index", "turn_pos"))
    out = [c for c in kept.columns if c != "block"]
    return kept.withColumn("nth", nth).join(starts, unit).selectExpr(*out, "start + nth - 1 AS pair_index")


def assign_shards(
    indexed: DataFrame, samples_per_shard: int = SAMPLES_PER_SHARD, prefix: str = "", per_file: bool = False
) -> DataFrame:
    """Key and shard of each numbered pair; the last shard may be short."""
    stem = stem_of("file")
    name = shard_name("shard_id", text_literal(prefix))
    if per_file:
        name = f"concat({stem}, '/', {name})"
    numbered = indexed.selectExpr("*", f"pair_index div {samples_per_shard} AS shard_id")
    key = sample_key(stem, "pair_index", "prompt")
    return numbered.selectExpr("*", f"{key} AS key", f"{name} AS shard_name")


def shard_sizes(samples: DataFrame) -> DataFrame:
    """Expected samples per shard."""
    return samples.groupBy("shard_id", "shard_name").agg(F.count("*").alias("samples"))


def skip_existing(samples: DataFrame, existing: DataFrame) -> DataFrame:
    """Drop the samples of shards that exist; their numbers stay taken."""
    return samples.join(existing.select("shard_name").distinct(), "shard_name", "left_anti")


def limit_shards(samples: DataFrame, max_shards: int) -> DataFrame:
    """Samples of the first shards only; 0 means no limit."""
    return samples.filter(F.col("shard_id") < max_shards) if max_shards else samples


def limited_stats(
    rows: DataFrame,
    built: DataFrame,
    indexed: DataFrame,
    max_shards: int,
    samples_per_shard: int = SAMPLES_PER_SHARD,
    batch_rows: int = BATCH_ROWS,
    per_file: bool = False,
) -> DataFrame:
    """Build counts of the part that is read before the shard limit stops the run.

    The run stops at the pair that fills the last shard. Its file counts the
    rows of the batch in hand, later files do not appear. Without enough pairs
    nothing stops and all counts are reported. With ``per_file`` every file is
    a run of its own.
    """
    at = f"struct({', '.join(ORDER)})"
    last = indexed.filter(F.col("pair_index") == max_shards * samples_per_shard - 1)
    if per_file:
        stops = last.selectExpr("file", f"{at} AS stop")

        def stopped(df: DataFrame) -> DataFrame:
            return df.join(stops, "file", "left")
    else:
        # One row or none: the number is dense and unique.
        stop = last.agg(F.expr(f"max({at})")).scalar()

        def stopped(df: DataFrame) -> DataFrame:
            return df.withColumn("stop", stop)

    seen = stopped(rows.select("file", "part", "row_index"))
    same_batch = f"""struct(file, part) = struct(stop.file, stop.part)
        AND row_index div {batch_rows} <= stop.row_index div {batch_rows}"""
    seen = seen.filter(
        f"stop IS NULL OR struct(file, part) < struct(stop.file, stop.part) OR ({same_batch})"
    )
    done = stopped(built.select(*ORDER, "status")).filter(f"stop IS NULL OR {at} <= stop")
    return build_stats(seen, done)
