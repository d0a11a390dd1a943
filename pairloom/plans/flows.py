"""Explore, audit and build flows over whole datasets."""

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairloom.functions.naming import stem_of
from pairloom.operators.audit import audit_examples, audit_stats, audited_pairs
from pairloom.operators.explore import explore_stats, explore_totals, missing_roots, root_histogram
from pairloom.operators.pairs import emit_pairs
from pairloom.operators.resolve import resolve_pairs, resolve_paths, staged_references
from pairloom.operators.shards import (
    BATCH_ROWS,
    KEPT,
    ORDER,
    SAMPLES_PER_SHARD,
    assign_shards,
    build_stats,
    build_status,
    limit_shards,
    limited_stats,
    pair_index,
    shard_sizes,
    skip_existing,
)
from pairloom.operators.slices import SUCCESS, PathSettings, rewrite_pairs, slice_gate
from pairloom.operators.verify import first_keys, verify_shards
from pairloom.runtime import spread, stage
from pairloom.sources.archives import index_members, list_archives
from pairloom.sources.images import UNCHECKED, decode_unchecked, image_size, image_validity
from pairloom.sources.listing import list_tree
from pairloom.sources.tar_sink import list_shards, write_shards

SIDES = ("input", "output")
DECODED_PER_SHARD = 3
MEMBERS_PER_TASK = 200
FIRST_SHARE = 1.25


def explore(rows: DataFrame, layouts: DataFrame, listing: DataFrame) -> dict[str, DataFrame]:
    """The sections of the exploration report."""
    stats, roots = explore_stats(rows), root_histogram(rows)
    return {
        "files": layouts.join(stats, "file", "left"),
        "roots": roots,
        "missing_roots": missing_roots(roots, listing),
        "totals": explore_totals(stats, layouts),
    }


def audit(
    rows: DataFrame, layouts: DataFrame, manifest: DataFrame, settings: PathSettings = PathSettings()
) -> dict[str, DataFrame]:
    """The sections of the audit report; pairs are resolved once."""
    audited = stage(audited_pairs(rows, manifest, settings), "audited")
    stats = layouts.select("file", "layout").join(audit_stats(rows, audited), "file", "left")
    counts = [f"coalesce({c}, 0) AS {c}" for c in ("rows", "strict_pairs", "both_exist", "broken_pairs")]
    stats = stats.selectExpr("file", "layout", *counts, "resolve_rate")
    return {"files": stats, "examples": audit_examples(audited, settings)}


def check_references(refs: DataFrame, manifest: DataFrame, settings: PathSettings, root: str = "") -> DataFrame:
    """What is known of each distinct reference: path, size, location, decodability.

    The manifest needs path, size and segments. Each file is decoded once,
    however many pairs name it.
    """
    known = resolve_paths(refs, manifest, settings.pair_dir, root=root)
    known = stage(known.select("ref", "path", "size", "segments"), "resolved")
    files = known.filter("size > 0").groupBy("path").agg(
        F.first("segments").alias("segments"), F.max("size").alias("size")
    )
    checked = stage(image_validity(spread(files, "size", "path"), root), "checked")
    checked = decode_unchecked(manifest.sparkSession, checked, root).select("path", "valid", "width", "height")
    return known.join(checked, "path", "left").drop("path")


def build_pairs(
    rows: DataFrame, manifest: DataFrame, settings: PathSettings = PathSettings(), root: str = ""
) -> DataFrame:
    """Every strict pair with its build status and the location of both images, without prompts."""
    pairs = rewrite_pairs(emit_pairs(rows, prompts=False), settings)
    refs = staged_references(pairs)
    return build_status(resolve_pairs(pairs, check_references(refs, manifest, settings, root), refs))


def first_pairs(
    rows: DataFrame, manifest: DataFrame, settings: PathSettings, root: str, enough: int, per_file: bool = False
) -> DataFrame:
    """``build_pairs`` of as many rows from the front as it takes to keep ``enough`` pairs; of all rows if they never do.

    Rows are taken in batches of ``BATCH_ROWS``, in order. The first round takes batches that emit ``FIRST_SHARE`` times
    ``enough`` pairs, each later round as many again as all before it, so at most about twice what is needed is
    resolved and decoded. With ``per_file`` every file is a run of its own, and only those still short go on.
    """
    unit = ["file", "part", "batch"]
    batch = F.expr(f"row_index div {BATCH_ROWS}").alias("batch")
    counts = emit_pairs(rows, prompts=False).groupBy("file", "part", batch).agg(F.count("*").alias("n"))
    counts = stage(counts, "batches")
    before = W.partitionBy("file").orderBy("part", "batch").rowsBetween(W.unboundedPreceding, -1)
    order = counts.select(*unit, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    if not per_file:
        # One row per pair file, as in pair_index.
        files = counts.groupBy("file").agg(F.sum("n").alias("n"))
        earlier = files.select("file", F.coalesce(F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
        order = order.join(earlier, "file").select(*unit, (F.col("before") + F.col("earlier")).alias("before"))
    order = stage(order.select(F.col("file").alias("run") if per_file else F.lit("").alias("run"), *unit, "before"), "order")
    low, high = 0, math.ceil(FIRST_SHARE * enough)
    built, open_ = [], order.select("run").distinct()
    while True:
        left = order.filter(F.col("before") >= low).join(open_, "run", "left_semi")
        if built and left.isEmpty():
            break
        taken = left.filter(F.col("before") < high).select(*unit)
        chosen = rows.select("*", batch).join(taken, unit, "left_semi").drop("batch")
        built.append(stage(build_pairs(chosen, manifest, settings, root), "built"))
        kept = reduce(DataFrame.unionByName, built).filter(F.col("status") == KEPT)
        done = kept.groupBy((F.col("file") if per_file else F.lit("")).alias("run")).count().filter(F.col("count") >= enough)
        open_ = stage(order.select("run").distinct().join(done, "run", "left_anti"), "open")
        low, high = high, 2 * high
    return reduce(DataFrame.unionByName, built)


def with_prompts(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs with their prompts, which no step before needs."""
    return pairs.join(emit_pairs(rows).select(*ORDER, "prompt"), ORDER)


@dataclass
class BuildResult:
    """``written`` has a row per shard, its samples and whether it was written or left alone."""

    stats: DataFrame
    samples: DataFrame
    sizes: DataFrame
    written: DataFrame

    def totals(self) -> DataFrame:
        """Kept pairs, and shards and samples written and skipped."""
        counts = [f"count_if(state = '{s}') AS shards_{s}" for s in ("written", "skipped")]
        counts += [f"coalesce(sum(IF(state = '{s}', samples, 0)), 0) AS samples_{s}" for s in ("written", "skipped")]
        kept = self.stats.agg(F.expr("coalesce(sum(kept), 0)")).scalar()
        return self.written.selectExpr(*counts).withColumn("kept", kept)


def build(
    rows: DataFrame,
    manifest: DataFrame,
    out: str,
    settings: PathSettings = PathSettings(),
    layouts: DataFrame | None = None,
    root: str = "",
    samples_per_shard: int = SAMPLES_PER_SHARD,
    prefix: str = "",
    per_file: bool = False,
    skip_written: bool = False,
    max_shards: int = 0,
    **write_options,
) -> BuildResult:
    """Status, numbers, keys and shards of all pairs; shards are written to ``out``.

    With ``per_file`` every pair file is a slice with its own folder and numbers.
    With ``max_shards`` resolving and decoding stop soon after so many shards are full.
    """
    spark = rows.sparkSession
    if max_shards:
        built = first_pairs(rows, manifest, settings, root, max_shards * samples_per_shard, per_file)
    else:
        built = stage(build_pairs(rows, manifest, settings, root), "built")
    kept = built.filter(F.col("status") == KEPT)
    numbered = pair_index(kept, per_file, staged=False)
    stats = build_stats(rows, built, layouts)
    if max_shards:
        stats = limited_stats(rows, built, numbered, max_shards, samples_per_shard, per_file=per_file)
    samples = assign_shards(with_prompts(numbered, rows), samples_per_shard, prefix, per_file)
    samples = limit_shards(samples, max_shards)
    if skip_written:
        samples = skip_existing(samples, list_shards(spark, out))
    samples = stage(samples, "samples")
    sizes = shard_sizes(samples)
    written = write_shards(samples, out, sizes.count(), root=root, **write_options)
    return BuildResult(stats, samples, sizes, written)


@dataclass
class GatedRun:
    """``verdicts`` has a row per slice; ``built`` holds only slices that passed the audit, each numbered for itself."""

    audit: dict[str, DataFrame]
    verdicts: DataFrame
    stats: DataFrame
    samples: DataFrame
    built: BuildResult | None = None


def run_slices(
    rows: DataFrame,
    layouts: DataFrame,
    manifest: DataFrame,
    settings: PathSettings = PathSettings(),
    root: str = "",
    out: str | None = None,
    samples_per_shard: int = SAMPLES_PER_SHARD,
    failures: DataFrame | None = None,
    min_rate: float = 1.0,
    allow_zero_pairs: bool = False,
    allow_empty: bool = False,
    allow_unchecked: bool = False,
    **write_options,
) -> GatedRun:
    """Audit, gate, build of the slices that passed, second gate on what was kept.

    A slice is one pair file with all its parts; its verdict comes from counts
    over all of them. Images of other slices are neither read nor written. With
    ``out`` the shards are written, else only samples are made.
    """
    limits = {"min_rate": min_rate, "allow_zero_pairs": allow_zero_pairs, "allow_empty": allow_empty, "allow_unchecked": allow_unchecked, "failures": failures}
    sections = audit(rows, layouts, manifest, settings)
    audited = stage(sections["files"], "audit")
    first = slice_gate(audited, **limits)
    passed = stage(first.filter(F.col("verdict") == SUCCESS).select("file"), "passed")
    chosen = rows.join(passed, "file", "left_semi")
    if out is not None:
        built = build(chosen, manifest, out, settings, None, root, samples_per_shard, per_file=True, **write_options)
        stats, samples = stage(built.stats, "stats"), built.samples
    else:
        built, pairs = None, stage(build_pairs(chosen, manifest, settings, root), "built")
        stats = stage(build_stats(chosen, pairs), "stats")
        numbered = pair_index(pairs.filter(F.col("status") == KEPT), per_file=True, staged=False)
        samples = assign_shards(with_prompts(numbered, chosen), samples_per_shard, per_file=True)
    return GatedRun(sections | {"files": audited}, slice_gate(audited, stats, **limits), stats, samples, built)


def _readable(data: bytes | None, suffix: str) -> bool | None:
    """Whether a member can be read; None where nobody could decode its format."""
    if data is None:
        return False
    if suffix != "txt":
        size, how = image_size(data)
        return None if how == UNCHECKED else size is not None
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def _decodes(batches):
    import pandas as pd

    from pairloom.sources.files import SegmentReader

    reader = SegmentReader("")
    for batch in batches:
        ok = [_readable(reader.read(segments), suffix) for suffix, segments in zip(batch.suffix, batch.segments)]
        yield pd.DataFrame({"shard_name": batch.shard_name, "member": batch.member, "readable": pd.array(ok, "boolean")})


def verify_decode(members: DataFrame, per_shard: int = DECODED_PER_SHARD) -> DataFrame:
    """Per shard: members of its first keys, how many of them cannot be read, and how many nobody could decode.

    ``members`` has shard_name, member and segments.
    """
    chosen = first_keys(members, per_shard).select("shard_name", "member", "suffix", "segments")
    # Reading is the work here, and the rows are short.
    chosen = stage(chosen, "chosen")
    tasks = max(1, chosen.count() // MEMBERS_PER_TASK)
    checked = chosen.repartitionByRange(tasks, "shard_name", "member").mapInPandas(_decodes, "shard_name string, member string, readable boolean")
    return checked.groupBy("shard_name").agg(
        F.count("*").alias("members_read"),
        F.count_if(~F.col("readable")).alias("unreadable"),
        F.count_if(F.col("readable").isNull()).alias("unchecked"),
    )


def shard_members(spark: SparkSession, out: str) -> DataFrame:
    """Member index of the shards below ``out``."""
    index = index_members(stage(list_archives(list_tree(spark, out)), "archives"), out)
    return index.selectExpr("archive AS shard_name", "member", "size", "segments", "state")


def verify(spark: SparkSession, out: str, expected: DataFrame, per_shard: int = DECODED_PER_SHARD) -> DataFrame:
    """Structure and decode checks of the written shards."""
    members = shard_members(spark, out).filter("state = 'file'")
    structure = verify_shards(members, expected)
    return structure.join(verify_decode(members, per_shard), "shard_name", "left")


def gate(audit_files: DataFrame, build_stats_: DataFrame | None = None, **limits) -> DataFrame:
    """Verdict per slice with its output folder name."""
    return slice_gate(audit_files, build_stats_, **limits).selectExpr("*", f"{stem_of('file')} AS stem")


def write_reports(sections: dict[str, DataFrame], out: str) -> None:
    """One JSON folder per report section."""
    for name, section in sections.items():
        section.write.mode("overwrite").json(f"{out.rstrip('/')}/{name}")
