"""Slices: one pair file each, with its own path settings, gate and verdict."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import text_literal
from pairloom.functions.naming import stem_of
from pairloom.functions.paths import null_path, prepend_subdir, substitute_paths
from pairloom.functions.text import let, strip

# Rename that hybrid slices need, and the stems that get it unasked.
HYBRID_RULE = ("results_compose", "results_hybrid")
HYBRID_STEM = "hybrid_part"

SUCCESS, SKIPPED, FAILED = "SUCCESS", "SKIPPED", "FAILED"


@dataclass(frozen=True)
class PathSettings:
    """How the paths of each slice are rewritten before they are looked up.

    ``subdirs`` maps a stem to the folder of its bare file names; the key ``*``
    is the default. ``hybrid_stems`` get the hybrid rename explicitly.
    ``stem_rules`` are a stem's own substitutions, after the common ``rules``.
    """

    rules: Sequence[tuple[str, str]] = ()
    subdirs: Mapping[str, str] = field(default_factory=dict)
    hybrid_stems: Sequence[str] = ()
    auto_hybrid: bool = True
    pair_dir: str = "Parquet"
    stem_rules: Mapping[str, Sequence[tuple[str, str]]] = field(default_factory=dict)

    def subdir(self, stem: str) -> str:
        """Expression for the folder of a slice's bare file names."""
        cases = [
            f"WHEN {stem} = {text_literal(k)} THEN {text_literal(v)}" for k, v in self.subdirs.items() if k != "*"
        ]
        default = text_literal(self.subdirs.get("*", ""))
        return f"CASE {' '.join(cases)} ELSE {default} END" if cases else default

    def hybrid(self, stem: str) -> str:
        """Expression that says whether a slice gets the hybrid rename."""
        tests = [f"{stem} = {text_literal(s)}" for s in self.hybrid_stems]
        if self.auto_hybrid:
            tests.append(f"startswith({stem}, '{HYBRID_STEM}')")
        return f"({' OR '.join(tests)})" if tests else "false"


def slice_rules(stem: str, settings: PathSettings) -> str:
    """The substitution rules of a slice as an array, the hybrid rename first."""

    def as_array(rules):
        pairs = [f"struct({text_literal(o)} AS old, {text_literal(n)} AS new)" for o, n in rules]
        return f"CAST(array({', '.join(pairs)}) AS array<struct<old:string,new:string>>)"

    with_rename = as_array([HYBRID_RULE, *settings.rules])
    return f"IF({settings.hybrid(stem)}, {with_rename}, {as_array(settings.rules)})"


def rewrite_path(x: str, stem: str, settings: PathSettings) -> str:
    """Path to look up: subfolder, then substitutions, then null words."""
    path = strip(prepend_subdir(x, settings.subdir(stem)))
    renamed = substitute_paths("r", [HYBRID_RULE])
    path = let(path, "r", lambda r: f"IF({settings.hybrid(stem)}, {renamed}, {r})")
    path = substitute_paths(path, settings.rules)
    for own, rules in settings.stem_rules.items():
        path = let(path, "r", lambda r, own=own, rules=rules: f"IF({stem} = {text_literal(own)}, {substitute_paths('r', rules)}, {r})")
    return let(path, "done", null_path)


def rewrite_pairs(pairs: DataFrame, settings: PathSettings) -> DataFrame:
    """Add the references to look up to every pair."""
    stem = stem_of("file")
    refs = [f"{rewrite_path(f'{s}_path', stem, settings)} AS {s}_ref" for s in ("input", "output")]
    return pairs.selectExpr("*", *refs)


def slice_gate(
    audit: DataFrame,
    build: DataFrame | None = None,
    min_rate: float = 1.0,
    allow_zero_pairs: bool = False,
    allow_empty: bool = False,
    allow_unchecked: bool = False,
    failures: DataFrame | None = None,
) -> DataFrame:
    """Verdict per slice from its audit and, once built, its build counts.

    ``audit`` needs file, layout, strict_pairs, broken_pairs and resolve_rate;
    ``build`` needs file and kept. Both hold one row per pair file. ``failures``
    (file, reason) are slices that could not be run, with or without a pair file.
    """
    gate = audit
    if failures is not None:
        first = failures.groupBy("file").agg(F.min("reason").alias("failure"))
        gate = gate.join(first, "file", "full")
    if build is not None:
        unchecked = F.col("unchecked") if "unchecked" in build.columns else F.lit(0)
        gate = gate.join(build.select("file", "kept", unchecked.alias("_unchecked")), "file", "left")
    else:
        gate = gate.withColumn("kept", F.lit(None).cast("bigint")).withColumn("_unchecked", F.lit(0))
    none = F.col("strict_pairs") == 0
    low = F.coalesce(F.col("resolve_rate"), F.lit(-1.0)) < min_rate
    reason = F.when(F.col("layout") == "unknown", "unknown_layout")
    if not allow_zero_pairs:
        reason = reason.when(none, "no_strict_pairs")
    reason = reason.when(~none & low, "low_resolve_rate")
    if not allow_empty:
        reason = reason.when(F.col("kept") == 0, "nothing_kept")
    if not allow_unchecked:
        reason = reason.when(F.col("_unchecked") > 0, "unchecked_images")
    verdict = F.when(F.col("reason").isNull(), SUCCESS).otherwise(SKIPPED)
    if failures is not None:
        reason = F.coalesce("failure", reason)
        verdict = F.when(F.col("failure").isNotNull(), FAILED).otherwise(verdict)
    return gate.withColumn("reason", reason).withColumn("verdict", verdict).drop("failure", "_unchecked")


def slice_failures(needed: DataFrame, splits: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """(file, reason) of slices whose pair file is missing or whose split archive is incomplete.

    ``needed`` has file and archive, ``splits`` is ``check_split_parts``, ``present`` the pair files there are.
    """
    torn = splits.filter("NOT complete").select(F.concat("dir", "base").alias("archive"))
    found = needed.join(torn, "archive", "left_semi").selectExpr("file", "'incomplete_archive' AS reason").distinct()
    if present is not None:
        gone = needed.select("file").distinct().join(present.select("file"), "file", "left_anti")
        found = found.unionByName(gone.selectExpr("file", "'missing_pair_file' AS reason"))
    return found


def run_summary(verdicts: DataFrame) -> DataFrame:
    """How many slices succeeded, were skipped and failed."""
    counts = [
        F.count_if(F.col("verdict") == v).alias(v.lower()) for v in (SUCCESS, SKIPPED, FAILED)
    ]
    return verdicts.agg(*counts)
