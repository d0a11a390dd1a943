"""Audit: which strict pairs resolve to listed files."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairloom.functions.naming import stem_of
from pairloom.functions.paths import prepend_subdir
from pairloom.operators.pairs import emit_pairs
from pairloom.operators.resolve import resolve_pairs, resolve_paths, staged_references
from pairloom.operators.slices import PathSettings, rewrite_pairs
from pairloom.runtime import stage

MAX_EXAMPLES = 8


def audited_pairs(
    rows: DataFrame, manifest: DataFrame, settings: PathSettings = PathSettings()
) -> DataFrame:
    """Every strict pair with a flag per side that says whether the file exists."""
    pairs = rewrite_pairs(emit_pairs(rows, prompts=False), settings)
    refs = staged_references(pairs)
    known = stage(resolve_paths(refs, manifest, settings.pair_dir, locate=False), "resolved")
    both = resolve_pairs(pairs, known.withColumn("ok", F.lit(True)), refs)
    flags = [f"coalesce({s}_ok, false) AS {s}_ok" for s in ("input", "output")]
    return both.selectExpr(*[c for c in both.columns if not c.endswith("_ok")], *flags)


def audit_stats(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Per file: rows, strict pairs, pairs with both files, broken pairs, resolve rate."""
    totals = rows.groupBy("file").agg(F.count("*").alias("rows"))
    pairs = audited.groupBy("file").agg(
        F.count("*").alias("pairs"), F.expr("count_if(input_ok AND output_ok)").alias("both")
    )
    counts = totals.join(pairs, "file", "left").selectExpr(
        "file", "rows", "coalesce(pairs, 0) AS strict_pairs", "coalesce(both, 0) AS both_exist"
    )
    return counts.selectExpr(
        "*",
        "strict_pairs - both_exist AS broken_pairs",
        "try_divide(both_exist, strict_pairs) AS resolve_rate",
    )


def audit_examples(
    audited: DataFrame, settings: PathSettings = PathSettings(), limit: int = MAX_EXAMPLES
) -> DataFrame:
    """The first broken pairs of each file, with the side that is missing."""
    first = W.partitionBy("file").orderBy("part", "row_index", "turn_pos")
    shown = {s: prepend_subdir(f"{s}_path", settings.subdir(stem_of("file"))) for s in ("input", "output")}
    return (
        audited.filter("NOT (input_ok AND output_ok)")
        .withColumn("nth", F.row_number().over(first))
        .filter(F.col("nth") <= limit)
        .selectExpr(
            "file",
            "nth",
            f"{shown['input']} AS input",
            f"{shown['output']} AS output",
            """CASE WHEN NOT input_ok AND NOT output_ok THEN 'missing_both'
               WHEN NOT input_ok THEN 'missing_input' ELSE 'missing_output' END AS reason""",
        )
    )
