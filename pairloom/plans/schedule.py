"""The standard run: slices, the archives they need and their path settings."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.slices import PathSettings
from pairloom.sources.listing import match_globs

@dataclass(frozen=True)
class Slice:
    """A pair file, the archives it needs, and its path settings; ``rules`` are its own substitutions."""

    stem: str
    pattern: str
    image_subdir: str = ""
    fix_hybrid: bool = False
    rules: tuple[tuple[str, str], ...] = ()


def standard_slices() -> list[Slice]:
    # Fixed values.
    return [
        Slice("action_part1", "Singleturn/action_part1.tar.split.*", image_subdir="Singleturn/part1"),
        Slice("action_part2", "Singleturn/action_part2.tar.split.*", image_subdir="Singleturn/part2"),
        Slice("action_part3", "Singleturn/action_part3.tar.split.*", image_subdir="Singleturn/part3"),
        Slice("action_part4", "Singleturn/action_part4.tar.split.*", image_subdir="Singleturn/part4"),
        Slice("add_part0", "Singleturn/results_add_laion_part0.tar.split.*"),
        Slice("add_part1", "Singleturn/results_add_laion_part1.tar.split.*"),
        Slice("add_part4", "Singleturn/results_add_laion_part4.tar.split.*"),
        Slice("add_part5", "Singleturn/results_add_laion_part5.tar.split.*"),
        Slice("adjust_canny_part0", "Singleturn/results_adjust_canny_laion_part0.tar.split.*"),
        Slice("adjust_canny_part2", "Singleturn/results_adjust_canny_laion_part2.tar.split.*"),
        Slice("adjust_canny_part3", "Singleturn/results_adjust_canny_laion_part3.tar.split.*"),
        Slice("adjust_canny_part4", "Singleturn/results_adjust_canny_laion_part4.tar.split.*"),
        Slice("background_part0", "Singleturn/results_background_laion_part0.tar.split.*"),
        Slice("background_part2", "Singleturn/results_background_laion_part2.tar.split.*"),
        Slice("background_part3", "Singleturn/results_background_laion_part3.tar.split.*"),
        Slice("background_part5", "Singleturn/results_background_laion_part5.tar.split.*"),
        Slice("background_part7", "Singleturn/results_background_laion_part7.tar.split.*"),
        Slice("hybrid_part0", "Singleturn/results_hybrid_part0.tar.split.*", fix_hybrid=True),
        Slice("hybrid_part2", "Singleturn/results_hybrid_part2.tar.split.*", fix_hybrid=True),
        Slice("hybrid_part6", "Singleturn/results_hybrid_part6.tar.split.*", fix_hybrid=True),
        Slice("reference_extract_part1", "Singleturn/results_extract_and_visualedit_part1.tar.split.*"),
        Slice("reference_extract_part7", "Singleturn/results_extract_and_visualedit_part7.tar.split.*"),
        Slice("remove_part0", "Singleturn/results_remove_part0.tar.split.*"),
        Slice("remove_part1", "Singleturn/results_remove_laion_part1.tar.split.*"),
        Slice("remove_part4", "Singleturn/results_remove_laion_part4.tar.split.*"),
        Slice("remove_part5", "Singleturn/results_remove_laion_part5.tar.split.*"),
        Slice("replace_part0", "Singleturn/results_replace_part0.tar.split.*"),
        Slice("replace_part1", "Singleturn/results_replace_laion_part1.tar.split.*"),
        Slice("replace_part4", "Singleturn/results_replace_laion_part4.tar.split.*"),
        Slice("replace_part5", "Singleturn/results_replace_laion_part5.tar.split.*"),
        Slice("style_transfer", "Singleturn/results_style_transfer.tar.split.*"),
        Slice("style_transfer_part0", "Singleturn/results_style_transfer_part0.tar.split.*"),
    ]


def path_settings(slices: list[Slice]) -> PathSettings:
    return PathSettings(
        subdirs={s.stem: s.image_subdir for s in slices if s.image_subdir},
        hybrid_stems=tuple(s.stem for s in slices if s.fix_hybrid),
        stem_rules={s.stem: s.rules for s in slices if s.rules},
    )


def slice_archives(spark: SparkSession, listing: DataFrame, slices: list[Slice]) -> DataFrame:
    """Listed archive files that each slice needs."""
    names = spark.createDataFrame([(s.stem, s.pattern) for s in slices], "stem string, pattern string")
    # One row per slice, given by the caller.
    matched = match_globs(listing, [s.pattern for s in slices])
    return matched.join(F.broadcast(names), "pattern").select("stem", "path")
