"""Pair files: footers, layouts and the scan."""

import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.pairs import INPUT, KEYS, OUTPUT, PAIR, PROMPT, TURNS, read_rows
from pairloom.sources.files import open_fs

# Column names by role, the preferred name first.
INPUT_NAMES = ["input_images", "original_path", "source_path", "input_path", "original"]
OUTPUT_NAMES = ["output_images", "edited_path", "target_path", "output_path", "edited", "result_path"]
INPUT_EMBEDDED = ["source_img", "original_img", "input_img"]
OUTPUT_EMBEDDED = ["target_img", "edited_img", "output_img"]
TEXT_NAMES = ["prompt", "instruction", "caption", "text", "edit_instruction"]
PREVIEW_TYPES = 16

CATALOG = "file string, part string, path string, rows long, position int, column_name string, column_type string"

# A pair file is one parquet file, or a folder of that name with part files in it,
# as a plain write or one partitioned by a file column makes it.
_LOGICAL = r"(?:[^/=]+=)?([^/]+\.parquet)(?:/(.+))?$"


def list_pair_files(root: str, pair_dir: str = "Parquet", only: str | Sequence[str] = ()) -> list[tuple[str, str, str]]:
    """(file, part, path) of the pair files below ``root``, sorted; footers are not read."""
    files, base = open_fs(f"{root.rstrip('/')}/{pair_dir}")
    prefix = base.rstrip("/") + "/"
    found = []
    for info in files.get_file_info(fs.FileSelector(base, recursive=True)):
        rel = info.path[len(prefix) :]
        match = re.fullmatch(_LOGICAL, rel)
        if info.type == fs.FileType.File and match and rel.endswith(".parquet"):
            if not any(s.startswith(("_", ".")) for s in rel.split("/")):
                scheme = "" if root.find("://") < 0 else root.split("://")[0] + "://"
                found.append((match[1], match[2] or "", scheme + info.path))
    return filter_files(sorted(found), only)


def filter_files(files: list[tuple[str, str, str]], only: str | Sequence[str] = ()) -> list[tuple[str, str, str]]:
    """Keep the named pair files; no name keeps all, and no match is an error."""
    names = only.split(",") if isinstance(only, str) else only
    names = {n.strip() for n in names if n.strip()}
    kept = [f for f in files if f[0] in names] if names else files
    if not kept:
        raise FileNotFoundError(f"no pair files match {sorted(names) or 'the folder'}")
    return kept


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            files, path = open_fs(row.path)
            with files.open_input_file(path) as f:
                meta = pq.ParquetFile(f)
                yield pd.DataFrame(
                    {
                        "file": row.file,
                        "part": row.part,
                        "path": row.path,
                        "rows": meta.metadata.num_rows,
                        "position": range(len(meta.schema_arrow.names)),
                        "column_name": meta.schema_arrow.names,
                        "column_type": [str(t) for t in meta.schema_arrow.types],
                    }
                )


def column_catalog(spark: SparkSession, files: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row per column of each file, read from the footers in parallel."""
    tasks = min(len(files), spark.sparkContext.defaultParallelism)
    names = spark.createDataFrame(list(files), "file string, part string, path string")
    return names.repartition(tasks, "path").mapInPandas(_read_footers, CATALOG)


def _pick(names: Sequence[str]) -> Column:
    """Column with the most preferred of ``names``, any case; the last of equal ones."""
    wanted = F.array(*[F.lit(n) for n in names])
    at = F.array_position(wanted, F.lower("column_name")).cast("int")
    return F.min(F.when(at > 0, F.struct(at.alias("at"), -F.col("position"), "column_name")))["column_name"]


def classify_schema(catalog: DataFrame, by: Sequence[str] = ("file",)) -> DataFrame:
    """Layout and column roles per file, from the column names alone."""
    name = F.col("column_name")
    found = catalog.groupBy(*by).agg(
        F.bool_or(name == TURNS).alias("turns"),
        (F.bool_or(name == INPUT) & F.bool_or(name == OUTPUT)).alias("lists"),
        _pick(INPUT_EMBEDDED).alias("in_img"),
        _pick(OUTPUT_EMBEDDED).alias("out_img"),
        _pick(INPUT_NAMES).alias("in_path"),
        _pick(OUTPUT_NAMES).alias("out_path"),
        _pick(TEXT_NAMES).alias("text"),
    )
    has = {c: F.col(c).isNotNull() for c in ("in_img", "out_img", "in_path", "out_path")}
    cases = [
        ("multiturn", F.col("turns"), F.lit(None), F.lit(None), F.lit(PROMPT)),
        ("lists", F.col("lists"), F.lit(INPUT), F.lit(OUTPUT), F.coalesce("text", F.lit(PROMPT))),
        ("embed", has["in_img"] & has["out_img"], F.col("in_img"), F.col("out_img"), F.col("text")),
        ("path", has["in_path"] & has["out_path"], F.col("in_path"), F.col("out_path"), F.col("text")),
        ("mixed_embed_orig", has["in_img"] & has["out_path"], F.col("in_img"), F.col("out_path"), F.col("text")),
        ("mixed_embed_edit", has["in_path"] & has["out_img"], F.col("in_path"), F.col("out_img"), F.col("text")),
        ("unknown", F.lit(True), F.lit(None), F.lit(None), F.col("text")),
    ]
    chosen = F.coalesce(
        *[
            F.when(
                when,
                F.struct(
                    F.lit(layout).alias("layout"),
                    i.cast("string").alias("input_col"),
                    o.cast("string").alias("output_col"),
                    t.cast("string").alias("text_col"),
                ),
            )
            for layout, when, i, o, t in cases
        ]
    )
    return found.select(*by, chosen.alias("c")).select(*by, "c.*")


def profile_files(catalog: DataFrame) -> DataFrame:
    """Per file: rows, columns, names, type preview and detected layout."""
    parts = catalog.groupBy("file", "part").agg(F.max("rows").alias("rows"))
    rows = parts.groupBy("file").agg(F.sum("rows").alias("rows"))
    # Part files of one pair file share a schema; the first one stands for it.
    first = catalog.groupBy("file").agg(F.min("part").alias("part"))
    columns = F.sort_array(F.collect_list(F.struct("position", "column_name", "column_type")))
    shape = (
        catalog.join(first, ["file", "part"], "left_semi")
        .groupBy("file")
        .agg(columns.alias("cs"))
        .select(
            "file",
            F.size("cs").alias("columns"),
            F.col("cs.column_name").alias("names"),
            F.slice("cs.column_type", 1, PREVIEW_TYPES).alias("types"),
        )
    )
    return rows.join(shape, "file").join(classify_schema(catalog), "file")


def scan_pairs(spark: SparkSession, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of all pair files with their strict pairs, and the layout of each file.

    Files are read in groups that share layout and column types, so no file is
    forced into another's schema, and only the columns a layout needs are read.
    """
    layouts = classify_schema(catalog)
    used = F.array_contains(F.array(F.lit(TURNS), "input_col", "output_col", "text_col"), F.col("column_name"))
    # Footer facts, one row per part file, as many as the scan itself lists.
    parts = (
        catalog.join(layouts, "file")
        .withColumn("used", F.when(used, F.concat_ws(":", "column_name", "column_type")))
        .groupBy("path", "layout", "input_col", "output_col", "text_col")
        .agg(F.array_sort(F.collect_list("used")).alias("signature"))
        .collect()
    )
    groups: dict[tuple, list[str]] = {}
    for p in parts:
        if p.layout != "unknown":
            key = (p.layout, p.input_col, p.output_col, p.text_col, tuple(p.signature))
            groups.setdefault(key, []).append(p.path)
    rows = spark.createDataFrame(
        [], f"file string, part string, row_index long, pairs array<{PAIR}>, prompts array<string>"
    )
    for (layout, i, o, t, _), paths in sorted(groups.items(), key=str):
        df = spark.read.parquet(*sorted(paths))
        rows = rows.unionByName(read_rows(df, layout, i, o, t, file_keys()))
    return rows, layouts


def file_keys() -> list[Column]:
    """File, part and row of a parquet scan."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return [
        F.regexp_extract(path, _LOGICAL, 1).alias(KEYS[0]),
        F.regexp_extract(path, _LOGICAL, 2).alias(KEYS[1]),
        F.col("_metadata.row_index").alias(KEYS[2]),
    ]
