"""A training corpus in five stages, each on all that its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import decontaminate, jaccard, language, packing, queries, secret_scan
from pairloom.runtime import ship_package, stage

ORACLE_SQL = None  # compression sizes, a Markov model and BPE ids are beyond SQL; tests hold the stages against brute force


def set_apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``text`` and all columns under names that no operator gives its own; and these names by column."""
    names = {c: f"__{i}" for i, c in enumerate(docs.columns)}
    return docs.select("text", *[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain, with that language as ``lang``."""
    model = language.learn(docs.where(queries.fold(4) != 2))
    rows, names = set_apart(docs)
    kept = language.identify(rows, model, list(names.values())).where("NOT rejected")
    return kept.select(*[F.col("lang_pred" if c == "lang" else n).alias(c) for c, n in names.items()])


def row_key() -> Column:
    """64 bits that only rows with the same doc_id and text share."""
    return F.xxhash64("doc_id", "text")


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents, the one with the smallest doc_id; rows that repeat it stay as one.

    Different texts under one doc_id, or under none, are documents of their own.
    """
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    key = F.coalesce(F.col("doc_id").cast("long"), row_key()) if repeated.isEmpty() else row_key()  # plain numbers are smaller on disk
    name = next(n for n in ("key", "_key", "__key") if n not in docs.columns)
    keyed = docs.withColumn(name, key)
    groups = jaccard.similar_components(keyed.select(F.col(name).alias("doc_id"), "text")).selectExpr(f"doc_id AS {name}", "component_id").distinct()
    first = groups.join(keyed.select(name, "doc_id").distinct(), name).groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", name)).alias("first"))
    return keyed.join(first.select(f"first.{name}"), name, "left_semi").dropDuplicates([name]).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    keyed = docs.select(row_key().alias("doc_id"), "text")
    held = next(n for n in ("held" + "_" * i for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    found = decontaminate.matches(keyed, queries.table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(held)).distinct()
    return docs.join(found, row_key() == F.col(held), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked and ``n_chars`` counted anew."""
    rows, names = set_apart(docs)
    masked = secret_scan.redact(rows, secret_scan.learn(docs))
    counted = F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col(names["n_chars"]))
    return masked.select(*[{"text": F.col("text"), "n_chars": counted}.get(c, F.col(n)).alias(c) for c, n in names.items()])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, piece by piece."""
    return queries.packed(docs)


def ready(step: Callable) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The step in a session that has the package and its settings."""

    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return step(spark, docs, sf_dir)

    return run_step


STAGES = [
    ("language ID", ready(keep_identified)),
    ("n-gram Jaccard join", ready(keep_one_of_similar)),
    ("benchmark decontamination", ready(drop_benchmark)),
    ("secret scans", ready(mask_secrets)),
    ("best-fit packing", ready(pack)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
