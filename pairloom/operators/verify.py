"""Shard verification from the member index of the written archives."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The members of one sample.
SUFFIXES = ("jpg", "jpg2", "txt")
MAX_BAD_KEYS = 3


def _sample_members(members: DataFrame) -> DataFrame:
    """Members that belong to samples, split at the last dot."""
    suffix = "substring_index(member, '.', -1)"
    return (
        members.filter(f"contains(member, '.') AND {suffix} IN {SUFFIXES}")
        .selectExpr("*", f"{suffix} AS suffix")
        .selectExpr("*", "left(member, length(member) - length(suffix) - 1) AS key")
    )


def verify_shards(members: DataFrame, expected: DataFrame) -> DataFrame:
    """Per shard: is every key a full triplet and are there as many as expected?

    ``members`` has shard_name and member, ``expected`` shard_name and samples.
    """
    per_key = _sample_members(members).groupBy("shard_name", "key").agg(
        *[F.expr(f"count_if(suffix = '{s}')").alias(f"n_{s}") for s in SUFFIXES]
    )
    full = " AND ".join(f"n_{s} > 0" for s in SUFFIXES)
    per_shard = per_key.groupBy("shard_name").agg(
        *[F.sum(f"n_{s}").alias(f"n_{s}") for s in SUFFIXES],
        F.expr(f"count_if(NOT ({full}))").alias("bad_keys"),
    )
    nth = F.row_number().over(W.partitionBy("shard_name").orderBy("key"))
    examples = (
        per_key.filter(f"NOT ({full})")
        .withColumn("nth", nth)
        .filter(F.col("nth") <= MAX_BAD_KEYS)
        .groupBy("shard_name")
        .agg(F.array_sort(F.collect_list("key")).alias("examples"))
    )
    numbers = [f"coalesce({c}, 0) AS {c}" for c in (*[f"n_{s}" for s in SUFFIXES], "bad_keys")]
    same = " AND ".join(f"n_{s} = samples" for s in SUFFIXES)
    problem = f"CASE WHEN bad_keys > 0 THEN 'incomplete_keys' WHEN NOT ({same}) THEN 'wrong_count' END"
    return (
        expected.select("shard_name", "samples")
        .join(per_shard, "shard_name", "left")
        .join(examples, "shard_name", "left")
        .selectExpr("shard_name", "samples", *numbers, "examples")
        .selectExpr("*", f"{problem} AS problem")
        .selectExpr("*", "problem IS NULL AS ok")
    )


def first_keys(members: DataFrame, per_shard: int) -> DataFrame:
    """Members of the first keys of each shard, as the decode check reads them."""
    mine = _sample_members(members)
    nth = F.row_number().over(W.partitionBy("shard_name").orderBy("key"))
    # The text member stands for its sample, so the window sees one row per key.
    keys = (
        mine.filter("suffix = 'txt'")
        .select("shard_name", "key")
        .distinct()
        .withColumn("nth", nth)
        .filter(F.col("nth") <= per_shard)
        .drop("nth")
    )
    return mine.join(keys, ["shard_name", "key"], "left_semi")
