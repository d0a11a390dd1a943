"""Split archives whose parts arrive over time, in any order: each is released once, when it is whole."""

import io
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyarrow import feather
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from pairloom.runtime import stage
from pairloom.sources.archives import PARTS, check_split_parts, split_parts

# Fixed value: the only kind of state store that keeps maps.
PROVIDER = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RELEASED = "archive string, idx string, path string, size long"


# Fixed value, as state is kept by it: archives are dealt to so many keys, since each key costs calls to the store in each batch.
KEYS = 1024


def _gathered() -> StatefulProcessor:
    """A processor for the archives of one key. The class travels with it, as Spark also starts it where this package is not shipped."""

    def packed(rows: pd.DataFrame) -> bytes:
        out = io.BytesIO()
        feather.write_feather(rows.reset_index(drop=True), out, compression="zstd")
        return out.getvalue()

    def unpacked(data: bytes) -> pd.DataFrame:
        return feather.read_feather(io.BytesIO(data))

    columns = ["archive", "idx", "path", "size"]

    class Gathered(StatefulProcessor):
        """Parts of archives so far, by archive and index, until they are all there, and the names of those that were."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            # One value, as each call to the store is a round trip: two tables.
            self._gathered = handle.getValueState("gathered", "parts binary, released binary")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
            # Rows that do not name their archive belong to the one that the key names.
            come = pd.concat([r.assign(archive=r["archive"] if "archive" in r else key[0]) for r in rows])
            parts, released = None, pd.DataFrame({"archive": pd.Series(dtype=object)})
            if self._gathered.exists():
                parts, released = map(unpacked, self._gathered.get())
                come = come[~come["archive"].isin(released["archive"])]
            if come.empty:
                return
            wanted = come.drop_duplicates("archive", keep="last").set_index("archive")["wanted"]
            parts = pd.concat([p for p in (parts, come[columns]) if p is not None and len(p)]).drop_duplicates(["archive", "idx"])
            there = parts["archive"].value_counts().reindex(wanted.index)
            done = wanted.index[there.to_numpy() == wanted.to_numpy()]
            whole = parts["archive"].isin(done)
            if len(done):
                yield parts[whole].reset_index(drop=True)
            self._gathered.update((packed(parts[~whole]), packed(pd.concat([released, pd.DataFrame({"archive": done})]))))

        def close(self) -> None:
            pass

    return Gathered()


def expected_parts(listing: DataFrame) -> DataFrame:
    """(archive, idx, path, size, wanted) of the parts of every split archive that ``listing`` shows as contiguous."""
    parts = split_parts(listing)
    whole = check_split_parts(parts).filter("complete").select("dir", "base", F.col("parts").alias("wanted"))
    return parts.join(whole, ["dir", "base"]).select(F.concat("dir", "base").alias("archive"), F.col("idx").cast("string").alias("idx"), "path", "size", "wanted")


def whole_archives(arrivals: DataFrame, listing: DataFrame) -> DataFrame:
    """A stream of the parts of each split archive, all in the batch that brings the last of them, and never again.

    ``arrivals`` is a stream of (path, size); ``listing`` tells which parts there will be. A part counts if it
    has the size that is listed; one that arrives twice counts once. State holds the
    parts of archives that are not whole yet, and a mark for each that is.
    """
    return _released(arrivals, expected_parts(listing))


def _released(arrivals: DataFrame, expected: DataFrame) -> DataFrame:
    known = arrivals.select("path", "size").join(expected, ["path", "size"])
    dealt = known.withColumn("key", F.pmod(F.xxhash64("archive"), F.lit(KEYS)))
    return dealt.groupBy("key").transformWithStateInPandas(_gathered(), StructType.fromDDL(RELEASED), "Append", "None")


@contextmanager
def _state_store(spark: SparkSession):
    before = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER[0], before) if before else spark.conf.unset(PROVIDER[0])


def ingest_archives(spark: SparkSession, arrivals: DataFrame, listing: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Land every archive that is whole by now in ``out``, as ``list_archives`` would give it; returns the finished query.

    The next run goes on with the parts that have arrived so far. A batch that is repeated replaces what it landed.
    ``index_archives`` takes what ``landed_archives`` reads.
    """

    def land(batch: DataFrame, number: int) -> None:
        one = F.struct(F.col("idx").cast("decimal(38,0)").alias("idx"), "path", "size")
        archives = batch.groupBy("archive").agg(F.sort_array(F.collect_list(one)).cast(PARTS).alias("parts"))
        archives.withColumn("whole", F.lit(False)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    expected = stage(expected_parts(listing), "expected")  # every batch joins it
    with _state_store(spark):
        stream = _released(arrivals, expected).writeStream.outputMode("append").foreachBatch(land)
        query = stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def landed_archives(spark: SparkSession, out: str) -> DataFrame:
    """(archive, parts, whole) of the archives released so far."""
    return spark.read.parquet(out).select("archive", "parts", "whole")
