"""Best-fit packing of token sequences by hierarchical residual packing.

Every task packs its own pieces best-fit; nearly full bins are final. Underfull
bins become items of the next round, which fewer tasks pack, and so on up a tree.
"""

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.memory import released
from pairloom.llm.words import chunks
from pairloom.runtime import stage

CAPACITY = 2048
END_ID = 0
FULL = 0.995
FAN_IN = 8
ITEMS_PER_TASK = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids binary"


@lru_cache(maxsize=2)
def _encoder(ranks_path: str):
    """tiktoken over the ranks of the byte-level BPE: the same ids as the JSON file in ``tokenizers``, four times as fast.

    Special tokens' strings are ordinary text.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else a shorter first piece and full ones."""
    first = length if length <= capacity else length % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def tokenize(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document's ids, each document ended by id 0; ``ids`` are little-endian 32-bit numbers.

    Null text counts as empty and gives one piece, the end id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks_path).encode_ordinary
        for whole in batches:
            for batch in chunks(whole):
                rows = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                    rows += [(doc, i, s, n, ids[s : s + n].tobytes()) for i, (s, n) in enumerate(cut(len(ids), capacity))]
                columns = list(zip(*rows, strict=True))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(released(run), PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; long items first, each into the fullest bin that still takes it."""
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made = 0, 0  # bit r of rooms: some bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            room, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - room
        if room > n:
            if not free[room - n]:
                rooms |= 1 << (room - n)
            free[room - n].append(b)
    return bins, offsets


def _pack_round(items: DataFrame, keys: str, level: int, capacity: int) -> DataFrame:
    """Adds ``bin`` and ``offset``, packing each partition for itself. Partitions hold numbers only."""
    names = [k.split()[0] for k in keys.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        table = table.sort_by([(n, "ascending") for n in names])
        bins, offsets = best_fit(table.column("length").to_numpy(), capacity)
        bins += (level << 56) + (TaskContext.get().partitionId() << 32)
        yield from table.append_column("bin", pa.array(bins)).append_column("offset", pa.array(offsets)).combine_chunks().to_batches(100_000)

    return items.select(*names, "length").mapInArrow(released(run), f"{keys}, length long, bin long, offset long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, full: float = FULL) -> DataFrame:
    """(doc_id, piece, sequence_id, offset) of every piece; ``pieces`` must be a staged table with unique (doc_id, piece, start).

    Each round has fewer tasks, by ``FAN_IN``, but enough for ``ITEMS_PER_TASK``
    underfull bins each (three numbers a bin); the round with so few is the last.
    """
    placed = stage(_pack_round(pieces, "doc_id long, piece int, nr long", 0, capacity), "packed")
    tasks = placed.select(F.shiftright("bin", 32)).distinct().count()
    merges, level, last, bins = [], 0, False, placed
    while not last:
        level += 1
        open_bins = bins.groupBy("bin").agg(F.sum("length").alias("length")).where(F.col("length") < int(capacity * full))
        open_bins = stage(open_bins.withColumnRenamed("bin", "part"), "open")
        need = -(-open_bins.count() // ITEMS_PER_TASK)
        if not need:
            break
        tasks = max(need, tasks // FAN_IN)
        last = tasks == need
        bins = stage(_pack_round(open_bins.repartition(tasks, F.xxhash64("part")), "part long", level, capacity), "merged")
        merges.append(bins.select("part", "bin", "offset"))
    root = None  # where each part of a round ends up, from the last round down
    for m in reversed(merges):
        if root is None:
            root = m
        else:
            up = root.select(F.col("part").alias("bin"), F.col("bin").alias("to"), F.col("offset").alias("more"))
            root = m.join(up, "bin", "left").select("part", F.coalesce("to", "bin").alias("bin"), (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"))
    if root is not None:
        up = root.select(F.col("part").alias("bin"), F.col("bin").alias("to"), F.col("offset").alias("more"))
        placed = placed.join(up, "bin", "left").withColumns({"offset": F.col("offset") + F.coalesce("more", F.lit(0)), "bin": F.coalesce("to", "bin")})
    return placed.select("doc_id", "piece", "nr", F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, keep: Sequence[Column | str] = ("ids",)) -> DataFrame:
    """Pieces with their ids and place: doc_id, piece, start, length, ids, sequence_id, offset.

    ``keep`` may name what is wanted of the ids instead; it is computed where a
    text is tokenized, so that ids nobody wants are neither written nor shuffled.

    Rows that repeat a doc_id are packed as documents of their own. No rows give
    no rows; null and empty texts are one end id; other columns are ignored.
    """
    pieces = tokenize(docs, ranks_path, capacity).withColumn("nr", F.monotonically_increasing_id())
    pieces = stage(pieces.select("nr", "doc_id", "piece", "start", "length", *keep), "pieces")
    return pieces.join(pack(pieces, capacity).drop("doc_id", "piece"), "nr")
