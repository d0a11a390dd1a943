"""Similarity join of shingle sets: size-banded tiles, bitmap bounds, exact intersection.

Equal sets become one class first. Two sets can only be similar if they share one
of their rarest shingles (a prefix of a common order), so classes meet by prefix
shingle. A first round links each class to the hub it shares most with; in the
second, tiles of classes of like size that are still apart compare hashed bitmaps,
whose bit counts bound the overlap from above, and sorted arrays decide.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.graph import components
from pairloom.llm.memory import released
from pairloom.llm.words import Words, chain, chunks, mix
from pairloom.runtime import stage

SIZE = 4
PERCENT = 85
SAMPLE_ROWS = 10_000  # documents from which common shingles are learned; this orders shingles and affects speed only
COMMON = 200_000  # common shingles at most
COMMON_FROM = 3
TILE = 512  # classes a side
SHORT_WORDS = 128  # 64-bit words of a bitmap at most where it stands beside every prefix shingle
FILTER_BITS = 24  # log2 of the bits of the filter that picks the documents to compare; 2 MB


def shingle_sets(texts: list, size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; fewer words make one shingle, no words none."""
    words = Words(texts)
    h = words.hashes()
    rolled = h.copy()
    for k in range(1, size):
        rolled[: len(h) - k] = chain(rolled[: len(h) - k], h[k:])
    out = []
    for lo, n in zip(words.first[:-1].tolist(), words.count.tolist(), strict=True):
        if n >= size:
            out.append(np.unique(rolled[lo : lo + n - size + 1]))
        elif n:
            x = np.full(1, n, dtype=np.uint64)
            for w in h[lo : lo + n]:
                x = chain(x, np.full(1, w, dtype=np.uint64))
            out.append(x)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(a) for a in arrays])]
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64)))


def bitmap(hashes: np.ndarray) -> bytes:
    """Bits at the hashes' low ends, at least four times as many as hashes; the number is a power of two."""
    width = max(64, 1 << (4 * len(hashes) - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[(mix(hashes) & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap as if it had been made with a smaller width."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def _short(bits: bytes) -> bytes:
    words = np.frombuffer(bits, np.uint64)
    return _fold(words, min(len(words), SHORT_WORDS)).tobytes()


def prefix_length(n: int, percent: int) -> int:
    """A similar set holds at least percent * n / 100 of n elements, so it holds one of these many."""
    return n - -(-percent * n // 100) + 1 if n else 0


def common_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """Hashes that several documents of a sample share, from the most to the least frequent."""
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    lot = F.shiftrightunsigned(F.xxhash64("text", F.lit(13)), 11) / float(1 << 53)
    sample = docs.select("text").where(lot < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                sets = shingle_sets(batch.column("text").to_pylist(), size)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["shingle"])

    counts = sample.distinct().mapInArrow(released(run), "shingle long").groupBy("shingle").count().where(F.col("count") >= COMMON_FROM)
    top = counts.orderBy(F.desc("count"), "shingle").limit(COMMON).select("shingle").toPandas()
    return top.shingle.to_numpy(dtype=np.int64).view(np.uint64)


def signatures(docs: DataFrame, common: np.ndarray, size: int, percent: int) -> DataFrame:
    """(doc_id, n, h1, h2, prefix, bits, short): size and hash of the set, its rarest shingles, its bitmap, whole and folded."""
    by = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[by], len(common) - by))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ranks = shared.value
        for whole in batches:
            for batch in chunks(whole):
                sets = shingle_sets(batch.column("text").to_pylist(), size)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                prefixes, hashes = [], np.zeros((len(sets), 2), dtype=np.uint64)
                for i, s in enumerate(sets):
                    if not len(s):
                        prefixes.append(s)
                        continue
                    hashes[i] = s.sum(), mix(s + np.uint64(77)).sum()
                    rank = np.zeros(len(s), dtype=np.int64)
                    if len(keys):
                        at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                        rank = np.where(keys[at] == s, ranks[at], 0)
                    prefixes.append(s[np.argsort(rank, kind="stable")[: prefix_length(len(s), percent)]])
                columns = [batch.column("doc_id"), pa.array(n), *(pa.array(np.ascontiguousarray(hashes[:, k]).view(np.int64)) for k in (0, 1))]
                maps = [bitmap(s) for s in sets]
                columns += [_lists(prefixes), pa.array(maps, pa.binary()), pa.array([_short(m) for m in maps], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "h1", "h2", "prefix", "bits", "short"])

    return docs.select("doc_id", "text").mapInArrow(released(run), "doc_id long, n long, h1 long, h2 long, prefix array<long>, bits binary, short binary")


def id_filter(ids: DataFrame) -> np.ndarray:
    """Bits at the hashes of all ids, a table of fixed size."""
    at = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))
    parts = ids.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    bits = np.zeros((1 << FILTER_BITS) + 32768, dtype=bool)
    for r in parts:  # buckets count from 1; bucket 0 holds value 0
        lo = (r.part - 1) * 32768
        found = np.flatnonzero(np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little"))
        bits[found + lo + 1 if r.part else found] = True
    return bits


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of class ids that are similar, by intersection of sorted arrays.

    Texts do not move: documents that a filter of ids may hold are shingled where they lie, and only their sets are shuffled.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(id_filter(wanted), bitorder="little"))

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for whole in batches:
            at = whole.column("at").to_numpy()
            held = (bits[at >> 3] >> (at & 7) & 1).astype(bool)
            for batch in chunks(whole.filter(pa.array(held))):
                yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(shingle_sets(batch.column("text").to_pylist(), size))], names=["id", "s"])

    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text")
    texts = named.withColumn("at", F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS)))
    sets = stage(texts.mapInArrow(released(shingle), "id long, s array<long>"), "sets")
    shared.destroy()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("s"), batch.column("t")
            good = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                x, y = left[i].values.to_numpy().view(np.uint64), right[i].values.to_numpy().view(np.uint64)
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                good[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)), batch.column("b").filter(pa.array(good))], names=["a", "b"])

    left = pairs.join(sets.selectExpr("id AS b", "s"), "b")
    return left.join(sets.selectExpr("id AS a", "s AS t"), "a").mapInArrow(released(compare), "a long, b long").distinct()


def _bound(n: np.ndarray, m: np.ndarray, bits: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m elements may be similar; every bit that only one bitmap has is an element that only one set has."""
    apart = np.bitwise_count(bits ^ other).sum(-1, dtype=np.int64)
    most = (n + m - apart) // 2
    return 100 * most >= percent * (n + m - most)


def bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for i, (n, m, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n", "m", "x", "y")), strict=True)):
                if 100 * min(n, m) >= percent * max(n, m):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    words = min(len(x), len(y))
                    good[i] = _bound(n, m, _fold(x, words), _fold(y, words), percent)
            yield batch.filter(pa.array(good)).select(["a", "b"])

    left = pairs.join(classes.select(F.col("id").alias("b"), "n", F.col("bits").alias("x")), "b")
    return left.join(classes.select(F.col("id").alias("a"), F.col("n").alias("m"), F.col("bits").alias("y")), "a").mapInArrow(released(run), "a long, b long")


def tile_pairs(ids, comp, n, band, side, raw: list[bytes], percent: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Pairs of one tile that may be similar; ``band`` is 0 or 1 within the tile, ``side`` 2 if the tile is one block."""
    first, second, bits = [], [], None
    for i in range(len(ids)):
        ok = (ids > ids[i]) & (comp != comp[i]) & ((band == 0) | (band[i] == 0)) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
        at = np.flatnonzero(ok & ((side != side[i]) | (side == 2)))
        if not len(at):
            continue
        if bits is None:
            views = [np.frombuffer(b, dtype=np.uint64) for b in raw]
            words = min(map(len, views))
            bits = np.stack([_fold(v, words) for v in views])
        at = at[_bound(n[at], n[i], bits[at], bits[i], percent)]
        first.append(np.full(len(at), ids[i]))
        second.append(ids[at])
    return first, second


def tiles(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of ``rows(token, id, set, component, n)``; ``classes`` has the bitmaps.

    A tile has one token and two neighbouring size bands; of tokens with the same
    classes (by 128 bits of hash; each class must be there once, or its hashes cancel out) one is enough. Large tiles are cut
    into blocks, and every pair of blocks is a tile of its own, so no task holds a whole group.
    """
    width = math.log(100 / percent) * 1.0001
    banded = rows.withColumn("size_band", F.floor(F.log("n") / width)).withColumn("tile", F.explode(F.array(F.col("size_band"), F.col("size_band") - 1)))
    members = [F.bit_xor(F.xxhash64("id", "set", F.lit(k))).alias(f"m{k}") for k in (1, 2)]
    counts = banded.groupBy("token", "tile").agg(F.count("*").alias("members"), F.min("component").alias("c0"), F.max("component").alias("c1"), F.min(F.col("size_band") - F.col("tile")).alias("lowest"), *members)
    counts = counts.where("c0 <> c1 AND lowest = 0").groupBy("tile", "members", "m1", "m2").agg(F.min("token").alias("token"))
    counts = counts.select("token", "tile", F.ceil(F.col("members") / TILE).cast("int").alias("blocks"))
    cut = banded.join(counts, ["token", "tile"]).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("token", "tile", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "id", "component", "n",
                     (F.col("size_band") - F.col("tile")).cast("int").alias("band"), F.expr("CASE WHEN block = other THEN 2 WHEN block < other THEN 0 ELSE 1 END").alias("side"))
    cut = cut.join(classes.select("id", F.col("short").alias("bits")), "id")

    keys = ["token", "tile", "x", "y"]

    def pairs(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        columns = [table.column(c).to_numpy() for c in ("id", "component", "n", "band", "side")]
        raw, first, second = table.column("bits").to_pylist(), [], []
        for lo, hi in zip(starts, np.r_[starts[1:], table.num_rows], strict=True):
            a, b = tile_pairs(*(c[lo:hi] for c in columns), raw[lo:hi], percent)
            first += a
            second += b
        none = [np.zeros(0, dtype=np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x + none)) for x in (first, second)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            starts = _starts(table, keys)
            if len(starts) > 1:  # the last tile may go on in the next batch
                yield pairs(table.slice(0, starts[-1]), starts[:-1])
            rest = table.slice(starts[-1])
        if rest is not None:
            yield pairs(rest, np.zeros(1, dtype=np.int64))

    return cut.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(released(run), "a long, b long").distinct()


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for k in keys:
        c = table.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def similar_components(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; linked documents share the smallest doc_id.

    Texts without words are linked with nothing. Rows that repeat a doc_id or a
    text are kept; rows of one doc_id are one node, and copies of a text with words
    share a component.
    Other columns are ignored; no rows give no rows. A null doc_id is not a
    component's name while another document can give one.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = stage(signatures(docs, common_shingles(docs, size), size, percent).withColumn("nr", F.monotonically_increasing_id()), "signed")
    some = signed.where("n > 0")
    classes = some.groupBy("h1", "h2").agg(F.min("doc_id").alias("id"))
    nodes = some.groupBy("doc_id", "h1", "h2").agg(F.min("nr").alias("nr")).join(classes.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    one = some.join(nodes.select("nr"), "nr", "left_semi")  # each set of a doc_id once, however often it is there
    one = stage(one.select(F.col("doc_id").alias("id"), F.col("h1").alias("set"), "n", "prefix", "bits", "short"), "classes")
    tokens = one.select(F.explode("prefix").alias("token"), "id", "set", "n")
    shared = tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    shared = stage(tokens.join(shared, "token"), "shared")

    width = math.log(100 / percent)
    banded = shared.withColumn("band", F.floor(F.log("n") / width))
    hubs = banded.groupBy("token", "band").agg(F.min("id").alias("a"), F.count("*").alias("members")).where("members > 1")
    common = banded.join(hubs, ["token", "band"]).where("a <> id").groupBy("id", "a").agg(F.count("*").alias("c"))
    best = common.groupBy("id").agg(F.max(F.struct("c", F.negative("a").alias("a"))).alias("best"))
    first = stage(verified(stage(bounded(best.selectExpr("-best.a AS a", "id AS b"), one, percent), "pairs"), docs, size, percent), "links")
    joined = stage(components(first), "joined")

    apart = shared.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_tokens = apart.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
    met = stage(tiles(apart.join(open_tokens, "token"), one, percent), "met")
    more = verified(stage(bounded(met, one, percent), "pairs"), docs, size, percent)
    final = components(first.union(more))

    names = classes.join(final, "id", "left").select("h1", "h2", F.coalesce("component", "id").alias("component"))
    out = signed.join(names, ["h1", "h2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
