"""Collocations by SON partitioning: phrases frequent in a shard at its share of the support, then counted everywhere.

The corpus is cut into ``SHARDS`` shards, however large it is, so a phrase that it has ``support`` times is there at least
``support / SHARDS`` times in one of them. Shards are mined completely at this support, word by word longer: their tasks send the sums of
all phrases whose parts are candidates, and what a shard has often enough joins the candidates of that length. A second pass counts all
candidates in the whole corpus, exactly; a third fetches what the frequent ones say.

Only hashes and sums are shuffled. Filters that travel to the tasks are bitmaps of bounded
size; what they let through wrongly is counted and falls to the support, so it costs time only.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.memory import released
from pairloom.llm.words import Words, chain, chunks
from pairloom.runtime import stage

SUPPORT = 30
LONGEST = 4
SHARE = 80  # per cent of its occurrences that a phrase may have inside a longer candidate
TOP = 2000
SHARDS = 8
BLOCK_WORDS = 8 << 20  # words of a task, and keys that it holds and sums up at a time
FILTER_BITS = 27  # at most 16 MB a filter
BITS_A_KEY = 32
ROWS = 100_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09]] = True
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True


class Pieces(Words):
    """Words ``[^\\x20\\x09]+`` of pieces between ``[.,;:!?\\x0A-\\x0D]``, A-Z lowered; ``joined`` tells whether the next word is in the same piece."""

    def __init__(self, texts: list):
        self.bytes = b"\n".join([(t or "").encode() for t in texts] + [b""]).lower()
        self.data = np.frombuffer(self.bytes, dtype=np.uint8)
        cut = _BREAK[self.data]
        apart = np.r_[True, cut | _SPACE[self.data]]
        edges = np.flatnonzero(apart[1:] != apart[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        piece = np.cumsum(cut, dtype=np.int32)[self.starts]
        self.joined = np.r_[piece[1:] == piece[:-1], False] if len(piece) else np.zeros(0, bool)


class Block:
    """Words of some texts of one language. A phrase's hash begins with its language's."""

    def __init__(self, lang: str, texts: list):
        p = Pieces(texts)
        self.lang, self.size = lang, len(p.starts)
        self.bytes, self.starts, self.ends = p.bytes, p.starts, p.ends
        self.hashes, self.joined = p.hashes(), p.joined
        salt = np.frombuffer(lang.encode() + b"\0" * (-len(lang.encode()) % 8), np.uint64)
        self.salt = np.array([len(lang) + 1], np.uint64)
        for x in salt:
            self.salt = chain(self.salt, x)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of all words."""
        return np.arange(self.size, dtype=np.int32), chain(self.salt, self.hashes)

    def longer(self, at: np.ndarray, keys: np.ndarray, length: int, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of phrases one word longer than ``length``, where the phrase at ``at`` and the one after it are both ``held``."""
        good = np.zeros(self.size + 1, bool)
        good[at[held]] = True
        some = held & good[at + 1] & self.joined[at + (length - 1)]
        at = at[some]
        return at, chain(keys[some], self.hashes[at + length])

    def keys(self, at: np.ndarray, length: int) -> np.ndarray:
        """Keys of the phrases of ``length`` words at these places."""
        out = chain(self.salt, self.hashes[at])
        for i in range(1, length):
            out = chain(out, self.hashes[at + i])
        return out

    def phrase(self, at: int, length: int) -> str:
        return b" ".join(self.bytes[self.starts[i] : self.ends[i]] for i in range(at, at + length)).decode()


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """A task's rows (text, lang) in blocks of one language and a chunk of text; phrases end with their texts, so a block needs no other."""
    for batch in batches:
        langs = batch.column("lang")
        for lang in pc.unique(langs).to_pylist():
            for part in chunks(batch.filter(pc.equal(langs, lang))):
                yield Block(lang, part.column("text").to_pylist())


def key_filter(keys: DataFrame) -> Broadcast:
    """A bitmap of all ``key`` values by their lowest bits, of 2**FILTER_BITS bits at most."""
    spark = keys.sparkSession
    bits = min(FILTER_BITS, max(15, (keys.count() * BITS_A_KEY).bit_length()))
    at = keys.select((F.col("key").bitwiseAND((1 << bits) - 1) + 1).alias("at"))
    parts = at.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    table = np.zeros(1 << (bits - 3), np.uint8)
    for r in parts:
        table[(r.part - 1) << 12 : r.part << 12] = np.frombuffer(r.bits, np.uint8)
    return spark.sparkContext.broadcast(table)


def held(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = np.empty(len(keys), bool)
    for lo in range(0, len(keys), ROWS):
        at = keys[lo : lo + ROWS] & np.uint64(8 * len(table) - 1)
        out[lo : lo + ROWS] = table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
    return out


def _rows(**columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(columns.values())))
    for lo in range(0, n, ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + ROWS]) for c in columns.values()], names=list(columns))


def _signed(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.int64)


def _counted(parts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys and how often they are in the parts, which are used up, ``ROWS`` at a time."""
    keys = np.empty(sum(map(len, parts)), np.uint64)
    end = len(keys)
    while parts:  # so that what is copied is free at once
        part = parts.pop()
        keys[end - len(part) : end] = part
        end -= len(part)
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    for lo in range(0, len(first), ROWS):
        some = first[lo : lo + ROWS + 1]
        yield keys[some[:ROWS]], np.diff(some if len(some) > ROWS else np.r_[some, len(keys)])


def tallied(parts: Iterator[tuple[str, np.ndarray]], limit: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Label, keys and their sums, whenever about ``limit`` keys over all labels have come. Nothing but keys is held."""
    held: dict[str, list] = {}
    size = 0
    for label, keys in parts:
        held.setdefault(label, []).append(keys)
        size += len(keys)
        if size >= limit:
            yield from _sums(held)
            size = 0
    yield from _sums(held)


def _sums(held: dict[str, list]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    while held:
        label, parts = held.popitem()
        for keys, n in _counted(parts):
            yield label, keys, n


def word_counts(texts: DataFrame, limit: int) -> DataFrame:
    """(lang, key, n): occurrences of each word in about ``limit`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, keys, n in tallied(((b.lang, b.words()[1]) for b in blocks(batches)), limit):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(_signed(keys)), pa.array(n)], names=["lang", "key", "n"])

    return texts.mapInArrow(released(run), "lang string, key long, n long")


def _climb(block: Block, filters: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and keys of the phrases of 1, 2 ... words whose shorter parts all pass the filter of their length."""
    at, keys = block.words()
    yield at, keys
    for length, table in enumerate(filters, 1):
        at, keys = block.longer(at, keys, length, held(keys, table))
        yield at, keys


def _last(steps: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    for _, keys in steps:
        pass
    return keys


def mine(texts: DataFrame, filters: list[Broadcast], shards: int, least: int, limit: int) -> DataFrame:
    """(key) of the phrases, one word longer than there are filters, that a shard has ``least`` times.

    A shard is every ``shards``-th task's rows; its sums are put together from those of its tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tables = TaskContext.get().partitionId() % shards, [f.value for f in filters]
        for _, keys, n in tallied((("", _last(_climb(b, tables))) for b in blocks(batches)), limit):
            yield from _rows(key=_signed(keys), n=n, shard=np.full(len(keys), shard, np.int32))

    # a task's sums differ already: they are dealt out as they are, without a table of them in each task
    sums = texts.mapInArrow(released(run), "key long, n long, shard int").repartition("key").groupBy("key", "shard").agg(F.sum("n").alias("n"))
    return sums.where(F.col("n") >= least).select("key").distinct()


def count(texts: DataFrame, filters: list[Broadcast], limit: int) -> DataFrame:
    """(key, n, part): occurrences of all candidates of 2 words or more, and the first of the tasks that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, part = [f.value for f in filters], TaskContext.get().partitionId()
        found = (("", keys[held(keys, t)]) for b in blocks(batches) for (_, keys), t in zip(_climb(b, tables[:-1]), tables, strict=True) if t is not tables[0])
        for _, keys, n in tallied(found, limit):
            yield from _rows(key=_signed(keys), n=n, part=np.full(len(keys), part, np.int32))

    sums = texts.mapInArrow(released(run), "key long, n long, part int").repartition("key")
    return sums.groupBy("key").agg(F.sum("n").alias("n"), F.min("part").alias("part"))


def _owned(found: DataFrame) -> DataFrame:
    """(key): a hash of key and part together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, part = batch.column("key").to_numpy().view(np.uint64), batch.column("part").to_numpy().astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(chain(keys, part)))], names=["key"])

    return found.select("key", "part").mapInArrow(run, "key long")


def tell(texts: DataFrame, filters: list[Broadcast], wanted: Broadcast, owned: bool) -> DataFrame:
    """(lang, key, phrase, heads, tails, inner): what phrases say, and the keys of their parts.

    Of phrases whose parts pass ``filters``, those that ``wanted`` holds; by key and task if ``owned``, so that about one task tells each.
    ``heads`` and ``tails`` are the two parts of each cut; ``inner`` all shorter phrases of 2 words or more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, part = [f.value for f in filters], np.array([TaskContext.get().partitionId()], np.uint64)
        done = np.zeros(0, np.uint64)  # keys of what this task has told, in order
        for block in blocks(batches):
            for size, (at, keys) in enumerate(_climb(block, tables), 1):
                if size > 1:
                    good = held(chain(keys, part) if owned else keys, wanted.value)
                    keys, first = np.unique(keys[good], return_index=True)
                    place, new = np.searchsorted(done, keys), np.ones(len(keys), bool)
                    inside = place < len(done)
                    new[inside] = done[place[inside]] != keys[inside]
                    done = np.insert(done, place[new], keys[new])
                    keys, at = keys[new], at[good][first[new]]
                    for lo in range(0, len(at), ROWS):
                        yield _told(block, at[lo : lo + ROWS], keys[lo : lo + ROWS], size)

    return texts.mapInArrow(released(run), "lang string, key long, phrase string, heads array<long>, tails array<long>, inner array<long>")


def _told(block: Block, at: np.ndarray, keys: np.ndarray, size: int) -> pa.RecordBatch:
    heads = [block.keys(at, k) for k in range(1, size)]
    tails = [block.keys(at + k, size - k) for k in range(1, size)]
    inner = [block.keys(at + k, m) for m in range(2, size) for k in range(size - m + 1)]

    def lists(columns: list[np.ndarray]) -> pa.Array:
        values = np.stack(columns, axis=1).ravel() if columns else np.zeros(0, np.uint64)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * len(columns)), pa.array(_signed(values)))

    said = [block.phrase(i, size) for i in at.tolist()]
    columns = [pa.array([block.lang] * len(said), pa.string()), pa.array(_signed(keys)), pa.array(said, pa.string()), *map(lists, (heads, tails, inner))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "key", "phrase", "heads", "tails", "inner"])


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All phrases that a language has ``support`` times, the counts of their parts, and its number of words.

    (lang, key, phrase, a, heads, tails, inner) of phrases of 2 to ``longest`` words, (key, f) of these and of all words that are
    there so often, and (lang, n). Keys are 64-bit hashes of language and words.
    Texts may be null or empty; a null lang is ``und``. Rows that repeat count as often.
    """
    texts = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    words = stage(word_counts(texts, block_words).repartition("lang", "key").groupBy("lang", "key").agg(F.sum("n").alias("n")), "words")
    sizes = stage(words.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    texts = texts.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // block_words)))
    often = words.where(F.col("n") >= support).select("key", F.col("n").alias("f"))
    filters = [key_filter(often)]
    for _ in range(1, longest):
        filters.append(key_filter(stage(mine(texts, filters, shards, -(-support // shards), block_words), "candidates")))
    found = stage(count(texts, filters, block_words).where(F.col("n") >= support), "found")
    owned = key_filter(_owned(found))
    told = stage(tell(texts, filters[:-1], owned, True).join(found.select("key"), "key", "left_semi"), "told")
    missing = stage(found.join(told.select("key"), "key", "left_anti").select("key"), "missing")
    if not missing.isEmpty():  # tasks were cut in another way than before, as when files have moved
        rest = key_filter(missing)
        told = stage(told.unionByName(tell(texts, filters[:-1], rest, False).join(missing, "key", "left_semi")), "told")
        rest.destroy()
    for f in [*filters, owned]:
        f.destroy()
    one = told.groupBy("key").agg(F.min(F.struct("lang", "phrase", "heads", "tails", "inner")).alias("p"))
    phrases = one.join(found.select("key", F.col("n").alias("a")), "key").select("key", "a", "p.*")
    return stage(phrases, "phrases"), often.union(found.select("key", "n")), sizes


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, share: int = SHARE, top: int = TOP, shards: int = SHARDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by score, a, and phrase.

    A phrase of 2 to ``longest`` words with a >= ``support`` occurrences is scored by the weakest of its cuts in two:
    2000000 * a div (l + r), with the parts' occurrences l and r; ties go to the first cut. It is left out
    if any longer candidate that holds it has ``share`` per cent of a or more. n is the language's number of words.

    ``docs`` has text and lang (null: ``und``) and perhaps other columns. Null and empty texts have no words; rows that
    repeat count as often; no rows give none.
    """
    phrases, known, sizes = frequent_phrases(docs, support, longest, shards, block_words)
    cuts = phrases.selectExpr("key", "a", "posexplode(arrays_zip(heads, tails)) AS (cut, c)").selectExpr("key", "a", "cut", "c.heads AS head", "c.tails AS tail")
    cuts = cuts.join(known.toDF("head", "l"), "head").join(known.toDF("tail", "r"), "tail")
    weakest = F.min(F.expr("struct(CAST(2000000 * CAST(a AS DECIMAL(30, 0)) div (CAST(l AS DECIMAL(30, 0)) + r) AS LONG) AS score, cut, l, r)")).alias("m")
    scored = cuts.groupBy("key").agg(weakest).select("key", "m.*")
    around = phrases.selectExpr("a", "explode(inner) AS key").groupBy("key").agg(F.max("a").alias("longer"))
    left = phrases.select("key", "lang", "phrase", "a").join(around, "key", "left").where(f"longer IS NULL OR 100 * CAST(longer AS DECIMAL(30, 0)) < {share} * CAST(a AS DECIMAL(30, 0))")
    ranked = left.join(scored, "key").selectExpr("*", "row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank").where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").selectExpr("lang", "CAST(rank AS LONG) AS rank", "phrase", "a", "l", "r", "n", "score")
