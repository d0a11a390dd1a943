"""N-gram language model in Elias-Fano tries, and scoring of documents with it.

Texts are kept as blocks of word numbers. Counts of all training n-grams meet in
shards by context; each shard is a trie of two Elias-Fano levels (contexts, and
successors relative to their context) with quantised smoothed probabilities. It is
mapped into memory and answers the n-grams that the blocks ask for, and the blocks
back off where it has none. Nothing that grows with the corpus reaches the driver
or a single task.
"""

import mmap
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.eliasfano import EliasFano, from_blob, to_blob
from pairloom.llm.words import Words, chain, chunks, mix
from pairloom.runtime import stage_alone, staged_halves

ORDER = 3
BLOCK_BYTES = 4 << 20
SHARD_CHARS = 8_000_000  # characters of text a shard
HOT = 500_000  # occurrences of a context from which its successors are dealt over all shards
END = np.uint64(1)  # key of the end of a text, also the context of its first word
PRIOR = {2: 50.0, 3: 5.0}  # weight of the shorter context, in occurrences
LEVELS = 256  # quantised probabilities a shard
ROWS = "block long, shard int, blob binary"


def _crush(*arrays: np.ndarray) -> bytes:
    """Compressed arrays; bytes of one significance lie together."""
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.kind), a.itemsize, len(a)))], dtype=np.int64).tobytes()
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T) for a in map(np.ascontiguousarray, arrays)]
    return zstandard.compress(b"".join([head, *planes]), 1)


def _uncrush(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    shape, at, out = np.frombuffer(raw, np.int64, 3 * count, 8).tolist(), 8 + 24 * count, []
    for i in range(count):
        kind, size, n = shape[3 * i : 3 * i + 3]
        planes = np.frombuffer(raw, np.uint8, size * n, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"{chr(kind)}{size}"))
        at += size * n
    return out


def _least(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the smallest type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _deal(by: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of the items by shard, and where each shard's part begins."""
    order = np.argsort(by, kind="stable")
    return order, np.searchsorted(by[order], np.arange(shards + 1))


def _places(order: np.ndarray) -> np.ndarray:
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.arange(len(order))
    return back


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct key, in the order of keys, and for every key its number in that order."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]][: len(keys)]
    at = np.empty(len(keys), dtype=np.int64)
    at[order] = np.cumsum(new) - 1
    return order[new], at


ONE_BYTE = 192  # codes below take a byte


def _short(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes as first bytes, the lower bits of those from ``ONE_BYTE`` on, and how many bits these are."""
    far = np.flatnonzero(codes >= ONE_BYTE)
    rest = codes[far] - ONE_BYTE
    bits = max(0, int(rest.max(initial=0)).bit_length() - 6)
    first = codes.astype(np.uint8)
    first[far] = ONE_BYTE + (rest >> bits)
    return first, _least(rest & ((1 << bits) - 1)), np.array([bits], np.uint8)


def _long(first: np.ndarray, rest: np.ndarray | None = None, bits: np.ndarray | None = None) -> np.ndarray:
    codes = first.astype(np.int64)
    if rest is not None:
        far = np.flatnonzero(codes >= ONE_BYTE)
        codes[far] = ONE_BYTE + (codes[far] - ONE_BYTE << int(bits[0]) | rest.astype(np.int64))
    return codes


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of nearly ``BLOCK_BYTES`` of text, whatever batches they come in; a longer text is one of its own."""
    held, size = [], 0
    for whole in batches:
        for batch in chunks(whole, limit=BLOCK_BYTES >> 3):
            more = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
            if held and size + more > BLOCK_BYTES:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(batch)
            size += more
    if held:
        yield pa.concat_batches(held)


def tokenize(docs: DataFrame, train: Column, shards: int) -> DataFrame:
    """Blocks of whole texts, in rows (block, shard, blob, ids).

    A block's own row has shard -1; its blob holds, per text, whether it trains and
    its tokens' number, and all tokens as codes of the block's distinct words,
    which go to their shards with their occurrences in training texts, the most frequent first. The code
    of the i-th word that shard s gets is i * shards + s, so frequent words have small ones. Each text ends with ``END``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in _together(batches):
            words = Words(batch.column("text").to_pylist())
            n = words.count + 1
            keys = np.full(int(n.sum()), END, dtype=np.uint64)
            keys[np.arange(len(words.starts)) + words.doc] = np.maximum(words.hashes(), np.uint64(2))
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            distinct, at = np.unique(keys, return_inverse=True)
            times = np.bincount(at[np.repeat(train, n)], minlength=len(distinct))
            by = np.argsort((65535 - np.minimum(np.bincount(at), 65535)).astype(np.uint16), kind="stable")
            shard = (mix(distinct) % np.uint64(shards)).astype(np.int64)
            order, cuts = _deal(shard[by], shards)
            order = by[order]
            code = np.empty(len(order), dtype=np.int64)
            code[order] = (np.arange(len(order)) - cuts[shard[order]]) * shards + shard[order]
            rows = [(-1, _crush(train.view(np.uint8), _least(n), *_short(code[at])))]
            rows += [(s, _crush(distinct[order[lo:hi]], _least(times[order[lo:hi]]))) for s, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if lo < hi]
            ids = [batch.column("id").to_pylist()] + [None] * (len(rows) - 1)
            numbers, blobs = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(rows), pa.int64()), pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary()), pa.array(ids, pa.list_(pa.int64()))], names=["block", "shard", "blob", "ids"])
            block += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"), train.alias("train"))
    return rows.mapInArrow(run, f"{ROWS}, ids array<long>")


def _table(shard: int, rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"block": pa.array([b for b, _ in rows], pa.int64()), "shard": pa.array([shard] * len(rows), pa.int32()), "blob": pa.array([b for _, b in rows], pa.binary())})


def _serve_words(shards: int):
    """For one shard of the vocabulary: count its words, number them, and answer each block. Block -1 gets the sums.

    The word of rank r in shard s has the number (r - 1) * shards + s + 1; answers have ranks, 0 for unknown words.
    """

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        asked = [_uncrush(b) for b in table.column("blob").to_pylist()]
        keys, at = np.unique(np.concatenate([k for k, _ in asked]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([t for _, t in asked])).astype(np.int64)
        rank = np.where(counts > 0, _places(np.argsort(-counts, kind="stable")) + 1, 0)
        out, lo = [(-1, _crush(np.array([counts.sum(), (counts > 0).sum()], dtype=np.int64)))], 0
        for block, (k, _) in zip(table.column("block").to_pylist(), asked, strict=True):
            own = at[lo : lo + len(k)]
            out.append((block, _crush(_least(rank[own]), _least(counts[own]))))
            lo += len(k)
        return _table(shard, out)

    return run


def _halves(contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts as steps of their upper halves, which are mostly small, and their lower halves."""
    return np.diff(contexts >> np.uint64(32), prepend=np.uint64(0)).astype(np.uint32), _least(contexts & np.uint64(0xFFFFFFFF))


def _whole(steps: np.ndarray, lower: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint32).astype(np.uint64) << np.uint64(32) | lower.astype(np.uint64)


class Block:
    """A block's tokens in order: word, c (0 for unknown words), doc, place in the text, p (log10 so far), and context."""

    def __init__(self, blob: bytes, shards: int, total: int, types: int):
        train, n, *codes = _uncrush(blob)
        self.codes = _long(*codes)
        self.train, self.n = train.astype(bool), n.astype(np.int64)
        self.shards, self.total, self.types, self.order = shards, total, types, 0
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self.place = np.arange(len(self.codes)) - (np.cumsum(self.n) - self.n)[self.doc]
        self.training = np.repeat(self.train, self.n)

    def take(self, answers: dict[int, bytes], last: bool = False, books: dict[int, np.ndarray] | None = None) -> None:
        """Go on to the next order with the shards' answers and what their codes mean; after the last there is none."""
        self.order += 1
        parts = [_uncrush(answers[s]) for s in sorted(answers)]
        if self.order == 1:
            first = np.zeros(self.shards, dtype=np.int64)
            first[sorted(answers)] = np.cumsum([0, *(len(p[0]) for p in parts[:-1])])
            self.at = first[self.codes % self.shards] + self.codes // self.shards
            numbers = [np.where(p[0] > 0, (p[0].astype(np.int64) - 1) * self.shards + s + 1, 0) for s, p in zip(sorted(answers), parts, strict=True)]
            word, c = np.concatenate(numbers).astype(np.uint64)[self.at], np.concatenate([p[1] for p in parts]).astype(np.int64)[self.at]
            self.word, self.c = word, c
            self.p = self.base = np.log10((c + 0.5) / (self.total + 0.5 * (self.types + 1)))
            ends = (np.cumsum(self.n) - 1)[self.doc]  # the end's number also opens a text
            self.context = np.where(self.place > 0, np.roll(word, 1), word[ends])
            self.context_n = np.where(self.place > 0, np.roll(c, 1), c[ends])
            self.rank = self.context.astype(np.int64)  # a number of the context below 2 ** 31 or so, in this block
        else:
            n, q, hit = np.zeros(len(self.at), dtype=np.int64), np.zeros(len(self.at)), self.at >= 0
            if parts:
                n[hit] = np.concatenate([p[1] for p in parts])[self.at[hit]]
                q[hit] = np.concatenate([books[s][p[0]] for s, p in zip(sorted(answers), parts, strict=True)])[self.at[hit]]
            prior = PRIOR[self.order]
            backed = self.p + np.log10(prior / (self.context_n + prior))
            self.p = np.where(n > 0, q, np.where(self.context_n > 0, backed, self.p))
            if last:
                return
            self.context = (np.roll(self.context, 1) << np.uint64(32)) | np.roll(self.word, 1)
            self.context_n = np.where(self.place > 0, np.roll(n, 1), 0)
            self.rank = np.roll(self.at, 1)
        if not last:
            self._ask()

    def _ask(self) -> None:
        """Distinct n-grams of known words in seen contexts, by shard, context and word; ``at`` is each token's place among them."""
        ask = np.flatnonzero((self.word > 0) & (self.context_n > 0))
        first, at = _distinct((self.rank[ask].astype(np.uint64) << np.uint64(32)) | self.word[ask])
        self.times = np.bincount(at[self.training[ask]], minlength=len(first))
        self.one = ask[first]
        context, word = self.context[self.one], self.word[self.one]
        hot = self.context_n[self.one] > HOT
        self.deal, self.cuts = _deal(mix(np.where(hot, chain(context, word), context)) % np.uint64(self.shards), self.shards)
        self.at = np.full(len(self.word), -1, dtype=np.int64)
        self.at[ask] = _places(self.deal)[at]

    def requests(self) -> Iterator[tuple[int, bytes]]:
        """A shard's n-grams: contexts, their successors' numbers, words, occurrences; and what it can't tell from those.

        It adds up the occurrences of a context itself unless the successors are dealt over all shards. What the shorter
        context gives a word is sent for n-grams of training texts only.
        """
        low = np.round(-self.p[self.one] * 1024).astype(np.uint16)
        for s, (lo, hi) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            if lo < hi:
                part = self.deal[lo:hi]
                one = self.one[part]
                context = self.context[one]
                runs = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
                context_n, times = self.context_n[one[runs]], self.times[part]
                hot = np.flatnonzero(context_n > HOT)
                yield s, _crush(*_halves(context[runs]), _least(np.diff(np.r_[runs, len(one)])), _least(self.word[one]), _least(times), low[part][times > 0], _least(hot), _least(context_n[hot]))


def build_trie(context: np.ndarray, word: np.ndarray, times: np.ndarray, context_n: np.ndarray, low: np.ndarray, prior: float) -> bytes:
    """Trie of sorted, distinct n-grams: contexts; first successor of each; successors relative to their context; codes.

    p = (times + prior * p_shorter) / (context_n + prior), its logarithm rounded to the mean of one of ``LEVELS`` classes of equal width.
    """
    heads = np.flatnonzero(np.r_[True, np.diff(context) != 0][: len(context)])
    owner = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, len(context)]))
    span = int(word.max()) + 1 if len(word) else 1
    p = np.log10((times + prior * 10.0 ** (low / -1024.0)) / (context_n + prior))
    edges = np.linspace(p.min(), p.max(), LEVELS + 1)[1:-1] if len(p) else np.zeros(0)
    code = np.searchsorted(edges, p)
    book = np.bincount(code, p, minlength=len(edges) + 1) / np.maximum(1, np.bincount(code, minlength=len(edges) + 1))
    levels = EliasFano.build(context[heads], "context.") | EliasFano.build(owner.astype(np.uint64) * np.uint64(span) + word, "next.")
    return to_blob(levels | {"span": np.array([span], np.uint64), "book": book.astype(np.float32), "code": code.astype(np.uint8), "seen": _least(np.minimum(times, 2**32 - 1))})


class Trie:
    def __init__(self, buffer):
        self.arrays = from_blob(buffer)
        self.contexts, self.next = (EliasFano(self.arrays, k) for k in ("context.", "next."))

    def find(self, contexts: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Position of each n-gram, or -1; ``lengths`` words follow each context."""
        at = np.repeat(self.contexts.find(contexts), lengths.astype(np.int64))
        span = self.arrays["span"][0]
        inside = (at >= 0) & (words < span)
        found = np.full(len(words), -1, dtype=np.int64)
        found[inside] = self.next.find(at[inside].astype(np.uint64) * span + words[inside].astype(np.uint64))
        return found


AT_ONCE = 1 << 20  # n-grams looked up together


def _groups(sizes: list[int]) -> Iterator[slice]:
    """Neighbours with about ``AT_ONCE`` together."""
    lo, total = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > AT_ONCE:
            yield slice(lo, i)
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield slice(lo, len(sizes))


def _gather(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """The distinct n-grams of training texts in all requests, sorted: context, word, occurrences, those of the context, and ``low``."""
    parts: list[list] = [[] for _ in range(6)]
    for blob in blobs:
        steps, lower, lengths, word, times, low, hot, hot_n = _uncrush(blob)
        contexts, seen = _whole(steps, lower), times > 0
        for part, a in zip(parts, (np.repeat(contexts, lengths)[seen], word[seen].astype(np.uint32), times[seen].astype(np.uint32), low, contexts[hot], hot_n.astype(np.int64)), strict=True):
            part.append(a)
    context, word, times, low, hot, hot_n = (np.concatenate(p) for p in parts)
    by = np.argsort(context)
    context = context[by]
    number = np.cumsum(np.r_[False, context[1:] != context[:-1]][: len(by)]).astype(np.uint64)
    by = by[np.argsort(number << np.uint64(32) | word[by])]  # contexts keep their places
    word = word[by]
    heads = np.flatnonzero(np.r_[True, (context[1:] != context[:-1]) | (word[1:] != word[:-1])][: len(by)])
    context, word, low = context[heads], word[heads].astype(np.uint64), low[by][heads].astype(np.int64)
    times = np.add.reduceat(times[by].astype(np.int64), heads) if len(heads) else np.zeros(0, dtype=np.int64)
    own = number[heads].astype(np.int64)
    context_n = np.bincount(own, times).astype(np.int64)[own]
    if len(hot):
        known, first = np.unique(hot, return_index=True)
        at = np.minimum(np.searchsorted(known, context), len(known) - 1)
        context_n = np.where(known[at] == context, hot_n[first][at], context_n)
    return context, word, times, context_n, low


def _serve(order: int, last: bool, keep: bool):
    """For one shard: build its trie from all requests, map it, and answer each block. The trie itself, if kept, is the row of block -1.

    An answer has the code of each n-gram and how often it was seen (of the last order, whether). What the codes mean is in ``book`` of the first row.
    """

    def run(table: pa.Table) -> pa.Table:
        blocks, blobs = table.column("block").to_pylist(), table.column("blob").to_pylist()
        trie = build_trie(*_gather(blobs), PRIOR[order])
        out = [(-1, trie)] if keep else []
        with tempfile.TemporaryFile() as file:
            file.write(trie)
            file.flush()
            with mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ) as mapped:
                own = Trie(mapped)
                code, seen = (own.arrays[k] for k in ("code", "seen"))
                book = own.arrays["book"].tobytes()
                for some in _groups([len(b) for b in blobs]):
                    asked = [_uncrush(b)[:4] for b in blobs[some]]
                    steps, lower, lengths, word = zip(*asked, strict=True)
                    contexts = np.concatenate([_whole(*a) for a in zip(steps, lower, strict=True)])
                    at = own.find(contexts, np.concatenate(lengths), np.concatenate(word))
                    hit = at >= 0
                    answer = (np.zeros(len(at), np.uint8), np.zeros(len(at), np.uint32))
                    answer[0][hit], answer[1][hit] = code[at[hit]], seen[at[hit]]
                    if last:
                        answer = answer[0], hit.view(np.uint8)
                    cuts = np.cumsum([0, *map(len, word)])
                    for block, lo, hi in zip(blocks[some], cuts[:-1], cuts[1:], strict=True):
                        out.append((block, _crush(answer[0][lo:hi], _least(answer[1][lo:hi]))))
                del own, code, seen
        rows = _table(table.column("shard")[0].as_py(), out)
        return rows.append_column("book", pa.array([book] + [None] * (len(out) - 1), pa.binary()))

    return run


SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _advance(blocks: DataFrame, answers: list[DataFrame], books: dict[int, dict], shards: int, total: int, types: int, last: bool) -> DataFrame:
    """The blocks' next requests, or their documents' scores, after all answers so far. ``books`` has, for each order, what the shards' codes mean."""
    orders = range(1, len(answers) + 1)
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = list(zip(*(right.column(k).to_pylist() for k in ("order", "shard", "blob")), strict=True))
        out = []
        for own in left.to_pylist():
            block = Block(own["blob"], shards, total, types)
            for order in orders:
                block.take({s: b for o, s, b in rows if o == order}, last and order == orders[-1], shared.value.get(order))
            if not last:
                out += [(own["block"], s, b) for s, b in block.requests()]
                continue
            sums = [np.bincount(block.doc, x, minlength=len(block.n)) for x in (block.c > 0, block.base, block.p)]
            out += zip(own["ids"], (~block.train).tolist(), block.n.tolist(), sums[0].astype(int).tolist(), sums[1].tolist(), sums[2].tolist(), strict=True)
        schema = SCORES if last else pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("blob", pa.binary())])
        columns = list(zip(*out, strict=True)) or [[]] * len(schema)
        return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    got = answers[0].withColumn("order", F.lit(1))
    for k, a in enumerate(answers[1:], 2):
        got = got.union(a.drop("book").withColumn("order", F.lit(k)))
    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double" if last else ROWS
    return blocks.groupBy("block").cogroup(got.where("block >= 0").groupBy("block")).applyInArrow(run, kind)


def score(docs: DataFrame, train: Column, order: int = ORDER, keep_model: bool = True) -> tuple[DataFrame, list[DataFrame]]:
    """Scores of all documents by a model of those where ``train`` holds, and the model.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 of the text's probability). The model is, for each order from 2, a table
    (shard, trie) in the shared folder; without ``keep_model`` tries go when their shard has answered. Orders are 2 or 3. Null and empty texts have
    one token, the end. Repeated rows are scored, and counted, each. Without training
    texts all words are unknown. No rows give no rows. Word numbers must stay below 2 ** 32.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-chars // SHARD_CHARS))
    with staged_halves(tokenize(docs, train, shards), "tokens", F.col("shard") == -1) as (blocks, asked):
        served = stage_alone(asked.select("block", "shard", "blob").groupBy("shard").applyInArrow(_serve_words(shards), ROWS), "words")
    answers, books, model = [served], {}, []
    sums = [_uncrush(r.blob)[0] for r in served.where("block = -1").select("blob").collect()]  # two numbers a shard
    total, types = (int(sum(x[k] for x in sums)) for k in (0, 1))
    for k in range(2, order + 1):
        asked = _advance(blocks, answers, books, shards, total, types, False)
        served = stage_alone(asked.groupBy("shard").applyInArrow(_serve(k, k == order, keep_model), f"{ROWS}, book binary"), "answers")
        answers.append(served)
        books[k] = {r.shard: np.frombuffer(r.book, np.float32) for r in served.where("book IS NOT NULL").select("shard", "book").collect()}  # 1 KB a shard
        if keep_model:
            model.append(served.where("block = -1").select("shard", F.col("blob").alias("trie")))
    scored = _advance(blocks, answers, books, shards, total, types, True)
    return scored.withColumn("train_tokens", F.lit(total).cast("long")), model
