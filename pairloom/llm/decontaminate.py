"""Benchmark decontamination by latent semantic retrieval.

Texts become sequences of numbers of the benchmark's words. A distributed
randomised SVD of TF-IDF passages gives a latent space in which every passage of
every document is compared with all benchmark items. Candidates must hold the
item's answer and a long common subsequence with it.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.memory import released
from pairloom.llm.words import Words, chunks
from pairloom.runtime import stage

STEP = 32  # words; a passage is two steps long and passages overlap by one
SLICE_WORDS = 100_000  # that are worked on at once
RANK = 64
OVERSAMPLE = 8
ITEM_CHARS = 2_000_000  # characters of benchmark items that are held at once; more are worked off in blocks
COSINE = 0.15
COMMON = 0.6  # of an item's words must be a common subsequence
ANSWER_WORDS = 6  # an item's rarest words stand for its answer where it has no answer column
ANSWER = 0.5  # of the answer's words must be there
FREQUENT = 128  # terms with the smallest idf, whose counts are a dense matrix
SHORT = 8  # items with fewer words must be there as a whole
_STOPS = np.zeros(256, dtype=bool)
_STOPS[list(b".,;:!?\"'()[]")] = True


def word_hashes(words: Words) -> np.ndarray:
    """Hashes of the words without up to two closing and one opening punctuation marks."""
    for _ in range(2):
        words.ends = words.ends - (_STOPS[words.data[words.ends - 1]] & (words.ends - words.starts > 1))
    words.starts = words.starts + (_STOPS[words.data[words.starts]] & (words.ends - words.starts > 1))
    return words.hashes()


class Lookup:
    """Numbers from 1 of hashes among sorted keys, 0 for others. A key is looked for from the first with the same highest bits."""

    def __init__(self, keys: np.ndarray):
        bits = (4 * len(keys)).bit_length() + 1
        self.keys, self.shift = np.r_[keys, np.uint64(2**64 - 1)], np.uint64(64 - bits)
        self.first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.size = len(keys)

    def numbers(self, h: np.ndarray) -> np.ndarray:
        at = self.first[(h >> self.shift).astype(np.int64)]
        behind = np.flatnonzero(self.keys[at] < h)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < h[behind]]
        return np.where((self.keys[at] == h) & (at < self.size), at + 1, 0).astype(np.int32)


@dataclass
class Items:
    """A block of benchmark items; ``terms`` are term numbers from 1, ``keys`` the sorted hashes behind them."""

    ids: list
    keys: np.ndarray
    terms: list[np.ndarray]
    answers: list[np.ndarray | None]

    @staticmethod
    def of(rows: list) -> "Items":
        words = Words([r["text"] for r in rows])
        h = word_hashes(words)
        split = lambda x, w: np.split(x, w.first[1:-1])
        keys, answers = np.unique(h), [None] * len(rows)
        if rows and rows[0].get("answer", 0) != 0:
            own = Words([r["answer"] for r in rows])
            g = word_hashes(own)
            keys = np.union1d(keys, g)
            answers = [a if len(a) else None for a in split(np.searchsorted(keys, g) + 1, own)]
        return Items([r["item_id"] for r in rows], keys, split(np.searchsorted(keys, h) + 1, words), answers)


def blocks(items: DataFrame) -> Iterator[Items]:
    """Items with words, in blocks of bounded size. Repeated item rows are taken once."""
    columns = ["item_id", "text", *(["answer"] if "answer" in items.columns else [])]
    rows, chars = [], 0
    for r in items.select(*columns).where("text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'").distinct().orderBy("item_id", "text").toLocalIterator():
        rows.append(r.asDict())
        chars += len(r.text)
        if chars >= ITEM_CHARS:
            yield Items.of(rows)
            rows, chars = [], 0
    if rows:
        yield Items.of(rows)


def as_terms(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, terms), staged: the number of every word of every document, 0 for words that no item has."""
    shared = docs.sparkSession.sparkContext.broadcast(items.keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Lookup(shared.value)
        for whole in batches:
            for batch in chunks(whole):
                words = Words(batch.column("text").to_pylist())
                terms = keys.numbers(word_hashes(words))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(words.first, pa.int32()), pa.array(terms))], names=["doc_id", "terms"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    terms = stage(rows.mapInArrow(released(run), "doc_id long, terms array<int>"), "terms")
    shared.destroy()
    return terms


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``SLICE_WORDS`` words each; a longer document is a part of its own."""
    at = batch.column("terms").offsets.to_numpy()
    part = (at[1:] - at[0]) // SLICE_WORDS
    cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if lo < hi:
            yield batch.slice(int(lo), int(hi - lo))


class Steps:
    """Terms of a batch of documents, cut into steps of ``STEP`` words: step number and term of every benchmark word."""

    def __init__(self, lists: pa.ListArray):
        offsets = lists.offsets.to_numpy().astype(np.int64)
        self.terms = lists.values.to_numpy()
        self.first = offsets - offsets[0]
        self.terms = self.terms[offsets[0] : offsets[-1]]
        n = np.diff(self.first)
        steps = -(-n // STEP)
        self.begin = np.r_[0, np.cumsum(steps)]
        self.count = int(self.begin[-1])
        self.doc = np.repeat(np.arange(len(n)), steps)
        at = np.flatnonzero(self.terms)
        doc = np.repeat(np.arange(len(n)), n)[at]
        self.step = self.begin[doc] + (at - self.first[doc]) // STEP
        self.term = self.terms[at] - 1

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """Sum of the rows of a matrix by term, for each step."""
        out = np.zeros((self.count, rows.shape[1]), dtype=np.float32)
        if len(self.step):
            heads = np.flatnonzero(np.r_[True, np.diff(self.step) > 0])
            out[self.step[heads]] = np.add.reduceat(rows[self.term], heads)
        return out

    def around(self, step: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First step, and the one after the last, of passages and ``reach`` steps on either side, within their documents."""
        doc = self.doc[step]
        return np.maximum(step - reach, self.begin[doc]), np.minimum(step + 2 + reach, self.begin[doc + 1])

    def window(self, step: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word, and the one after the last, of passages and half of ``size`` words on either side, within their documents."""
        doc = self.doc[step]
        begin = self.first[doc] + (step - self.begin[doc]) * STEP
        return np.maximum(self.first[doc], begin - size // 2), np.minimum(self.first[doc + 1], begin + 2 * STEP + size // 2)

    def passages(self, sums: np.ndarray) -> np.ndarray:
        """Two steps each; the last of a document is its last step alone."""
        same = np.r_[self.doc[1:] == self.doc[:-1], False][: self.count]
        after = np.roll(sums, -1, axis=0) * same[:, None] if self.count else sums
        return sums + after


class Sums:
    """Sums of the rows of a matrix by term, for sorted rows of terms, and back.

    Counts of the ``FREQUENT`` terms are dense, so that their sums are matrix products; rows of other terms are gathered.
    """

    def __init__(self, rows: np.ndarray, idf: np.ndarray):
        self.rows, self.top = rows, np.argsort(idf, kind="stable")[:FREQUENT]
        self.column = np.full(len(idf), -1, dtype=np.int64)
        self.column[self.top] = np.arange(len(self.top))

    def split(self, row: np.ndarray, term: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of the frequent terms for each row, and row and term of the others."""
        column, width = self.column[term], len(self.top)
        often, rare = np.flatnonzero(column >= 0), np.flatnonzero(column < 0)
        counts = np.bincount(row[often] * width + column[often], minlength=count * width)
        return counts.reshape(count, width).astype(float), row[rare], term[rare]

    def forth(self, counts: np.ndarray, row: np.ndarray, term: np.ndarray) -> np.ndarray:
        """For each row, the sum of its terms' rows of the matrix."""
        out = counts @ self.rows[self.top]
        if len(row):
            heads = np.flatnonzero(np.r_[True, np.diff(row) > 0])
            out[row[heads]] += np.add.reduceat(self.rows[term], heads)
        return out

    def back(self, counts: np.ndarray, row: np.ndarray, term: np.ndarray, left: np.ndarray, total: np.ndarray) -> None:
        """Adds to ``total``, for each term, the sum of the rows of ``left`` that have it."""
        total[self.top] += counts.T @ left
        if len(row):
            by = np.argsort(term.astype(np.uint16) if len(total) <= 1 << 16 else term, kind="stable")
            term = term[by]
            heads = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
            total[term[heads]] += np.add.reduceat(left[row[by]], heads)


def document_frequencies(terms: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """Number of steps in all documents, and of those with each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, df = 0, np.zeros(size, dtype=np.int64)
        for whole in batches:
            for batch in slices(whole):
                s = Steps(batch.column("terms"))
                count += s.count
                pairs = np.sort((s.step * size + s.term).astype(np.int32 if s.count * size < 1 << 31 else np.int64))
                df += np.bincount(pairs[np.r_[True, pairs[1:] != pairs[:-1]][: len(pairs)]] % size, minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some]), pa.array(np.r_[count, df[some]])], names=["term", "n"])

    found = terms.select("terms").mapInArrow(released(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    by = dict(zip(found.term.tolist(), found.n.tolist(), strict=True))
    return by.get(-1, 0), np.array([by.get(t, 0) for t in range(size)], dtype=float)


def _summed(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of matrices, one a row, added up in rounds of fewer tasks; the driver adds the last few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape[0] * shape[1], dtype=np.float64)
        for batch in batches:
            for raw in batch.column("m").to_pylist():
                total += np.frombuffer(raw, np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    summed = stage(parts, "parts")
    while (n := summed.count()) > 16:
        summed = stage(summed.repartition(max(1, n // 16)).mapInArrow(released(run), "m binary"), "parts")
    out = np.zeros(shape)
    for r in summed.toLocalIterator():
        out += np.frombuffer(r.m, np.float64).reshape(shape)
    return out


def latent_space(docs: DataFrame, idf: np.ndarray, items: Items, rank: int = RANK) -> np.ndarray:
    """Right singular vectors of the TF-IDF matrix of passages, columns by singular value, by a randomised range finder.

    The rows are the passages of all documents and the benchmark items, each of length 1. Two products with the
    transposed and the plain matrix are spread over the cluster; the small factorisation is the driver's.
    """
    size, width = len(idf), min(rank + OVERSAMPLE, len(idf))

    def product(basis: np.ndarray) -> np.ndarray:
        shared = docs.sparkSession.sparkContext.broadcast((basis.astype(np.float32), idf.astype(np.float32)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = Gram(*shared.value)
            for whole in batches:
                for batch in slices(whole):
                    s = Steps(batch.column("terms"))
                    total.add(s.step, s.term, s.count)
            yield pa.RecordBatch.from_arrays([pa.array([total.sum().tobytes()], pa.binary())], names=["m"])

        own = Gram(basis, idf)
        own.add(np.concatenate([np.full(len(t), i) for i, t in enumerate(items.terms)]), np.concatenate(items.terms) - 1, len(items.terms))
        total = _summed(docs.select("terms").mapInArrow(released(run), "m binary"), (size, width))
        shared.destroy()
        return total + own.sum()

    start = np.random.default_rng(23).standard_normal((size, width))
    basis, _ = np.linalg.qr(product(start))
    values, vectors = np.linalg.eigh(basis.T @ product(basis))
    return (basis @ vectors[:, np.argsort(-values)[:rank]]).astype(np.float32)


class Gram:
    """transpose(A) A basis, added up by slices of the sparse matrix A of rows of length 1 whose entries are idf by occurrence."""

    def __init__(self, basis: np.ndarray, idf: np.ndarray):
        self.idf, self.squares = idf.astype(float), (idf**2).astype(float)
        self.sums = Sums(self.idf[:, None] * basis, idf)
        self.total = np.zeros(basis.shape)

    def add(self, row: np.ndarray, term: np.ndarray, rows: int) -> None:
        weight = np.bincount(row, self.squares[term], minlength=rows)  # square of the row's length
        parts = self.sums.split(row, term, rows)
        left = self.sums.forth(*parts) / np.maximum(weight, 1e-18)[:, None]
        self.sums.back(*parts, left, self.total)

    def sum(self) -> np.ndarray:
        return self.total * self.idf[:, None]


def common_length(masks: dict[int, int], size: int, text: list[int]) -> int:
    """Length of the longest common subsequence, bit by bit in parallel; masks has the places of each term in the item."""
    full = (1 << size) - 1
    v = full
    for t in text:
        if m := masks.get(t):
            u = v & m
            v = (v + u) | (v - u)
            v &= full
    return size - v.bit_count()


class Judge:
    """Retrieval and checks for one block of items."""

    def __init__(self, items: Items, idf: np.ndarray, space: np.ndarray):
        self.items = items
        self.rows = (idf[:, None] * space).astype(np.float32)
        vectors = np.stack([self.rows[t - 1].sum(0) for t in items.terms])
        self.vectors = (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).T
        self.reach = np.maximum(1, -(-(np.array([len(t) for t in items.terms]) // 2) // STEP))  # steps on either side of a passage that an item may fill
        self.whole = [i for i, a in enumerate(items.answers) if a is None and self.reach[i] > 1]  # too long for a few words to stand for them: rephrasing takes just the rarest
        self.masks, answers, whole = [], [], set(self.whole)
        for terms, answer in zip(items.terms, items.answers, strict=True):
            masks: dict[int, int] = {}
            for i, t in enumerate(terms.tolist()):
                masks[t] = masks.get(t, 0) | 1 << i
            self.masks.append(masks)
            rare = np.unique(terms)
            answers.append(terms[:0] if len(self.masks) - 1 in whole else np.unique(answer) if answer is not None else rare[np.argsort(-idf[rare - 1], kind="stable")[:ANSWER_WORDS]])
        self.needed = np.array([-(-len(a) * (ANSWER if len(t) >= SHORT else 1) // 1) for a, t in zip(answers, items.terms, strict=True)])
        terms, owner = np.concatenate(answers), np.repeat(np.arange(len(answers)), [len(a) for a in answers])
        self.owner = owner[np.argsort(terms, kind="stable")]
        self.owners = np.searchsorted(np.sort(terms), np.arange(len(idf) + 3))  # items of term t: owner[owners[t]:owners[t + 1]]

    def candidates(self, steps: Steps) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Passage, item and cosine, where the cosine is high enough and the passage, or what is within the item's reach, holds enough of the answer.

        Of items that reach beyond a step, the cosine is that of the passage or of all within reach, if that is higher.
        """
        sums = steps.sums(self.rows)
        x = steps.passages(sums)
        length = np.linalg.norm(x, axis=1)
        cosine = (x / np.maximum(length, 1e-9)[:, None]) @ self.vectors
        passage, item = np.divmod(np.concatenate([self.answered(steps), *(self.held(steps, i) for i in self.whole)]), len(self.masks))
        found = cosine[passage, item]
        far = np.flatnonzero(self.reach[item] > 1)
        if len(far):
            total = np.concatenate([np.zeros((1, sums.shape[1])), np.cumsum(sums, axis=0, dtype=np.float64)])
            for at in np.array_split(far, -(-len(far) // 10_000)):
                lo, hi = steps.around(passage[at], self.reach[item[at]])
                span = total[hi] - total[lo]
                span /= np.maximum(np.linalg.norm(span, axis=1), 1e-9)[:, None]
                found[at] = np.maximum(found[at], np.einsum("ij,ij->i", span, self.vectors.T[item[at]]))
        close = found >= COSINE
        return passage[close], item[close], found[close]

    def held(self, steps: Steps, item: int) -> np.ndarray:
        """passage * items + item where enough words are the item's for the common subsequence."""
        m, member = len(self.items.terms[item]), np.zeros(len(self.rows) + 1, dtype=bool)
        member[self.items.terms[item]] = True
        own = np.r_[0, np.cumsum(member[steps.terms])]
        start, end = steps.window(np.arange(steps.count), m)
        return np.flatnonzero(own[end] - own[start] >= COMMON * m) * len(self.masks) + item

    def answered(self, steps: Steps) -> np.ndarray:
        """passage * items + item for all pairs in which the answer check can succeed."""
        items = len(self.masks)
        has = self.owners[steps.term + 1] < self.owners[steps.term + 2]
        step, term = steps.step[has], steps.term[has] + 1
        n = self.owners[term + 1] - self.owners[term]
        of = self.owner[np.repeat(self.owners[term] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        step, term = np.repeat(step, n), np.repeat(term, n)
        by = np.lexsort((step, term, of))
        step, term, of = step[by], term[by], of[by]
        doc, reach = steps.doc[step], self.reach[of]
        lo, hi = np.maximum(step - 1 - reach, steps.begin[doc]), np.minimum(step + reach, steps.begin[doc + 1] - 1)  # passages that reach the word
        again = np.r_[False, (term[1:] == term[:-1]) & (of[1:] == of[:-1])][: len(step)]
        lo = np.where(again, np.maximum(lo, np.roll(hi, 1) + 1), lo)  # each passage counts a term once
        n = np.maximum(hi - lo + 1, 0)
        key = (np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())) * items + np.repeat(of, n)
        pairs, counts = np.unique(key, return_counts=True)
        return pairs[counts >= self.needed[pairs % items]]

    def check(self, text: np.ndarray, item: int) -> float:
        """Common share of the item's words, 0 if it is too small."""
        terms = self.items.terms[item]
        share = common_length(self.masks[item], len(terms), text[text > 0].tolist()) / len(terms)
        return share if share >= (COMMON if len(terms) >= SHORT else 1) else 0.0

    def find(self, ids: list, lists: pa.ListArray) -> list[tuple]:
        """(doc_id, item_id, common, cosine, start, end) of the best passage of every document and item that pass; words from start to end were compared."""
        steps, best = Steps(lists), {}
        for passage, item, cosine in zip(*(a.tolist() for a in self.candidates(steps)), strict=True):
            doc, m = int(steps.doc[passage]), len(self.items.terms[item])
            lo, (start, end) = int(steps.first[doc]), map(int, steps.window(passage, m))
            share = self.check(steps.terms[start:end], item)
            if share > best.get((doc, item), (0,))[0]:
                best[doc, item] = (share, cosine, start - lo, end - lo)
        return [(ids[doc], self.items.ids[item], *found) for (doc, item), found in sorted(best.items())]


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, common, cosine, start, end): documents that hold a benchmark item, exact or rephrased.

    One row a document row and item. Null and empty texts and items match nothing;
    items that repeat are taken once; extra columns are ignored. An item column
    ``answer`` replaces the rarest words in the answer check.
    """
    kind = "doc_id long, item_id long, common double, cosine double, start long, end long"
    out = docs.sparkSession.createDataFrame([], kind)
    for block in blocks(items):
        terms = as_terms(docs, block)
        count, df = document_frequencies(terms, len(block.keys))
        idf = np.log((count + 1) / (df + 1)) + 0.01
        space = latent_space(terms, idf, block)
        shared = docs.sparkSession.sparkContext.broadcast(Judge(block, idf, space))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            judge = shared.value
            for whole in batches:
                for batch in slices(whole):
                    found = list(zip(*judge.find(batch.column("doc_id").to_pylist(), batch.column("terms")), strict=True)) or [[]] * 6
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, (pa.int64(),) * 2 + (pa.float64(),) * 2 + (pa.int64(),) * 2, strict=True)], names=["doc_id", "item_id", "common", "cosine", "start", "end"])

        out = out.union(stage(terms.select("doc_id", "terms").mapInArrow(released(run), kind), "matches"))
        shared.destroy()
    return out
