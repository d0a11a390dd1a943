"""Toxicity from two class-conditional Kneser-Ney bigram models that share their backoff counts.

A pair counts as often as it occurs in a class. What the discount takes from a
pair that either class holds is shared by both classes, as their words' own
probabilities are to each other, so a rare pair says little about the class. Words
back off to the number of different words before them in the class, and then, in
both classes, to the number of different words that precede a word in either.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.words import Words, chain, chunks
from pairloom.runtime import stage

ROWS = 20_000  # labelled rows a class for the counts, and as many in all for the calibration
DISCOUNT = 1.5  # taken from every count; it takes all of what was seen once
WINDOW = 32  # words
EVIDENCE = 1.5  # log ratio from which a word speaks for itself; weaker ones mostly tell how languages and topics are mixed in the classes
SCALES = (5, 50, 10) * 2  # bring the features of ordinary and toxic texts to about 0 to 5
LIMIT = 10
RATIOS = ["mean_ratio", "telling_ratio", "window_ratio"]
FEATURES = [*RATIOS, *(f"word_{r}" for r in RATIOS)]  # by both orders of the model, and by words alone


@dataclass
class Model:
    """Sorted hashes with class probabilities (columns: toxic, ordinary), backoff weights by word, and the calibration."""

    words: np.ndarray
    p: np.ndarray
    backoff: np.ndarray
    unknown: float
    pairs: np.ndarray
    extra: np.ndarray
    weights: np.ndarray | None = None

    def ratios(self, hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log p(word | previous word, toxic) - log p(... , ordinary) of each word, and the same without the previous word."""
        at, known = _find(self.words, hashes)
        p = np.where(known[:, None], self.p[at], self.unknown)
        alone = np.log(p[:, 0]) - np.log(p[:, 1])
        same = np.r_[False, doc[1:] == doc[:-1]][: len(doc)]
        before = np.roll(hashes, 1)
        u, u_known = np.roll(at, 1), np.roll(known, 1) & same
        p = p * np.where(u_known[:, None], self.backoff[u], 1.0)
        pair, found = _find(self.pairs, chain(before, hashes))
        p = p + np.where((found & u_known)[:, None], self.extra[pair], 0.0)
        return np.log(p[:, 0]) - np.log(p[:, 1]), alone

    def features(self, texts: list) -> np.ndarray:
        """``FEATURES`` per text: the mean log ratio a word, the same of telling words alone, and the largest mean of these in a window; 0 without words."""
        words = Words(texts)
        out = np.zeros((len(texts), len(FEATURES)))
        if not len(words.starts):
            return out
        first, n = words.first[:-1], words.count
        some = n > 0
        ends = np.minimum(np.arange(len(words.starts)) + WINDOW, (first + n)[words.doc])
        for i, ratios in enumerate(self.ratios(words.hashes(), words.doc)):
            all_words, telling = (np.r_[0.0, np.cumsum(r)] for r in (ratios, np.where(np.abs(ratios) >= EVIDENCE, ratios, 0.0)))
            for k, total in enumerate((all_words, telling)):
                out[some, 3 * i + k] = (total[first + n] - total[first])[some] / n[some]
            out[some, 3 * i + 2] = np.maximum.reduceat((telling[ends] - telling[:-1]) / WINDOW, first[some])
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(features) @ self.weights, -30, 30)))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _design(features: np.ndarray) -> np.ndarray:
    return np.column_stack([np.clip(features * SCALES, -LIMIT, LIMIT), np.ones(len(features))])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def count_pairs(labelled: DataFrame) -> DataFrame:
    """(toxic, u, w, n): the words u, w follow each other n times (hashes; u is 0 before the first word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                words, labels = Words(batch.column("text").to_pylist()), batch.column("toxic").to_numpy()
                w = words.hashes()
                place = np.arange(len(w)) - words.first[words.doc]
                u = np.where(place >= 1, np.roll(w, 1), 0).astype(np.uint64)
                rows = pa.table({"toxic": pa.array(labels[words.doc], pa.int32()), "u": _signed(u), "w": _signed(w)})
                counted = rows.group_by(["toxic", "u", "w"]).aggregate([([], "count_all")]).rename_columns({"count_all": "n"})
                yield from counted.select(["toxic", "u", "w", "n"]).combine_chunks().to_batches(100_000)

    found = labelled.select(F.col("text").cast("string"), F.col("toxic").cast("int")).mapInArrow(run, "toxic int, u long, w long, n long")
    return found.groupBy("toxic", "u", "w").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, labels: DataFrame, calibrate: Column) -> Model | None:
    """Model from the docs that ``labels`` marks; rows with ``calibrate`` only fit the weights of the score.

    Sampled by hash of doc_id, as many ordinary as toxic rows. None if a class is missing.
    """
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.withColumn("calibrate", calibrate)
    sizes = {(r.calibrate, r.toxic): r["count"] for r in marks.groupBy("calibrate", "toxic").count().collect()}
    if not sizes.get((False, 0)) or not sizes.get((False, 1)):
        return None
    per_class = min(ROWS, sizes[False, 0], sizes[False, 1])
    calibrating = sizes.get((True, 0), 0) + sizes.get((True, 1), 0)
    lot = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(5)), 11) / float(1 << 53)
    share = F.when(F.col("calibrate"), min(1.0, ROWS / max(1, calibrating)))
    share = share.when(F.col("toxic") == 1, per_class / sizes[False, 1]).otherwise(per_class / sizes[False, 0])
    chosen = F.broadcast(marks.where(lot < share))  # three times ROWS rows of three numbers, give or take chance
    sample = docs.select("doc_id", "text").join(chosen, "doc_id")
    pairs = stage(count_pairs(sample.where("NOT calibrate")), "pairs")
    model = _smooth(pairs)
    if model is None:
        return None
    model.weights = np.array([0.0, 1.0, 0.0, 0.0, 0.0, 0.0, -1.0])
    found = score(sample.where("calibrate"), model, ["toxic"]).select(*FEATURES, "toxic").toPandas()
    if found.toxic.nunique() == 2:
        model.weights = _logistic(found[FEATURES].to_numpy(), found.toxic.to_numpy())
    return model


def _smooth(pairs: DataFrame) -> Model | None:
    by_class = [F.sum(F.when(F.col("toxic") == c, F.col("n"))).alias(f"n{c}") for c in (1, 0)]
    wide = pairs.groupBy("u", "w").agg(*by_class).fillna(0)
    types = [F.count(F.when(F.col("toxic") == c, 1)).alias(f"n{c}") for c in (1, 0)]
    words = pairs.groupBy("w").agg(*types, F.countDistinct("u").alias("before"), F.sum("n").alias("seen"))
    totals = words.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.sum("before").alias("before"), F.count("*").alias("types")).first()
    if not totals.n1 or not totals.n0:
        return None
    uni = words.where("seen > 1").drop("seen").toPandas()
    bi = wide.where((F.greatest("n1", "n0") > DISCOUNT) & (F.col("u") != 0)).toPandas()
    if uni.empty:
        return None
    n, big = uni[["n1", "n0"]].to_numpy(float), np.array([totals.n1, totals.n0], dtype=float)
    shared = (uni["before"].to_numpy() + 0.5) / (totals.before + 0.5 * (totals.types + 1))
    own = np.maximum(n - DISCOUNT, 0) / big
    p = own + (1 - own.sum(0)) * shared[:, None]
    order = np.argsort(uni.w.to_numpy().view(np.uint64))
    keys = uni.w.to_numpy().view(np.uint64)[order]
    p = p[order]
    m, u = bi[["n1", "n0"]].to_numpy(float), bi.u.to_numpy().view(np.uint64)
    at, known = _find(keys, u)
    at, m, u, bi = at[known], m[known], u[known], bi[known]
    taken = np.maximum(m - DISCOUNT, 0)
    used = np.zeros_like(p)
    np.add.at(used, at, taken)
    follow = pairs.groupBy("u").agg(*by_class).fillna(0)  # all that follows a word
    follow = follow.join(words.where("seen > 1").select(F.col("w").alias("u")), "u").toPandas().set_index("u")
    n = follow.reindex(keys.view(np.int64))[["n1", "n0"]].fillna(0).to_numpy(float)
    own = p[_find(keys, bi.w.to_numpy().view(np.uint64))[0]]
    shared = DISCOUNT * own / own.sum(1, keepdims=True)
    lent = np.zeros_like(p)
    np.add.at(lent, at, shared)
    size = n + DISCOUNT * np.bincount(at, minlength=len(p))[:, None]  # with DISCOUNT for each pair that either class holds
    extra = (taken + shared) / size[at]
    hashes = chain(u, bi.w.to_numpy().view(np.uint64))
    by = np.argsort(hashes)
    backoff = 1 - (used + lent) / np.maximum(size, 1)
    if not len(by):
        hashes, extra, by = np.zeros(1, np.uint64), np.zeros((1, 2)), np.array([0])
    return Model(keys, p, np.maximum(backoff, 1e-6), 0.5 / (totals.before + 0.5 * (totals.types + 1)), hashes[by], extra[by])


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 1e-3) -> np.ndarray:
    """Newton's method."""
    a, w = _design(x), np.zeros(x.shape[1] + 1)
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (q * (1 - q))[:, None]).T @ a + ridge * len(y) * np.eye(len(w)) / 100 + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (q - y) + ridge * len(y) * w / 100)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``FEATURES`` and score (0 to 1) of each whole text.

    Null and empty texts have ratios of 0; without a model every score is 0.
    Repeated rows stay, extra columns go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for batch in chunks(whole, "__text"):
                texts = batch.column("__text").to_pylist()
                x = own.features(texts) if own else np.zeros((len(texts), len(FEATURES)))
                y = own.scores(x) if own else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *(pa.array(c) for c in (*x.T.copy(), y))], names=[*keep, *FEATURES, "score"])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, {', '.join(f'{c} double' for c in FEATURES)}, score double")
