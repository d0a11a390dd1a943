"""Collocations against counts of all phrases."""

import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import collocations as col

ROWS = "text string, lang string"


def brute(rows, support, longest=4, share=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        inside = defaultdict(int)
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        kept = []
        for p, a in often.items():
            if 100 * inside[p] < share * a or not inside[p]:
                score, cut = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:cut]], counts[p[cut:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows_of(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in df.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(8)
    vocabulary = ["New", "york", "new", "É", "über", "x y", "a-b", "the", "of", "\x85", "日本"]
    ends = [" ", "  ", "\t", " ", " ", ". ", ", ", "\n", "\r\n", "!", "\x0b", " "]
    rows = []
    for i in range(300):
        words = rng.choice(len(vocabulary), rng.integers(0, 60), p=np.r_[np.full(4, 0.16), np.full(7, 0.36 / 7)])
        rows.append(("".join(vocabulary[w] + ends[rng.integers(len(ends))] for w in words), ["en", "de", None, "und"][i % 4]))
    return rows + [(None, "en"), ("", None), (" \t,;", "fr"), ("solo", "it"), ("go " * 500, "en"), ("Go go. " * 40, "xx"), ("Go go. " * 40, "xx")]


@pytest.mark.parametrize(("block_words", "shards", "support", "longest"), [(40, 100, 6, 4), (700, 3, 6, 4), (1 << 20, 1, 6, 3), (100, 8, 30, 2)])
def test_against_all_counts(spark, texts, block_words, shards, support, longest):
    """Many shards, whose own support is 1, and few, in small blocks and large ones, give the same rows."""
    frame = spark.createDataFrame(texts, ROWS).repartition(7)
    got = rows_of(col.collocations(frame, support=support, longest=longest, shards=shards, block_words=block_words))
    assert got == brute(texts, support, longest) and len(got) > 20


def test_top_and_ties(spark, texts):
    frame = spark.createDataFrame(texts, ROWS)
    got = rows_of(col.collocations(frame, support=4, top=5, share=101))
    assert got == brute(texts, 4, top=5, share=101)


def test_clashing_columns_and_rows_without_words(spark, texts):
    frame = spark.createDataFrame(texts, ROWS)
    for name in ("key", "n", "phrase", "f", "size", "rank", "score", "a", "w", "cut", "longer"):
        frame = frame.withColumn(name, F.lit("x"))
    assert rows_of(col.collocations(frame, support=6)) == brute(texts, 6)
    assert rows_of(col.collocations(frame.where("false"))) == []
    assert rows_of(col.collocations(frame.where("text IS NULL OR text = ''"))) == []


def test_phrases_are_told_even_if_tasks_are_cut_anew(spark, texts, monkeypatch):
    """Who tells a phrase is only a matter of time: with all owners wrong the rows are the same."""
    frame = spark.createDataFrame(texts, ROWS).repartition(7)
    count = col.count
    monkeypatch.setattr(col, "count", lambda *a: count(*a).withColumn("part", F.col("part") + 1000))
    assert rows_of(col.collocations(frame, support=6)) == brute(texts, 6)


def test_filter_holds_its_keys(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000, dtype=np.int64)
    table = col.key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long")).value
    assert col.held(keys.view(np.uint64), table).all()
    others = np.random.default_rng(2).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert col.held(others, table).mean() < 0.06


class Task:
    """Stands for a frame: keeps the task function."""

    def mapInArrow(self, run, schema):
        return run


def test_tasks_hold_keys_of_eight_bytes(monkeypatch):
    """Per word a task holds no more than its key, a copy and a place; telling holds nothing that grows with the words."""
    monkeypatch.setattr(col, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    full = SimpleNamespace(value=np.full(1 << 12, 255, np.uint8))
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(f"w{i % 97}" for i in range(k, k + 50_000)) for k in range(4)], "lang": ["en"] * 4})

    def peak(run, times):
        tracemalloc.start()
        try:
            rows = sum(r.num_rows for r in run(batch for _ in range(times)))
            return rows, tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    words = 10 * 4 * 50_000
    rows, most = peak(col.word_counts(Task(), 8 << 20), 10)
    assert rows == 97 and most < 28 * words
    rows, most = peak(col.tell(Task(), [full] * 3, full, True), 10)
    assert rows == 3 * 97 and most < 2 * peak(col.tell(Task(), [full] * 3, full, True), 1)[1]
