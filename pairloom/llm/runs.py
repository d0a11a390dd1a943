"""Periodic runs: maximal stretches of words that repeat with a smallest period.

A text's words become numbers. Suffix trees (Ukkonen) of the words and of their
reversal answer how far two places agree forwards and backwards: the depth of two
leaves' lowest common ancestor, a minimum over the Euler tour in constant time. By
the runs theorem each run has a Lyndon root that is the longest Lyndon word at one
of its places, in one of two opposite orders of the words; so two candidates a place
are extended in both directions, and all runs are found.
"""

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pairloom.llm.words import chunks

LEAST = 12

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class SuffixTree:
    """Suffix tree of numbers of at least 1; an end smaller than all of them is added.

    ``order`` lists the places by their suffixes, ``agree`` the depth of the lowest common
    ancestor of each leaf and the one before it: what the Euler tour passes between them.
    """

    def __init__(self, numbers: list[int]):
        self.text = [*numbers, 0]
        self.kids, self.starts, self.ends, self.leaves = _ukkonen(self.text)
        self.order, agree = self.tour()
        self.rank = np.empty(len(self.order), np.int64)
        self.rank[self.order] = np.arange(len(self.order))
        self.levels = [agree]
        step = 1
        while 2 * step <= len(agree):
            self.levels.append(np.minimum(self.levels[-1][:-step], self.levels[-1][step:]))
            step *= 2

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Leaves in the order of their suffixes; with ``reverse`` larger numbers come first, ends before all."""
        order, agree, stack = [], [], [(0, 0)]
        pop, push = stack.pop, stack.append
        kids, starts, ends = self.kids, self.starts, self.ends
        back = -1 if reverse else 1
        between = -1
        while stack:
            node, depth = pop()
            if between < 0:
                between = depth
            if node < 0:
                order.append(~node)
                agree.append(between)
                between = -1
            else:
                depth += ends[node] - starts[node]
                for _, child in sorted(kids[node].items(), key=lambda x: -back * x[0] if x[0] else np.inf):
                    push((child, depth))
        return np.array(order, np.int64), np.array(agree, np.int64)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers agree from places a and from places b on; a and b differ."""
        x, y = self.rank[a], self.rank[b]
        lo, hi = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((hi - lo).astype(float))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            at, table = level == k, self.levels[k]
            out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k)])
        return out


def _ukkonen(text: list[int]) -> tuple[list[dict], list[int], list[int], list[int]]:
    """Inner nodes (children by first number, edge from start to end) and where each leaf's edge starts; leaf i is ~i."""
    kids, starts, ends, links, leaves = [{}], [0], [0], [0], []
    node = edge = length = waiting = 0
    for i, c in enumerate(text):
        last = 0
        waiting += 1
        while waiting:
            if not length:
                edge = i
            first = text[edge]
            child = kids[node].get(first)
            if child is None:
                kids[node][first] = ~len(leaves)
                leaves.append(i)
                if last:
                    links[last] = node
                last = node
            else:
                if child < 0:
                    at = leaves[~child]
                else:
                    at = starts[child]
                    span = ends[child] - at
                    if length >= span:
                        node = child
                        edge += span
                        length -= span
                        continue
                other = text[at + length]
                if other == c:
                    length += 1
                    if last:
                        links[last] = node
                    break
                middle = len(kids)
                kids.append({c: ~len(leaves), other: child})
                starts.append(at)
                ends.append(at + length)
                links.append(0)
                leaves.append(i)
                if child < 0:
                    leaves[~child] = at + length
                else:
                    starts[child] = at + length
                kids[node][first] = middle
                if last:
                    links[last] = middle
                last = middle
            waiting -= 1
            if node:
                node = links[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return kids, starts, ends, leaves


def _next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one of smaller rank: where its longest Lyndon word ends."""
    n = len(rank)
    out, open_ = [n] * n, []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return np.array(out, np.int64)


def runs_of(numbers: list[int], least: int = LEAST) -> np.ndarray:
    """(start, length, period) of every run of at least ``least`` numbers, sorted by start, then period."""
    n = len(numbers)
    if n < max(least, 2):
        return np.zeros((0, 3), np.int64)
    forward = SuffixTree(numbers)
    opposite = np.empty(n + 1, np.int64)
    opposite[forward.tour(reverse=True)[0]] = np.arange(n + 1)
    places = np.arange(n)
    start = np.r_[places, places]
    end = np.r_[_next_smaller(forward.rank.tolist())[:n], _next_smaller(opposite.tolist())[:n]]
    del opposite
    some = end < n  # a root that ends the text has nothing to repeat after it; the one before it does
    start, period = start[some], (end - start)[some]
    right = start + period + forward.common(start, start + period)
    del forward
    backward = SuffixTree(numbers[::-1])
    left = start.copy()
    inner = start > 0
    left[inner] -= backward.common(n - start[inner], n - start[inner] - period[inner])
    found = np.stack([left, right - left, period], axis=1)[right - left >= np.maximum(2 * period, least)]
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


_FACTORS = np.random.default_rng(12).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def _repeating(words: list, least: int) -> list[tuple[int, int]]:
    """Stretches that hold all runs: a run repeats each half-``least`` of words in it one period on or before.

    So words in no group of that many words that the text has twice are in no run. Equal hashes of
    different groups only make a stretch longer than it need be.
    """
    n, width = len(words), max(1, min(least // 2, 64))
    m = n - width + 1
    if n < least or m < 2:
        return []
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    group = hashes[:m] * _FACTORS[0]
    for k in range(1, width):
        group += hashes[k : k + m] * _FACTORS[k]
    order = np.argsort(group)
    group = group[order]
    same = group[1:] == group[:-1]
    if not same.any():
        return []
    cover = np.zeros(n + 1, np.int64)
    twice = np.zeros(m, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    cover[:m] += twice
    cover[width:] -= twice
    edges = np.flatnonzero(np.diff(np.r_[0, np.cumsum(cover[:n]) > 0, 0].astype(np.int8)))
    return [(a, b) for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True) if b - a >= least]


def text_runs(words: list, least: int = LEAST) -> np.ndarray:
    """``runs_of`` words; trees are built only over stretches where words repeat in groups."""
    found = [np.zeros((0, 3), np.int64)]
    for a, b in _repeating(words, least):
        numbers: dict = {}
        part = runs_of([numbers.setdefault(w, len(numbers) + 1) for w in words[a:b]], least)
        found.append(part + [a, 0, 0])
    return np.concatenate(found)


def collapsed(words: list, runs: np.ndarray) -> list:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    inside = np.zeros(len(words) + 1, np.int64)
    np.add.at(inside, runs[:, 0] + runs[:, 2], 1)
    np.add.at(inside, runs[:, 0] + runs[:, 1], -1)
    return list(compress(words, (np.cumsum(inside[:-1]) == 0).tolist()))


def periodic_runs(docs: DataFrame, keep: list[str], least: int = LEAST, edit: Callable[[dict, list], list] | None = None) -> DataFrame:
    """``keep`` and, of each row's whole ``text``, ``runs`` (sorted by start, then period) and ``collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+`` as they stand, numbered from 0. A run has the smallest period q, at least
    ``least`` words and two periods, and no neighbouring word goes on with it. ``collapsed`` is the text
    without the words that any run holds after its first q, joined by one space. ``edit`` may change a
    row's words beforehand; it gets the row's kept columns.

    Null and empty texts have no runs and an empty ``collapsed``; rows that repeat stay; no rows give none.
    Columns called ``runs``, ``collapsed`` or ``text`` may not be kept; others of any name may be there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                runs, left = [], []
                kept = part.drop_columns(["text"])
                for text, row in zip(part.column("text").to_pylist(), kept.to_pylist() if edit else [None] * len(part), strict=True):
                    words = (text or "").encode().split()
                    if edit:
                        words = edit(row, words)
                    found = text_runs(words, least)
                    runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found.tolist()])
                    left.append(b" ".join(collapsed(words, found)).decode())
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(runs, _RUNS), pa.array(left, pa.string())], names=[*keep, "runs", "collapsed"])

    kept = docs.select(*[docs[f"`{c}`"] for c in [*keep, "text"]])
    schema = T.StructType([*kept.schema.fields[:-1], *T.StructType.fromDDL(f"runs {RUNS}, collapsed string").fields])
    return kept.mapInArrow(run, schema)
