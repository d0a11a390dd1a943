"""Words and their hashes, computed for a whole batch of texts at once with numpy.

Words are runs of ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z; a null text has none.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 512 << 10
POWERS = 1 << 20  # kept from one chunk to the next

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


@lru_cache(maxsize=2)
def _kept_powers(base: int) -> np.ndarray:
    return _powers(base, POWERS)


def _powers(base: int, n: int) -> np.ndarray:
    """base to the power of 0 to n - 1, in 64 bits."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, out=out)


def powers(base: int, n: int) -> np.ndarray:
    return _kept_powers(base)[:n] if n <= POWERS else _powers(base, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finisher of splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of its front and of its last part."""
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + right + np.uint64(1))


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(sizes)], strict=True):
        yield batch.slice(int(lo), int(hi - lo))


class Words:
    """All words of some texts: ``starts`` and ``ends`` in ``data``, ``doc`` is the text's number, ``first`` each text's first word."""

    def __init__(self, texts: list):
        raw = [(t or "").encode() for t in texts]
        sizes = np.array([len(r) + 1 for r in raw], dtype=np.int64)
        self.bytes = (b"\n".join(raw) + b"\n").lower() if raw else b""
        self.data = np.frombuffer(self.bytes, dtype=np.uint8)
        space = np.r_[True, _SPACE[self.data]]
        edges = np.flatnonzero(space[1:] != space[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        bounds = np.cumsum(sizes)
        self.doc = np.searchsorted(bounds, self.starts, side="right")
        self.first = np.searchsorted(self.doc, np.arange(len(raw) + 1))
        self.count = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64 bits per word. Equal words have equal hashes; others differ but for a chance of 2**-64 a pair."""
        n = len(self.data)
        if not n:
            return np.zeros(0, dtype=np.uint64)
        total = np.zeros(n + 1, dtype=np.uint64)
        values = total[1:]
        np.take(_BYTE_VALUES, self.data, out=values, mode="clip")
        values *= powers(_BASE, n)
        np.cumsum(values, out=values)
        return mix((total[self.ends] - total[self.starts]) * powers(_BASE_INVERSE, n)[self.starts])

    def word(self, i: int) -> str:
        return self.bytes[self.starts[i] : self.ends[i]].decode(errors="replace")
