"""Elias-Fano sequences and blocks of arrays in one buffer, which may be a memory-mapped file."""

import numpy as np


def to_blob(arrays: dict[str, np.ndarray]) -> bytes:
    """The arrays one after another, each at a multiple of 8 bytes, behind a directory of 40 bytes an array."""
    head, body, at = [np.array([len(arrays)], dtype=np.uint64).tobytes()], [], 8 + 40 * len(arrays)
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        raw = a.tobytes()
        head.append(name.encode().ljust(16, b"\0") + a.dtype.str.encode().ljust(8, b"\0") + np.array([at, a.size], dtype=np.uint64).tobytes())
        raw += b"\0" * (-len(raw) % 8)
        body.append(raw)
        at += len(raw)
    return b"".join(head + body)


def from_blob(buffer) -> dict[str, np.ndarray]:
    """Views of the arrays; nothing is copied, so a mapped file is read page by page as it is used."""
    out = {}
    for i in range(int(np.frombuffer(buffer, np.uint64, 1)[0])):
        entry = bytes(buffer[8 + 40 * i : 48 + 40 * i])
        at, size = np.frombuffer(entry, np.uint64, 2, 24)
        out[entry[:16].rstrip(b"\0").decode()] = np.frombuffer(buffer, np.dtype(entry[16:24].rstrip(b"\0").decode()), int(size), int(at))
    return out


_ONES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_IN_BYTE = np.zeros((256, 8), dtype=np.uint8)  # place of the i-th set bit of each byte
for _byte in range(256):
    _set = [i for i in range(8) if _byte >> i & 1]
    _IN_BYTE[_byte, : len(_set)] = _set


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the rank-th set bit (from 0) of each word: the byte by sums of its bytes' set bits side by side, then a table."""
    rank = rank.astype(np.uint64)
    sums = word - (word >> np.uint64(1) & np.uint64(0x5555555555555555))
    sums = (sums & np.uint64(0x3333333333333333)) + (sums >> np.uint64(2) & np.uint64(0x3333333333333333))
    sums = (sums + (sums >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _ONES
    byte = np.bitwise_count((rank * _ONES | _TOPS) - sums & _TOPS).astype(np.uint64) * np.uint64(8)
    rank -= sums << np.uint64(8) >> byte & np.uint64(255)
    return _IN_BYTE.ravel()[(word >> byte & np.uint64(255)) * np.uint64(8) + rank].astype(np.uint64) + byte


class EliasFano:
    """A strictly increasing sequence of 64-bit numbers in about 2 + log2(universe / n) bits each.

    The high parts are in unary in a bit vector, the low parts are packed. A number
    is looked up in the bucket of its high part, which begins at a selected zero and is as long as the ones behind it.
    """

    def __init__(self, arrays: dict[str, np.ndarray], prefix: str):
        self.n, self.low_bits = (int(x) for x in arrays[prefix + "shape"])
        self.high, self.zeros, low = (arrays[prefix + k] for k in ("high", "zeros", "low"))
        self.low = np.ndarray(len(low) - 7, "<u8", low, strides=(1,))  # the eight bytes from each byte on

    @staticmethod
    def build(values: np.ndarray, prefix: str) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = min(56, max(0, ((top + 1) // max(n, 1)).bit_length() - 1))
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        size = (int(high[-1]) if n else 0) + n + 2
        bits = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        zeros = np.r_[0, np.cumsum(64 - np.bitwise_count(words).astype(np.int64))]
        low = np.zeros(0, dtype=np.uint8)
        if low_bits:
            bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, count=low_bits, bitorder="little")
            low = np.packbits(bits.ravel(), bitorder="little")
        return {prefix + "shape": np.array([n, low_bits], np.int64), prefix + "high": words, prefix + "zeros": zeros[:-1], prefix + "low": np.r_[low, np.zeros(9, np.uint8)]}

    def _begin(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bit behind the zero before each high part's bucket, and how many members have a smaller one; beyond the last high part, all."""
        last = len(self.high) * 64 - self.n  # zeros in the vector
        k = np.minimum(high, last) - 1  # the zero that ends the bucket before
        word = np.searchsorted(self.zeros, np.maximum(k, 0), side="right") - 1
        bit = word * 64 + _select_in_word(~self.high[word], np.maximum(k, 0) - self.zeros[word]).astype(np.int64) + 1
        bit[k < 0] = 0
        return bit, bit - k - 1

    def _bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First member of each high part's bucket, and the one after its last."""
        bit, lo = self._begin(high)
        at, left = bit >> 6, 64 - (bit & 63)
        rest = ~self.high.take(at, mode="clip") >> (64 - left).astype(np.uint64)  # the bucket's ones are clear
        run = np.bitwise_count(~rest & rest - np.uint64(1)).astype(np.int64) * (at < len(self.high))
        hi, open_ = lo + run, np.flatnonzero(run >= left)  # these go on in the next word
        if len(open_):
            hi[open_] = self._begin(high[open_] + 1)[1]
        return lo, hi

    def _low(self, i: np.ndarray) -> np.ndarray:
        bit = i * self.low_bits
        return (self.low[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Position of each wanted number, or -1."""
        if not self.n or not len(wanted):
            return np.full(len(wanted), -1, dtype=np.int64)
        wanted = wanted.astype(np.uint64)
        high = (wanted >> np.uint64(self.low_bits)).astype(np.int64)
        lo, end = self._bucket(high)
        low, hi, open_ = wanted & np.uint64((1 << self.low_bits) - 1), end.copy(), np.flatnonzero(lo < end)
        while len(open_):  # successor search in the bucket: the first low part that is not smaller
            mid = (lo[open_] + hi[open_]) >> 1
            below = self._low(mid) < low[open_]
            lo[open_[below]] = mid[below] + 1
            hi[open_[~below]] = mid[~below]
            open_ = open_[lo[open_] < hi[open_]]
        at = np.minimum(lo, self.n - 1)
        return np.where((lo < end) & (self._low(at) == low), at, -1)
