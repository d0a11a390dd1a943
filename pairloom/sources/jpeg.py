"""Whether a JPEG's scans hold all the blocks its header promises.

The entropy-coded data is walked code by code; no pixel is made. Baseline, extended
and progressive Huffman files are covered, with restart markers. A window of 16 bits finds a
code's length and what follows it in one look-up, so a symbol costs one step.
"""

import re
import struct
from array import array
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

# Markers.
SOI, EOI, SOS, DHT, DQT, DRI, DNL = 0xD8, 0xD9, 0xDA, 0xC4, 0xDB, 0xDD, 0xDC
WALKED = {0xC0: False, 0xC1: False, 0xC2: True}  # frames with Huffman codes: progressive or not
FRAMES = {*range(0xC0, 0xD0)} - {DHT, 0xC8, 0xCC}
ALONE = {0x01, *range(0xD0, 0xD8)}  # without a length

_MARKER = re.compile(rb"\xff+([\x01-\xcf\xd8-\xfe])")
_RESTART = re.compile(rb"\xff+([\xd0-\xd7])")
END = 128  # a step that ends the block
MAX_PIXELS = 178_956_970  # fixed value: more count as an attack and are no image


class NotWalked(Exception):
    """A kind of file whose codes are not followed here."""


class Broken(Exception):
    """The file lacks something that decoding needs."""


@lru_cache(maxsize=64)
def symbols(counts: bytes, values: bytes) -> array:
    """For each 16 bits ahead: 256 * length + symbol of the code they begin with; 0 where none fits."""
    table = np.zeros(1 << 16, np.int64)
    code = at = 0
    for length, count in enumerate(counts, 1):
        for _ in range(count):
            low = code << (16 - length)
            if at >= len(values) or low >= 1 << 16:
                raise Broken("a code table")
            table[low : low + (1 << (16 - length))] = 256 * length + values[at]
            code, at = code + 1, at + 1
        code <<= 1
    return _packed(table)


def _packed(table: np.ndarray) -> array:
    return array("I", table.astype(np.uint32).tobytes())


@lru_cache(maxsize=64)
def steps(counts: bytes, values: bytes, dc: bool) -> array:
    """For each 16 bits ahead: 256 * bits to skip, the code and its number, + coefficients passed; 0 where no code fits."""
    table = np.array(symbols(counts, values), np.int64)
    length, symbol = table >> 8, table & 255
    run, size = symbol >> 4, symbol & 15
    if dc:
        return _packed(np.where((length > 0) & (symbol <= 16), 256 * (length + symbol) + 1, 0))
    passed = np.where(size > 0, run + 1, np.where(run == 15, 16, END))
    return _packed(np.where(length > 0, 256 * (length + size) + passed, 0))


JUMP_BLOCKS = 1024  # a scan must have so many blocks to be worth a table of jumps


@lru_cache(maxsize=64)
def jumps(dc: tuple[bytes, bytes], ac: tuple[bytes, bytes], most: int) -> array:
    """For each 16 bits ahead: 256 * bits + number of the whole blocks, at most ``most``, that they begin with; 0 if they hold none."""
    first, later = np.array(steps(*dc, True), np.int64), np.array(steps(*ac, False), np.int64)
    ahead = np.arange(1 << 16)
    out, at, going = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.ones(1 << 16, bool)
    for n in range(1, most + 1):
        k = np.zeros(1 << 16, np.int64)
        while (open_ := np.flatnonzero(going & (k < 64))).size:
            window = ahead[open_] << at[open_] & 65535
            e = np.where(k[open_] == 0, first[window], later[window])
            fits = (e > 0) & (at[open_] + (e >> 8) <= 16)
            going[open_[~fits]] = False
            at[open_] += np.where(fits, e >> 8, 0)
            k[open_] += np.where(fits, e & 255, 0)
        going &= (k == 64) | (k >= END)
        out[going] = 256 * at[going] + n
    return _packed(out)


@dataclass
class Component:
    wide: int
    high: int
    table: int
    columns: int = 0  # of blocks that hold pixels
    rows: int = 0
    line: int = 0  # blocks of a row of units
    known: bytearray = field(default_factory=bytearray)  # coefficients that earlier scans made non-zero


class Frame:
    def __init__(self, body: bytes, progressive: bool):
        _, self.height, self.width, n = struct.unpack_from(">BHHB", body)
        if not self.height:
            raise NotWalked("the height comes later")
        if not self.width or self.width * self.height > MAX_PIXELS or not n or len(body) < 6 + 3 * n:
            raise Broken("the frame header")
        self.progressive = progressive
        self.parts: dict[int, Component] = {}
        for i in range(n):
            name, sampling, table = body[6 + 3 * i : 9 + 3 * i]
            self.parts[name] = Component(sampling >> 4, sampling & 15, table)
        if any(not 1 <= s <= 4 for p in self.parts.values() for s in (p.wide, p.high)):
            raise Broken("the sampling")
        wide, high = max(p.wide for p in self.parts.values()), max(p.high for p in self.parts.values())
        self.across, self.down = -(-self.width // (8 * wide)), -(-self.height // (8 * high))
        for p in self.parts.values():
            p.columns, p.rows = -(-(-(-self.width * p.wide // wide)) // 8), -(-(-(-self.height * p.high // high)) // 8)
            p.line = self.across * p.wide
        self.seen: set[int] = set()


class Bits:
    """The bits between two markers. Reading past the end gives zeros, and ``late`` tells."""

    def __init__(self, data: bytes):
        data = data.replace(b"\xff\x00", b"\xff")
        self.end = 8 * len(data)
        raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
        ahead = raw[:-3] << 24
        for i, shift in ((1, 16), (2, 8), (3, 0)):
            ahead |= raw[i : i + len(ahead)] << shift
        self.ahead = array("I", ahead.tobytes())
        self.at = 0

    def check(self) -> None:
        if self.at > self.end:
            raise Broken("the scan ends early")


def _sequential(bits: Bits, blocks: int, plan: list[tuple[array, array]], jump: list[array]) -> None:
    """``blocks`` blocks whose code tables come by turns from ``plan``; ``jump`` has ``jumps`` of the same tables, or nothing."""
    ahead, p, end = bits.ahead, bits.at, bits.end
    turns, i = len(plan), 0
    while i < blocks:
        if jump and p + 16 <= end and i + 16 <= blocks:
            e = jump[i % turns][ahead[p >> 3] >> (16 - (p & 7)) & 65535]
            if e:
                p += e >> 8
                i += e & 255
                continue
        if p >= end:
            raise Broken("the scan ends early")
        dc, ac = plan[i % turns]
        e = dc[ahead[p >> 3] >> (16 - (p & 7)) & 65535]
        if not e:
            raise Broken("a code")
        p += e >> 8
        k = 1
        while k < 64:
            if p > end:
                raise Broken("the scan ends early")
            e = ac[ahead[p >> 3] >> (16 - (p & 7)) & 65535]
            if not e:
                raise Broken("a code")
            p += e >> 8
            k += e & 255
        if 64 < k < END:
            raise Broken("a block")
        i += 1
    bits.at = p
    bits.check()


def _first(bits: Bits, places: list[int], table: array, known: bytearray, low: int, high: int) -> None:
    """First scan of some AC coefficients: runs of blocks may end together."""
    ahead, p, end, ended = bits.ahead, bits.at, bits.end, 0
    for base in places:
        if ended:
            ended -= 1
            continue
        k = low
        while k <= high:
            if p >= end:
                raise Broken("the scan ends early")
            e = table[ahead[p >> 3] >> (16 - (p & 7)) & 65535]
            if not e:
                raise Broken("a code")
            p += e >> 8
            run, size = e >> 4 & 15, e & 15
            if size:
                k += run
                if k > high:
                    raise Broken("a block")
                known[base + k] = 1
                p += size
                k += 1
            elif run == 15:
                k += 16
            else:
                ended = (1 << run) - 1 + ((ahead[p >> 3] >> (32 - (p & 7) - run) & ((1 << run) - 1)) if run and p < end else 0)
                p += run
                break
    bits.at = p
    bits.check()


def _refined(bits: Bits, places: list[int], table: array, known: bytearray, low: int, high: int) -> None:
    """A further bit of some AC coefficients: one for each that is known, codes for those that become so."""
    ahead, p, end, ended = bits.ahead, bits.at, bits.end, 0
    for base in places:
        k = low
        if not ended:
            while k <= high:
                if p >= end:
                    raise Broken("the scan ends early")
                e = table[ahead[p >> 3] >> (16 - (p & 7)) & 65535]
                if not e:
                    raise Broken("a code")
                p += e >> 8
                run, size = e >> 4 & 15, e & 15
                if size > 1:
                    raise Broken("a block")
                if size:
                    p += 1
                elif run < 15:
                    ended = (1 << run) + ((ahead[p >> 3] >> (32 - (p & 7) - run) & ((1 << run) - 1)) if run and p < end else 0)
                    p += run
                    break
                while k <= high:
                    if known[base + k]:
                        p += 1
                    elif run:
                        run -= 1
                    else:
                        break
                    k += 1
                if size:
                    if k > high:
                        raise Broken("a block")
                    known[base + k] = 1
                k += 1
        if ended:
            p += sum(known[base + k : base + high + 1])
            ended -= 1
    bits.at = p
    bits.check()


def _scan(frame: Frame, body: bytes, pieces: list[tuple[bytes, int]], interval: int, dc: dict, ac: dict, quantisers: set[int]) -> None:
    """One scan: its header, and its data between restart markers with the number of the marker before."""
    n = body[0] if body else 0
    if not n or len(body) < 4 + 2 * n:
        raise Broken("the scan header")
    chosen = []
    for i in range(n):
        name, tables = body[1 + 2 * i], body[2 + 2 * i]
        part = frame.parts.get(name)
        if part is None or part.table not in quantisers:
            raise Broken("a component")
        chosen.append((part, tables >> 4, tables & 15))
        frame.seen.add(name)
    low, high, above = body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4
    if n == 1:
        units, blocks = chosen[0][0].columns * chosen[0][0].rows, 1
    else:
        units, blocks = frame.across * frame.down, sum(p.wide * p.high for p, _, _ in chosen)
    interval = interval or units
    if len(pieces) < -(-units // interval):
        raise Broken("the scan ends early")
    pieces = pieces[: -(-units // interval)]
    if [m for _, m in pieces[1:]] != [i % 8 for i in range(len(pieces) - 1)]:
        raise Broken("a restart marker")
    if not frame.progressive:
        tables = [(dc[d], ac[a]) for p, d, a in chosen for _ in range(p.wide * p.high if n > 1 else 1)]
        plan = [(steps(*d, True), steps(*a, False)) for d, a in tables]
        most = 8 if len(set(tables)) == 1 else 1  # a block has two bits at least
        jump = [jumps(d, a, most) for d, a in tables] if units * blocks >= JUMP_BLOCKS else []
    elif low == 0:
        if high:
            raise Broken("the scan header")
        plan = [steps(*dc[d], True) for p, d, _ in chosen for _ in range(p.wide * p.high if n > 1 else 1)] if not above else []
    else:
        part, _, a = chosen[0]
        if n > 1 or not low <= high < 64:
            raise Broken("the scan header")
        table = symbols(*ac[a])
        if not part.known:
            part.known = bytearray(64 * part.line * frame.down * part.high)
    for i, (data, _) in enumerate(pieces):
        bits, count = Bits(data), min(interval, units - i * interval)
        if not frame.progressive:
            _sequential(bits, count * blocks, plan, jump)
        elif low == 0 and above:
            bits.at = count * blocks
            bits.check()
        elif low == 0:
            _levels(bits, count * blocks, plan)
        else:
            places = [64 * (u // part.columns * part.line + u % part.columns) for u in range(i * interval, i * interval + count)]
            (_refined if above else _first)(bits, places, table, part.known, low, high)


def _levels(bits: Bits, blocks: int, plan: list[array]) -> None:
    """First scan of DC values: one code a block."""
    ahead, p, end, turns = bits.ahead, bits.at, bits.end, len(plan)
    for i in range(blocks):
        if p >= end:
            raise Broken("the scan ends early")
        e = plan[i % turns][ahead[p >> 3] >> (16 - (p & 7)) & 65535]
        if not e:
            raise Broken("a code")
        p += e >> 8
    bits.at = p
    bits.check()


def _code_tables(body: bytes, dc: dict, ac: dict) -> None:
    at = 0
    while at < len(body):
        counts = body[at + 1 : at + 17]
        n = sum(counts)
        values = body[at + 17 : at + 17 + n]
        if len(counts) < 16 or len(values) < n or n > 256:
            raise Broken("a code table")
        (ac if body[at] >> 4 else dc)[body[at] & 15] = (counts, values)
        at += 17 + n


def walk(data: bytes) -> tuple[int, int]:
    """Width and height of a JPEG all of whose blocks are there, up to the end marker.

    Raises ``Broken`` if codes, blocks, tables or markers are missing or wrong, and ``NotWalked``
    for arithmetic coding, lossless and hierarchical files. It is stricter than decoders that fill up what a
    torn scan lacks. Bytes after the end marker, and between a scan's last block and the next marker, are ignored.
    """
    at, frame, interval = 2, None, 0
    dc: dict = {}
    ac: dict = {}
    quantisers: set[int] = set()
    try:
        while True:
            found = _MARKER.match(data, at)
            if not found:
                raise Broken("a marker")
            marker, at = found[1][0], found.end()
            if marker in ALONE:
                continue
            if marker == EOI:
                if frame is None or frame.seen != set(frame.parts):
                    raise Broken("a scan")
                return frame.width, frame.height
            (length,) = struct.unpack_from(">H", data, at)
            body = data[at + 2 : at + length]
            if length < 2 or len(body) < length - 2:
                raise Broken("a segment")
            at += length
            if marker in FRAMES:
                if marker not in WALKED:
                    raise NotWalked(f"frame {marker:x}")
                if frame is not None:
                    raise Broken("a second frame")
                frame = Frame(body, WALKED[marker])
            elif marker == DHT:
                _code_tables(body, dc, ac)
            elif marker == DQT:
                i = 0
                while i < len(body):
                    quantisers.add(body[i] & 15)
                    i += 129 if body[i] >> 4 else 65
            elif marker == DRI:
                (interval,) = struct.unpack_from(">H", body)
            elif marker == DNL:
                raise NotWalked("the height comes later")
            elif marker == SOS:
                if frame is None:
                    raise Broken("a scan before the frame")
                after = _MARKER.search(data, at)
                end = after.start() if after else len(data)
                cuts = [(m.start(), m.end(), m[1][0] & 7) for m in _RESTART.finditer(data, at, end)] if interval else []
                starts, stops = [at, *(c[1] for c in cuts)], [*(c[0] for c in cuts), end]
                pieces = [(data[a:b], m) for a, b, m in zip(starts, stops, [-1, *(c[2] for c in cuts)], strict=True)]
                _scan(frame, body, pieces, interval, dc, ac, quantisers)
                at = end
    except (KeyError, IndexError, struct.error) as e:
        raise Broken("a table, or the end of the file") from e
