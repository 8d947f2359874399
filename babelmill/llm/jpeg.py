"""Media columns: progressive (and sequential) JPEG to full-resolution RGB tensors.

The scans of a picture are accumulated into one coefficient array a component, by spectral selection and successive
approximation; the blocks are then dequantised and inverse-transformed in numpy all at once, chroma is interpolated up
to full resolution, and the samples are turned into RGB. ``encode`` writes progressive pictures with 4:2:0 chroma, for
tables that hold no media of their own.

Contract of ``decode_column``: the input's id and (height, width, channels, tensor, error) for each input row; tensor
holds height * width * 3 bytes, row by row, red, green, blue.

* NULL media: NULL height, width, channels, tensor and error; empty or damaged media, and kinds that aren't supported
  (arithmetic coding, lossless, 12 bits, four components): NULL tensor and a text in ``error``; no row raises.
* grey pictures are repeated over the three channels. A picture whose data end early is an error, never part of one.
* pictures are decoded whole; those of more than ``most`` pixels, or whose header promises more blocks than their bits
  can fill, have a text in ``error``; a damaged stream costs no more than its size and pixels; repeated rows repeat; NULL ids are kept; an empty table gives an empty table;
  only the two named columns are read, so further columns can't clash.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import tune


def _zigzag() -> list[int]:
    """Natural index of each place in the zigzag order: along anti-diagonals, turning at each edge."""
    cells = [(r, c) for r in range(8) for c in range(8)]
    return [r * 8 + c for r, c in sorted(cells, key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))]


ZIGZAG = _zigzag()
MOST = 1 << 26  # pixels of a picture; what a worker holds grows with them, about 11 bytes each
BASIS = np.array([[(0.5 if k else 0.5**1.5) * np.cos((2 * x + 1) * k * np.pi / 16) for x in range(8)] for k in range(8)])

WAVES = np.kron(BASIS, BASIS).astype(np.float32)[ZIGZAG]  # (frequency in zigzag order, place in the block)


class Damaged(ValueError):
    """A stream that doesn't follow the format."""


EARLY = "the data of a scan end early"


@lru_cache(64)
def code_table(counts: bytes, symbols: bytes) -> tuple[array, array]:
    """For every 16 bits ahead what they begin with, as (AC, DC) entries: length | run << 5 | value << 9 of a code together
    with its value's bits. A value of 0 is a code without one. Codes whose value reaches beyond the 16 bits have a length
    of 0 and the code's own length, run and size in the higher bits; an entry of 0 is no code."""
    if len(symbols) != sum(counts):
        raise Damaged("a code table that ends early")
    lengths = np.repeat(np.arange(1, 17), list(counts))
    spans = 1 << (16 - lengths)
    if int(spans.sum()) > 65536:
        raise Damaged("a code table that overflows")
    total = int(spans.sum())
    length = np.zeros(65536, np.int64)
    symbol = np.zeros(65536, np.int64)
    length[:total] = np.repeat(lengths, spans)
    symbol[:total] = np.repeat(np.frombuffer(symbols, np.uint8), spans)
    ahead = np.arange(65536)
    out = []
    for run, size in ((symbol >> 4, symbol & 15), (np.zeros_like(symbol), np.minimum(symbol, 16))):
        whole = length + size
        raw = ahead >> np.maximum(16 - whole, 0) & ((1 << size) - 1)
        value = np.where((size > 0) & (raw >> np.maximum(size - 1, 0) == 0), raw - (1 << size) + 1, raw)
        short = whole <= 16
        entry = np.where(short, whole | run << 5 | np.where(size > 0, value, 0) << 9, (length | run << 5 | size << 9) << 5)
        out.append(array("i", np.where(length > 0, entry, 0).astype(np.int32).tobytes()))
    return out[0], out[1]


class Component:
    """Sampling factors, the quantisation table's number, and the coefficients of one component: an array of blocks of
    64, in zigzag order."""

    def __init__(self, ident: int, h: int, v: int, quant: int):
        if not (1 <= h <= 4 and 1 <= v <= 4):
            raise Damaged("a sampling factor that isn't allowed")
        self.ident, self.h, self.v, self.quant = ident, h, v, quant
        self.wide = self.high = self.own_wide = self.own_high = 0
        self.flat = array("h")

    def allocate(self) -> None:
        self.flat = array("h", bytes(128 * self.wide * self.high))

    def blocks(self) -> np.ndarray:
        return np.frombuffer(self.flat, np.int16).reshape(-1, 64)


class Bits:
    """A reader over the entropy-coded bytes of one restart interval: an integer that holds the next bits."""

    def __init__(self, data: bytes):
        self.data, self.last = data + bytes(12), len(data) * 8
        self.acc = self.n = self.p = 0

    def fill(self) -> None:
        if self.p + 6 > len(self.data):
            raise Damaged(EARLY)
        self.acc = (self.acc & ((1 << self.n) - 1)) << 48 | int.from_bytes(self.data[self.p : self.p + 6])
        self.p += 6
        self.n += 48

    def take(self, count: int) -> int:
        if self.n < count:
            self.fill()
        self.n -= count
        return self.acc >> self.n & ((1 << count) - 1)

    def signed(self, count: int) -> int:
        value = self.take(count)
        return value if value >> (count - 1) else value - (1 << count) + 1

    def many(self, count: int) -> np.ndarray:
        """The next ``count`` bits as an array."""
        at = self.p * 8 - self.n
        if at + count > self.last:
            raise Damaged(EARLY)
        found = np.unpackbits(np.frombuffer(self.data, np.uint8, (at + count + 7) // 8 - at // 8, at // 8))[at % 8 : at % 8 + count]
        at += count
        self.p, self.n = at // 8 + 1, 8 - at % 8
        self.acc = self.data[at // 8]
        return found

    def done(self) -> None:
        if self.p * 8 - self.n > self.last:
            raise Damaged(EARLY)


def _value(reader: Bits, entry: int) -> tuple[int, int]:
    """(run, value) of a code whose value reaches beyond the 16 bits that were looked up."""
    if not entry:
        raise Damaged("a code that is in no table")
    entry >>= 5
    reader.take(entry & 31)
    return entry >> 5 & 15, reader.signed(entry >> 9)


def _blocks(reader: Bits, comps: list[tuple[Component, tuple | None, tuple | None]], places: list[list[int]], low: int, progressive: bool) -> None:
    """The units of an interval, block by block: DC values, and in sequential pictures AC values after them."""
    before = [0] * len(comps)
    order = [(n, comp.flat, dc, ac, where, len(where) // len(places[-1])) for n, ((comp, dc, ac), where) in enumerate(zip(comps, places[:-1]))]
    for unit in range(len(places[-1])):
        for n, flat, dc, ac, where, each in order:
            for i in range(unit * each, unit * each + each):
                base = where[i] * 64
                if reader.n < 16:
                    reader.fill()
                entry = dc[1][reader.acc >> (reader.n - 16) & 0xFFFF]
                if entry & 31:
                    reader.n -= entry & 31
                    before[n] += entry >> 9
                else:
                    before[n] += _value(reader, entry)[1]
                flat[base] = before[n] << low
                if progressive:
                    continue
                k = 1
                while k < 64:
                    if reader.n < 16:
                        reader.fill()
                    entry = ac[0][reader.acc >> (reader.n - 16) & 0xFFFF]
                    if entry & 31:
                        reader.n -= entry & 31
                        zeros, value = entry >> 5 & 15, entry >> 9
                    else:
                        zeros, value = _value(reader, entry)
                    if value:
                        k += zeros
                        if k > 63:
                            raise Damaged("a run beyond its block")
                        flat[base + k] = value
                        k += 1
                    elif zeros == 15:
                        k += 16
                    else:
                        break


def _first(reader: Bits, flat: array, where: list[int], ac: array, start: int, stop: int, low: int) -> None:
    """The first scan of a band. A run of blocks without further values is passed over at once."""
    acc, n, p, data = reader.acc, reader.n, reader.p, reader.data
    at, count, limit = 0, len(where), len(data) - 6
    while at < count:
        base = where[at] * 64
        at += 1
        k = start
        while k <= stop:
            if n < 16:
                if p > limit:
                    raise Damaged(EARLY)
                acc = (acc & ((1 << n) - 1)) << 48 | int.from_bytes(data[p : p + 6])
                p += 6
                n += 48
            entry = ac[acc >> (n - 16) & 0xFFFF]
            if length := entry & 31:
                n -= length
                zeros, value = entry >> 5 & 15, entry >> 9
            else:
                reader.acc, reader.n, reader.p = acc, n, p
                zeros, value = _value(reader, entry)
                acc, n, p = reader.acc, reader.n, reader.p
            if value:
                k += zeros
                if k > stop:
                    raise Damaged("a run beyond its band")
                flat[base + k] = value << low
                k += 1
            elif zeros == 15:
                k += 16
            else:
                reader.acc, reader.n, reader.p = acc, n, p
                at += (1 << zeros) - 1 + (reader.take(zeros) if zeros else 0)
                acc, n, p = reader.acc, reader.n, reader.p
                break
    reader.acc, reader.n, reader.p = acc, n, p
    if at > count:
        raise Damaged("a run beyond its scan")


def _refine(reader: Bits, flat: array, where: list[int], ac: array, start: int, stop: int, low: int) -> None:
    """One more bit for a band. In a run of blocks without new values the bits of all old values are taken at once."""
    plus = 1 << low
    view = np.frombuffer(flat, np.int16).reshape(-1, 64)
    at, count = 0, len(where)
    while at < count:
        base = where[at] * 64
        k, run = start, 0
        while k <= stop:
            if reader.n < 16:
                reader.fill()
            entry = ac[reader.acc >> (reader.n - 16) & 0xFFFF]
            if entry & 31:
                reader.n -= entry & 31
                zeros, value = entry >> 5 & 15, entry >> 9
            else:
                zeros, value = _value(reader, entry)
            if not value and zeros < 15:
                run = (1 << zeros) + (reader.take(zeros) if zeros else 0)
                break
            if value not in (-1, 0, 1):
                raise Damaged("a refinement by more than a bit")
            place, end = base + k, base + stop + 1
            while place < end:
                now = flat[place]
                if now:
                    if not reader.n:
                        reader.fill()
                    reader.n -= 1
                    if reader.acc >> reader.n & 1 and not abs(now) & plus:
                        flat[place] = now + plus if now > 0 else now - plus
                elif zeros:
                    zeros -= 1
                else:
                    break
                place += 1
            if value:
                if place >= end:
                    raise Damaged("a run beyond its band")
                flat[place] = value << low
            k = place - base + 1
        if not run:
            at += 1
            continue
        if at + run > count:
            raise Damaged("a run beyond its scan")
        for rows, begin in ((where[at : at + 1], k), (where[at + 1 : at + run], start)):
            if not rows or begin > stop:
                continue
            block = view[rows, begin : stop + 1]
            old = np.nonzero(block)
            bits = reader.many(len(old[0])).astype(bool)
            now = block[old]
            block[old] = np.where(bits & (np.abs(now) & plus == 0), now + np.sign(now) * np.int16(plus), now)
            view[rows, begin : stop + 1] = block
        at += run


@lru_cache(32)
def _order(across: int, down: int, h: int, v: int, wide: int) -> np.ndarray:
    """The places of a component's blocks in the order of a scan over units of h x v blocks."""
    y, x = np.arange(down)[:, None, None, None], np.arange(across)[None, :, None, None]
    j, i = np.arange(v)[None, None, :, None], np.arange(h)[None, None, None, :]
    return ((y * v + j) * wide + x * h + i).ravel()


def _scan(parts: list[bytes], comps: list[tuple[Component, tuple | None, tuple | None]], across: int, down: int, every: int, band: tuple[int, int], high: int, low: int, progressive: bool) -> None:
    """Adds one scan to the coefficients of its components."""
    start, stop = band
    if len(comps) == 1:
        comp = comps[0][0]
        wide, tall = comp.own_wide, comp.own_high
        orders = [_order(wide, tall, 1, 1, comp.wide)]
    else:
        wide, tall = across, down
        if progressive and start:
            raise Damaged("a band of several components")
        orders = [_order(across, down, comp.h, comp.v, comp.wide) for comp, _, _ in comps]
    units = wide * tall
    step = every or units
    if -(-units // step) > len(parts):
        raise Damaged("a restart interval is missing")
    for number, first in enumerate(range(0, units, step)):
        size = min(step, units - first)
        reader = Bits(parts[number])
        own = [o[first * len(o) // units : (first + size) * len(o) // units] for o in orders]
        if progressive and start:
            comp, _, ac = comps[0]
            (_refine if high else _first)(reader, comp.flat, own[0].tolist(), ac[0], start, stop, low)
        elif high:
            each = [len(o) // size for o in own]
            bits = reader.many(size * sum(each)).reshape(size, -1).astype(np.int16) << low
            done = 0
            for (comp, _, _), where, n in zip(comps, own, each):
                comp.blocks()[where, 0] |= bits[:, done : done + n].ravel()
                done += n
        else:
            _blocks(reader, comps, [*(o.tolist() for o in own), list(range(size))], low, progressive)
        reader.done()


def decode(data: bytes, most: int = MOST) -> np.ndarray:
    """A (height, width, 3) array of bytes; raises Damaged, whatever is wrong with the data."""
    try:
        return _decode(data, most)
    except (IndexError, TypeError, KeyError, ValueError, ZeroDivisionError, OverflowError) as error:
        raise error if isinstance(error, Damaged) else Damaged(f"not a whole picture: {error}") from error


def _samples(comp: Component, quant: np.ndarray, step: int = 8192) -> np.ndarray:
    """The plane of a component: its blocks dequantised and inverse-transformed, some thousands at once."""
    blocks, out = comp.blocks(), np.empty((comp.high * comp.wide, 8, 8), np.uint8)
    both = WAVES * quant[:, None].astype(np.float32)
    for low in range(0, len(blocks), step):
        found = blocks[low : low + step].astype(np.float32) @ both + np.float32(128)
        out[low : low + step] = np.clip(np.round(found), 0, 255).astype(np.uint8).reshape(-1, 8, 8)
    return out.reshape(comp.high, comp.wide, 8, 8).swapaxes(1, 2).reshape(comp.high * 8, comp.wide * 8)


def _widen(plane: np.ndarray, comp: Component, rows: np.ndarray, width: int, height: int, h: int, v: int) -> np.ndarray:
    """Rows of a component's plane at full resolution: halved components are interpolated by a triangle filter (three
    parts of the nearer sample, one of the next), those of other factors are repeated."""
    wide, tall = -(-width * comp.h // h), -(-height * comp.v // v)
    if comp.h * 2 != h or v not in (comp.v, comp.v * 2) or wide < 3:
        return plane[rows * comp.v // v][:, np.arange(width) * comp.h // h]
    if v == comp.v:
        near, odd, even, shift = plane[rows, :wide].astype(np.int32), 2, 1, 2
    else:
        far = np.clip(rows // 2 + np.where(rows % 2, 1, -1), 0, tall - 1)
        near, odd, even, shift = 3 * plane[rows // 2, :wide].astype(np.int32) + plane[far, :wide], 7, 8, 4
    sides = np.pad(near, ((0, 0), (1, 1)), mode="edge")
    out = np.empty((len(rows), 2 * wide), np.uint8)
    out[:, 0::2] = (3 * near + sides[:, :-2] + even) >> shift
    out[:, 1::2] = (3 * near + sides[:, 2:] + odd) >> shift
    return out[:, :width]


def _decode(data: bytes, most: int) -> np.ndarray:
    if data[:2] != b"\xff\xd8":
        raise Damaged("not a JPEG stream")
    quants: dict[int, np.ndarray] = {}
    tables: dict[tuple[int, int], tuple] = {}
    comps: dict[int, Component] = {}
    height = width = across = down = every = scans = 0
    progressive, adobe, ended, at = False, None, False, 2
    while at < len(data):
        if data[at] != 0xFF:
            raise Damaged("a marker is missing")
        while data[at] == 0xFF:
            at += 1
        kind = data[at]
        at += 1
        if kind == 0xD9:
            ended = True
            break
        if kind == 0x01 or 0xD0 <= kind <= 0xD7:
            continue
        size = data[at] << 8 | data[at + 1]
        body = data[at + 2 : at + size]
        if len(body) != size - 2:
            raise Damaged("a segment ends early")
        at += size
        if kind == 0xDB:
            p = 0
            while p < len(body):
                wide, ident = body[p] >> 4, body[p] & 15
                quants[ident] = np.frombuffer(body, ">u2" if wide else "u1", 64, p + 1).astype(np.int64)
                p += 1 + 64 * (2 if wide else 1)
        elif kind == 0xC4:
            p = 0
            while p < len(body):
                counts = body[p + 1 : p + 17]
                tables[body[p] >> 4, body[p] & 15] = code_table(counts, body[p + 17 : p + 17 + sum(counts)])
                p += 17 + sum(counts)
        elif kind == 0xDD:
            every = body[0] << 8 | body[1]
        elif kind == 0xEE and body[:5] == b"Adobe":
            adobe = body[11]
        elif kind in (0xC0, 0xC1, 0xC2):
            progressive = kind == 0xC2
            height, width = body[1] << 8 | body[2], body[3] << 8 | body[4]
            if body[0] != 8 or body[5] not in (1, 3) or not height or not width or comps:
                raise Damaged("a kind of picture that isn't supported")
            for n in range(body[5]):
                ident, factors, quant = body[6 + 3 * n : 9 + 3 * n]
                comps[ident] = Component(ident, factors >> 4, factors & 15, quant)
            if len(comps) != body[5]:
                raise Damaged("two components of one name")
            h, v = max(c.h for c in comps.values()), max(c.v for c in comps.values())
            across, down = -(-width // (8 * h)), -(-height // (8 * v))
            for c in comps.values():
                c.wide, c.high = across * c.h, down * c.v
                c.own_wide, c.own_high = -(-(-(-width * c.h // h)) // 8), -(-(-(-height * c.v // v)) // 8)
            if height * width > most:
                raise Damaged(f"more than {most} pixels")
            if sum(c.own_wide * c.own_high for c in comps.values()) > 8 * len(data):
                raise Damaged("fewer bits than blocks")  # each block has a DC code of one bit at least
            for c in comps.values():
                c.allocate()
        elif 0xC3 <= kind <= 0xCF:
            raise Damaged("a kind of coding that isn't supported")
        elif kind == 0xDA:
            parts, begin, p = [], at, at
            while True:
                p = data.find(b"\xff", p)
                if p < 0 or p + 1 >= len(data):
                    raise Damaged(EARLY)
                after = data[p + 1]
                if after == 0:
                    p += 2
                    continue
                if after == 0xFF:
                    p += 1
                    continue
                parts.append(data[begin:p].replace(b"\xff\0", b"\xff"))
                if not 0xD0 <= after <= 0xD7:
                    break
                p = begin = p + 2
            at = p
            n = body[0]
            named = [(comps[body[1 + 2 * i]], tables.get((0, body[2 + 2 * i] >> 4)), tables.get((1, body[2 + 2 * i] & 15))) for i in range(n)]
            start, stop, approx = body[1 + 2 * n : 4 + 2 * n]
            if not named or progressive and (start > stop or stop > 63 or approx & 15 > 13):
                raise Damaged("a scan of nothing")
            band = (start, stop) if progressive else (0, 63)
            _scan(parts, named, across, down, every, band, approx >> 4 if progressive else 0, approx & 15 if progressive else 0, progressive)
            scans += 1
    if not comps or not scans or not ended:
        raise Damaged("the picture isn't whole")
    h, v = max(c.h for c in comps.values()), max(c.v for c in comps.values())
    planes = [(_samples(c, quants[c.quant]), c) for c in comps.values()]
    rgb = np.empty((height, width, 3), np.uint8)
    for low in range(0, height, 256):  # chroma is brought to full resolution strip by strip
        rows = np.arange(low, min(low + 256, height))
        full = [_widen(plane, c, rows, width, height, h, v) for plane, c in planes]
        if len(full) == 1:
            rgb[rows] = full[0][:, :, None]
        elif adobe == 0:
            rgb[rows] = np.stack(full, axis=2)
        else:
            y, cb, cr = full[0].astype(np.float32), full[1].astype(np.float32) - 128, full[2].astype(np.float32) - 128
            found = np.stack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], axis=2)
            rgb[rows] = np.clip(np.round(found), 0, 255).astype(np.uint8)
    return rgb


class Writer:
    """Entropy-coded bits with the fixed codes of ``encode``: four bits for DC, eight or nine for AC symbols."""

    def __init__(self) -> None:
        self.bits: list[str] = []

    def dc(self, symbol: int) -> None:
        self.bits.append(format(symbol, "04b"))

    def ac(self, symbol: int) -> None:
        self.bits.append(format(symbol, "08b") if symbol < 254 else format(0x1FC + symbol - 254, "09b"))

    def raw(self, value: int, n: int) -> None:
        if n:
            self.bits.append(format(value, f"0{n}b"))

    def value(self, value: int, n: int) -> None:
        self.raw(value if value > 0 else value + (1 << n) - 1, n)

    def bytes(self) -> bytes:
        text = "".join(self.bits)
        text += "1" * (-len(text) % 8)
        return int("1" + text, 2).to_bytes(len(text) // 8 + 1, "big")[1:].replace(b"\xff", b"\xff\0") if text else b""


def _encode_ac(blocks: list[list[int]], start: int, stop: int, high: int, low: int) -> bytes:
    """One AC scan of one component: the first approximation if high is 0, else a refinement by one bit."""
    out, run, held = Writer(), 0, []

    def flush() -> None:
        nonlocal run, held
        if run:
            n = run.bit_length() - 1
            out.ac(n << 4)
            out.raw(run - (1 << n), n)
            run = 0
        for bit in held:
            out.raw(bit, 1)
        held = []

    for block in blocks:
        sizes = [abs(block[ZIGZAG[k]]) >> low for k in range(64)]
        zeros, extra = 0, []
        last = max((k for k in range(start, stop + 1) if sizes[k] == 1), default=0) if high else 63
        for k in range(start, stop + 1):
            size = sizes[k]
            if not size:
                zeros += 1
                continue
            while zeros > 15 and k <= last:
                flush()
                out.ac(0xF0)
                zeros -= 16
                for bit in extra:
                    out.raw(bit, 1)
                extra = []
            if high and size > 1:
                extra.append(size & 1)
                continue
            flush()
            positive = block[ZIGZAG[k]] > 0
            if high:
                out.ac(zeros << 4 | 1)
                out.raw(int(positive), 1)
                for bit in extra:
                    out.raw(bit, 1)
                extra = []
            else:
                n = size.bit_length()
                out.ac(zeros << 4 | n)
                out.value(size if positive else -size, n)
            zeros = 0
        if zeros or extra:
            run += 1
            held += extra
            if run == 0x7FFF or len(held) > 900:
                flush()
    flush()
    return out.bytes()


def encode(rgb: np.ndarray, step: int = 12) -> bytes:
    """A progressive stream with 4:2:0 chroma: ten scans, spectral selection and two successive approximations."""
    height, width, _ = rgb.shape
    across, down = -(-width // 16), -(-height // 16)
    full = np.pad(rgb.astype(float), ((0, down * 16 - height), (0, across * 16 - width), (0, 0)), mode="edge")
    r, g, b = full[:, :, 0], full[:, :, 1], full[:, :, 2]
    planes = [0.299 * r + 0.587 * g + 0.114 * b, 128 - 0.168736 * r - 0.331264 * g + 0.5 * b, 128 + 0.5 * r - 0.418688 * g - 0.081312 * b]
    quant = np.clip(step * (1 + np.add.outer(np.arange(8), np.arange(8)) / 4), 1, 255).astype(int)
    comps = []
    for n, plane in enumerate(planes):
        if n:
            plane = plane.reshape(down * 8, 2, across * 8, 2).mean(axis=(1, 3))
        tall, wide = plane.shape[0] // 8, plane.shape[1] // 8
        blocks = (plane - 128).reshape(tall, 8, wide, 8).swapaxes(1, 2)
        found = np.round(np.einsum("ku,abuv,lv->abkl", BASIS, blocks, BASIS) / quant).astype(int).reshape(tall, wide, 64)
        own = (-(-height // (8 if n == 0 else 16)), -(-width // (8 if n == 0 else 16)))
        comps.append((found, own))

    def segment(kind: int, body: bytes) -> bytes:
        return bytes([0xFF, kind]) + (len(body) + 2).to_bytes(2, "big") + body

    out = [b"\xff\xd8", segment(0xDB, b"\0" + bytes(quant.ravel()[ZIGZAG].tolist()))]
    frame = bytes([8, *height.to_bytes(2, "big"), *width.to_bytes(2, "big"), 3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    out.append(segment(0xC2, frame))
    out.append(segment(0xC4, b"\0" + bytes([0, 0, 0, 12, *[0] * 12]) + bytes(range(12))))
    out.append(segment(0xC4, b"\x10" + bytes([0] * 7 + [254, 2] + [0] * 7) + bytes(range(256))))

    def scan(which: list[int], start: int, stop: int, high: int, low: int, data: bytes) -> None:
        body = bytes([len(which), *(x for c in which for x in (c + 1, 0)), start, stop, high << 4 | low])
        out.append(segment(0xDA, body) + data)

    def dc(high: int, low: int) -> bytes:
        bits, before = Writer(), [0, 0, 0]
        for y in range(down):
            for x in range(across):
                for n, (found, _) in enumerate(comps):
                    f = 2 if n == 0 else 1
                    for j in range(f):
                        for i in range(f):
                            value = int(found[y * f + j, x * f + i, 0]) >> low
                            if high:
                                bits.raw(value & 1, 1)
                            else:
                                size = abs(value - before[n]).bit_length()
                                bits.dc(size)
                                bits.value(value - before[n], size)
                                before[n] = value
        return bits.bytes()

    def ac(n: int, start: int, stop: int, high: int, low: int) -> None:
        found, (tall, wide) = comps[n]
        scan([n], start, stop, high, low, _encode_ac(found[:tall, :wide].reshape(-1, 64).tolist(), start, stop, high, low))

    scan([0, 1, 2], 0, 0, 0, 1, dc(0, 1))
    for n, start, stop, high, low in ((0, 1, 5, 0, 2), (2, 1, 63, 0, 1), (1, 1, 63, 0, 1), (0, 6, 63, 0, 2), (0, 1, 63, 2, 1)):
        ac(n, start, stop, high, low)
    scan([0, 1, 2], 0, 0, 1, 0, dc(1, 0))
    for n in (2, 1, 0):
        ac(n, 1, 63, 1, 0)
    return b"".join([*out, b"\xff\xd9"])


def draw(vector: list[float], number: int) -> np.ndarray:
    """A small picture of a vector: its values as coloured tiles, in one of several sizes that needn't fit blocks."""
    height, width = 17 + number % 8, 24 - number % 5
    values = np.asarray(vector, float)
    values = values[np.isfinite(values)] if len(values) else values
    if not len(values):
        values = np.zeros(1)
    place = (np.arange(height)[:, None] // 3 * 8 + np.arange(width)[None, :] // 3)[:, :, None] + 21 * np.arange(3)
    return np.clip(128 + 400 * values[place % len(values)], 0, 255).astype(np.uint8)


def media_column(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, media): a progressive JPEG for each vector, NULL for a NULL vector. The tables hold no media, so these stand in."""
    tune(df.sparkSession)
    kept = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            media = [None if v is None else encode(draw([x for x in v if x is not None], i or 0)) for i, v in zip(ids, vectors)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(media, pa.binary())], names=["id", "media"])

    return kept.mapInArrow(run, "id long, media binary").withColumnRenamed("id", id_column)


def decode_column(df: DataFrame, id_column: str, media_column: str = "media", step: int = 64, most: int = MOST) -> DataFrame:
    """RGB tensors of a media column; a single narrow stage whose batches are cut small, as tensors are large."""
    tune(df.sparkSession)
    kept = df.select(F.col(id_column).cast("long").alias("id"), F.col(media_column).cast("binary").alias("media"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                rows: list[tuple] = []
                for media in part.column(1).to_pylist():
                    if media is None:
                        rows.append((None, None, None, None, None))
                        continue
                    try:
                        rgb = decode(media, most)
                        rows.append((*rgb.shape, rgb.tobytes(), None))
                    except Damaged as error:
                        rows.append((None, None, None, None, str(error)))
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string())
                columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["id", "height", "width", "channels", "tensor", "error"])

    out = kept.mapInArrow(run, "id long, height int, width int, channels int, tensor binary, error string")
    return out.withColumnRenamed("id", id_column)
