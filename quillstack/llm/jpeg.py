"""Progressive JPEG with numpy: an encoder for byte payloads, and a decoder for any 8-bit progressive file.

The decoder runs all restart intervals of one scan, of many images, in step with each other: each step
decodes one symbol of every interval that is not done. Scans accumulate in coefficient arrays by
spectral selection and successive approximation; inverse transform, chroma upsampling and colour
conversion follow in exact integer arithmetic, so equal files give equal tensors in any batch.

The encoder keeps bytes as quantised coefficients, which JPEG keeps exactly: byte b is the coefficient
whose eight magnitude bits are b (b from 128, b - 255 below). Three components with 4:2:0 sampling; a comment segment
holds the lengths.
"""

from __future__ import annotations

import math
import re
import struct

import numpy as np

# Fixed values of the format: the zigzag order.
ZIGZAG = np.array([
    0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28,
    35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63,
])
SOI, SOF2, DHT, EOI, SOS, DQT, DRI, COM = 0xD8, 0xC2, 0xC4, 0xD9, 0xDA, 0xDB, 0xDD, 0xFE
MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")
SCALE = 11  # bits of the inverse transform's integer basis


# ---------------------------------------------------------------- encoder
def segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def table(cls: int, ident: int, by_length: dict[int, list[int]]) -> bytes:
    return bytes([cls << 4 | ident]) + bytes(len(by_length.get(n, ())) for n in range(1, 17)) + bytes(s for n in range(1, 17) for s in by_length.get(n, ()))


#: DC categories have four-bit codes. A first AC scan's usual symbol (no run, seven bits) and a
#: refining scan's (end of block) have one bit, so both kinds of scan stay in whole bytes.
TABLES = segment(DHT, table(0, 0, {4: list(range(12))}) + table(1, 0, {1: [0x07], 2: [0x00]}) + table(1, 1, {1: [0x00], 2: [0x01]}))
FLAT = segment(DQT, bytes([0]) + bytes([1] * 64))
ONE_BLOCK = segment(DRI, struct.pack(">H", 1))


def scan_head(parts: list[tuple[int, int]], ss: int, se: int, ah: int, al: int) -> bytes:
    return segment(SOS, bytes([len(parts)]) + b"".join(bytes(p) for p in parts) + bytes([ss, se, ah << 4 | al]))


DC_FIRST, DC_AGAIN = (scan_head([(1, 0), (2, 0), (3, 0)], 0, 0, *x) for x in ((0, 1), (1, 0)))
AC_FIRST = [scan_head([(c, 0x00)], 1, 63, 0, 1) for c in (1, 2, 3)]
AC_AGAIN = [scan_head([(c, 0x01)], 1, 63, 1, 0) for c in (1, 2, 3)]


def grid(blocks: int) -> tuple[int, int]:
    """Columns and rows of 16x16 units that hold so many blocks, six each."""
    units = max(1, -(-blocks // 6))
    cols = min(4095, math.isqrt(units - 1) + 1)
    return cols, -(-units // cols)


def stuffed(rows: np.ndarray, valid: np.ndarray, number: np.ndarray, last: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Rows of bytes, one restart interval each, with stuffing and restart markers; the end of each row."""
    n, w = rows.shape
    out, keep = np.zeros((n, 2 * w + 2), np.uint8), np.zeros((n, 2 * w + 2), bool)
    out[:, 0 : 2 * w : 2], keep[:, 0 : 2 * w : 2] = rows, valid
    keep[:, 1 : 2 * w : 2] = valid & (rows == 0xFF)
    out[:, -2], out[:, -1] = 0xFF, 0xD0 + number % 8
    keep[:, -2:] = ~last[:, None]
    return out[keep].tobytes(), np.cumsum(keep.sum(1))


def bit_rows(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's codes as bytes, filled up with ones: (bytes, valid)."""
    n, k = codes.shape
    wide = int(lengths.max(initial=1))
    bits = np.zeros((n, k, wide), np.uint8)
    keep = np.zeros((n, k, wide), bool)
    for j in range(wide):
        own = lengths > j
        bits[:, :, j] = (codes >> np.maximum(lengths - 1 - j, 0)) & 1
        keep[:, :, j] = own
    bits, keep = bits.reshape(n, -1), keep.reshape(n, -1)
    used = keep.sum(1)
    size = -(-used // 8)
    full = np.ones((n, int(size.max(initial=1)) * 8), np.uint8)
    full[np.arange(full.shape[1]) < used[:, None]] = bits[keep]
    return np.packbits(full, axis=1), np.arange(full.shape[1] // 8) < size[:, None]


def encode(payloads: list[tuple[bytes, int]]) -> list[bytes]:
    """JPEG files of payloads (bytes, a positive multiple of 64; length to note)."""
    grids = [grid(len(p) // 64) for p, _ in payloads]
    units = np.array([c * r for c, r in grids])
    data = np.array([len(p) // 64 for p, _ in payloads])
    first = np.cumsum(6 * units) - 6 * units  # of each image's blocks: luma rows, then both chromas
    image = np.repeat(np.arange(len(units)), 6 * units)
    inside = np.arange(len(image)) - first[image]
    full = inside < data[image]
    raw = np.zeros((len(image), 64), np.uint8)
    raw[full] = np.frombuffer(b"".join(p for p, _ in payloads), np.uint8).reshape(-1, 64)
    comp = np.minimum(inside // (4 * units[image]), 1) + (inside >= 5 * units[image])

    # DC, by units: four luma blocks and two chroma blocks.
    unit_image = np.repeat(np.arange(len(units)), units)
    unit = np.arange(len(unit_image)) - (np.cumsum(units) - units)[unit_image]
    cols = np.array([c for c, _ in grids])[unit_image]
    x, y, at, k = unit % cols, unit // cols, first[unit_image], units[unit_image]
    order = np.stack([at + (2 * y + j) * 2 * cols + 2 * x + i for j in (0, 1) for i in (0, 1)] + [at + 4 * k + unit, at + 5 * k + unit], 1)
    dc = np.where(full, np.where(raw[:, 0] < 128, raw[:, 0].astype(np.int64) - 255, raw[:, 0]), 0)[order]
    high = dc >> 1
    diff = high.copy()
    diff[:, 1:4] -= high[:, :3]
    size = np.ceil(np.log2(np.abs(diff) + 1)).astype(np.int64)
    extra = np.where(diff < 0, diff + (1 << size) - 1, diff)
    last_unit = unit == k - 1
    ends = np.cumsum(units)
    parts = []
    for head, rows in ((DC_FIRST, bit_rows((size << size) | extra, 4 + size)), (DC_AGAIN, bit_rows(dc & 1, np.ones_like(dc)))):
        body, upto = stuffed(*rows, unit, last_unit)
        parts.append((head, body, np.concatenate(([0], upto[ends - 1]))))
    # AC, by components.
    sign = raw[:, 1:] < 128
    low = np.concatenate((np.zeros((len(raw), 1), np.uint8), (raw[:, 1:] & 1) ^ sign), 1)  # an end of block, then the low magnitude bits
    for c in range(3):
        own = np.flatnonzero(comp == c)
        number = inside[own] - np.array([0, 4, 5])[c] * units[image[own]]
        count = units * (4, 1, 1)[c]
        last, ends, some = number == count[image[own]] - 1, np.cumsum(count), full[own][:, None]
        coarse = np.where(some, raw[own][:, 1:] >> 1, 0xBF)  # an empty block is an end of block, 10
        body, upto = stuffed(coarse, some | (np.arange(63) == 0), number, last)
        parts.append((AC_FIRST[c], body, np.concatenate(([0], upto[ends - 1]))))
        fine = np.where(some, np.packbits(low[own], axis=1), 0x7F)
        body, upto = stuffed(fine, some | (np.arange(8) == 0), number, last)
        parts.append((AC_AGAIN[c], body, np.concatenate(([0], upto[ends - 1]))))
    parts = parts[:2] + parts[2::2] + parts[3::2]
    out = []
    for i, ((c, r), (p, note)) in enumerate(zip(grids, payloads, strict=True)):
        frame = segment(SOF2, struct.pack(">BHHB", 8, 16 * r, 16 * c, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
        head = bytes([0xFF, SOI]) + segment(COM, struct.pack(">QQ", note, len(p))) + FLAT + frame + TABLES + ONE_BLOCK
        out.append(b"".join([head, *(x for h, body, at in parts for x in (h, body[at[i] : at[i + 1]])), bytes([0xFF, EOI])]))
    return out


# ---------------------------------------------------------------- decoder
class Image:
    """Headers of one file: size, components, quantisation tables, comment, scans."""

    def __init__(self, data: bytes):
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        self.quant: dict[int, np.ndarray] = {}
        self.comment, self.scans, self.parts = b"", [], []
        huffman: dict[tuple[int, int], bytes] = {}
        interval, at = 0, 2
        while data[at + 1] != EOI:
            marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            body, at = data[at + 4 : at + 2 + size], at + 2 + size
            if marker == COM:
                self.comment = body
            elif marker == DRI:
                interval = struct.unpack(">H", body)[0]
            elif marker == DQT:
                while body:
                    wide, ident = body[0] >> 4, body[0] & 15
                    self.quant[ident] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, 1).astype(np.int64)
                    body = body[1 + 64 * (1 + wide) :]
            elif marker == DHT:
                while body:
                    n = sum(body[1:17])
                    huffman[body[0] >> 4, body[0] & 15] = body[1 : 17 + n]
                    body = body[17 + n :]
            elif marker == SOF2:
                bits, self.height, self.width, n = struct.unpack_from(">BHHB", body)
                if bits != 8:
                    raise ValueError("only 8-bit samples are read")
                self.parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
                self.hmax, self.vmax = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
                self.cols, self.rows = -(-self.width // (8 * self.hmax)), -(-self.height // (8 * self.vmax))
            elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError("only progressive files are read")
            elif marker == SOS:
                n = body[0]
                ids = [p[0] for p in self.parts]
                own = tuple(ids.index(body[1 + 2 * i]) for i in range(n))
                ss, se, approx = body[1 + 2 * n : 4 + 2 * n]
                tables = tuple(huffman.get((1, body[2 + 2 * i] & 15) if ss else (0, body[2 + 2 * i] >> 4), b"") for i in range(n))
                end = MARKER.search(data, at).start()
                shape = tuple(p[1:3] for p in self.parts)
                self.scans.append(((own, ss, se, approx >> 4, approx & 15, tables, shape), interval, data[at:end]))
                at = end

    def blocks(self) -> list[int]:
        return [p[1] * self.cols * p[2] * self.rows for p in self.parts]


_luts: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}


def lut(spec: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Length and symbol of the code at the head of each 16-bit value."""
    if spec not in _luts:
        length, symbol = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        code, at = 0, 16
        for n in range(1, 17):
            for _ in range(spec[n - 1]):
                s = code << (16 - n)
                length[s : s + (1 << (16 - n))], symbol[s : s + (1 << (16 - n))] = n, spec[at]
                code, at = code + 1, at + 1
            code <<= 1
        if len(_luts) > 64:
            _luts.clear()
        _luts[spec] = length, symbol
    return _luts[spec]


class Streams:
    """Bit streams of restart intervals, read together."""

    def __init__(self, scans: list[bytes]):
        data = np.frombuffer(b"".join(scans) + bytes(8), np.uint8)
        ends = np.cumsum([len(s) for s in scans])
        ff = np.flatnonzero(data[:-1] == 0xFF)
        after = data[ff + 1]
        drop = np.zeros(len(data), bool)
        drop[ff[after == 0] + 1] = True
        restart = ff[(after >= 0xD0) & (after <= 0xD7)]
        drop[restart] = drop[restart + 1] = True
        kept = np.cumsum(~drop)
        starts = np.sort(np.concatenate((ends - [len(s) for s in scans], restart + 2)))
        self.scan = np.searchsorted(ends, starts, side="right")  # which scan each interval belongs to
        self.at = (kept[starts] - ~drop[starts]) * 8
        bytes_ = data[~drop].astype(np.uint32)
        bytes_ = np.concatenate((bytes_, np.zeros(8, np.uint32)))
        self.words = bytes_[:-3] << 24 | bytes_[1:-2] << 16 | bytes_[2:-1] << 8 | bytes_[3:]

    def peek(self, who: np.ndarray) -> np.ndarray:
        at = self.at[who]
        return ((self.words[np.minimum(at >> 3, len(self.words) - 1)] << (at & 7).astype(np.uint32)) >> np.uint32(16)).astype(np.int64)

    def bits(self, who: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = self.peek(who) >> (16 - n)
        self.at[who] += n
        return out

    def symbols(self, who: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        head = self.peek(who)
        size = table[0][head]
        if not size.all():
            raise ValueError("no such code")
        self.at[who] += size
        return table[1][head]

    def at_bits(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 3] >> (31 - (at & 7)).astype(np.uint32)) & 1


def extended(bits: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where((n > 0) & (bits < (1 << np.maximum(n - 1, 0))), bits - (1 << n) + 1, bits)


def decode(files: list[bytes]) -> tuple[list[Image], np.ndarray, np.ndarray]:
    """(headers, first block of each image, coefficients (blocks, 64) in zigzag order)."""
    images = [Image(f) for f in files]
    sizes = np.array([sum(im.blocks()) for im in images])
    first = np.cumsum(sizes) - sizes
    coef = np.zeros((int(sizes.sum()), 64), np.int16)
    for k in range(max((len(im.scans) for im in images), default=0)):
        groups: dict[tuple, list[int]] = {}
        for i, im in enumerate(images):
            if k < len(im.scans):
                groups.setdefault(im.scans[k][0], []).append(i)
        for kind, own in groups.items():
            run_scan(kind, [images[i] for i in own], [images[i].scans[k] for i in own], first[own], coef)
    return images, first, coef


def run_scan(kind: tuple, images: list[Image], scans: list[tuple], first: np.ndarray, coef: np.ndarray) -> None:
    own, ss, se, ah, al, tables, shape = kind
    streams = Streams([s[2] for s in scans])
    cols, rows = np.array([im.cols for im in images]), np.array([im.rows for im in images])
    single = len(own) == 1
    before = [sum(h * v for h, v in shape[:c]) for c in range(len(shape))]  # blocks a unit of earlier components
    if single:  # blocks of one component, without padding
        h, v = shape[own[0]]
        wide = np.array([-(-(-(-im.width * h // im.hmax)) // 8) for im in images])
        high = np.array([-(-(-(-im.height * v // im.vmax)) // 8) for im in images])
    else:
        wide, high = cols, rows
    total = wide * high
    every = np.array([s[1] or t for s, t in zip(scans, total, strict=True)])
    number = np.arange(len(streams.scan)) - np.searchsorted(streams.scan, streams.scan)
    unit = number * every[streams.scan]
    stop = np.minimum(unit + every[streams.scan], total[streams.scan])
    start = first[streams.scan] + (before[own[0]] * (cols * rows)[streams.scan] if single else 0)

    def place(who: np.ndarray) -> np.ndarray:
        u, s = unit[who], streams.scan[who]
        return start[who] + (u // wide[s]) * (shape[own[0]][0] * cols[s]) + u % wide[s]

    who = np.flatnonzero(unit < stop)
    if ss == 0:
        sequence = [(own[0], 0, 0)] if single else [(c, i, j) for c in own for j in range(shape[c][1]) for i in range(shape[c][0])]
        lutb = {c: lut(t) for c, t in zip(own, tables, strict=True)} if not ah else {}
        last = {c: np.zeros(len(unit), np.int64) for c in own}
        while len(who):
            s = streams.scan[who]
            x, y = unit[who] % wide[s], unit[who] // wide[s]
            for c, i, j in sequence:
                at = place(who) if single else start[who] + before[c] * (cols * rows)[s] + (shape[c][1] * y + j) * shape[c][0] * cols[s] + shape[c][0] * x + i
                if ah:
                    coef[at, 0] |= (streams.bits(who, np.ones(len(who), np.int64)) << al).astype(np.int16)
                else:
                    n = streams.symbols(who, lutb[c])
                    last[c][who] += extended(streams.bits(who, n), n)
                    coef[at, 0] = last[c][who] << al
            unit[who] += 1
            who = who[unit[who] < stop[who]]
        return
    codes, skip, k = lut(tables[0]), np.zeros(len(unit), np.int64), np.full(len(unit), ss)
    here = np.zeros(len(unit), np.int64)  # the block that each interval is in
    here[who] = place(who)
    flat = coef.reshape(-1)

    def finish(done: np.ndarray) -> None:
        unit[done] += 1
        k[done] = ss
        more = done[unit[done] < stop[done]]
        here[more] = place(more)

    def touch_up(w: np.ndarray, upto: np.ndarray) -> None:
        """Correction bits for coefficients that have a value, from k to before upto."""
        span = np.arange(64)
        block = coef[here[w]]
        has = block != 0
        has &= (span >= k[w][:, None]) & (span < upto[:, None])
        counts = has.sum(1)
        at = np.repeat(streams.at[w] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        bits = (streams.at_bits(at) << al).astype(np.int16)
        old = block[has]
        block[has] = np.where(old < 0, old - bits, old + bits)
        coef[here[w]] = block
        streams.at[w] += counts

    while len(who):
        idle = who[skip[who] > 0] if skip.any() else who[:0]
        if len(idle):
            if ah:
                touch_up(idle, np.full(len(idle), se + 1))
            skip[idle] -= 1
            finish(idle)
            who = who[unit[who] < stop[who]]
            continue
        symbol = streams.symbols(who, codes)
        if not ah and (symbol == symbol[0]).all() and 0 < symbol[0] < 16:  # the same length without a run: most steps
            n = int(symbol[0])
            bits = streams.bits(who, n)
            at = k[who]
            flat[here[who] * 64 + at] = np.where(bits < 1 << (n - 1), bits - (1 << n) + 1, bits) << al
            k[who] = at + 1
            if at.max() >= se:
                finish(who[at >= se])
                who = who[unit[who] < stop[who]]
            continue
        run, size = symbol >> 4, symbol & 15
        end = (size == 0) & (run < 15)
        if end.any():
            e = who[end]
            skip[e] = (1 << run[end]) + streams.bits(e, run[end]) - 1
            if ah:
                touch_up(e, np.full(len(e), se + 1))
        go = ~end
        w, r, n = (who, run, size) if go.all() else (who[go], run[go], size[go])
        if len(w):
            value = streams.bits(w, n)
            if ah:
                value = np.where(n > 0, np.where(value > 0, 1, -1), 0)
                zero = (coef[here[w]] == 0) & (np.arange(64) >= k[w][:, None])
                to = np.argmax(np.cumsum(zero, 1) > r[:, None], 1)  # the zero after r others
                touch_up(w, to)
                k[w] = to
            else:
                value = extended(value, n)
                k[w] += r
            some = n > 0
            flat[(here[w] * 64 + k[w])[some]] = (value << al)[some]
            k[w] += 1
        done = end | (k[who] > se)
        if done.any():
            finish(who[done])
            who = who[unit[who] < stop[who]]


def basis() -> np.ndarray:
    """(64 zigzag coefficients, 64 samples) of the inverse transform, in integers of 2**-SCALE."""
    x, u = np.arange(8)[None, :], np.arange(8)[:, None]
    c = np.where(u == 0, math.sqrt(1 / 8), 0.5) * np.cos((2 * x + 1) * u * math.pi / 16)
    whole = np.einsum("vy,ux->vuyx", c, c).reshape(64, 64)
    return np.rint(whole[ZIGZAG] * (1 << SCALE))


BASIS = basis()


def samples(coef: np.ndarray) -> np.ndarray:
    """Dequantised coefficients (blocks, 64) to 8-bit samples (blocks, 8, 8). All sums are exact integers."""
    small = np.abs(coef).max(initial=0) < 256
    kind = np.float32 if small else np.float64  # 8 + 9 + 6 bits fit in a float32's 24
    total = coef.astype(kind) @ BASIS.astype(kind)
    return np.clip(((total.astype(np.int64) + (1 << (SCALE - 1))) >> SCALE) + 128, 0, 255).astype(np.uint8).reshape(-1, 8, 8)


def planes(im: Image, blocks: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for (_, h, v, _), n in zip(im.parts, im.blocks(), strict=True):
        own = blocks[at : at + n].reshape(v * im.rows, h * im.cols, 8, 8).transpose(0, 2, 1, 3).reshape(8 * v * im.rows, 8 * h * im.cols)
        out.append(own.repeat(im.vmax // v, 0).repeat(im.hmax // h, 1)[: im.height, : im.width])
        at += n
    return out


def rgb(im: Image, blocks: np.ndarray) -> np.ndarray:
    """(height, width, 3) tensor, chroma at full resolution."""
    parts = planes(im, blocks)
    if len(parts) == 1:
        return np.repeat(parts[0][:, :, None], 3, 2)
    y, cb, cr = (p.astype(np.int32) for p in parts)
    cb, cr, half = cb - 128, cr - 128, 1 << 15
    out = np.empty((*y.shape, 3), np.uint8)
    out[:, :, 0] = np.clip(y + ((91881 * cr + half) >> 16), 0, 255)
    out[:, :, 1] = np.clip(y - ((22554 * cb + 46802 * cr + half) >> 16), 0, 255)
    out[:, :, 2] = np.clip(y + ((116130 * cb + half) >> 16), 0, 255)
    return out


def tensors(files: list[bytes]):
    """(image, payload coefficients, RGB tensor) of each file."""
    images, first, coef = decode(files)
    scaled = []
    for im, at in zip(images, first, strict=True):
        part, q = coef[at : at + sum(im.blocks())], np.concatenate([np.broadcast_to(im.quant[p[3]], (n, 64)) for p, n in zip(im.parts, im.blocks(), strict=True)]) if any((x != 1).any() for x in im.quant.values()) else None
        scaled.append(part if q is None else part * q)
    blocks = samples(np.concatenate(scaled)) if scaled else np.zeros((0, 8, 8), np.uint8)
    for im, at in zip(images, first, strict=True):
        n = sum(im.blocks())
        yield im, coef[at : at + n], rgb(im, blocks[at : at + n])


def payload(im: Image, coef: np.ndarray) -> tuple[int, bytes]:
    """(length noted, bytes) of a payload file."""
    note, size = struct.unpack(">QQ", im.comment)
    kept = coef[: size // 64]
    return note, np.where(kept < 0, kept + 255, kept).astype(np.uint8).tobytes()
