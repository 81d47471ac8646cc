"""Progressive JPEG: lossless storage of bytes as quantised DCT coefficients, and decoding to RGB tensors.

``encode`` writes a payload as the coefficients of a progressive JPEG with chroma at half resolution (4:2:0): every byte
is one coefficient, in the order of the MCUs' blocks. Its scans are those of any progressive file: DC first, AC by spectral
selection, then one refinement of each by successive approximation; restart markers cut every scan into intervals.

``decode`` accumulates all scans into coefficient arrays, gives the payload back from them, and then
dequantises, inverse-transforms, upsamples chroma and converts to full-resolution RGB. Intervals of all images of a batch
are decoded in step with one another: each numpy operation reads one code of every interval.

Which byte is which coefficient: ``level`` moves bytes away from zero so that the first scans already make every
coefficient nonzero; files of other encoders, whose refinements also bring new coefficients, decode by the same code.

Cases: null and empty texts hold one unit of padding; payloads of any length are cut into blocks, and images of more than
65,500 lines are refused with an error (over 1.6 GB); equal texts give equal files; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tributary.llm.common import gather, groups, map_rows, utf8
from tributary.session import ship

#: Payloads are filled with bytes 255 to a positive multiple of UNIT.
UNIT = 576
MCU = 384
#: Blocks (AC scans) or MCUs (DC scans) between restart markers.
RESTART = 4
#: Texts decoded in step, in characters.
BATCH_CHARS = 2_000_000
#: (components, first and last coefficient, high and low bit): the scans' order.
SCANS = (
    ((0, 1, 2), 0, 0, 0, 1),
    ((0,), 1, 5, 0, 1),
    ((0,), 6, 63, 0, 1),
    ((1,), 1, 63, 0, 1),
    ((2,), 1, 63, 0, 1),
    ((0, 1, 2), 0, 0, 1, 0),
    ((0,), 1, 63, 1, 0),
    ((1,), 1, 63, 1, 0),
    ((2,), 1, 63, 1, 0),
)


def zigzag() -> np.ndarray:
    """Row-major place of each coefficient in zigzag order: anti-diagonals, alternately upwards and downwards."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (sum(x), x[0] if sum(x) % 2 else x[1]))
    return np.array([8 * r + c for r, c in cells])


ZIGZAG = zigzag()


def idct_matrix() -> np.ndarray:
    k = np.arange(8)
    m = np.cos((2 * k[None, :] + 1) * k[:, None] * math.pi / 16) / 2
    m[0] /= math.sqrt(2)
    return m.astype(np.float32)


IDCT = idct_matrix()


def level(data: np.ndarray) -> np.ndarray:
    """Bytes to coefficients of magnitude 2 or more."""
    x = data.astype(np.int16) - 128
    return np.where(x >= 0, x + 2, x - 1).astype(np.int16)


def unlevel(c: np.ndarray) -> np.ndarray:
    return (np.where(c >= 0, c - 2, c + 1) + 128).astype(np.uint8)


class Huffman:
    """A canonical code from the number of symbols of each length."""

    def __init__(self, counts: list[int], symbols: list[int]):
        self.counts, self.symbols = counts, symbols
        self.code, self.length = np.zeros(256, np.uint32), np.zeros(256, np.int64)
        #: the next 16 bits -> symbol << 8 | length; 0 where no code begins so
        self.table = np.zeros(1 << 16, np.int32)
        code = at = 0
        for bits, n in enumerate(counts, 1):
            for s in symbols[at : at + n]:
                self.code[s], self.length[s] = code, bits
                self.table[code << (16 - bits) : (code + 1) << (16 - bits)] = s << 8 | bits
                code += 1
            at += n
            code <<= 1

    def segment(self, kind: int) -> bytes:
        return struct.pack(">HHB", 0xFFC4, 19 + len(self.symbols), kind) + bytes(self.counts) + bytes(self.symbols)


def _made(short: list[tuple[int, int]], rest: list[int]) -> Huffman:
    """(symbol, length) of the frequent ones; the rest get 12 bits."""
    counts = [0] * 16
    for _, n in short:
        counts[n - 1] += 1
    counts[11] += len(rest)
    return Huffman(counts, [s for s, _ in sorted(short, key=lambda x: x[1])] + rest)


def tables() -> tuple[Huffman, Huffman]:
    """Codes of this encoder: DC differences by size; AC with the sizes of text bytes first."""
    dc = _made([(s, 3 if s in (3, 4, 5, 6) else 4 if s in (0, 1, 2, 7) else 6) for s in range(12)], [])
    first = [(4, 2), (3, 3), (5, 3), (2, 4), (6, 4), (1, 6), (7, 6), (0, 6), (0xF0, 7)]
    # zeros only stand at a block's end here, so that no size follows a run
    return dc, _made(first, [0x10 * r for r in range(1, 15)])


DC_CODE, AC_CODE = tables()


def shape(n_bytes: int) -> tuple[int, int]:
    """MCUs across and down for a payload."""
    n = max(1, -(-n_bytes // MCU))
    across = min(4000, math.isqrt(n - 1) + 1)
    return across, -(-n // across)


def raster_of(across: int, down: int) -> np.ndarray:
    """Number (4 MCU + block) of each luma block in raster order."""
    n = np.arange(4 * across * down).reshape(down, across, 2, 2)
    return n.transpose(0, 2, 1, 3).ravel()


def from_planes(luma: np.ndarray, cb: np.ndarray, cr: np.ndarray, across: int, down: int) -> np.ndarray:
    y = luma.reshape(down, 2, across, 2, 64).transpose(0, 2, 1, 3, 4).reshape(-1, 4, 64)
    return np.concatenate([y, cb[:, None], cr[:, None]], 1)


BIT_SIZES = np.array([n.bit_length() for n in range(1 << 12)], np.int64)


def bit_size(x: np.ndarray) -> np.ndarray:
    """Bits of a magnitude under 2^12."""
    return BIT_SIZES[np.abs(x)]


def pack_fields(values: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fields of up to 31 bits, highest bit first, in byte-aligned intervals that end after the given fields, filled up with 1s.

    Returns all bytes and each interval's number of them.
    """
    total = np.concatenate([[0], np.cumsum(lengths)])
    first = np.concatenate([[0], ends[:-1]])
    bits = total[ends] - total[first]
    size = (bits + 7) // 8
    base = (np.cumsum(size) - size) * 8
    at = total[:-1] + np.repeat(base - total[first], ends - first)
    # the fill of each interval is a field too
    fill = size * 8 - bits
    values = np.concatenate([values, (1 << fill) - 1])
    lengths = np.concatenate([lengths, fill])
    at = np.concatenate([at, base + bits])
    word = at >> 5
    wide = values.astype(np.uint64) << (64 - (at & 31) - lengths).astype(np.uint64)
    # every field lies in two neighbouring 32-bit words; fields don't overlap, so that sums are unions (exact in doubles)
    n = int(size.sum()) // 4 + 3
    out = np.bincount(word, (wide >> np.uint64(32)).astype(np.float64), n)
    out[1:] += np.bincount(word, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), n)[:-1]
    return np.frombuffer(out.astype(np.uint32).astype(">u4").tobytes(), np.uint8)[: int(size.sum())], size


def pack_flags(flags: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Single bits (0 or 1) in the same form."""
    bits = np.diff(ends, prepend=0)
    size = (bits + 7) // 8
    base = (np.cumsum(size) - size) * 8
    out = np.ones(int(size.sum()) * 8, np.uint8)
    out[gather(base, bits)] = flags
    return np.packbits(out), size


def assemble(raw: np.ndarray, size: np.ndarray, intervals: np.ndarray) -> list[bytes]:
    """Each image's data of one scan: its intervals with restart markers between them, 255 escaped."""
    escape = raw == 255
    moved = np.cumsum(escape) - escape
    first = np.cumsum(intervals) - intervals
    own = np.arange(len(size)) - np.repeat(first, intervals)  # number inside the image
    marked = own > 0
    before = np.cumsum(marked)  # markers up to and with each interval's own
    dest = np.arange(len(raw)) + moved + 2 * np.repeat(before, size)
    out = np.zeros(len(raw) + int(escape.sum()) + 2 * int(marked.sum()), np.uint8)
    out[dest] = raw
    start = np.cumsum(size) - size
    grown = start + (np.concatenate([moved, [int(escape.sum())]])[start] if len(raw) else 0) + 2 * before
    at = grown[marked]
    out[at - 2] = 255
    out[at - 1] = 0xD0 + (own[marked] - 1) % 8
    edge = np.append(grown[first], len(out))
    data = out.tobytes()
    return [data[x:y] for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]


def _ac_first(band: np.ndarray, code: Huffman) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fields of a first AC scan: values, lengths, and each block's number of fields."""
    n, width = band.shape
    row, col = np.nonzero(band)
    value = band[row, col].astype(np.int64)
    fresh = np.diff(row, prepend=-1) != 0
    run = np.where(fresh, col, np.diff(col, prepend=0) - 1)
    size = bit_size(value)
    extra = value + np.where(value < 0, (1 << size) - 1, 0)
    symbol = (run & 15) << 4 | size
    field = (code.code[symbol].astype(np.int64) << size) | extra
    length = code.length[symbol] + size
    long = run >> 4  # each sixteen zeros have a code of their own
    last = np.full(n, -1, np.int64)
    last[row] = col
    stops = last < width - 1  # an end of block
    per = np.bincount(row, long + 1, n).astype(np.int64) + stops
    if not (stops.any() or long.any()):
        return field, length, per
    ends = np.cumsum(per)
    at = np.cumsum(long + 1) - 1 + (np.cumsum(stops) - stops)[row]
    fields = np.full(int(ends[-1]), int(code.code[0xF0]), np.int64)
    lengths = np.full(len(fields), int(code.length[0xF0]), np.int64)
    fields[at], lengths[at] = field, length
    fields[ends[stops] - 1], lengths[ends[stops] - 1] = int(code.code[0]), int(code.length[0])
    return fields, lengths, per


def _ac_refine(old: np.ndarray, new: np.ndarray, ends: np.ndarray, code: Huffman) -> tuple[np.ndarray, np.ndarray]:
    """Flags of a refining AC scan in which no coefficient is new: for each interval one end of all its bands, then a
    correction bit for each known coefficient. Returns the flags and where each interval's ones end."""
    known = old != 0
    bits = (np.abs(new) & 1)[known].astype(np.uint8)
    blocks = np.diff(ends, prepend=0)
    power = bit_size(blocks) - 1
    head_value = (code.code[power << 4].astype(np.int64) << power) | (blocks - (1 << power))
    head_length = code.length[power << 4] + power
    per = np.add.reduceat(known.sum(1), ends - blocks)
    finish = np.cumsum(head_length + per)
    start = finish - head_length - per
    out = np.empty(int(finish[-1]), np.uint8)
    out[gather(start + head_length, per)] = bits
    for i in range(int(head_length.max())):
        some = head_length > i
        out[start[some] + i] = head_value[some] >> (head_length[some] - 1 - i) & 1
    return out, finish


def _segment(marker: int, data: bytes) -> bytes:
    return struct.pack(">HH", marker, len(data) + 2) + data


def _cuts(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of intervals of ``size`` units over images of so many units, and each image's number of them."""
    intervals = -(-counts // size)
    number = gather(np.ones(len(counts), np.int64), intervals)
    before = np.cumsum(counts) - counts
    return np.minimum(number * size, np.repeat(counts, intervals)) + np.repeat(before, intervals), intervals


def encode(payloads: list[bytes], restart: int = RESTART) -> list[bytes]:
    """A progressive JPEG for each payload; all are worked on together."""
    if not payloads:
        return []
    shapes = [shape(len(p)) for p in payloads]
    mcus = np.array([a * d for a, d in shapes], np.int64)
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    flat = np.zeros(int(mcus.sum()) * MCU, np.int16)
    flat[gather((np.cumsum(mcus) - mcus) * MCU, sizes)] = level(np.frombuffer(b"".join(payloads), np.uint8))
    blocks = flat.reshape(-1, 6, 64)
    first = (np.cumsum(mcus) - mcus).tolist()
    raster = np.concatenate([4 * f + raster_of(a, d) for f, (a, d) in zip(first, shapes)])
    full = [blocks[:, :4].reshape(-1, 64)[raster], blocks[:, 4], blocks[:, 5]]
    half = [np.sign(p) * (np.abs(p) >> 1) for p in full]  # after the first scans: one bit less
    of_mcus, of_luma = _cuts(mcus, restart), _cuts(4 * mcus, restart)
    starts_mcu = np.zeros(len(blocks), bool)
    starts_mcu[np.concatenate([[0], of_mcus[0][:-1]])] = True
    dc = blocks[:, :, 0].astype(np.int64)
    parts = []
    for components, low, high, ah, al in SCANS:
        c = components[0]
        ends, intervals = of_mcus if low == 0 or c else of_luma
        if low == 0 and ah == 0:
            x = dc >> al  # DC is shifted arithmetically
            difference = np.empty_like(x)
            difference[:, 1:4] = x[:, 1:4] - x[:, :3]
            for i, j in ((0, 3), (4, 4), (5, 5)):  # from the same component's block before
                previous = np.concatenate([[0], x[:-1, j]])
                difference[:, i] = x[:, i] - np.where(starts_mcu, 0, previous)
            d = difference.ravel()
            size = bit_size(d)
            extra = np.where(d < 0, d + (1 << size) - 1, d)
            packed = pack_fields((DC_CODE.code[size].astype(np.int64) << size) | extra, DC_CODE.length[size] + size, 6 * ends)
        elif low == 0:
            packed = pack_flags((dc >> al & 1).ravel().astype(np.uint8), 6 * ends)
        elif ah == 0:
            fields, lengths, per = _ac_first(half[c][:, low : high + 1], AC_CODE)
            packed = pack_fields(fields, lengths, np.cumsum(per)[ends - 1])
        else:
            packed = pack_flags(*_ac_refine(half[c][:, low : high + 1], full[c][:, low : high + 1], ends, AC_CODE))
        head = bytes([len(components)]) + b"".join(bytes([i + 1, 0]) for i in components) + bytes([low, high, ah << 4 | al])
        parts.append((_segment(0xFFDA, head), assemble(*packed, intervals)))
    tables_ = DC_CODE.segment(0x00) + AC_CODE.segment(0x10) + _segment(0xFFDD, struct.pack(">H", restart))
    quant = _segment(0xFFDB, b"\x00" + bytes([1] * 64))
    out = []
    for i, (payload, (across, down)) in enumerate(zip(payloads, shapes)):
        frame = struct.pack(">BHHB", 8, 16 * down, 16 * across, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
        scans = b"".join(head + data[i] for head, data in parts)
        out.append(b"".join([b"\xff\xd8", _segment(0xFFFE, b"bytes=%d" % len(payload)), quant, _segment(0xFFC2, frame), tables_, scans, b"\xff\xd9"]))
    return out


class Image:
    """A parsed file: frame, and each scan with its tables and intervals."""

    def __init__(self, data: bytes):
        self.scans: list[dict] = []
        self.comment = b""
        quant: dict[int, np.ndarray] = {}
        huffman: dict[int, tuple] = {}
        restart = 0
        at = 2
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        while True:
            marker = data[at + 1]
            if marker == 0xD9:
                break
            size = int.from_bytes(data[at + 2 : at + 4], "big")
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xFE:
                self.comment = body
            elif marker == 0xDB:
                while body:
                    kind = ">u2" if body[0] >> 4 else "u1"
                    n = 64 * (1 + (body[0] >> 4))
                    quant[body[0] & 15] = np.frombuffer(body[1 : 1 + n], kind).astype(np.float32)
                    body = body[1 + n :]
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    huffman[body[0]] = (bytes(body[1:17]), bytes(body[17 : 17 + n]))
                    body = body[17 + n :]
            elif marker == 0xDD:
                restart = int.from_bytes(body, "big")
            elif marker == 0xC2:
                self.height, self.width = struct.unpack(">HH", body[1:5])
                self.components = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5])]
            elif marker in (0xC0, 0xC1, 0xC3):
                raise ValueError("not a progressive file")
            elif marker == 0xDA:
                ids = [c[0] for c in self.components]
                which = tuple(ids.index(body[1 + 2 * i]) for i in range(body[0]))
                selectors = [body[2 + 2 * i] for i in range(body[0])]
                low, high, bits = body[-3:]
                end = at
                while True:  # the scan's data: up to a marker that is neither an escape nor a restart
                    end = data.index(b"\xff", end)
                    if data[end + 1] == 0 or 0xD0 <= data[end + 1] <= 0xD7:
                        end += 2
                        continue
                    break
                codes = [huffman.get(s >> 4 if low == 0 else 0x10 | s & 15) for s in selectors]
                self.scans.append(
                    {"components": which, "low": low, "high": high, "ah": bits >> 4, "al": bits & 15, "codes": codes, "restart": restart, "data": data[at:end]}
                )
                at = end
        self.quant = [quant[c[3]] for c in self.components]
        self.across = -(-self.width // (8 * max(c[1] for c in self.components)))
        self.down = -(-self.height // (8 * max(c[2] for c in self.components)))


class _Lanes:
    """Bit readers over the intervals of one scan of many images; ``pos`` is each one's place in bits."""

    def __init__(self, scans: list[bytes]):
        raw = np.frombuffer(b"".join(scans) + b"\x00" * 9, np.uint8)
        mark = raw == 255
        after = np.append(raw[1:], 0)
        restart = mark & (after >= 0xD0) & (after <= 0xD7)
        second = np.concatenate([[False], mark[:-1]])  # escapes' zeros and markers' second bytes
        stay = ~(restart | second)
        place = np.cumsum(stay) - stay
        begins = np.cumsum([0, *map(len, scans[:-1])])
        begins = np.sort(np.concatenate([begins, np.flatnonzero(restart) + 2]))
        self.pos = place[begins] * 8
        data = np.concatenate([raw[stay], np.zeros(16, np.uint8)])
        #: 64 bits from each byte on
        self.words = np.zeros(len(data) - 7, np.uint64)
        for i in range(8):
            self.words |= data[i : len(data) - 7 + i].astype(np.uint64) << np.uint64(56 - 8 * i)

    def peek(self, pos: np.ndarray) -> np.ndarray:
        """At least 57 bits, the next one highest."""
        return self.words[pos >> 3] << (pos & 7).astype(np.uint64)

    def flags(self, pos: np.ndarray) -> np.ndarray:
        """The bit at each place."""
        return (self.words[pos >> 3] >> (63 - (pos & 7)).astype(np.uint64)) & np.uint64(1)


def _code(table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """symbol << 8 | length of the code that each begins with."""
    got = table[bits >> np.uint64(48)]
    if not got.all():
        raise ValueError("no such code")
    return got


def _extra(bits: np.ndarray, skip: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``size`` bits (0 to 16) after ``skip``."""
    return (((bits << skip.astype(np.uint64)) >> np.uint64(1)) >> (63 - size).astype(np.uint64)).astype(np.int64)


def _signed(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    one = np.int64(1) << size
    return value - np.where(value < one >> 1, one - 1, 0)


def _dc_first(lanes: _Lanes, counts: np.ndarray, starts: np.ndarray, order: np.ndarray, comp: np.ndarray, tables_: list, flat: np.ndarray, al: int) -> None:
    """starts: each interval's first place in order (block numbers) and comp (component of each)."""
    last = np.zeros((len(counts), 4), np.int64)
    for step in range(int(counts.max(initial=0))):
        live = np.flatnonzero(counts > step)
        at = starts[live] + step
        c = comp[at]
        for k in np.unique(c):
            some = live[c == k]
            bits = lanes.peek(lanes.pos[some])
            got = _code(tables_[k], bits).astype(np.int64)
            size, length = got >> 8, got & 255
            last[some, k] += _signed(_extra(bits, length, size), size)
            lanes.pos[some] += length + size
            flat[order[at[c == k]], 0] = last[some, k] << al


def _ac_first_decode(lanes: _Lanes, counts: np.ndarray, starts: np.ndarray, low: int, high: int, table: np.ndarray, flat: np.ndarray, al: int) -> None:
    """flat: blocks by 64; an interval's blocks are neighbours."""
    out = flat.reshape(-1)
    pos, block, end = lanes.pos.copy(), starts.copy(), starts + counts
    k = np.full(len(counts), low, np.int64)
    while len(pos):
        bits = lanes.peek(pos)
        got = _code(table, bits).astype(np.int64)
        length, size, run = got & 255, got >> 8 & 15, got >> 12
        if size.all():
            k += run
            out[block * 64 + k] = _signed(_extra(bits, length, size), size) << al
            k += 1
            pos += length + size
        else:
            value = _signed(_extra(bits, length, size), size)
            some = size > 0
            at = block * 64 + k + run
            out[at[some]] = value[some] << al
            bands = ~some & (run < 15)  # the band ends here, and in 2^run - 1 + extra further blocks
            wide = np.where(bands, run, size)
            block += np.where(bands, (np.int64(1) << run) + _extra(bits, length, np.where(bands, run, 0)) - 1, 0)
            k = np.where(some, k + run + 1, np.where(bands, high + 1, k + 16))
            pos += length + wide
        done = k > high
        if done.any():
            block += done
            k[done] = low
            live = block < end
            if not live.all():
                pos, block, end, k = pos[live], block[live], end[live], k[live]


def _ac_refine_decode(lanes: _Lanes, counts: np.ndarray, starts: np.ndarray, low: int, high: int, table: np.ndarray, flat: np.ndarray, al: int) -> None:
    """Correction bits of known coefficients are read in one go; new coefficients one at a time."""
    block = starts.copy()
    end = starts + counts
    bit = 1 << al
    live = np.flatnonzero(block < end)
    k = np.full(len(counts), low, np.int64)
    one = np.int64(1)

    def correct(lane: np.ndarray, n: np.ndarray, cells: np.ndarray) -> None:
        """The next n bits of each lane correct the cells, lane after lane."""
        bits = lanes.flags(gather(lanes.pos[lane], n))
        flat_ = flat.reshape(-1)
        x = flat_[cells]
        flat_[cells] = np.where(bits.astype(bool) & ((np.abs(x) & bit) == 0), np.where(x > 0, x + bit, x - bit), x)
        lanes.pos[lane] += n

    def rest_of(lane: np.ndarray, first: np.ndarray, number: np.ndarray) -> None:
        """Correct what is known in a block from ``first`` on, and in the number - 1 blocks behind it."""
        blocks = gather(block[lane], number)
        begin = np.full(len(blocks), low, np.int64)
        begin[np.cumsum(number) - number] = first
        columns = np.arange(low, high + 1)
        known = (flat[blocks, low : high + 1] != 0) & (columns[None, :] >= begin[:, None])
        r, c = np.nonzero(known)
        n = np.add.reduceat(known.sum(1), np.cumsum(number) - number) if len(number) else number
        correct(lane, n.astype(np.int64), blocks[r] * 64 + c + low)

    while len(live):
        bits = lanes.peek(lanes.pos[live])
        got = _code(table, bits).astype(np.int64)
        length, size, run = got & 255, got >> 8 & 15, got >> 12
        lanes.pos[live] += length
        ends = (size == 0) & (run < 15)
        if ends.any():
            lane = live[ends]
            number = (one << run[ends]) + _extra(bits[ends], length[ends], run[ends])
            lanes.pos[lane] += run[ends]
            rest_of(lane, k[lane], number)
            block[lane] += number
            k[lane] = low
        for lane, r, z in zip(live[~ends].tolist(), run[~ends].tolist(), size[~ends].tolist()):
            # a new coefficient of one bit after r zeros (none after sixteen): known ones on the way take their bits
            p = int(lanes.pos[lane])

            def next_bit() -> int:
                nonlocal p
                out = int(lanes.words[p >> 3]) >> (63 - (p & 7)) & 1
                p += 1
                return out

            value = 0
            if z:
                value = bit if next_bit() else -bit
            b, i = int(block[lane]), int(k[lane])
            while i <= high:
                x = int(flat[b, i])
                if x:
                    if next_bit() and not abs(x) & bit:
                        flat[b, i] = x + bit if x > 0 else x - bit
                elif r == 0:
                    if value:
                        flat[b, i] = value
                    i += 1
                    break
                else:
                    r -= 1
                i += 1
            lanes.pos[lane] = p
            if i > high:
                block[lane] += 1
                i = low
            k[lane] = i
        live = live[block[live] < end[live]]


def coefficients(images: list[Image]) -> list[list[np.ndarray]]:
    """All scans of all images accumulated: each image's components as (blocks in raster order, zigzag place).

    Images whose scans have the same parameters and tables are decoded in step.
    """
    flats, offsets, total = [], [], 0
    for image in images:
        own = []
        for _, h, v, _ in image.components:
            own.append(total)
            total += image.across * h * image.down * v
        offsets.append(own)
    flat = np.zeros((total, 64), np.int32)
    for number in range(max((len(i.scans) for i in images), default=0)):
        alike: dict[tuple, list[int]] = {}
        for i, image in enumerate(images):
            if number < len(image.scans):
                s = image.scans[number]
                alike.setdefault((s["components"], s["low"], s["high"], s["ah"], s["al"], tuple(s["codes"])), []).append(i)
        for (which, low, high, ah, al, codes), members in alike.items():
            made = [Huffman(list(c[0]), list(c[1])).table if c else None for c in codes]
            data, counts, starts, orders, comps = [], [], [], [], []
            placed = 0
            for i in members:
                image, s = images[i], images[i].scans[number]
                if low == 0:
                    # MCUs of all components' blocks
                    x, y = np.meshgrid(np.arange(image.across), np.arange(image.down))
                    columns, comp = [], []
                    for slot, c in enumerate(which):
                        _, h, v, _ = image.components[c]
                        for dy in range(v):
                            for dx in range(h):
                                columns.append(offsets[i][c] + (y.ravel() * v + dy) * image.across * h + x.ravel() * h + dx)
                                comp.append(slot)
                    order = np.stack(columns, 1).ravel()
                    per, n = len(comp), image.across * image.down
                    orders.append(order)
                    comps.append(np.tile(comp, n))
                    begin = placed
                    placed += len(order)
                else:
                    # blocks of one component; padding blocks beyond the picture aren't coded
                    _, h, v, _ = image.components[which[0]]
                    if image.width % 16 or image.height % 16:
                        raise ValueError("pictures of whole MCUs only")
                    per, n, begin = 1, image.across * h * image.down * v, offsets[i][which[0]]
                size = s["restart"] or n
                firsts = np.arange(0, n, size)
                data.append(s["data"])
                counts.append(np.minimum(size, n - firsts) * per)
                starts.append(begin + firsts * per)
            lanes, count, start = _Lanes(data), np.concatenate(counts), np.concatenate(starts)
            if low == 0:
                order, comp = np.concatenate(orders), np.concatenate(comps)
                if ah == 0:
                    _dc_first(lanes, count, start, order, comp, made, flat, al)
                else:
                    flat[order[gather(start, count)], 0] |= lanes.flags(gather(lanes.pos, count)).astype(np.int32) << al
            elif ah == 0:
                _ac_first_decode(lanes, count, start, low, high, made[0], flat, al)
            else:
                _ac_refine_decode(lanes, count, start, low, high, made[0], flat, al)
    for image, own in zip(images, offsets):
        flats.append([flat[o : o + image.across * h * image.down * v] for o, (_, h, v, _) in zip(own, image.components)])
    return flats


def to_payload(image: Image, parts: list[np.ndarray]) -> bytes:
    """The bytes that ``encode`` stored."""
    n = int(image.comment.removeprefix(b"bytes="))
    return unlevel(from_planes(*parts, image.across, image.down).ravel()[:n]).tobytes()


def to_rgb(image: Image, parts: list[np.ndarray]) -> np.ndarray:
    """Full-resolution RGB tensor (height, width, 3)."""
    samples = []
    for (_, h, v, _), blocks, quant in zip(image.components, parts, image.quant):
        grid = np.empty((len(blocks), 64), np.float32)
        grid[:, ZIGZAG] = blocks * quant
        pixels = IDCT.T @ grid.reshape(-1, 8, 8) @ IDCT
        plane = pixels.reshape(image.down * v, image.across * h, 8, 8).transpose(0, 2, 1, 3).reshape(image.down * v * 8, -1)
        samples.append(plane)
    height, width = samples[0].shape
    up = [np.repeat(np.repeat(s, height // s.shape[0], 0), width // s.shape[1], 1) for s in samples[1:]]
    y = samples[0] + np.float32(128)
    cb, cr = up
    rgb = np.stack([y + np.float32(1.402) * cr, y - np.float32(0.344136) * cb - np.float32(0.714136) * cr, y + np.float32(1.772) * cb], 2)
    return np.clip(np.rint(rgb), 0, 255).astype(np.uint8)[: image.height, : image.width]


def padded(text: str | None) -> bytes:
    data = utf8(text)
    return data + b"\xff" * (UNIT * max(1, -(-len(data) // UNIT)) - len(data))


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: every whole text as a progressive JPEG."""
    ship(docs.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [x if isinstance(x, str) else "" for x in frame["text"]]
            for a, b in groups([len(x) for x in texts], BATCH_CHARS):
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"].iloc[a:b],
                        "n_bytes": [len(utf8(x)) for x in texts[a:b]],
                        "media": encode([padded(x) for x in texts[a:b]]),
                    }
                )

    return map_rows(docs.select("doc_id", "text"), work, "doc_id long, n_bytes long, media binary")


def load_media(stored: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media, payload, height, width, rgb (bytes of the tensor, row by row)."""
    ship(stored.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            media = [bytes(x) for x in frame["media"]]
            for a, b in groups([len(x) for x in media], BATCH_CHARS):
                images = [Image(x) for x in media[a:b]]
                found = coefficients(images)
                out = frame.iloc[a:b].copy()
                out["payload"] = [to_payload(i, p) for i, p in zip(images, found)]
                out["height"] = [i.height for i in images]
                out["width"] = [i.width for i in images]
                out["rgb"] = [to_rgb(i, p).tobytes() for i, p in zip(images, found)]
                yield out

    return map_rows(
        stored.select("doc_id", "n_bytes", "media"), work, "doc_id long, n_bytes long, media binary, payload binary, height int, width int, rgb binary"
    )
