"""Media columns as progressive JPEG.

``decode`` accumulates the scans of a progressive JPEG file (DC and AC, spectral selection, first and refining
successive-approximation passes, restart markers, EOB runs) into coefficient arrays; ``to_rgb``
inverse-transforms them in numpy with whole-number arithmetic, upsamples the chroma and gives the full-resolution
RGB tensor.  Scans whose table has one symbol, and refinements of bands without zeros, are read with array
operations; all others symbol by symbol.

``encode_payload`` stores bytes losslessly as quantised coefficients, the format's unit: six 8x8
blocks make one 4:2:0 MCU; a DC holds its byte less 128 and an AC holds 128 plus its byte's low seven bits,
negative where the top bit is clear.  A comment segment keeps the lengths.

Defined cases: a null or empty text is 64 zero bytes of payload; repeated rows each get a row; equal texts have equal files;
an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, id_text, materialize

BLOCK = 64
MEDIA = "doc_id long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_NEXT_MARKER = re.compile(rb"\xff[\x01-\xcf\xd8-\xfe]")
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")


def _zigzag() -> np.ndarray:
    """Natural index of each zigzag position: diagonals walked in turns up and down."""
    cells = [(r, c) for r in range(8) for c in range(8)]
    cells.sort(key=lambda rc: (rc[0] + rc[1], rc[0] if (rc[0] + rc[1]) % 2 else rc[1]))
    return np.array([8 * r + c for r, c in cells])


ZIGZAG = _zigzag()
#: The DCT matrix in 13-bit whole numbers: products stay exact in double precision, so equal coefficients give equal samples.
COSINE = np.rint(np.array([[math.sqrt(1 / 8) if u == 0 else math.cos((2 * x + 1) * u * math.pi / 16) / 2 for x in range(8)] for u in range(8)]) * 8192)


# ---- writing ---------------------------------------------------------------------------------


def pack_bits(values: np.ndarray, lengths: np.ndarray) -> bytes:
    """The low ``lengths`` bits of each value, one after another, filled up with ones and byte-stuffed."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    place = np.arange(total)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    bits = (values[owner] >> (ends[owner] - 1 - place)) & 1
    bits = np.concatenate([bits, np.ones(-total % 8, dtype=bits.dtype)]).astype(np.uint8)
    return np.packbits(bits).tobytes().replace(b"\xff", b"\xff\x00")


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _table(kind: int, slot: int, length: int, symbols: list[int]) -> bytes:
    """A Huffman table whose codes all have ``length`` bits."""
    counts = bytes(len(symbols) if k + 1 == length else 0 for k in range(16))
    return _segment(0xC4, bytes([kind << 4 | slot]) + counts + bytes(symbols))


def _scan(components: list[int], first: int, last: int, high: int, low: int, data: bytes) -> bytes:
    body = bytes([len(components)]) + b"".join(bytes([c, 0]) for c in components) + bytes([first, last, high << 4 | low])
    return _segment(0xDA, body) + data


def _eob_runs(bits: np.ndarray) -> bytes:
    """A refinement without new coefficients: EOB runs (4-bit codes), each followed by its blocks' correction bits."""
    values, lengths = [], []
    for at in range(0, len(bits), 32767):
        part = bits[at : at + 32767]
        r = len(part).bit_length() - 1
        values += [np.array([r, len(part) - (1 << r)]), part.ravel()]
        lengths += [np.array([4, r]), np.ones(part.size, dtype=np.int64)]
    return pack_bits(np.concatenate(values).astype(np.int64), np.concatenate(lengths))


def encode_payload(payload: bytes, n_bytes: int) -> bytes:
    """A progressive 4:2:0 JPEG file whose coefficients hold ``payload`` (a multiple of 64 bytes)."""
    mcus = -(-len(payload) // (6 * BLOCK))
    wide = math.isqrt(mcus - 1) + 1
    high = -(-mcus // wide)
    raw = np.zeros(wide * high * 6 * BLOCK, dtype=np.uint8)
    raw[: len(payload)] = np.frombuffer(payload, dtype=np.uint8)
    units = raw.reshape(high, wide, 6, BLOCK)
    luma = units[:, :, :4].reshape(high, wide, 2, 2, BLOCK).transpose(0, 2, 1, 3, 4).reshape(-1, BLOCK)
    planes = [luma, units[:, :, 4].reshape(-1, BLOCK), units[:, :, 5].reshape(-1, BLOCK)]

    dc = units[:, :, :, 0].reshape(-1, 6).astype(np.int64) - 128
    coarse = dc >> 1
    steps = np.empty_like(coarse)
    steps[:, :4] = np.diff(coarse[:, :4].ravel(), prepend=0).reshape(-1, 4)
    for k in (4, 5):
        steps[:, k] = np.diff(coarse[:, k], prepend=0)
    steps = steps.ravel()
    size = np.frexp(np.abs(steps).astype(float))[1].astype(np.int64)
    extra = np.where(steps < 0, steps + (1 << size) - 1, steps)
    dc_data = pack_bits(np.stack([size, extra], 1).ravel(), np.stack([np.full_like(size, 4), size], 1).ravel())

    frame = struct.pack(">BHHB", 8, 16 * high, 16 * wide, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    out = [
        b"\xff\xd8", _segment(0xFE, struct.pack(">QQ", n_bytes, len(payload))), _segment(0xDB, b"\x00" + b"\x01" * 64), _segment(0xC2, frame),
        _table(0, 0, 4, list(range(8))), _table(1, 0, 1, [7]), _scan([1, 2, 3], 0, 0, 0, 1, dc_data),
    ]
    for first, last in ((1, 5), (6, 63)):
        for c, plane in enumerate(planes, 1):
            part = plane[:, first : last + 1]
            half = (part & 127) + 128 >> 1
            out.append(_scan([c], first, last, 0, 1, np.where(part & 128, half, 127 - half).astype(np.uint8).tobytes()))
    out.append(_scan([1, 2, 3], 0, 0, 1, 0, pack_bits(dc.ravel() & 1, np.ones(dc.size, dtype=np.int64))))
    out.append(_table(1, 0, 4, [r << 4 for r in range(15)]))
    out += [_scan([c], 1, 63, 1, 0, _eob_runs((plane[:, 1:] & 1).astype(np.int64))) for c, plane in enumerate(planes, 1)]
    return b"".join(out) + b"\xff\xd9"


# ---- reading ---------------------------------------------------------------------------------


class _Huffman:
    def __init__(self, counts: bytes, symbols: bytes):
        self.single = symbols[0] if len(symbols) == 1 and counts[0] == 1 else None
        self.length, self.symbol = [0] * 65536, [0] * 65536
        code, k = 0, 0
        for bits, n in enumerate(counts, 1):
            for _ in range(n):
                lo, hi = code << (16 - bits), (code + 1) << (16 - bits)
                self.length[lo:hi], self.symbol[lo:hi] = [bits] * (hi - lo), [symbols[k]] * (hi - lo)
                code, k = code + 1, k + 1
            code <<= 1


_tables: dict[tuple[bytes, bytes], _Huffman] = {}


def _huffman(counts: bytes, symbols: bytes) -> _Huffman:
    if len(_tables) > 64:
        _tables.clear()
    if (counts, symbols) not in _tables:
        _tables[counts, symbols] = _Huffman(counts, symbols)
    return _tables[counts, symbols]


class _Bits:
    """The bits of one restart interval; past its end there are ones."""

    def __init__(self, data: bytes):
        self.data = data.replace(b"\xff\x00", b"\xff")
        self.at = 0

    @property
    def windows(self) -> list[int]:
        """The 16 bits from each place on."""
        if not hasattr(self, "_windows"):
            b = np.frombuffer(self.data + b"\xff" * 8, dtype=np.uint8).astype(np.int64)
            whole = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
            self._windows = (whole[:, None] >> (8 - np.arange(8)) & 0xFFFF).ravel().tolist()
        return self._windows

    def symbol(self, table: _Huffman) -> int:
        w = self.windows[self.at]
        self.at += table.length[w]
        return table.symbol[w]

    def take(self, n: int) -> int:
        value = self.windows[self.at] >> (16 - n) if n else 0
        self.at += n
        return value

    def signed(self, n: int) -> int:
        value = self.take(n)
        return value if not n or value >> (n - 1) else value - (1 << n) + 1

    def run(self, n: int) -> np.ndarray:
        """The next ``n`` bits as an array."""
        first = self.at >> 3
        bits = np.unpackbits(np.frombuffer(self.data, np.uint8, -(-(self.at + n) // 8) - first, first))[self.at - 8 * first :][:n]
        self.at += n
        return bits


class Decoded:
    """Coefficients of each component, (rows, columns, 64) in zigzag order, with what else the file says."""

    def __init__(self):
        self.quant: dict[int, np.ndarray] = {}
        self.comment = b""
        self.height = self.width = 0
        self.parts: list[dict] = []


def _dc(bits: _Bits, part: dict, blocks: list[np.ndarray], table: _Huffman | None, last: int, high: int, low: int) -> int:
    for block in blocks:
        if high:
            block[0] |= bits.take(1) << low
        else:
            last += bits.signed(bits.symbol(table))
            block[0] = last << low
    return last


def _ac_first(bits: _Bits, blocks: np.ndarray, table: _Huffman, first: int, end: int, low: int) -> None:
    s = table.single
    if s is not None and 0 < s < 16:  # one code of one bit: each coefficient has 1 + s bits
        n = len(blocks) * (end - first + 1)
        if s == 7:
            value = np.frombuffer(bits.data, np.uint8, n).astype(np.int16)
        else:
            value = bits.run(n * (1 + s)).reshape(n, 1 + s).astype(np.int64) @ (1 << np.arange(s, -1, -1))
        value = np.where(value >> (s - 1) == 0, value - (1 << s) + 1, value)
        blocks[:, first : end + 1] = (value << low).reshape(len(blocks), -1)
        return
    run = 0
    for block in blocks:
        if run:
            run -= 1
            continue
        k = first
        while k <= end:
            r, s = divmod(bits.symbol(table), 16)
            if s:
                k += r
                block[k] = bits.signed(s) * (1 << low)
                k += 1
            elif r == 15:
                k += 16
            else:
                run = (1 << r) + bits.take(r) - 1
                break


def _ac_refine(bits: _Bits, blocks: np.ndarray, table: _Huffman, first: int, end: int, low: int) -> None:
    band = blocks[:, first : end + 1]
    if band.all():  # no coefficient can be new: EOB runs with their correction bits
        at = 0
        while at < len(band):
            r, _ = divmod(bits.symbol(table), 16)
            n = (1 << r) + bits.take(r)
            part = band[at : at + n]
            part += (np.sign(part) * (bits.run(part.size).reshape(part.shape).astype(np.int16) << low)).astype(np.int16)
            at += n
        return
    step, run = 1 << low, 0

    def correct(block, k):
        if bits.take(1) and not abs(int(block[k])) & step:
            block[k] += step if block[k] > 0 else -step

    for block in blocks:
        k = first
        while not run and k <= end:
            r, s = divmod(bits.symbol(table), 16)
            new = (step if bits.take(1) else -step) if s else 0
            if not s and r < 15:
                run = (1 << r) + bits.take(r)
                break
            while k <= end:
                if block[k]:
                    correct(block, k)
                elif r == 0:
                    block[k] = new
                    k += 1
                    break
                else:
                    r -= 1
                k += 1
        if run:
            for j in range(k, end + 1):
                if block[j]:
                    correct(block, j)
            run -= 1


def decode(data: bytes) -> Decoded:
    """Accumulate all scans of a progressive JPEG file."""
    out, tables, interval, at = Decoded(), {}, 0, 2
    while True:
        marker = data[at + 1]
        if marker == 0xD9:
            return out
        body = data[at + 4 : at + 2 + struct.unpack_from(">H", data, at + 2)[0]]
        at += 4 + len(body)
        if marker == 0xFE:
            out.comment = body
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                n = 64 << wide
                out.quant[body[0] & 15] = np.frombuffer(body[1 : 1 + n], dtype=">u2" if wide else "u1").astype(np.int64)
                body = body[1 + n :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = _huffman(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            interval = struct.unpack(">H", body)[0]
        elif marker == 0xC2:
            out.height, out.width, n = struct.unpack_from(">HHB", body, 1)
            out.parts = [{"id": body[6 + 3 * k], "h": body[7 + 3 * k] >> 4, "v": body[7 + 3 * k] & 15, "q": body[8 + 3 * k]} for k in range(n)]
            h, v = max(p["h"] for p in out.parts), max(p["v"] for p in out.parts)
            wide, high = -(-out.width // (8 * h)), -(-out.height // (8 * v))
            for p in out.parts:
                p["coefs"] = np.zeros((high * p["v"], wide * p["h"], 64), dtype=np.int16)
                p["rows"], p["cols"] = (-(-(-(-size * p[f] // most)) // 8) for size, f, most in ((out.height, "v", v), (out.width, "h", h)))
        elif marker == 0xDA:
            stop = _NEXT_MARKER.search(data, at).start()
            _read_scan(out, tables, interval, body, data[at:stop])
            at = stop
        elif 0xC0 <= marker <= 0xCF:
            raise ValueError("not a progressive Huffman-coded file")


def _read_scan(out: Decoded, tables: dict, interval: int, body: bytes, data: bytes) -> None:
    n = body[0]
    chosen = [(next(p for p in out.parts if p["id"] == body[1 + 2 * k]), body[2 + 2 * k]) for k in range(n)]
    first, end, high, low = body[-3], body[-2], body[-1] >> 4, body[-1] & 15
    intervals = [_Bits(x) for x in (_RESTART.split(data) if interval else [data])]
    if n == 1:
        part, slots = chosen[0]
        coefs = part["coefs"][: part["rows"], : part["cols"]]
        flat = np.ascontiguousarray(coefs).reshape(-1, 64)
        step = interval or len(flat)
        for k, bits in enumerate(intervals):
            blocks = flat[k * step : (k + 1) * step]
            if first == 0:
                _dc(bits, part, blocks, tables.get(slots >> 4), 0, high, low)
            else:
                (_ac_refine if high else _ac_first)(bits, blocks, tables[16 | slots & 15], first, end, low)
        coefs[...] = flat.reshape(coefs.shape)
        return
    p0 = chosen[0][0]
    wide, mcus = p0["coefs"].shape[1] // p0["h"], p0["coefs"].shape[0] * p0["coefs"].shape[1] // (p0["h"] * p0["v"])
    units = []  # each component's DC values in the order of the MCUs
    for p, _ in chosen:
        r, c, _ = p["coefs"].shape
        units.append(p["coefs"][:, :, 0].reshape(r // p["v"], p["v"], wide, p["h"]).transpose(0, 2, 1, 3).reshape(mcus, -1).copy())
    if high:
        per = sum(u.shape[1] for u in units)
        step = interval or mcus
        for k, bits in enumerate(intervals):
            rows = slice(k * step, min(mcus, (k + 1) * step))
            new = bits.run((rows.stop - rows.start) * per).reshape(-1, per).astype(np.int16) << low
            for u, part in zip(units, np.split(new, np.cumsum([u.shape[1] for u in units])[:-1], axis=1), strict=True):
                u[rows] |= part
    else:
        step = interval or mcus
        plan = [(c, tables[slots >> 4], u.shape[1]) for c, ((_, slots), u) in enumerate(zip(chosen, units, strict=True))]
        values: list[list[int]] = [[] for _ in units]
        for k, bits in enumerate(intervals):
            last = [0] * n
            for _ in range(min(step, mcus - k * step)):
                for c, table, blocks in plan:
                    for _ in range(blocks):
                        last[c] += bits.signed(bits.symbol(table))
                        values[c].append(last[c])
        for u, got in zip(units, values, strict=True):
            u[...] = (np.array(got, dtype=np.int64) << low).reshape(u.shape)
    for (p, _), u in zip(chosen, units, strict=True):
        r, c, _ = p["coefs"].shape
        p["coefs"][:, :, 0] = u.reshape(r // p["v"], wide, p["v"], p["h"]).transpose(0, 2, 1, 3).reshape(r, c)


def read_payload(file: Decoded) -> tuple[bytes, int]:
    """The bytes that ``encode_payload`` stored, and how many of them are not padding."""
    n_bytes, payload_bytes = struct.unpack(">QQ", file.comment)
    high, wide, _ = file.parts[1]["coefs"].shape
    units = np.empty((high, wide, 6, BLOCK), dtype=np.int16)
    units[:, :, :4] = file.parts[0]["coefs"].reshape(high, 2, wide, 2, BLOCK).transpose(0, 2, 1, 3, 4).reshape(high, wide, 4, BLOCK)
    units[:, :, 4], units[:, :, 5] = file.parts[1]["coefs"], file.parts[2]["coefs"]
    raw = np.where(units > 0, units, 128 + -units - 256).astype(np.uint8)
    raw[..., 0] = units[..., 0] + 128
    return raw.tobytes()[:payload_bytes], n_bytes


def _samples(part: dict, quant: np.ndarray) -> np.ndarray:
    """Samples of one component, 0 to 255."""
    rows, cols, _ = part["coefs"].shape
    out = np.empty((rows, 8, cols, 8), dtype=np.uint8)
    natural = np.empty((1, cols, 64))
    step = max(1, 4096 // cols)
    for at in range(0, rows, step):  # strips bound the memory of very large files
        coefs = part["coefs"][at : at + step]
        natural = np.empty(coefs.shape)
        natural[..., ZIGZAG] = coefs * quant
        block = natural.reshape(-1, 8, 8)
        value = COSINE.T @ (block @ COSINE)
        value = np.clip(np.floor(value * 2.0**-26 + 128.5), 0, 255).astype(np.uint8)
        out[at : at + step] = value.reshape(len(coefs), cols, 8, 8).transpose(0, 2, 1, 3)
    return out.reshape(8 * rows, 8 * cols)


def to_rgb(file: Decoded) -> np.ndarray:
    """The RGB tensor (height, width, 3): inverse transform, chroma by pixel replication, JFIF colours."""
    v, h = max(p["v"] for p in file.parts), max(p["h"] for p in file.parts)
    planes = []
    for p in file.parts:
        plane = _samples(p, file.quant[p["q"]])
        plane = plane.repeat(v // p["v"], axis=0).repeat(h // p["h"], axis=1)
        planes.append(plane[: file.height, : file.width].astype(np.int32))
    if len(planes) == 1:
        return np.stack([planes[0]] * 3, axis=-1).astype(np.uint8)
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    rgb = np.empty((*y.shape, 3), dtype=np.uint8)
    # JFIF's factors 1.402, 0.344136, 0.714136 and 1.772 in 16-bit whole numbers
    rgb[..., 0] = np.clip(y + (91881 * cr + 32768 >> 16), 0, 255)
    rgb[..., 1] = np.clip(y - (22554 * cb + 46802 * cr + 32768 >> 16), 0, 255)
    rgb[..., 2] = np.clip(y + (116130 * cb + 32768 >> 16), 0, 255)
    return rgb


# ---- tables ----------------------------------------------------------------------------------


def pad(raw: bytes) -> bytes:
    """``raw`` with zero bytes up to a positive multiple of 64."""
    return raw + bytes(max(BLOCK, -(-len(raw) // BLOCK) * BLOCK) - len(raw))


def media_column(docs: DataFrame) -> DataFrame:
    """doc_id and ``media``, the JPEG file that holds the text's UTF-8 bytes."""

    def write(batches):
        for batch in chunks(batches):
            media = [encode_payload(pad(raw), len(raw)) for raw in (t.encode() for t in batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(media, pa.binary())], names=["doc_id", "media"])

    return id_text(docs).mapInArrow(write, MEDIA)


def rgb_column(media: DataFrame) -> DataFrame:
    """doc_id, height, width and ``rgb``, the full-resolution tensor's bytes, of a table of JPEG files."""

    def read(batches):
        for batch in chunks(batches, "media"):
            tensors = [to_rgb(decode(m)) for m in batch.column("media").to_pylist()]
            sizes = [pa.array([t.shape[k] for t in tensors], pa.int32()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *sizes, pa.array([t.tobytes() for t in tensors], pa.binary())], names=["doc_id", "height", "width", "rgb"])

    return media.mapInArrow(read, "doc_id long, height int, width int, rgb binary")


def _features(media: bytes) -> tuple:
    file = decode(media)
    payload, n_bytes = read_payload(file)
    rgb = to_rgb(file)
    sums = rgb.reshape(-1, 3).sum(axis=0, dtype=np.int64).tolist()
    feature = f"{file.width}x{file.height}:{zlib.crc32(rgb):08x}:{sums[0]},{sums[1]},{sums[2]}"
    return n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature


def media_features(docs: DataFrame) -> DataFrame:
    """Store every text as a JPEG file in the shared folder, read the files back and describe them."""

    def read(batches):
        names = [c.split()[0] for c in FEATURES.split(", ")][1:]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in chunks(batches, "media"):
            rows = list(zip(*(_features(m) for m in batch.column("media").to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(rows, kinds, strict=True))], names=["doc_id", *names])

    return materialize(media_column(docs), "media").mapInArrow(read, FEATURES)
