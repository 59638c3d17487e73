"""Progressive scans of all kinds, written by a plain encoder, against the coefficients they were made of; samples against the defining sum."""

import math
import struct

import numpy as np

from logloom.llm import progressive_jpeg
from logloom.llm.common import materialize

# Every symbol a scan may need, each with a code of eight bits.
SYMBOLS = [16 * r + s for r in range(16) for s in range(11)]


class Writer:
    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> k & 1 for k in range(n - 1, -1, -1)]

    def symbol(self, s):
        self.put(SYMBOLS.index(s), 8)

    def signed(self, v):
        n = abs(v).bit_length()
        self.put(v if v > 0 else v + (1 << n) - 1, n)

    def bytes(self):
        bits = self.bits + [1] * (-len(self.bits) % 8)
        raw = bytes(sum(b << 7 - k for k, b in enumerate(bits[at : at + 8])) for at in range(0, len(bits), 8))
        return raw.replace(b"\xff", b"\xff\x00")


def scan(coefs, first, end, high, low):
    """One component's entropy-coded segment."""
    w, last, ended, kept = Writer(), 0, 0, []

    def end_of_bands():
        nonlocal ended, kept
        if ended:
            n = ended.bit_length() - 1
            w.symbol(16 * n)
            w.put(ended - (1 << n), n)
            w.bits += kept
        ended, kept = 0, []

    for block in coefs.tolist():
        if first == 0:
            dc = block[0] >> low
            if high:
                w.put(dc & 1, 1)
            else:
                w.symbol(abs(dc - last).bit_length())
                if dc != last:
                    w.signed(dc - last)
                last = dc
            continue
        size = [abs(c) >> low for c in block]
        newest = max((k for k in range(first, end + 1) if (size[k] == 1 if high else size[k])), default=-1)
        run, marks = 0, []
        for k in range(first, end + 1):
            if not size[k]:
                run += 1
                continue
            while run > 15 and k <= newest:
                end_of_bands()
                w.symbol(0xF0)
                w.bits += marks
                run, marks = run - 16, []
            if high and size[k] > 1:
                marks.append(size[k] & 1)
                continue
            end_of_bands()
            if high:
                w.symbol(16 * run + 1)
                w.put(int(block[k] > 0), 1)
                w.bits += marks
            else:
                v = size[k] if block[k] > 0 else -size[k]
                w.symbol(16 * run + size[k].bit_length())
                w.signed(v)
            run, marks = 0, []
        if run or marks:
            ended, kept = ended + 1, kept + marks
            if ended == 5:
                end_of_bands()
    end_of_bands()
    return w.bytes()


def jpeg(coefs, width, height, scans, quant, restart=0):
    segment = lambda marker, body: struct.pack(">HH", 0xFF00 | marker, len(body) + 2) + body
    table = bytes([0] * 7 + [len(SYMBOLS)] + [0] * 8) + bytes(SYMBOLS)
    out = b"\xff\xd8" + segment(0xDB, b"\x00" + bytes(quant)) + segment(0xC2, struct.pack(">BHHBBBB", 8, height, width, 1, 1, 0x11, 0)) + segment(0xC4, b"\x00" + table + b"\x10" + table)
    if restart:
        out += segment(0xDD, struct.pack(">H", restart))
    for first, end, high, low in scans:
        out += segment(0xDA, bytes([1, 1, 0, first, end, 16 * high + low]))
        step = restart or len(coefs)
        for k, at in enumerate(range(0, len(coefs), step)):
            out += (struct.pack(">BB", 0xFF, 0xD0 + (k - 1) % 8) if k else b"") + scan(coefs[at : at + step], first, end, high, low)
    return out + b"\xff\xd9"


SCANS = [(0, 0, 0, 1), (1, 5, 0, 2), (6, 63, 0, 2), (1, 63, 2, 1), (0, 0, 1, 0), (1, 63, 1, 0)]


def sparse(rng, n, share):
    coefs = np.where(rng.random((n, 64)) < share, rng.integers(-200, 201, (n, 64)), 0)
    coefs[:, 0] = rng.integers(-500, 500, n)
    return coefs


def test_sparse_bands_refinements_and_restarts():
    rng = np.random.default_rng(4)
    for share in (0.0, 0.02, 0.3, 1.0):
        for restart in (0, 1, 5):
            coefs = sparse(rng, 12, share)
            file = progressive_jpeg.decode(jpeg(coefs, 32, 24, SCANS, [1] * 64, restart))
            assert (file.width, file.height) == (32, 24) and (file.parts[0]["coefs"].reshape(-1, 64) == coefs).all(), (share, restart)


def test_samples_equal_the_defining_sum():
    rng, quant = np.random.default_rng(5), list(range(1, 65))
    coefs = sparse(rng, 4, 0.1) // 8
    rgb = progressive_jpeg.to_rgb(progressive_jpeg.decode(jpeg(coefs, 13, 11, SCANS, quant)))
    zigzag = sorted(range(64), key=lambda k: (k // 8 + k % 8, k // 8 if (k // 8 + k % 8) % 2 else k % 8))
    assert rgb.shape == (11, 13, 3)
    for y in range(11):
        for x in range(13):
            block = coefs[y // 8 * 2 + x // 8]
            total = 128.0
            for k, at in enumerate(zigzag):
                v, u = divmod(at, 8)
                c = (math.sqrt(0.5) if u == 0 else 1) * (math.sqrt(0.5) if v == 0 else 1) / 4
                total += c * int(block[k]) * quant[k] * math.cos((2 * (x % 8) + 1) * u * math.pi / 16) * math.cos((2 * (y % 8) + 1) * v * math.pi / 16)
            assert all(abs(int(s) - min(255, max(0, total))) <= 1 for s in rgb[y, x])


def test_stored_tensors(spark, own):
    media = materialize(progressive_jpeg.media_column(own), "media")
    files = {r.doc_id: r.media for r in media.collect()}
    tensors = materialize(progressive_jpeg.rgb_column(media), "tensors").collect()
    assert len(tensors) == len(files)
    for r in tensors:
        want = progressive_jpeg.to_rgb(progressive_jpeg.decode(bytes(files[r.doc_id])))
        assert want.shape == (r.height, r.width, 3) and want.tobytes() == bytes(r.rgb)
