"""SentencePiece BPE with seeded merge-dropout.

Pieces and scores are the public model's own; the merges are done here, so that each candidate merge can be
skipped: a keyed hash of seed, doc_id, the chunk's position in the text, its symbols, the place in it and the merged piece says so
with the given probability.  So every occurrence of a word is cut by itself, and copies of a text are cut differently.
The agenda takes the best-scored pair first, the leftmost among equals; a skipped pair stays apart until one of
its sides changes.  Merges never cross from a letter to a blank, so texts are cut there into chunks.  A bounded memo
holds what no skip changes: each distinct chunk's merges without dropout, in order, and the ids they lead to.  An occurrence none of
whose merges is skipped has those ids; the others go through their agendas side by side in numpy, long chunks one by one with a heap.

Ids decode to exactly the text: characters without a piece become byte pieces, and so does U+2581, which the plain
library would turn into a blank.  Without dropout, ids of all other texts equal the library's.

Defined cases: null and empty texts have no ids; repeated rows get equal ids; an empty table gives no rows; other
columns are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, id_text
from .tokens import crc32

BLANK = "▁"
MEMO_CHUNKS, LONG = 400_000, 40
#: Occurrences of chunks that are looked at together.
AT_ONCE = 32_768
_RUNS = re.compile(r" *[^ ]+| +")
LETTERS, MARKS = "A-Za-z0-9À-ÖØ-öø-ɏ", ".,;:!?\n\t\"'-"
_MASK, _LOW = (1 << 64) - 1, (1 << 32) - 1
# Odd constants of the splitmix64 generator.
_STEP, _MIX1, _MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
SLOT_BITS = 20  # of the table of merges
SIDE = 21  # bits of a symbol in a pair's key; symbols without a piece lie above all ids


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(_MIX1)
    x = (x ^ x >> np.uint64(27)) * np.uint64(_MIX2)
    return x ^ x >> np.uint64(31)


def _mixed_one(x: int) -> int:
    x = (x ^ x >> 30) * _MIX1 & _MASK
    x = (x ^ x >> 27) * _MIX2 & _MASK
    return x ^ x >> 31


class Pieces:
    """The model's vocabulary as tables: characters, merges with their ranks, and decoded bytes."""

    def __init__(self, name: str):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.n = sp.get_piece_size()
        usual = [i for i in range(self.n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in usual}
        self.byte = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(self.n) if sp.is_byte(i)}
        self.raw = [b""] * self.n
        for piece, i in self.ids.items():
            self.raw[i] = piece.replace(BLANK, " ").encode()
        for value, i in self.byte.items():
            self.raw[i] = bytes([value])
        self.raw = np.array(self.raw, dtype=object)
        order = sorted({sp.get_score(i) for i in usual}, reverse=True)
        rank_of_score = {s: r for r, s in enumerate(order)}
        merges = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                a = self.symbol(piece[0]) if a is None and cut == 1 else a
                b = self.symbol(piece[-1]) if b is None and cut == len(piece) - 1 else b
                if a is not None and b is not None:
                    merges[a << SIDE | b] = (rank_of_score[sp.get_score(i)], i)
        self.merges = merges
        self.keys = np.array(sorted(merges), dtype=np.int64)
        self.ranks = np.array([*(merges[k][0] for k in self.keys.tolist()), len(order)], dtype=np.int32)
        self.none, self.by_code = len(order), None
        self.merged = np.array([*(merges[k][1] for k in self.keys.tolist()), 0], dtype=np.int64)
        # places of keys by hash; where keys share a slot, those after the first are looked up by bisection
        slots = self._slots(self.keys)
        first = np.unique(slots, return_index=True)[1]
        self.slots, self.crowded = np.full(1 << SLOT_BITS, len(self.keys), np.int32), np.zeros(1 << SLOT_BITS, bool)
        self.slots[slots[first]] = first
        self.crowded[np.delete(slots, first)] = True
        self.keys = np.append(self.keys, -1)
        letter = re.compile(f"[{LETTERS}]")
        joined = {m for piece in self.ids for a, b in zip(piece, piece[1:]) for m, x in ((a, b), (b, a)) if letter.match(x)}
        marks = "".join(re.escape(m) for m in MARKS if m not in joined)
        #: Places that no piece of this vocabulary crosses: between a letter and a mark.
        self.borders = re.compile(rf"(?<=[{LETTERS}])(?=[{marks}])|(?<=[{marks}])(?=[{LETTERS}])") if marks else re.compile(r"(?!)")

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(_STEP) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def found(self, pairs: np.ndarray) -> np.ndarray:
        """Where pairs of symbols are among the merges; the last place for those that do not merge."""
        slot = self._slots(pairs)
        at = self.slots[slot]
        miss = self.keys[at] != pairs
        again = self.crowded[slot] & miss
        at[miss] = len(self.keys) - 1
        if again.any():
            place = np.searchsorted(self.keys[:-1], pairs[again])
            at[again] = np.where(self.keys[place] == pairs[again], place, len(self.keys) - 1)
        return at

    def symbol(self, char: str) -> int:
        return self.ids.get(char, self.n + ord(char))

    def matrix(self, parts: list[str]) -> np.ndarray:
        """One row of symbols per part, a symbol per character, filled up with -1.

        Blanks stand for U+2581 here; U+2581 itself counts as a character without a piece.
        """
        if self.by_code is None:
            self.by_code = np.arange(self.n, self.n + 0x110000, dtype=np.int64)
            for piece, i in self.ids.items():
                if len(piece) == 1 and piece != BLANK:
                    self.by_code[ord(piece)] = i
            self.by_code[ord(" ")] = self.ids[BLANK]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        out = np.full((len(parts), int(lengths.max())), -1, np.int64)
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = self.by_code[codes]
        return out

    def finish(self, symbols) -> bytes:
        """Little-endian ids; symbols without a piece become byte pieces."""
        if max(symbols) >= self.n:
            symbols = [i for s in symbols for i in ([s] if s < self.n else [self.byte[b] for b in chr(s - self.n).encode("utf-8", "surrogatepass")])]
        return struct.pack(f"<{len(symbols)}I", *symbols)

    def finish_rows(self, sym: np.ndarray) -> list[bytes]:
        valid = sym >= 0
        flat, ends = sym[valid], np.cumsum(valid.sum(axis=1)) * 4
        raw, starts = flat.astype("<u4").tobytes(), [0, *ends[:-1].tolist()]
        out = [raw[a:b] for a, b in zip(starts, ends.tolist(), strict=True)]
        for r in np.flatnonzero((sym >= self.n).any(axis=1)):
            out[r] = self.finish(sym[r][valid[r]].tolist())
        return out

    def finish_all(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after the other, and how many each has."""
        if int(sym.max()) >= self.n:
            rows = self.finish_rows(sym)
            return np.frombuffer(b"".join(rows), "<u4"), np.fromiter(map(len, rows), np.int64, len(rows)) // 4
        valid = sym >= 0
        return sym[valid].astype("<u4"), valid.sum(axis=1)


class _Growing:
    """An array with room at its end."""

    def __init__(self, kind: str):
        self.data, self.n = np.zeros(1 << 12, kind), 0

    def extend(self, values: np.ndarray) -> None:
        end = self.n + len(values)
        if end > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(end, self.data.dtype)])
        self.data[self.n : end] = values
        self.n = end


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1 ... of each row, one row after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


class _Numbers(dict):
    """Numbers of words in the order they come up; ``fresh`` lists the new ones."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class Dropout:
    """Encodes texts; ``rate`` is the share of candidate merges that are skipped."""

    def __init__(self, pieces: Pieces, seed: int, rate: float):
        self.pieces, self.seed, self.limit = pieces, seed, min(_MASK, int(rate * 2**64))
        self._forget()

    def _forget(self) -> None:
        self.units, self.unit_parts, self.unit_ends = _Numbers(), _Growing("i8"), _Growing("i8")  # chunk numbers of each word
        self.numbers: dict[str, int] = {}
        self.chunks: list[str] = []
        self.sums, self.lengths = _Growing("u8"), _Growing("i8")  # of each chunk: its symbols' sum, for keys; its length
        self.symbols, self.symbol_ends = _Growing("i4"), _Growing("i8")
        self.plain, self.merges = _Growing("<u4"), _Growing("u8")  # ids without dropout, and the merges that lead there
        self.plain_ends, self.merge_ends = _Growing("i8"), _Growing("i8")
        for ends in (self.plain_ends, self.merge_ends, self.unit_ends, self.symbol_ends):
            ends.extend(np.zeros(1, np.int64))

    def symbol_sums(self, sym: np.ndarray) -> np.ndarray:
        places = np.arange(sym.shape[1], dtype=np.uint64) * np.uint64(_MIX1)
        each = np.where(sym >= 0, _mixed(sym.astype(np.uint64) * np.uint64(_STEP) + places), np.uint64(0))
        return each.sum(axis=1, dtype=np.uint64)

    def keys(self, sums: np.ndarray, variant: np.ndarray) -> np.ndarray:
        return _mixed(sums + (np.uint64(self.seed * 1_000_003 & _MASK) + variant) * np.uint64(_STEP))

    def part_keys(self, sym: np.ndarray, variant) -> np.ndarray:
        """A hash of seed, variant (a number of the occurrence) and all symbols of each row."""
        return self.keys(self.symbol_sums(sym), np.atleast_1d(np.asarray(variant)).astype(np.uint64))

    def agenda(self, symbols: list[int], key: int) -> list[int]:
        """One chunk with a heap of candidate merges."""
        merges, limit = self.pieces.merges, self.limit
        sym, left, right = list(symbols), list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(a: int) -> None:
            b = right[a] if a >= 0 else -1
            if a >= 0 and b >= 0 and (found := merges.get(sym[a] << SIDE | sym[b])):
                heapq.heappush(heap, (found[0], a, sym[a], sym[b], found[1]))

        for a in range(len(symbols) - 1):
            offer(a)
        while heap:
            _, a, was, beside, merged = heapq.heappop(heap)
            b = right[a]
            if sym[a] != was or b < 0 or sym[b] != beside:
                continue
            if limit and _mixed_one((key + (a * 65_537 + merged) * _STEP) & _MASK) < limit:
                continue
            sym[a], sym[b], right[a] = merged, -1, right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a])
            offer(a)
        return [s for s in sym if s >= 0]

    def _ranks(self, left: np.ndarray, right: np.ndarray, keys: np.ndarray, drop: bool) -> np.ndarray:
        """Ranks of pairs of cells; pairs that do not merge, or are skipped, have the last rank."""
        p = self.pieces
        a, b = (left & _LOW) - 1, (right & _LOW) - 1
        at = p.found(np.where((a >= 0) & (b >= 0), a << SIDE | b, 0))
        rank = p.ranks[at]
        if self.limit and drop:
            some = np.nonzero(rank < p.none)
            place = ((left >> 32)[some] * 65_537 + p.merged[at[some]]).astype(np.uint64)
            skipped = _mixed(np.broadcast_to(keys, rank.shape)[some] + place * np.uint64(_STEP)) < np.uint64(self.limit)
            rank[tuple(x[skipped] for x in some)] = p.none
        return rank

    def side_by_side(self, sym: np.ndarray, key: np.ndarray, made: list | None = None) -> np.ndarray:
        """The agendas of many short parts at once: rows of symbols filled up with -1.

        With ``made``, nothing is skipped, and rows and merges of each step are added to it.
        """
        drop, none = made is None, self.pieces.none
        out, number = np.full_like(sym, -1), np.arange(len(sym))
        # a cell holds a symbol's number plus one, and above it its place; the last cell is a filler
        cells = np.zeros((len(sym), sym.shape[1] + 1), np.int64)
        cells[:, :-1] = sym + 1
        cells |= np.arange(cells.shape[1]) << 32
        rank = self._ranks(cells[:, :-1], cells[:, 1:], key[:, None], drop)
        while len(cells):
            best, line, w = rank.argmin(axis=1), np.arange(len(cells)), cells.shape[1]
            low = rank[line, best]
            on = low < none
            if not on.all():
                out[number[~on], : w - 1] = (cells[~on, :-1] & _LOW) - 1
                cells, rank, key, number, best, low = (x[on] for x in (cells, rank, key, number, best, low))
                line = np.arange(len(cells))
                if not len(cells):
                    break
            was = cells[line, best]
            piece = self.pieces.merged[self.pieces.found((was & _LOW) - 1 << SIDE | (cells[line, best + 1] & _LOW) - 1)]
            if made is not None:
                made.append((number, (was >> 32) * 65_537 + piece))
            cells[line, best] = was & ~_LOW | piece + 1
            keep = np.arange(w) != best[:, None] + 1  # the right side's place goes
            # the filler is never the right side, so the pair to the right of the best one is there, and goes too
            cells, rank = cells[keep].reshape(-1, w - 1), rank[keep[:, : w - 1]].reshape(-1, w - 2)
            row, p = np.concatenate([line, line]), np.concatenate([best - 1, best])
            inside = (p >= 0) & (p < w - 2)
            row, p = row[inside], p[inside]
            rank[row, p] = self._ranks(cells[row, p], cells[row, p + 1], key[row], drop)
        return out

    def _learn(self, new: list[str]) -> None:
        """Chunks of new words; merges and ids without dropout of new chunks."""
        p, lots = self.pieces, {}
        cut = [p.borders.split(" " + unit) for unit in new]
        for part in {part for c in cut for part in c if part not in self.numbers}:
            if len(part) > LONG:  # goes through its agenda at each occurrence
                self._number([part], p.matrix([part]), _NO_IDS, _ZERO, _NO_MERGES, _ZERO)
            else:
                lots.setdefault(-(-len(part) // 3), []).append(part)
        for lot in lots.values():
            for at in range(0, len(lot), 8192):
                some, made = lot[at : at + 8192], []
                sym = p.matrix(some)
                ids, n_ids = p.finish_all(self.side_by_side(sym, np.zeros(len(some), np.uint64), made))
                row = np.concatenate([_NO_ROWS, *(r for r, _ in made)])
                merges = np.concatenate([_NO_ROWS, *(c for _, c in made)])[np.argsort(row, kind="stable")]
                self._number(some, sym, ids, n_ids, merges, np.bincount(row, minlength=len(some)))
        self.unit_parts.extend(np.fromiter((self.numbers[part] for c in cut for part in c), np.int64))
        self.unit_ends.extend(self.unit_ends.data[self.unit_ends.n - 1] + np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut))))

    def _number(self, parts: list[str], sym: np.ndarray, ids: np.ndarray, n_ids: np.ndarray, merges: np.ndarray, n_merges: np.ndarray) -> None:
        self.numbers.update(zip(parts, range(len(self.chunks), len(self.chunks) + len(parts)), strict=True))
        self.chunks += parts
        self.sums.extend(self.symbol_sums(sym))
        valid = sym >= 0
        self.lengths.extend(valid.sum(axis=1))
        self.symbol_ends.extend(self.symbols.n + np.cumsum(valid.sum(axis=1)))
        self.symbols.extend(sym[valid])
        self.plain_ends.extend(self.plain.n + np.cumsum(n_ids))
        self.merge_ends.extend(self.merges.n + np.cumsum(n_merges))
        self.plain.extend(ids)
        self.merges.extend(merges.astype(np.uint64))

    def _occurrences(self, part: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of occurrences of chunks, one after the other, and how many each has."""
        p = self.pieces
        first, last = self.merge_ends.data[part], self.merge_ends.data[part + 1]
        at, counts = self.plain_ends.data[part], self.plain_ends.data[part + 1] - self.plain_ends.data[part]
        length = self.lengths.data[part]
        cut = length > LONG
        if self.limit:
            n = last - first
            skipped = _mixed(np.repeat(key, n) + self.merges.data[_spread(first, n)] * np.uint64(_STEP)) < np.uint64(self.limit)
            cut |= np.bincount(np.repeat(np.arange(len(part)), n)[skipped], minlength=len(part)) > 0
        kept = self.plain.n  # beyond the memo, the ids of these occurrences lie here for a while
        rows = np.flatnonzero(cut)
        rows = rows[np.argsort(length[rows], kind="stable")]
        short = int(np.searchsorted(length[rows], LONG, side="right"))
        steps = np.flatnonzero(np.diff((length[rows[:short]] + 2) // 3)) + 1
        for lot in np.split(rows[:short], steps):
            for a in range(0, len(lot), 8192):
                some = lot[a : a + 8192]
                ids, n = p.finish_all(self.side_by_side(self._matrix(part[some]), key[some]))
                counts[some], at[some] = n, self.plain.n + np.cumsum(n) - n
                self.plain.extend(ids)
        for k in rows[short:].tolist():
            ids = np.frombuffer(p.finish(self.agenda(self._matrix(part[k : k + 1])[0].tolist(), int(key[k]))), "<u4")
            counts[k], at[k] = len(ids), self.plain.n
            self.plain.extend(ids)
        out = self.plain.data[_spread(at, counts)]
        self.plain.n = kept
        return out, counts

    def _matrix(self, part: np.ndarray) -> np.ndarray:
        """One row of symbols for each chunk, filled up with -1."""
        n = self.lengths.data[part]
        out = np.full((len(part), int(n.max())), -1, np.int64)
        out[np.arange(out.shape[1])[None, :] < n[:, None]] = self.symbols.data[_spread(self.symbol_ends.data[part], n)]
        return out

    def encode(self, texts: list[str], variants: list[int]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; ``variants`` are numbers of the documents."""
        if len(self.chunks) > MEMO_CHUNKS:
            self._forget()
        cut: list[list[str]] = []
        for text in texts:
            units = text.split(" ") if text else []
            if "" in units:
                units = [c[1:] for c in _RUNS.findall(" " + text)]
            cut.append(units)
        units = [np.fromiter(map(self.units.__getitem__, c), np.int64, len(c)) for c in cut]
        if self.units.fresh:
            self._learn(self.units.fresh)
            self.units.fresh = []
        parts = []
        for u in units:
            first = self.unit_ends.data[u]
            parts.append(self.unit_parts.data[_spread(first, self.unit_ends.data[u + 1] - first)])
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        part = np.concatenate([_NO_ROWS, *parts])
        document = np.repeat(_mixed(np.array([v & _MASK for v in variants], np.uint64)), sizes)
        place = _spread(np.zeros(len(sizes), np.int64), sizes).astype(np.uint64)
        key = self.keys(self.sums.data[part], _mixed(document + place * np.uint64(_STEP)))
        pools, counts = [_NO_IDS], [_NO_ROWS]
        for a in range(0, len(part), AT_ONCE):
            ids, n = self._occurrences(part[a : a + AT_ONCE], key[a : a + AT_ONCE])
            pools.append(ids)
            counts.append(n)
        raw, ends = np.concatenate(pools).tobytes(), np.concatenate([[0], np.cumsum(np.concatenate(counts))]) * 4
        stops = ends[np.cumsum(sizes)].tolist()
        return [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]


_NO_IDS, _NO_MERGES, _NO_ROWS = np.empty(0, "<u4"), np.empty(0, np.uint64), np.empty(0, np.int64)
_ZERO = np.zeros(1, np.int64)


def decode(pieces: Pieces, ids: bytes) -> bytes:
    """The text's UTF-8 bytes."""
    return b"".join(pieces.raw[np.frombuffer(ids, dtype="<u4")].tolist())[1:]


_loaded: dict[str, Pieces] = {}


def pieces(name: str) -> Pieces:
    if name not in _loaded:
        _loaded[name] = Pieces(name)
    return _loaded[name]


def encode_column(docs: DataFrame, model: str = "piece_bpe_32k.model", seed: int = 1, rate: float = 0.1) -> DataFrame:
    """doc_id, text and ``ids``, the segmentation's ids as little-endian unsigned 32-bit integers."""

    def encode(batches):
        state = Dropout(pieces(model), seed, rate)
        for batch in chunks(batches):
            ids = state.encode(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["doc_id", "text", "ids"])

    variant = F.xxhash64("doc_id", F.lit(seed))
    return id_text(docs).withColumn("variant", variant).mapInArrow(encode, "doc_id long, text string, ids binary")


def encode_and_decode(docs: DataFrame, model: str = "piece_bpe_32k.model", seed: int = 1, rate: float = 0.1) -> DataFrame:
    """doc_id, n_bytes, n_pieces, ids_crc32 and decoded_sha256, the digest of what the ids decode to."""

    def describe(batches):
        state = Dropout(pieces(model), seed, rate)
        for batch in chunks(batches):
            ids = state.encode(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            raw = [decode(state.pieces, i) for i in ids]
            columns = [pa.array([len(r) for r in raw]), pa.array([len(i) // 4 for i in ids]), pa.array([crc32(i) for i in ids], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(c.cast(pa.int64()) for c in columns), pa.array([hashlib.sha256(r).hexdigest() for r in raw])],
                names=["doc_id", "n_bytes", "n_pieces", "ids_crc32", "decoded_sha256"],
            )

    variant = F.xxhash64("doc_id", F.lit(seed))
    described = id_text(docs).withColumn("variant", variant).mapInArrow(describe, "doc_id long, n_bytes long, n_pieces long, ids_crc32 long, decoded_sha256 string")
    return described
