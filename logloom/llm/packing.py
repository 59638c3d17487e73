"""Best-fit packing of token sequences with swap-based local search.

Documents are encoded where they are read; only piece lengths and checksums travel.  Pieces are dealt
by hash into groups of about GROUP_PIECES, and every group is packed by best fit in descending
length and then improved: the emptiest bin hands its pieces to fuller ones by moves, one-for-one,
two-for-one and one-for-two exchanges, each of which increases the sum of squared fills, until it is empty or no exchange
with any bin helps.  What all bins can give is indexed by length, so each exchange is looked up among all of them.  Passes over
the underfull bins go on until one empties no bin, or all room left is less than one sequence.  Bins below CLOSED of the
capacity are then opened again and dealt anew into fewer groups, as long as that saves a sequence, until one group is left.

Defined cases: a null or empty text is a document of the end id alone; pieces of repeated rows are packed
each by itself; ties go by doc_id, piece and checksum; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import struct
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, id_text, materialize
from .tokens import crc32, encoder

GROUP_PIECES = 40_000
#: Bins filled at least so far are final after a level.
CLOSED = 0.995
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", bin long, offset long, fill long"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32."""

    def cut(batches):
        encode, end, step = encoder(tokenizer).ids, struct.pack("<I", end_id), 4 * capacity
        for batch in batches:
            out = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = encode(text) + end
                for k, at in enumerate(range(0, len(raw), step)):
                    part = raw[at : at + step]
                    for column, value in zip(out, (doc_id, k, at // 4, len(part) // 4, crc32(part)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return id_text(docs).mapInArrow(cut, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes into ``lengths``, which descend: each piece goes where it leaves least room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0  # bit r is set while a bin has room r
    for k, n in enumerate(lengths):
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(k)
        else:
            b, room = len(bins), capacity
            bins.append([k])
        left = room - n
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins


class _Exchange:
    """Local search over the underfull bins of one group."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.size, self.capacity = lengths, capacity
        self.bins = dict(enumerate(bins))
        self.room = {b: capacity - sum(lengths[k] for k in items) for b, items in self.bins.items()}
        self.gives: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of each bin: the lengths of pieces and of pairs that it can give
        self.total = sum(self.room.values())

    def _kinds(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of one piece, and of two, of a bin; pieces of a length stand for each other."""
        if b not in self.gives:
            sizes = np.sort(np.array([self.size[k] for k in self.bins[b]]))
            one, counts = np.unique(sizes, return_counts=True)
            i, j = np.triu_indices(len(one), 1)
            self.gives[b] = one, np.unique(np.concatenate([one[i] + one[j], 2 * one[counts > 1]]))
        return self.gives[b]

    def _index(self, source: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For a length of two pieces, and of one: the least length that some other bin must give back for it, and that bin."""
        fill = self.capacity - self.room[source]
        others = [b for b, r in self.room.items() if r and b != source and self.capacity - r >= fill]
        room = np.array([self.room[b] for b in others], dtype=np.int64)
        at = np.arange(len(others))
        one, two = ([self._kinds(b)[k] for b in others] for k in (0, 1))
        lots = [(np.zeros(len(others), np.int64), at)] + [(np.concatenate(x), np.repeat(at, [len(y) for y in x])) for x in (one, two) if others]
        found = []
        for upto in (2, 3):  # for two pieces: nothing or one; for one piece also two
            give, owner = (np.concatenate(x) for x in zip(*lots[:upto], strict=True))
            holds = np.minimum(give + room[owner], self.capacity)
            least = np.full(self.capacity + 2, (self.capacity + 1) * (len(others) + 1), np.int64)
            np.minimum.at(least, holds, give * (len(others) + 1) + owner)
            least = np.minimum.accumulate(least[::-1])[::-1]
            found.append((least // (len(others) + 1), least % (len(others) + 1)))
        return [(give, np.array([*others, -1])[owner]) for give, owner in found]

    def _pick(self, b: int, length: int) -> list[int]:
        """One or two pieces of a bin of this length together, or none."""
        if not length:
            return []
        by_size = defaultdict(list)
        for k in self.bins[b]:
            by_size[self.size[k]].append(k)
        if length in by_size:
            return by_size[length][:1]
        for size, items in by_size.items():
            rest = by_size.get(length - size, [])
            if rest and (size * 2 != length or len(rest) > 1):
                return [items[0], rest[-1]]
        return []

    def drain(self, source: int) -> bool:
        """Hand the pieces of ``source`` to fuller bins while that increases squared fill; True if it empties."""
        while self.bins[source]:
            two, one = self._index(source)
            best = (0, 0, 0, 0)
            for takes, (give, owner) in zip(self._kinds(source), (one, two), strict=True):
                takes = takes[takes <= self.capacity]
                gain = takes - give[takes]
                if len(gain) and gain.max() > best[0]:
                    at = int(gain.argmax())
                    best = (int(gain[at]), int(takes[at]), int(give[takes[at]]), int(owner[takes[at]]))
            gain, take, give, other = best
            if gain <= 0:
                return False
            taken, given = self._pick(source, take), self._pick(other, give)
            self.bins[source] = [k for k in self.bins[source] if k not in taken] + given
            self.bins[other] = [k for k in self.bins[other] if k not in given] + taken
            self.room[source] += gain
            self.room[other] -= gain
            self.gives.pop(source, None)
            self.gives.pop(other, None)
        del self.bins[source], self.room[source]
        self.total -= self.capacity
        return True

    def run(self) -> list[list[int]]:
        saved = True
        while saved:
            saved = False
            for source in sorted((b for b, r in self.room.items() if r), key=lambda b: (-self.room[b], b)):
                if self.total < self.capacity:  # no further bin can be saved
                    return list(self.bins.values())
                if self.room.get(source):
                    saved |= self.drain(source)
        return list(self.bins.values())


def pack_group(rows: pa.Table, capacity: int) -> pa.Table:
    """Bin, offset and the bin's fill for each piece of one group."""
    rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
    lengths = rows.column("length").to_pylist()
    bins = _Exchange(best_fit(lengths, capacity), lengths, capacity).run()
    counts = np.array([len(b) for b in bins])
    number = np.repeat(np.arange(len(bins)), counts)
    out = rows.take(pa.array(np.concatenate([np.array(b, dtype=np.int64) for b in bins])))
    sizes = out.column("length").to_numpy()
    before = np.cumsum(sizes) - sizes
    offset = before - before[np.cumsum(counts) - counts][number]
    fill = np.bincount(number, weights=sizes).astype(np.int64)[number]
    for name, values in (("bin", number), ("offset", offset), ("fill", fill)):
        out = out.append_column(name, pa.array(values.astype(np.int64)))
    return out


def pack_pieces(pieces: DataFrame, capacity: int, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (columns of PIECES) with sequence_id and offset; as few sequences as the search finds."""

    def pack(rows: pa.Table) -> pa.Table:
        return pack_group(rows, capacity)

    columns, final = [c.split()[0] for c in PIECES.split(", ")], F.col("fill") >= int(capacity * CLOSED)
    with Tables(pieces.sparkSession) as tables:
        left, done, level, before, packed = tables.write(pieces.select(*columns), "pieces"), [], 0, None, None
        while True:
            groups = max(1, -(-left.count() // group_pieces))
            dealt = left.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level)), F.lit(groups)))
            once = dealt.select("grp", *columns).groupBy("grp").applyInArrow(pack, "grp long, " + PACKED)
            sequence = F.shiftleft(F.lit(level).cast("long"), 56) + F.shiftleft("grp", 24) + F.col("bin")
            anew = tables.write(once.withColumn("sequence_id", sequence), "packed")
            bins, still_open = anew.agg(F.count_if(F.col("offset") == 0), F.count_if((F.col("offset") == 0) & ~final)).first()
            if before is not None and bins >= before:  # dealing them anew saves nothing
                done.append(packed.where(~final))
                break
            if packed is not None:
                tables.drop(left)
            if groups == 1 or not still_open:
                done.append(anew)
                break
            done.append(anew.where(final))
            left, level, before, packed = anew.where(~final).select(*columns), level + 1, still_open, anew
        out = done[0]
        for part in done[1:]:
            out = out.unionByName(part)
        return materialize(out.select(*columns, "sequence_id", "offset"), "sequences")


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Pack all documents: one row per piece with its sequence and its place there."""
    return pack_pieces(token_pieces(docs, tokenizer, end_id, capacity), capacity)
