"""Shards of near equal bytes: groups of equal texts in one order, cut where the fullest shard is as small as it can be.

A group, all rows with one text, is never split.  Groups stand in order: first those larger than an even share of what is left, by falling size, each a shard of its
own; then all others by the SHA-256 of their texts.  The smallest capacity with which a greedy pass over these
needs no more shards than are left is found by binary search.  The order is then cut within that capacity, each time at the end of a group nearest to an even share
of what is left, so that the last shard is not the pass's remainder.

The order can be far too long for one machine, so the search works on buckets of hash prefixes, whose sums are
collected.  Taken whole, buckets give a capacity that is surely enough; taken as divisible, one that is surely needed.  Cuts of
any capacity between the two fall into few buckets; these are split by further bits of the hash, or into their groups once
those are few, until cuts meet groups only, and the capacity is exact.  The driver holds some ten thousand sums at a time.

Rows are dealt by comparing their text's hash with the cuts, without a join.  Slots come from one sort by ranges (shard, hash, doc_id), which
splits even a group of a third of all rows, and one count for each range.

Defined cases: a null text has no bytes and is in the group of empty texts; repeated rows and rows of one doc_id each get a slot; a null doc_id comes first in its group; fewer groups
than shards leave shards empty; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Tables, id_text, materialize, small

SHARDS, ROW_BYTES = 24, 8
#: Bits of the hash that number the first buckets, and that split a bucket further.
FIRST_BITS, MORE_BITS = 12, 7
KEY_BITS = 60
#: Most groups that are collected one by one in a step.
GROUPS = 100_000


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the text's SHA-256 and ``key``, its first 60 bits."""
    sha = F.sha2("text", 256)
    rows = id_text(docs).select("doc_id", (F.octet_length("text").cast("long") + ROW_BYTES).alias("size"), F.crc32("text").alias("text_crc32"), F.unhex(sha).alias("digest"), sha.alias("hex"))
    return rows.withColumn("key", F.conv(F.substring("hex", 1, KEY_BITS // 4), 16, 10).cast("long")).drop("hex")


@dataclass
class Order:
    """What the driver knows of the order: number (key at its bits), first digest and size of each bucket, or of each ``single`` group."""

    digest: list
    key: np.ndarray
    bits: np.ndarray
    size: np.ndarray
    single: np.ndarray

    def __post_init__(self):
        place = sorted(range(len(self.digest)), key=self.digest.__getitem__)
        self.digest = [self.digest[i] for i in place]
        self.key, self.bits, self.size, self.single = (x[place] for x in (self.key, self.bits, self.size, self.single))
        self.ends = np.cumsum(self.size)

    def at(self, byte: int) -> int:
        """The item that holds this byte."""
        return int(np.searchsorted(self.ends, byte, "right"))

    def whole(self, at: int, capacity: int) -> int:
        """The last end of an item that lies no more than ``capacity`` after a byte."""
        k = self.at(at + capacity)
        return max(at, int(self.ends[k - 1])) if k else at


def greedy(order: Order, capacity: int, shards: int, divisible: bool = False) -> list[int] | None:
    """The ends, in bytes, of the shards of a greedy pass; None where it needs more than ``shards``.  ``divisible``: buckets may be cut anywhere."""
    total, at, ends = int(order.ends[-1]), 0, []
    while at < total:
        k = order.at(at + capacity)
        to = at + capacity if divisible and k < len(order.ends) and not order.single[k] else order.whole(at, capacity)
        if to == at or len(ends) == shards:
            return None
        ends.append(at := to)
    return ends


def least_capacity(order: Order, shards: int, divisible: bool = False, low: int = 0) -> int:
    """The smallest capacity, from ``low`` on, with which the greedy pass needs no more than ``shards``."""
    high = max(low, int(order.ends[-1]))
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if greedy(order, middle, shards, divisible) else (middle + 1, high)
    return low


def even_ends(order: Order, capacity: int, shards: int) -> tuple[list[int], list[int]]:
    """Ends of shards within a capacity that is enough, each nearest to an even share of what is left; and the shares' own places."""
    total = int(order.ends[-1])
    begins = order.ends - order.size
    latest = [total]  # where the last 0, 1, 2 ... shards have to begin, if they hold all they can
    while latest[-1] > 0:
        latest.append(int(begins[np.searchsorted(begins, latest[-1] - capacity, "left")]))
    at, ends, shares = 0, [], []
    for left in range(shards, 0, -1):
        share = at + -(-(total - at) // left)
        after = latest[left - 1] if left - 1 < len(latest) else 0
        k = min(order.at(share), len(order.ends) - 1)
        near = min((int(begins[k]), int(order.ends[k])), key=lambda end: (abs(end - share), end))
        ends.append(at := max(min(near, order.whole(at, capacity)), after, at))
        shares.append(share)
    return ends, shares


def _bucket(bits: int) -> Column:
    return F.shiftright("key", KEY_BITS - bits)


def _order(rows: list, bits: int) -> Order:
    numbers = [np.array([r[c] for r in rows], np.int64) for c in ("key", "size", "n")]
    return Order([bytes(r.digest) for r in rows], numbers[0], np.full(len(rows), bits), numbers[1], numbers[2] == 1)


def _sums(groups: DataFrame, bits: int) -> Order:
    return _order(groups.groupBy(_bucket(bits).alias("key")).agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.min("digest").alias("digest")).collect(), bits)


def _split(groups: DataFrame, order: Order, at: np.ndarray) -> Order:
    """The order with the coarsest of the buckets at some places split further, by one job."""
    bits = int(order.bits[at].min())
    at = at[order.bits[at] == bits]
    inside = groups.where(_bucket(bits).isin(order.key[at].tolist()))
    if bits == KEY_BITS or inside.limit(GROUPS + 1).count() <= GROUPS:
        part = _order(inside.select("key", "digest", "size", F.lit(1).alias("n")).collect(), KEY_BITS)
    else:
        part = _sums(inside, min(bits + MORE_BITS, KEY_BITS))
    rest = np.setdiff1d(np.arange(len(order.digest)), at)
    joined = [np.r_[getattr(order, c)[rest], getattr(part, c)] for c in ("key", "bits", "size", "single")]
    return Order([order.digest[i] for i in rest] + part.digest, *joined)


def _between(order: Order, low: int, high: int, shards: int) -> np.ndarray:
    """Buckets that a greedy pass may cut, with a capacity from ``low`` to ``high``."""
    touched = np.zeros(len(order.digest), bool)
    first, last = 0, greedy(order, high, shards, divisible=True)
    for k in range(shards):
        first = order.whole(first, low)
        touched[order.at(first) : int(np.searchsorted(order.ends, last[min(k, len(last) - 1)], "left")) + 1] = True
    return np.nonzero(touched & ~order.single)[0]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[bytes | None], int]:
    """The first digest of the second and each further shard (None: there is none), and the capacity; ``groups`` has key, digest and size."""
    order = _sums(groups, FIRST_BITS)
    if not len(order.digest):
        return [None] * (shards - 1), 0
    while True:
        low = least_capacity(order, shards, divisible=True)
        capacity = least_capacity(order, shards, low=low)
        if not len(at := _between(order, low, capacity, shards)):
            break
        order = _split(groups, order, at)
    while True:
        ends, shares = even_ends(order, capacity, shards)
        at = np.unique([k for s in shares if (k := order.at(s)) < len(order.digest) and not order.single[k]])
        if not len(at):
            break
        order = _split(groups, order, at.astype(np.int64))
    return [order.digest[k] if (k := order.at(end)) < len(order.digest) else None for end in ends[:-1]], capacity


def giants(groups: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Digest and size of the groups that are larger than an even share of what the larger ones leave."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    out: list[tuple[bytes, int]] = []
    for r in groups.orderBy(F.desc("size"), "digest").limit(shards - 1).select("digest", "size").collect():  # more can't be
        if r["size"] * (shards - len(out)) <= total:
            break
        out.append((bytes(r.digest), r["size"]))
        total -= r["size"]
    return out


def shard_of(digest: Column, alone: list[bytes], cuts: list[bytes | None]) -> Column:
    """The shard of a text with this hash."""
    later = sum((F.when(digest >= F.lit(bytearray(c)), 1).otherwise(0) for c in cuts if c is not None), F.lit(0))
    out = None
    for k, d in enumerate(alone):
        here = digest == F.lit(bytearray(d))
        out = F.when(here, k) if out is None else out.when(here, k)
    rest = F.lit(len(alone)) + later
    return (rest if out is None else out.otherwise(rest)).cast("int")


def shards_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot and grown_shard (null: this law grows no shard)."""
    spark = docs.sparkSession
    with Tables(spark) as tables:
        rows = tables.write(sized(docs), "sized")
        groups = tables.write(rows.groupBy("digest", "key").agg(F.sum("size").alias("size")), "groups")
        alone = [d for d, _ in giants(groups, shards)]
        rest = groups.where(~F.col("digest").isin([F.lit(bytearray(d)) for d in alone])) if alone else groups
        cuts, _ = minimax_cuts(rest, shards - len(alone))
        dealt = rows.withColumn("shard", shard_of(F.col("digest"), alone, cuts))
        order = ["shard", "digest", "doc_id"]
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
        ranged = dealt.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("at"))
        ranged = tables.write(ranged, "ranges")
        part = F.shiftright("at", 33)
        counts = ranged.groupBy(part.alias("part"), "shard").agg(F.count("*").alias("n"), F.min("at").alias("first"))
        # a row for each range, and one more for each shard that begins inside one
        before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = ranged.withColumn("part", part).join(small(counts.select("part", "shard", "first", before.alias("before"))), ["part", "shard"])
        slot = F.col("before") + F.col("at") - F.col("first")
        return materialize(placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard")), "shards")
