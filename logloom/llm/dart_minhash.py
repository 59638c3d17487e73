"""Near-duplicates by DartMinHash.

A document is its set of five-word shingles.  For the signature each shingle has a weight, 2c / (c + 1) for c occurrences in
the document: 1 for a single one, below 2 for any number.  Darts are thrown by hash at the plane of weight and rank: every unit of
area over an element has a Poisson(1) number of them, at places that depend on the element alone.  A document keeps the darts that
lie below its elements' weights and below a rank that leaves about ``k ln k + 2k`` darts; the earliest dart of each of ``k``
coordinates is the signature (the rank is doubled while a coordinate is empty).  Two documents agree in a coordinate
with probability of their weighted Jaccard similarity.  Bands of ``rows`` coordinates are joined.

Two documents are linked if their plain sets have a similarity of ``threshold`` or more; classes are what links connect.
Weights below 2 keep the weighted similarity of such a pair near the plain one (at 0.8, above 0.66 in the worst case), so one of 32 bands
agrees but for a chance of about 5e-8 (9e-4 in the worst case).

Documents with equal sets are one node from the start.  Nothing ever lists the pairs of a bucket:

1. Leader rounds.  In each bucket of more than one class, one member of its largest class is compared with the members of other classes: as
   many pairs as members.  It is drawn by hash, in the first round by one hash for all buckets, so that the many buckets of one group of near copies ask for
   the same pairs, then by one for each bucket.  Pairs that the signatures do not rule out are verified by their exact sets.
2. Families.  In what buckets are left, members outside the largest class are compared by signature with all members of
   other classes, in cells of bounded size; a cell gives for each member that has such a partner a representative of what hangs
   together.  What representatives connect is a family.
3. Exact cells.  In each family, members outside its largest class meet all members with their exact sets, again in cells of bounded
   size; a cell gives one link for each class that it joins.

The work inside cells grows with outsiders times members, and so do the rows that fill the cells, one for each 512 such pairs.

Defined cases: texts without words (null, empty, blanks) have the same, empty, set and are one class; texts below five
words are one shingle; rows of one doc_id are one document; a row without doc_id has no class; an empty table gives no rows; other
columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, chunks, id_text, materialize, small

WORDS, K, ROWS = 5, 128, 4
THRESHOLD = 0.8
#: Deviations of an estimated similarity below the threshold at which a pair is ruled out.
DEVIATIONS = 5.6
LEADER_ROUNDS = 2
#: Members of a cell's side, and shingles of an exact cell's side.
CELL_ROWS, CELL_SHINGLES = 1024, 400_000
MEMO_WORDS = 500_000
_STEP, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Cumulative Poisson(1) probabilities of 0, 1, 2, ... darts in a unit of area.
POISSON = np.cumsum(np.exp(-1.0) / np.array([1.0, *np.cumprod(np.arange(1.0, 18.0))]))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _MIX1
    x = (x ^ x >> np.uint64(27)) * _MIX2
    return x ^ x >> np.uint64(31)


class Shingles:
    """Sets of shingle hashes; a bounded memo of word hashes."""

    def __init__(self, width: int = WORDS):
        self.width, self.memo = width, {}
        self.factors = mixed(np.arange(1, width + 1, dtype=np.uint64) * _STEP) | np.uint64(1)

    def _word(self, word: str) -> int:
        value = self.memo[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles in ascending order, and their counts."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo, learn = self.memo, self._word
        words = np.array([memo[w] if w in memo else learn(w) for w in text.lower().split()], dtype=np.uint64)
        n = max(1, len(words) - self.width + 1) if len(words) else 0
        parts = np.zeros(n, dtype=np.uint64)
        for k, factor in enumerate(self.factors[: len(words)]):
            parts += words[k : k + n] * factor
        return np.unique(mixed(parts + np.uint64(min(len(words), self.width))), return_counts=True)


def _darts(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owner, rank and identity of all darts below each element's weight and its owner's rank limit.

    Weights fall into slabs [2^v - 1, 2^(v+1) - 1); a slab's cells are 2^-v ranks high, so that each has area one.
    """
    found = []
    slab = 0
    while True:
        floor, width = 2.0**slab - 1, 2.0**slab
        on = weights > floor
        if not on.any():
            break
        e, w, o = elements[on], weights[on], owner[on]
        cells = np.ceil(limit[o] * width).astype(np.int64)
        which = np.repeat(np.arange(len(e)), cells)
        cell = np.arange(len(which)) - np.repeat(np.cumsum(cells) - cells, cells)
        seed = mixed(e[which] + (cell.astype(np.uint64) * np.uint64(64) + np.uint64(slab)) * _STEP)
        count = np.searchsorted(POISSON, (seed >> np.uint64(11)).astype(float) * 2.0**-53, side="right")
        where = np.repeat(np.arange(len(which)), count)
        number = np.arange(len(where)) - np.repeat(np.cumsum(count) - count, count)
        dart = mixed(seed[where] + (number + 1).astype(np.uint64) * _MIX2)
        rank = (cell[where] + (dart >> np.uint64(11)).astype(float) * 2.0**-53) / width
        of = which[where]
        keep = rank < limit[o[of]]
        part = keep & (w[of] < floor + width)  # the slab's upper weights are not all covered
        if part.any():
            height = floor + (mixed(dart ^ _STEP) >> np.uint64(11)).astype(float) * 2.0**-53 * width
            keep &= ~part | (height < w[of])
        found.append((o[of[keep]], rank[keep], dart[keep]))
        slab += 1
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def signatures(sets: list[np.ndarray], weights: list[np.ndarray] | None = None, k: int = K) -> np.ndarray:
    """Signature rows of non-empty sets; ``k`` is a power of two up to 1024."""
    out = np.zeros((len(sets), k), dtype=np.uint64)
    weights = weights or [np.ones(len(s)) for s in sets]
    total = np.array([w.sum() for w in weights], dtype=float)
    limit, todo = (k * np.log(k) + 2 * k) / total, np.arange(len(sets))
    while len(todo):
        sizes = [len(sets[d]) for d in todo]
        owner, rank, dart = _darts(np.concatenate([sets[d] for d in todo]), np.concatenate([weights[d] for d in todo]).astype(float), np.repeat(np.arange(len(todo)), sizes), limit[todo])
        slot = owner * k + (dart & np.uint64(k - 1)).astype(np.int64)
        earliest = np.full(len(todo) * k, np.inf)
        np.minimum.at(earliest, slot, rank)
        hit = rank == earliest[slot]
        found = np.zeros(len(todo) * k, dtype=np.uint64)
        found[slot[hit]] = mixed(dart[hit])
        full = np.isfinite(earliest).reshape(-1, k).all(axis=1)
        out[todo[full]] = found.reshape(-1, k)[full]
        limit[todo] *= 2
        todo = todo[~full]
    return out


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; a key holds its band's number."""
    n, k = sig.shape
    factors = mixed(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    return mixed((sig.reshape(n, k // rows, rows) * factors).sum(axis=2, dtype=np.uint64) + np.arange(k // rows, dtype=np.uint64) * _STEP).astype(np.int64)


def saturated(counts: np.ndarray) -> np.ndarray:
    """Weights of shingles by their number of occurrences."""
    return 2.0 * counts / (counts + 1.0)


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n, the set's 128-bit digest (d1, d2), its bands and one byte per coordinate; nulls for documents without words."""

    def run(batches):
        shingle = Shingles()
        for batch in chunks(batches):
            parts = [shingle(t) for t in batch.column(1).to_pylist()]
            some = [i for i, (s, _) in enumerate(parts) if len(s)]
            n, d1, d2, bands, short = ([None] * len(parts) for _ in range(5))
            if some:
                sig = signatures([parts[i][0] for i in some], [saturated(parts[i][1]) for i in some])
                keys, low = band_keys(sig), (sig & np.uint64(255)).astype(np.uint8)
                for j, i in enumerate(some):
                    s = parts[i][0]
                    n[i], bands[i], short[i] = len(s), keys[j], low[j].tobytes()
                    d1[i], d2[i] = (int(mixed(s + x).sum(dtype=np.uint64).astype(np.int64)) for x in (_STEP, _MIX1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(short, pa.binary())],
                names=["doc_id", "n", "d1", "d2", "bands", "short"],
            )

    return id_text(docs).mapInArrow(run, "doc_id long, n long, d1 long, d2 long, bands array<long>, short binary")


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and its sorted shingles, for the wanted nodes."""

    def run(batches):
        shingle = Shingles()
        for batch in chunks(batches):
            sets = [shingle(t)[0].tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    wanted = id_text(docs).join(small(nodes.select(F.col("node").alias("doc_id"))), "doc_id", "left_semi")
    return wanted.mapInArrow(run, "node long, shingles binary")


def _bytes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _hopeful(threshold: float, k: int = K) -> float:
    """Least share of equal low bytes of a pair that the signatures do not rule out."""
    least = max(0.0, threshold - DEVIATIONS * (threshold * (1 - threshold) / k) ** 0.5)
    return least + (1 - least) / 256


def _agreeing(pairs: DataFrame, short: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose signatures do not rule them out."""
    least = _hopeful(threshold)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                share = (_bytes(batch.column("sa")) == _bytes(batch.column("sb"))).mean(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(share >= least))

    left = short.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("short").alias("sa"))
    right = short.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("short").alias("sb"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where(F.least("na", "nb") >= F.lit(threshold - 1e-9) * F.greatest("na", "nb"))
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, threshold: float, tables: Tables) -> DataFrame:
    """Pairs whose exact set similarity reaches the threshold, as a table."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(shared >= threshold * (len(a) + len(b) - shared) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = tables.write(_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))
    both = left.join(small(pairs), "a").join(right, "b").select("a", "b", "xa", "xb")
    links = tables.write(both.mapInArrow(run, "a long, b long"), "links")
    tables.drop(sets)
    return links


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """node and class, the least node that it is connected with, of all nodes on the edges (a, b)."""
    both = tables.write(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = tables.write(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("class")), "labels")
    while True:
        far = both.join(labels.select(F.col("node").alias("b"), "class"), "b").groupBy(F.col("a").alias("node")).agg(F.min("class").alias("near"))
        step = labels.join(far, "node").select("node", F.col("class").alias("was"), F.least("class", "near").alias("class"))
        jump = step.join(labels.select(F.col("node").alias("class"), F.col("class").alias("root")), "class")
        nxt = tables.write(jump.select("node", "was", F.least("class", "root").alias("class")), "labels")
        tables.drop(labels)
        moved = nxt.where(F.col("was") != F.col("class")).limit(1).count()
        labels = nxt
        if not moved:
            tables.drop(both)
            return labels.select("node", "class")


def _named(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the class of each node, itself if it has no link."""
    if labels is None:
        return rows.withColumn("class", F.col("node"))
    return rows.join(labels.hint("merge"), "node", "left").withColumn("class", F.coalesce("class", "node"))


def _joined(labels: DataFrame | None, links: DataFrame, tables: Tables) -> DataFrame | None:
    """Classes after more links: classes are joined, not members."""
    if links.isEmpty():
        return labels
    ends = _named(links.select(F.col("a").alias("node"), "b"), labels).select(F.col("class").alias("a"), F.col("b").alias("node"))
    ends = _named(ends, labels).select("a", F.col("class").alias("b")).where("a != b").distinct()
    roots = components(ends, tables)
    if labels is None:
        return roots
    old = labels.join(roots.select(F.col("node").alias("class"), F.col("class").alias("root")), "class", "left")
    old = old.select("node", F.coalesce("root", "class").alias("class"))
    return tables.write(old.unionByName(roots.join(labels.hint("merge"), "node", "left_anti")), "labels")


def _shape(members: DataFrame, group: str, salt: int) -> DataFrame:
    """Of each group with more than one class: its size, the largest class and a member of that, drawn by hash: for salt 0 the same hash
    for all groups, so that groups of the same members have one leader and ask for the same pairs; else one for each group."""
    drawn = F.struct(F.xxhash64("node", *([group] if salt else []), F.lit(salt)).alias("draw"), F.col("node").alias("leader"))
    each = members.groupBy(group, "class").agg(F.count("*").alias("size"), F.max(drawn).alias("lead"))
    whole = each.groupBy(group).agg(F.sum("size").alias("size"), F.count("*").alias("classes"), F.max(F.struct("size", "lead.draw", "lead.leader", "class")).alias("top"))
    return whole.where("classes > 1").select(group, "size", F.col("top.size").alias("main_size"), F.col("top.class").alias("main"), F.col("top.leader").alias("leader"))


def _cells(members: DataFrame, group: str, rows_a_side: int, load: str | None = None, most: int = 0) -> DataFrame:
    """Rows of cells (group, asked, held): each row of a group is held by one part of it, once for every part of those that ask; each row that
    asks meets every part.  Parts have about ``rows_a_side`` rows, and about ``most`` of the summed ``load``."""
    loads = F.sum(load) if load else F.lit(0)
    asking = F.sum(F.when(F.col("asks"), F.col(load))) if load else F.lit(0)
    sizes = members.groupBy(group).agg(F.count("*").alias("rows"), F.count_if("asks").alias("asking"), loads.alias("load"), asking.alias("asking_load"))
    parts = lambda rows, total: F.greatest(F.lit(1), F.ceil(F.col(rows) / rows_a_side), F.ceil(F.col(total) / max(1, most))).cast("int")
    sizes = sizes.where("asking > 0").select(group, parts("rows", "load").alias("held_parts"), parts("asking", "asking_load").alias("asked_parts"))
    rows = members.join(sizes, group)
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = lambda n: F.pmod(F.xxhash64("node", F.lit(7)), F.col(n)).cast("int")
    held = rows.withColumn("held", own("held_parts")).withColumn("asked", F.explode(every("asked_parts"))).withColumn("asks", F.lit(False))
    asked = rows.where("asks").withColumn("asked", own("asked_parts")).withColumn("held", F.explode(every("held_parts")))
    return held.unionByName(asked.select(held.columns)).drop("held_parts", "asked_parts")


def _sides(rows: pa.Table) -> tuple[pa.Table, pa.Table]:
    rows = rows.sort_by("node")
    asks = rows.column("asks")
    return rows.filter(asks).combine_chunks(), rows.filter(pa.compute.invert(asks)).combine_chunks()


def _numbers(side: pa.Table, *columns: str) -> list[np.ndarray]:
    return [side.column(c).to_numpy() for c in columns]


def _hanging(open_: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the nodes with an open pair (a matrix of left by right): the node, and the least node that it hangs together with."""
    far = np.iinfo(np.int64).max
    a, b = np.where(open_.any(axis=1), left, far), np.where(open_.any(axis=0), right, far)
    while True:
        b2 = np.minimum(b, np.where(open_, a[:, None], far).min(axis=0, initial=far))
        a2 = np.minimum(a, np.where(open_, b2[None, :], far).min(axis=1, initial=far))
        if (a2 == a).all() and (b2 == b).all():
            break
        a, b = a2, b2
    node, least = np.concatenate([left, right]), np.concatenate([a, b])
    return node[least < far], least[least < far]


def _family_edges(rows: pa.Table, threshold: float) -> pa.Table:
    """One cell of a bucket: (a, b) where a has a partner of another class that its signature does not rule out."""
    asks, holds = _sides(rows)
    none = pa.table([pa.array([], pa.int64())] * 2, names=["a", "b"])
    if not asks.num_rows or not holds.num_rows:
        return none
    (qn, qc, qs), (on, oc, os) = (_numbers(side, "node", "class", "n") for side in (asks, holds))
    left, right = _bytes(asks.column("short")), _bytes(holds.column("short"))
    open_ = (qc[:, None] != oc[None, :]) & (np.minimum(qs[:, None], os[None, :]) >= (threshold - 1e-9) * np.maximum(qs[:, None], os[None, :]))
    least, step = _hopeful(threshold, left.shape[1]), max(1, (8 << 20) // right.size)
    for at in range(0, len(left), step):
        open_[at : at + step] &= (left[at : at + step, None, :] == right[None, :, :]).mean(axis=2) >= least
    a, b = _hanging(open_, qn, on)
    return pa.table([pa.array(a), pa.array(b)], names=["a", "b"])


def _shared(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of sets, left by right."""
    out = np.zeros((len(left), len(right)), np.float32)
    rows = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    flat = [np.concatenate(side) if side else np.zeros(0, np.uint64) for side in (left, right)]
    common = np.intersect1d(*map(np.unique, flat), assume_unique=True)
    place = [np.minimum(np.searchsorted(common, f), max(0, len(common) - 1)) for f in flat]
    for at in range(0, len(common), columns):
        dense = []
        for side, row, p, f in zip((left, right), rows, place, flat, strict=True):
            on = (p >= at) & (p < at + columns)
            on[on] = common[p[on]] == f[on]
            m = np.zeros((len(side), columns), np.float32)
            m[row[on], p[on] - at] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def _exact_links(rows: pa.Table, threshold: float) -> pa.Table:
    """One cell of a family: a verified link for each class that it joins with others."""
    asks, holds = _sides(rows)
    none = pa.table([pa.array([], pa.int64())] * 2, names=["a", "b"])
    if not asks.num_rows or not holds.num_rows:
        return none
    (qc,), (oc,) = _numbers(asks, "class"), _numbers(holds, "class")
    left, right = ([np.frombuffer(x, np.uint64) for x in side.column("shingles").to_pylist()] for side in (asks, holds))
    both = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
    shared = _shared(left, right)
    linked = (qc[:, None] != oc[None, :]) & (shared >= threshold * (both - shared) - 1e-6)
    a, b = _hanging(linked, qc, oc)
    pairs = np.unique(np.stack([a, b], 1), axis=0)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _cell_job(job, threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        return job(rows, threshold)

    return run


def _families(members: DataFrame, labels: DataFrame | None, nodes: DataFrame, threshold: float, tables: Tables) -> DataFrame | None:
    """node and family of the members that have a partner of another class that signatures do not rule out; None if there are none."""
    named = tables.write(_named(members, labels), "named")
    asks = F.col("class") != F.col("main")
    wide = named.join(_shape(named, "key", LEADER_ROUNDS).select("key", "main"), "key").select("key", "node", "class", asks.alias("asks"))
    cells = _cells(wide, "key", CELL_ROWS).join(nodes.select("node", "n", "short").hint("merge"), "node")
    edges = cells.groupBy("key", "asked", "held").applyInArrow(_cell_job(_family_edges, threshold), "a long, b long")
    edges = tables.write(edges.distinct(), "family-edges")
    return None if edges.isEmpty() else components(edges, tables).withColumnRenamed("class", "family")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class) and n_shingles of every row."""
    with Tables(docs.sparkSession) as tables:
        sketched = tables.write(sketch(docs), "sketch")
        worded = sketched.where("doc_id IS NOT NULL AND n IS NOT NULL")
        digest = ["d1", "d2", "n"]
        nodes = worded.groupBy(*digest).agg(F.min(F.struct("doc_id", "bands", "short")).alias("first"))
        nodes = tables.write(nodes.select(*digest, F.col("first.doc_id").alias("node"), F.col("first.bands").alias("bands"), F.col("first.short").alias("short")), "nodes")

        banded = nodes.select("node", F.explode("bands").alias("key"))
        shared = banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
        members, labels = tables.write(banded.join(shared.hint("merge"), "key"), "members"), None
        for round_ in range(LEADER_ROUNDS):
            named = tables.write(_named(members, labels), "named")
            shape = tables.write(_shape(named, "key", round_), "shape")
            led = named.join(shape.hint("merge"), "key")
            pairs = led.where(F.col("class") != F.col("main")).select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
            pairs = tables.write(_agreeing(pairs.where("a < b").distinct(), nodes, threshold), "pairs")
            labels = _joined(labels, _verified(pairs, docs, threshold, tables), tables)
            # a bucket of two has no other pair, and one of a single class needs none
            fewer = tables.write(led.where("size > 2").select("key", "node"), "members")
            tables.drop(members, named, shape, pairs)
            members = fewer
        families = _families(members, labels, nodes, threshold, tables)
        if families is not None:
            placed = _named(families, labels)
            main = _shape(placed, "family", LEADER_ROUNDS).select("family", "main")
            placed = placed.join(main, "family").select("family", "node", "class", (F.col("class") != F.col("main")).alias("asks"))
            placed = tables.write(placed.join(nodes.select("node", "n").hint("merge"), "node"), "families")
            sets = tables.write(_sets(docs, placed.select("node").distinct()), "sets")
            cells = _cells(placed, "family", CELL_ROWS, "n", CELL_SHINGLES).drop("n").join(sets, "node")
            links = cells.groupBy("family", "asked", "held").applyInArrow(_cell_job(_exact_links, threshold), "a long, b long")
            labels = _joined(labels, tables.write(links.distinct(), "links"), tables)

        found = _named(nodes.select(*digest, "node"), labels).select(*digest, F.col("class").alias("found"))
        wordless = sketched.where("doc_id IS NOT NULL AND n IS NULL").agg(F.min("doc_id")).first()[0]
        rows = sketched.select("doc_id", *digest).join(found, digest, "left")
        rows = rows.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("found", F.lit(wordless), "doc_id")).alias("class_id"), F.coalesce("n", F.lit(0)).alias("n_shingles"))
        return materialize(rows, "classes")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all its columns; of each class the row or rows of least doc_id stay."""
    gone = materialize(classes(docs, threshold).where("class_id != doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    return docs.join(small(gone), docs["doc_id"].cast("long") == gone["__gone"], "left_anti")
