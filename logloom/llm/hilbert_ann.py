"""Nearest neighbours by shifted space-filling curves.

Every vector is scaled to length one and projected into a few dimensions in ``curves`` seeded ways, each
shifted by its own offsets; its Hilbert number there, made unique by a hash of its id, is its key.  Every
curve's order is cut at quantiles into ``blocks`` key ranges of equal numbers of rows.  A query meets the
rows of its own range and of the two beside it, on every curve; what the windows give is merged and
reranked by the cosine of the original vectors in double precision.  Ranges are dealt to tasks in chunks
of bounded size, so neither a range nor a crowd of equal vectors has to fit into one task.

Windows are a share of all rows (3 / ``blocks`` on each curve) and ranges hold LEAST_ROWS rows or more, so that a small table
is one range and a query there meets all rows: vectors that spread evenly over many dimensions
need wide windows for a recall of 0.9, clustered ones get by with far more blocks.  With the defaults a query is compared 1.5 times
with each row on average (once with 78 % of the rows), and queries times rows is what the work grows with; ``exact`` compares each query
once with every row, in the same chunks, and finds all.

Defined cases: vectors that are null, zero or hold null or non-finite components take no part, as queries or as
candidates, nor do vectors of another length than most; a query with fewer candidates gets them all; equal scores
go to the smaller vec_id; rows of a repeated vec_id are never each other's neighbours and appear once in a
result; a null vec_id takes no part; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize

DIMENSIONS, BITS, TIE_BITS = 10, 4, 20
CHUNK_ROWS, CHUNK_QUERIES = 8192, 16_384
#: Rows of a key range, and as a multiple of k, below which the table is cut into fewer ranges.
LEAST_ROWS, LEAST_TIMES_K = 64, 4


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert numbers of whole-number points (rows, dimensions), by Skilling's transposition."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for shift in range(bits - 1, 0, -1):
        q, low = 1 << shift, (1 << shift) - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for shift in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] & (1 << shift), (1 << shift) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | x[i] >> bit & 1
    return key


def curve_keys(unit: np.ndarray, curves: int, seed: int) -> np.ndarray:
    """Hilbert number of each unit vector (rows) on each curve (columns)."""
    width = unit.shape[1]
    m, out = min(DIMENSIONS, width), np.empty((len(unit), curves), np.int64)
    for c in range(curves):
        rng = np.random.default_rng([seed, c])
        basis = np.linalg.qr(rng.normal(size=(width, width)))[0][:, :m]
        # unit vectors' projections lie within about four deviations of 0; a third of the grid is room for the shift
        place = (unit @ basis) * (np.sqrt(width) / 8) + 0.5 + rng.uniform(0, 0.5, m)
        out[:, c] = hilbert(np.clip(place / 1.5 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _scaled(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two, exactly, so that squares neither overflow nor vanish."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, summed in an order that depends on the length alone."""
    a, b = _scaled(a), _scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and the vector as doubles, of the rows that take part."""
    v = vectors[vector_col].cast("array<double>")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    width = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (width[0] if width else 0))


def _best(query: np.ndarray, other: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best rows of each query: highest score, then smallest id, each pair once."""
    order = np.lexsort((other, -score, query))
    first = np.ones(len(order), bool)
    first[1:] = (query[order[1:]] != query[order[:-1]]) | (other[order[1:]] != other[order[:-1]])
    order = order[first]
    starts = np.flatnonzero(np.concatenate([[True], query[order[1:]] != query[order[:-1]]])) if len(order) else np.zeros(0, int)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(order)]])))
    return order[place < k]


def _cell(rows: pa.Table, k: int) -> pa.Table:
    """The k nearest rows of one chunk for each of its queries."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    rows = rows.combine_chunks()
    asks = rows.column("asks").to_numpy(zero_copy_only=False).astype(bool)
    ids, v = rows.column("vec_id").to_numpy(), _matrix(rows.column("v").chunk(0)) if rows.num_rows else np.zeros((0, 1))
    queries, others = np.flatnonzero(asks), np.flatnonzero(~asks)
    if not len(queries) or not len(others):
        return schema.empty_table()
    unit = _scaled(v)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    left, right = [], []
    for at in range(0, len(queries), 256):
        part = queries[at : at + 256]
        near = unit[part] @ unit[others].T
        near[ids[part][:, None] == ids[others][None, :]] = -np.inf
        few = min(k, near.shape[1])
        least = np.partition(near, near.shape[1] - few, axis=1)[:, -few]
        q, o = np.nonzero((near >= np.maximum(least, -2)[:, None] - 1e-9))  # ties stay: the exact cosine decides
        left.append(part[q])
        right.append(others[o])
    left, right = np.concatenate(left), np.concatenate(right)
    score = cosines(v[left], v[right])
    best = _best(ids[left], ids[right], score, k)
    return pa.table([ids[left][best], ids[right][best], score[best]], schema=schema)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, curves: int = 12, blocks: int = 24, seed: int = 11, exact: bool = False, least_rows: int = LEAST_ROWS, **columns) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest rows that the curves find for each query row.

    ``is_query`` is a condition on vec_id.  Each curve is cut into ``blocks`` ranges, or as many as leave each of them ``least_rows`` rows.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    curves, blocks = (1, 1) if exact else (curves, blocks)

    def keys(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _scaled(_matrix(batch.column(1)))
            found = curve_keys(v / np.sqrt((v * v).sum(axis=1, keepdims=True)), curves, seed)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * curves), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), flat], names=["vec_id", "v", "keys"])

    tie = F.pmod(F.xxhash64("vec_id", "curve"), F.lit(1 << TIE_BITS))
    index = materialize(usable(vectors, **columns).mapInArrow(keys, "vec_id long, v array<double>, keys array<long>"), "curves")
    placed = index.select("vec_id", F.posexplode("keys").alias("curve", "key")).select("curve", (F.shiftleft("key", TIE_BITS) + tie).alias("key"))
    n, n_queries = index.agg(F.count("*"), F.count_if(is_query)).first()
    blocks = max(1, min(blocks, n // max(least_rows, LEAST_TIMES_K * k)))
    shares = [b / blocks for b in range(1, blocks)] or [1.0]
    cuts = placed.groupBy("curve").agg(F.percentile_approx("key", shares, 10_000).alias("cuts"))  # curves x blocks numbers
    chunks_of_rows = max(1, -(-n // (blocks * CHUNK_ROWS)))
    chunks_of_queries = max(1, -(-3 * n_queries // (blocks * CHUNK_QUERIES)))

    spread = index.select("vec_id", "v", is_query.alias("asks"), F.posexplode("keys").alias("curve", "key")).join(F.broadcast(cuts), "curve")
    block = F.size(F.filter("cuts", lambda c: c < F.col("full")))
    spread = spread.withColumn("full", F.shiftleft("key", TIE_BITS) + tie).withColumn("block", block)
    own = F.pmod(F.xxhash64("vec_id"), F.lit(chunks_of_rows)).cast("int")
    asked = F.pmod(F.xxhash64("vec_id"), F.lit(chunks_of_queries)).cast("int")
    every = lambda count: F.sequence(F.lit(0), F.lit(count - 1))
    candidates = spread.select("vec_id", "v", F.lit(False).alias("asks"), "curve", "block", own.alias("rows_part"), F.explode(every(chunks_of_queries)).alias("query_part"))
    beside = F.array(*(F.col("block") + d for d in (-1, 0, 1)))
    queries = spread.where("asks").select("vec_id", "v", "asks", "curve", F.explode(beside).alias("block"), asked.alias("query_part"))
    queries = queries.where(F.col("block").between(0, blocks - 1)).select("*", F.explode(every(chunks_of_rows)).alias("rows_part"))
    cells = candidates.unionByName(queries)

    def search(rows: pa.Table) -> pa.Table:
        return _cell(rows, k)

    found = cells.groupBy("curve", "block", "rows_part", "query_part").applyInArrow(search, "query_id long, vec_id long, score double")
    ranked = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id")))  # at most k rows of each curve and window
    top = ranked.groupBy("query_id").agg(F.slice(ordered, 1, k).alias("top")).select("query_id", F.posexplode("top").alias("at", "hit"))
    return top.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))
