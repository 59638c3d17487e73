"""Word runs, clusters and shards against plain versions of what they return."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logloom.llm import minimax_shards as shards
from logloom.llm import partial_distance as clusters
from logloom.llm import queries, word_runs

from ..oracle import same
from .conftest import SF


def plain_runs(words):
    """(start, length, period) of all runs: for each period, the stretches of words that equal those a period on."""
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found, n = {}, len(ids)
    for q in range(1, n // 4 + 1):
        same_ = np.r_[False, ids[q:] == ids[:-q], False]
        edges = np.nonzero(np.diff(same_.astype(int)))[0]
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a + q >= max(6, 4 * q):
                found.setdefault((a, b - a + q), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]


def plain_row(doc_id, text):
    words = plain_planted(doc_id, [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w])
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *best, best[1] * 1000 // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def row(r):
    return (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)


def test_runs_of_the_whole_table(spark, all_texts):
    got = {r.doc_id: row(r) for r in queries.op11_word_runs(spark, SF).collect()}
    assert got == {i: plain_row(i, t) for i, t in all_texts.items()}
    assert sum(r[0] > 0 for r in got.values()) > 50


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), min_size=1, max_size=4), st.integers(1, 9), st.integers(0, 40))
def test_runs_of_any_words(documents, period, times):
    documents = [[*d, *(d[:period] * times)] for d in documents]
    flat = [w for d in documents for w in d]
    number = {w: k for k, w in enumerate("abc")}
    owner = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
    rows = word_runs.runs_in(np.array([number[w] for w in flat], np.int64), owner, 6, 4) if flat else []
    want, at = [], 0
    for d in documents:
        want += [(s + at, length, q) for s, length, q in plain_runs(d)]
        at += len(d)
    assert [tuple(r) for r in np.asarray(rows).tolist()] == want


def test_masking_needs_repeated_grams():
    assert word_runs.gram_length(6, 4) == 5 and word_runs.gram_length(12, 4) == 9
    ids = np.array([1, 2, 3, 4, 5, 9, 1, 2, 3, 4, 5, 7, 8])
    one = word_runs.repeated_grams(ids, np.zeros(13, np.int64), 5)
    assert one.tolist() == [True] * 5 + [False] + [True] * 5 + [False] * 2
    assert not word_runs.repeated_grams(ids, np.r_[np.zeros(6, np.int64), np.ones(7, np.int64)], 5).any()


def test_runs_of_own_texts(spark, own, none):
    long = "a b c " * 50_000 + "end"
    more = [(20, long, ""), (20, "x x x x x x", ""), (None, "y y " * 6, ""), (21, " \t\n", "")]
    docs = own.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string")).withColumnRenamed("lang", "runs")
    got = sorted((r.doc_id or -1, r.n_words, [tuple(x) for x in r.runs]) for r in word_runs.word_runs(docs).collect())
    assert [g for g in got if g[0] in (-1, 20, 21)] == [(-1, 6, [(0, 6, 1)]), (20, 6, [(0, 6, 1)]), (20, 150_001, [(0, 150_000, 3)]), (21, 0, [])]
    assert len(got) == own.count() + 4 and word_runs.digests(word_runs.word_runs(none)).count() == 0


def plain_clusters(rows, centroids=16, rounds=3):
    kept = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1].tolist()))[:centroids]
    centres, v = np.array([c for _, c in first]), np.array([c for _, c in kept])
    for k in range(rounds + 1):
        distances = ((v[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
        own = distances.argmin(axis=1)
        for c in range(len(centres)) if k < rounds else []:
            if (own == c).any():
                centres[c] = [int(s) // int((own == c).sum()) for s in v[own == c].sum(axis=0)]
    least = distances.min(axis=1)
    sha = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centres]
    return sorted((i, int(c), int(d), int(least[own == c].sum()), int(least.sum()), sha[c]) for (i, _), c, d in zip(kept, own, least, strict=True))


def shown(df):
    return sorted((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_clusters_of_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert shown(queries.op12_partial_distance(spark, SF)) == plain_clusters(rows)
    same(queries.op12_partial_distance, queries.ORACLE_SQL["op12_partial_distance"], spark, SF)


def test_clusters_of_own_vectors(spark):
    r = random.Random(5)
    some = [(k, [r.choice([-1.5, 0.0, 0.25, 1e5]) if d < 3 else 0.0 for d in range(64)]) for k in range(40)]
    bad = [(50, None), (51, [0.0] * 63), (52, [0.0] * 63 + [None]), (53, [float("nan")] * 64), (54, [float("inf")] * 64), (55, [])]
    rows = some + some[:5] + bad + [(60, [0.0] * 64)] * 9
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, v string")
    assert shown(clusters.cluster_rows(df)) == plain_clusters(rows)
    assert clusters.cluster_rows(df.limit(0)).count() == 0
    few = df.where("vec_id < 3").dropDuplicates(["vec_id"])
    assert {x.cluster for x in clusters.cluster_rows(few).collect()} <= {0, 1, 2}
    huge = spark.createDataFrame([(1, [1e30] * 64), (2, [1.0] * 64), (None, [2.0] * 64)], "vec_id long, embedding array<float>")
    assert sorted((x.vec_id or 0, x.cluster) for x in clusters.cluster_rows(huge).collect()) == [(0, 1), (2, 0)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 9), st.integers(1, 20))
def test_partial_distances_are_exact(seed, rows, centroids, spread):
    r = np.random.default_rng(seed)
    v, c = r.integers(-spread, spread, (rows, 64)), r.integers(-spread, spread, (centroids, 64))
    c[-1] = c[0]
    whole = ((v[:, None] - c[None]) ** 2).sum(axis=2)
    best, distance = clusters.nearest(v, c, r.permutation(64))
    assert best.tolist() == whole.argmin(axis=1).tolist() and distance.tolist() == whole.min(axis=1).tolist()


def least_of_all(sizes, count):
    """The smallest fullest shard over all ways to cut, by dynamic programming."""
    ends = np.r_[0, np.cumsum(sizes)]
    best = [0] + [10**18] * len(sizes)
    for _ in range(count):
        best = [min([best[k]] + [max(best[j], int(ends[k] - ends[j])) for j in range(k)]) for k in range(len(sizes) + 1)]
    return best[-1]


def check_shards(rows, texts, count):
    held = defaultdict(list)
    for r in rows:
        raw = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        held[r.shard].append(r)
    assert all(sorted(x.slot for x in own) == list(range(len(own))) for own in held.values()) and set(held) <= set(range(count))
    homes = {}
    for r in rows:
        assert homes.setdefault(r.text or "", r.shard) == r.shard
    groups = Counter()
    for t in texts:
        groups[t or ""] += len((t or "").encode()) + 8
    alone = []
    rest = sorted(groups.values(), reverse=True)
    while len(alone) < count - 1 and rest and rest[0] * (count - len(alone)) > sum(rest):
        alone.append(rest.pop(0))
    few = sorted((hashlib.sha256(t.encode()).digest(), n) for t, n in groups.items())
    large = sorted(((-n, d) for d, n in few))[: len(alone)]
    order = [n for d, n in few if (-n, d) not in large]
    sizes = {k: sum(x.size for x in own) for k, own in held.items()}
    assert [sizes.get(k, 0) for k in range(len(alone))] == alone
    assert max([v for k, v in sizes.items() if k >= len(alone)], default=0) == least_of_all(order, count - len(alone))
    return sizes


def with_texts(spark, docs, **options):
    made = shards.shards_by_bytes(docs, **options)
    return made.join(docs.select("doc_id", "text").dropDuplicates(["doc_id"]), "doc_id").collect()


def test_shards_of_the_whole_table(spark, documents, all_texts):
    rows = with_texts(spark, documents)
    assert sorted(r.doc_id for r in rows) == sorted(all_texts)
    sizes = check_shards(rows, all_texts.values(), 24)
    assert min(sizes.values()) > 0.85 * max(sizes.values())


@pytest.mark.parametrize("first, more, groups", [(2, 1, 5), (1, 3, 0), (12, 7, 100_000)])
def test_shards_with_coarse_buckets(spark, monkeypatch, first, more, groups):
    """Buckets that are split again and again give the cuts of all groups at once."""
    r = random.Random(7)
    texts = ["x" * r.choice([1, 5, 50, 300]) + str(r.randrange(70)) for _ in range(120)] + ["hot" * 40] * 60 + [None, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for name, value in (("FIRST_BITS", first), ("MORE_BITS", more), ("GROUPS", groups)):
        monkeypatch.setattr(shards, name, value)
    for count in (1, 5, 24):
        rows = with_texts(spark, docs, shards=count)
        assert len(rows) == len(texts)
        check_shards(rows, texts, count)


def test_shards_of_own_texts(spark, own, none, texts):
    docs = own.withColumnRenamed("class", "shard").withColumnRenamed("key", "digest")
    check_shards(with_texts(spark, docs), texts.values(), 24)
    assert shards.shards_by_bytes(none).count() == 0
    odd = spark.createDataFrame([(None, "a"), (None, "a"), (3, "a"), (3, "b")], "doc_id long, text string")
    assert sorted((r.shard, r.slot, r.doc_id or 0) for r in shards.shards_by_bytes(odd, shards=1).collect()) in ([(0, 0, 0), (0, 1, 0), (0, 2, 3), (0, 3, 3)], [(0, 0, 3), (0, 1, 0), (0, 2, 0), (0, 3, 3)])
