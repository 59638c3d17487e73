"""Periodic runs of words: found by Main and Lorentz's method in what repeated k-grams leave over.

A run is a stretch of words with smallest period q, at least ``max(least, exponent * q)`` words long, that no neighbour
extends.  Its overlap with itself, shifted by q, has at least k words, where k is the smallest such overlap over all q; so
every word of a run lies in a k-gram that the same document holds twice.  Words outside such k-grams are masked; the stretches
between masked words are the only ones searched, and a run never leaves its stretch.

The search halves the stretches again and again.  At each centre and for each period, one comparison left and one right of
the centre finds a pair of equal words, and the common extensions of that pair in both directions give the run.  Extensions come from
names of all stretches of 2^j words (equal names, equal words), so they are exact.  All stretches of a chunk of documents
are searched together, level by level, in numpy; nothing is shuffled, and memory is bounded by a chunk or one document.

Defined cases: a null, empty or blank text has no words and no runs; equal texts have equal runs; repeated rows each get a row; a null doc_id is kept
(and never planted); a document is searched whole, however long; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, id_text

LEAST, EXPONENT = 6, 4
RUN = "struct<start:long,length:long,period:long>"


def gram_length(least: int, exponent: int) -> int:
    """The smallest overlap of a run with itself, shifted by its period."""
    return min(max(least, exponent * q) - q for q in range(1, least + 1))


def names_of(ids: np.ndarray, most: int) -> list[np.ndarray]:
    """Numbers of the stretches of 1, 2, 4 ... words at each place, equal for equal stretches; up to ``most`` words, or until none repeats."""
    names = [ids.astype(np.int64)]
    while (width := 1 << len(names)) <= min(most, len(ids)):
        half, last = width // 2, names[-1]
        pairs = last[: len(ids) - width + 1] * (int(last.max()) + 1) + last[half : half + len(ids) - width + 1]
        found, number = np.unique(pairs, return_inverse=True)
        if len(found) == len(pairs):
            break
        names.append(number)
    return names


def _ahead(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from a on equal those from b on (a < b)."""
    got = np.zeros(len(a), np.int64)
    for j in range(len(names) - 1, -1, -1):
        fits = np.nonzero(b + got < len(names[j]))[0]
        same = fits[names[j][a[fits] + got[fits]] == names[j][b[fits] + got[fits]]]
        got[same] += 1 << j
    return got


def _behind(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from a backwards equal those from b backwards (a < b)."""
    got = np.zeros(len(a), np.int64)
    for j in range(len(names) - 1, -1, -1):
        width = 1 << j
        fits = np.nonzero(a - got - width + 1 >= 0)[0]
        at = -got[fits] - width + 1
        same = fits[names[j][a[fits] + at] == names[j][b[fits] + at]]
        got[same] += width
    return got


def main_lorentz(ids: np.ndarray, longest: int, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start; no stretch of equal words has more than ``longest`` words."""
    n, found = len(ids), []
    names = names_of(ids, longest)
    half = 1
    while half < n:
        centres = np.arange(half, n, 2 * half)
        # one side of the centre holds exponent / 2 periods at least
        periods = np.arange(1, min(2 * half // exponent, longest // exponent) + 1)
        if len(periods):
            c, p = (x.ravel() for x in np.broadcast_arrays(centres[:, None], periods[None, :]))
            for first, second in ((c, c + p), (c - 1 - p, c - 1)):
                inside = np.nonzero((first >= 0) & (second < n))[0]
                equal = inside[ids[first[inside]] == ids[second[inside]]]
                a, b, q = first[equal], second[equal], p[equal]
                start, end = a + 1 - _behind(names, a, b), b + _ahead(names, a, b)
                good = end - start >= np.maximum(least, exponent * q)
                found.append(np.stack([start[good], (end - start)[good], q[good]], axis=1))
        half *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # of one stretch's periods the smallest comes first
    fresh = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)] if len(rows) else np.zeros(0, bool)
    rows = rows[fresh]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def repeated_grams(ids: np.ndarray, owner: np.ndarray, k: int) -> np.ndarray:
    """Which words lie in k-grams that their own document holds more than once."""
    n = len(ids) - k + 1
    covered = np.zeros(len(ids) + 1, np.int64)
    if n <= 0:
        return covered[:-1] > 0
    top = k.bit_length() - 1
    names = names_of(ids, 1 << top)
    if len(names) <= top:  # a shorter gram repeats nowhere
        return covered[:-1] > 0
    name = names[top]
    gram = name[:n] * (int(name.max()) + 1) + name[k - (1 << top) : k - (1 << top) + n]
    whole = owner[:n] == owner[k - 1 :]
    gram = np.unique(gram, return_inverse=True)[1] * (int(owner[-1]) + 1) + owner[:n]
    at = np.nonzero(whole)[0]
    _, number, times = np.unique(gram[at], return_inverse=True, return_counts=True)
    starts = at[times[number] > 1]
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + k, -1)
    return np.cumsum(covered)[:-1] > 0


def runs_in(ids: np.ndarray, owner: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """Rows (start, length, period) of the runs of all documents; ``owner`` numbers each word's document, in order."""
    none = np.zeros((0, 3), np.int64)
    covered = np.nonzero(repeated_grams(ids, owner, gram_length(least, exponent)))[0]
    if not len(covered):
        return none
    opens = np.r_[True, (np.diff(covered) > 1) | (np.diff(owner[covered]) != 0)]
    segment = np.cumsum(opens) - 1
    sizes = np.bincount(segment)
    stays = (sizes >= least)[segment]
    covered, segment = covered[stays], segment[stays]
    if not len(covered):
        return none
    segment = np.unique(segment, return_inverse=True)[1]
    # a word of its own before each stretch: no two stretches join
    place = np.arange(len(covered)) + segment + 1
    joined = int(ids.max()) + 1 + np.arange(len(covered) + int(segment[-1]) + 1)
    joined[place] = ids[covered]
    joined = np.unique(joined, return_inverse=True)[1]
    back = np.full(len(joined), -1, np.int64)
    back[place] = covered
    rows = main_lorentz(joined, int(np.bincount(segment).max()), least, exponent)
    rows[:, 0] = back[rows[:, 0]]
    return rows


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """A tenth of the documents, chosen by crc32 of their id, with a periodic tail made of their own words."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * -(-(n - a) // p))[: n - a]


def _collapse(batch: pa.RecordBatch, least: int, exponent: int, plant: bool) -> pa.RecordBatch:
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids, words = batch.column(0).to_pylist(), [t.split() for t in batch.column(1).cast(pa.binary()).to_pylist()]  # bytes split at exactly these blanks
    if plant:
        words = [planted(w, i) for i, w in zip(ids, words, strict=True)]
    sizes = np.array([len(w) for w in words], np.int64)
    first = np.cumsum(sizes) - sizes
    flat = np.fromiter((numbers[w] for own in words for w in own), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(words)), sizes)
    rows = runs_in(flat, owner, least, exponent) if len(flat) else np.zeros((0, 3), np.int64)
    gone = np.zeros(len(flat) + 1, np.int64)
    np.add.at(gone, rows[:, 0] + rows[:, 2], 1)
    np.add.at(gone, rows[:, 0] + rows[:, 1], -1)
    stays = np.cumsum(gone)[:-1] == 0
    holder = owner[rows[:, 0]] if len(rows) else np.zeros(0, np.int64)
    each = np.bincount(holder, minlength=len(words))
    kept = [b" ".join(compress(w, stays[s : s + n].tolist()) if runs else w) for w, s, n, runs in zip(words, first.tolist(), sizes.tolist(), each.tolist(), strict=True)]
    struct = pa.StructArray.from_arrays([pa.array(rows[:, 0] - first[holder]), pa.array(rows[:, 1]), pa.array(rows[:, 2])], names=["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(each)].astype(np.int32)), struct)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), lists, pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def word_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT, plant: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, ``runs`` (start, length and period, by start and period) and ``collapsed``, the words less those after the first period of a run.

    ``plant`` first gives a tenth of the documents periodic tails, for measurements.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks([batch]):
                yield _collapse(chunk, least, exponent, plant)

    return id_text(docs).mapInArrow(find, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of greatest length over period, compared exactly; of equal ones the first; null without runs."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, r: F.when(better(best, r), r).otherwise(best))


def digests(found: DataFrame) -> DataFrame:
    """The rows of ``word_runs`` with counts, the strongest run and digests in place of lists and texts."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), strongest(F.col("runs")).alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    best = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    return rows.select("doc_id", "n_words", "n_runs", *best, F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
