"""Line dedup against levelled, sorted runs of line hashes.

``LineRuns`` keeps the keys of all lines seen so far as runs: Parquet tables bucketed and sorted by a
128-bit hash.  A new batch of documents is anti-joined with every run (sort-merge; the runs' side is
not shuffled, being bucketed by the same keys); what no run holds becomes a run of level 0.  When a level has
``fanout`` runs, they are merged into one run of the next level.  Runs lie in the shared folder.  A batch's line is dropped if a run
holds its key, or if a document of smaller id in the same batch does.  Batches come in ascending order
of doc_id, so the line that stays is the one of the smallest doc_id.

A key that a third of all lines share is aggregated before any shuffle where keys are collected; where
lines meet their keys' first documents, Spark's skew join splits it.

Defined cases: a null or empty text is one empty line; keys below ``min_chars`` code points always stay; all
lines of a document with a repeated key stay if no smaller document has it; rows that repeat a doc_id
are one document to the key rule and each row is returned, with its own lines where their texts differ; a null doc_id counts as the smallest; an empty table
gives no rows; other columns are left out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Tables, drop_path, id_text, materialize, scratch

#: What is stripped from a line's ends, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """Stripped and with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, a hash of the text, and pos of every line whose key is long enough, with the key's hash in h1 and h2."""
    # the hash is made before lines are, else it would be made again for each line
    texts = id_text(docs).select(F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    lines = texts.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keys = lines.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keys.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


class LineRuns:
    """The index of line keys: levels of sorted runs in bucketed tables.  As a context it is dropped at the end."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}

    def __enter__(self) -> LineRuns:
        return self

    def __exit__(self, *_) -> None:
        self.drop()

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = scratch(self.spark, "run")
        dealt = keys.repartition(self.buckets, *KEY).sortWithinPartitions(*KEY)
        dealt.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).format("parquet").option("path", self.paths[name]).saveAsTable(name)
        return name

    def _remove(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_path(self.spark, self.paths.pop(name))

    @property
    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch (columns doc_id, text_hash, pos, h1, h2); the batch's lines to drop (doc_id, text_hash, pos), to be read before
        the next batch comes."""
        fresh = lines.groupBy(*KEY).agg(F.min("doc_id").alias("first_doc"))
        for run in self.runs:
            fresh = fresh.join(self.spark.table(run).select(*KEY).hint("merge"), KEY, "left_anti")
        name = self._write(fresh)
        # read as plain files, not as buckets: Spark can then split a line's many rows in the join
        firsts = self.spark.read.schema(self.spark.table(name).schema).parquet(self.paths[name])
        late = lines.join(firsts.hint("merge"), KEY, "left").where(F.col("first_doc").isNull() | (F.col("first_doc") != F.col("doc_id")))
        self.levels[0].append(name)
        return late.select("doc_id", "text_hash", "pos")

    def compact(self) -> None:
        """Merge the runs of each level that has ``fanout`` of them."""
        for k, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                merged = self.spark.table(level[0])
                for run in level[1:]:
                    merged = merged.unionByName(self.spark.table(run))
                name = self._write(merged)
                for run in level:
                    self._remove(run)
                self.levels[k] = []
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(name)

    def drop(self) -> None:
        for name in list(self.paths):
            self._remove(name)
        self.levels = [[]]


def dropped_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 3) -> DataFrame:
    """doc_id, a hash of the text, and the sorted positions of the lines that each document loses, in ``batches`` ascending ranges of doc_id."""
    spark = docs.sparkSession
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [(k + 1) / batches for k in range(batches - 1)], 10_000)).first()[0] or []
    batch = F.lit(0)
    for cut in sorted(set(cuts)):
        batch = batch + (F.col("doc_id") > cut).cast("int")
    path = scratch(spark, "lines")
    schema = "doc_id long, text_hash long, pos int, h1 long, h2 long, batch int"
    with LineRuns(spark, fanout=fanout) as runs, Tables(spark) as tables:
        try:
            keyed_lines(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").option("compression", "zstd").parquet(path)
            out = None
            for k in range(len(set(cuts)) + 1):
                part = tables.write(runs.add(spark.read.schema(schema).parquet(path).where(F.col("batch") == k).drop("batch")), "dropped-lines")
                out = part if out is None else out.unionByName(part)
                runs.compact()
        finally:
            drop_path(spark, path)
        return materialize(out.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("drop")), "drops")


def _with_drops(docs: DataFrame, drops: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    key = F.coalesce(doc_id.cast("long"), F.lit(-(2**63)))
    keyed = docs.withColumns({"__run_key": key, "__run_text": F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))})
    drops = drops.select(F.col("doc_id").alias("__run_key"), F.col("text_hash").alias("__run_text"), F.col("drop").alias("__run_drop"))
    return keyed.join(drops.hint("merge"), ["__run_key", "__run_text"], "left")


def _kept(text: Column, drop: Column) -> Column:
    """The text without the lines at the positions ``drop``, in time that grows with the lines alone."""
    whole = F.coalesce(text.cast("string"), F.lit(""))

    def rest(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    # as a lambda's variable the lines are split once, not for each that stays
    return F.when(drop.isNull(), whole).otherwise(F.get(F.transform(F.array(F.split(whole, "\n", -1)), rest), 0))


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 3) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped and ``kept``, the text of the lines that stay."""
    rows = _with_drops(id_text(docs), dropped_lines(docs, min_chars, batches, fanout), F.col("doc_id"), F.col("text"))
    return rows.select(
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__run_drop"), F.lit(0)).cast("long").alias("n_dropped"),
        _kept(F.col("text"), F.col("__run_drop")).alias("kept"),
    )


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with all its columns and ``text`` replaced by the lines that stay; rows without a dropped line keep their text as it was,
    the others' n_chars, if there, follows the text."""
    rows = _with_drops(docs, dropped_lines(docs, **options), docs["doc_id"], docs["text"])
    text = F.when(F.col("__run_drop").isNull(), F.col("text")).otherwise(_kept(F.col("text"), F.col("__run_drop")))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("__run_drop").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return rows.select(*docs.columns)
