"""Corpus pipeline: toxic documents go, repeated lines go, one document of each near-duplicate class stays, the rest is packed.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes each result as
Parquet in the shared folder and reads it back as the next stage's documents.  No SQL says the same: ORACLE_SQL is None, and
the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logloom.llm import dart_minhash, line_runs, packing, toxicity_cnn
from logloom.llm.common import bounded_batches, drop_path, scratch, scratch_folder, write_table

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on the table of labels, does not reject."""
    bounded_batches(spark)
    return toxicity_cnn.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that a document of smaller id has."""
    return line_runs.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each class."""
    return dart_minhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each stage's intermediate tables go when its result is written, and that
    goes when its successor's is."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch(spark, name)
        with scratch_folder(spark, name):
            docs = write_table(stage(spark, docs, sf_dir), path)
        if last:
            drop_path(spark, last)
        last = path
    return docs
