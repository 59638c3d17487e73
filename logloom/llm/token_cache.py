"""Token counts with a digest cache.

``count_tokens`` keys every text by the SHA-256 of its normalised content (null is empty; these
vocabularies count every other character, so no more is normalised) and by a digest of the tokenizer's
file and options.  Digests are aggregated before texts are shuffled, so a text that a third of all
rows share travels once per map task.  Digests that the cache holds are joined; only distinct misses
are encoded; their counts are appended to the cache, a Parquet folder partitioned by version.

Defined cases: null and empty texts count 0 tokens; repeated rows each get a row; rows appended twice
to the cache (by concurrent runs) count once; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, materialize, scratch
from .tokens import encoder


def tokenizer_version(name: str) -> str:
    """Digest of the vocabulary file and of the way it is used."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return hashlib.sha256(f.read() + b"add_special_tokens=False").hexdigest()


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def cached_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """digest and n_tokens of this version, one row per digest."""
    path = f"{cache}/version={version}"
    if not _exists(spark, path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return spark.read.schema("digest binary, n_tokens long").parquet(path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _digests(docs: DataFrame) -> DataFrame:
    return id_text(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))


def fill_cache(docs: DataFrame, cache: str, tokenizer: str) -> None:
    """Encode the distinct texts that the cache lacks and append their counts."""

    def count(batches):
        ids = encoder(tokenizer).ids
        for batch in batches:
            lengths = [len(ids(t)) // 4 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], names=["digest", "n_tokens"])

    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    distinct = _digests(docs).groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(cached_counts(spark, cache, version), "digest", "left_anti")
    misses.select("digest", "text").mapInArrow(count, "digest binary, n_tokens long").write.mode("append").parquet(f"{cache}/version={version}")


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024, cache: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row.

    ``cache`` is a folder that lives on between runs; by default a new one in the shared folder.
    """
    spark = docs.sparkSession
    cache = cache or scratch(spark, "token-cache")
    fill_cache(docs, cache, tokenizer)
    # a table of its own: Spark can then split a text's many rows in the join
    counts = materialize(cached_counts(spark, cache, tokenizer_version(tokenizer)), "counts")
    rows = _digests(docs).select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    joined = rows.join(counts, "digest", "left")
    return joined.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
