"""Shared helpers: the shared work folder, materialised tables and Arrow batching."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handed to one numpy step; also bounded by CHUNK_BYTES of text.
CHUNK_ROWS = 128
CHUNK_BYTES = 1 << 20
#: Bytes of an Arrow batch between the JVM and Python, however long the texts are.
ARROW_BATCH_BYTES = 8 << 20


#: The folder, below the shared one, that new scratch paths go to.
_folder: ContextVar[str] = ContextVar("folder", default="")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A local session without one (as in tests) gets a local folder, once; on a cluster its absence is an error, since
    executors would each write to their own disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="logloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/logloom/{_folder.get()}{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession, name: str):
    """Scratch paths made inside lie in one folder, which is deleted at the end, whether or not the work succeeded."""
    own = f"{_folder.get()}{name}-{uuid.uuid4().hex}/"
    token = _folder.set(own)
    try:
        yield
    finally:
        _folder.reset(token)
        drop_path(spark, f"{shared_dir(spark)}/logloom/{own}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    return write_table(df, scratch(df.sparkSession, name))


def write_table(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables:
    """Intermediate tables of one job; what is not deleted on the way goes at the end of the ``with`` block."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch(self.spark, name)
        self.paths[path] = None
        self.paths[path] = table = write_table(df, path)
        return table

    def drop(self, *tables: DataFrame | None) -> None:
        for path in [p for p, t in self.paths.items() if any(t is x for x in tables if x is not None)]:
            del self.paths[path]
            drop_path(self.spark, path)

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            drop_path(self.spark, path)
        self.paths = {}


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path below the shared folder, whatever its file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches, so that very long texts do not fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns ``doc_id`` and ``text`` with null texts empty; all other columns are left out,
    so extra columns of any name cannot clash."""
    bounded_batches(docs.sparkSession)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slice Arrow batches into pieces of at most CHUNK_ROWS rows and about CHUNK_BYTES bytes."""
    for batch in batches:
        start = 0
        lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
        while start < batch.num_rows:
            stop, total = start, 0
            while stop < batch.num_rows and stop - start < CHUNK_ROWS and (stop == start or total < CHUNK_BYTES):
                total += lengths[stop] or 0
                stop += 1
            yield batch.slice(start, stop - start)
            start = stop


#: Most rows of a table of ids or id pairs that may be broadcast.
SMALL_ROWS = 1_000_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df``, a table of a few numbers a row, marked for broadcast if it has at most ``rows`` rows; else as it is, for a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
