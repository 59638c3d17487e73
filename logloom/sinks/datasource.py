"""The bulk sinks as a Spark data source, for tables and for streams: ``df.write.format("log_bulk")``, ``stream.writeStream.format("log_bulk")``.

Each task sends its rows and gives a commit message with what it sent and what servers refused for good.  A task that can't deliver ends with an error: Spark
runs it again, and if that does not help the batch is aborted and stays uncommitted, so that the query, once restarted on its checkpoint, sends it again.  The
driver gets one message a task, never documents.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from importlib import import_module

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from . import bulk

FORMAT = "log_bulk"
KINDS = {"elastic": bulk.ElasticSink, "doris": bulk.DorisSink, "victoria": bulk.VictoriaSink}
log = logging.getLogger("logloom.sinks")


class TooManyRefused(RuntimeError):
    """Servers refused more documents of a batch for good than the settings allow."""


@dataclass
class Delivered(WriterCommitMessage):
    """What a task sent, and what of it was refused for good."""

    sent: int
    refused: int


def _transport(name: str) -> bulk.Transport:
    if not name:
        return bulk.http_transport
    module, _, function = name.partition(":")
    return getattr(import_module(module), function)


class _Writing:
    """What both writers do."""

    def __init__(self, options: dict[str, str]):
        given = json.loads(options["sink"])
        self.kind, self.settings = given.pop("kind"), given
        self.transport = options.get("transport", "")
        self.most_refused = int(options["most_refused"]) if options.get("most_refused") else None

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Delivered:
        sink, transport = KINDS[self.kind](**self.settings), _transport(self.transport)
        sent = refused = 0
        rows = (row for batch in iterator for row in batch.to_pylist())
        for part in bulk.batches(rows, sink.most, sink.most_bytes):
            refused += sink.send(part, transport)
            sent += len(part)
        return Delivered(sent, refused)

    def done(self, messages: list, batch: str) -> None:
        sent, refused = (sum(getattr(m, c) for m in messages if m is not None) for c in ("sent", "refused"))
        log.info("%s: %d documents sent, %d of them refused", batch, sent, refused)
        if self.most_refused is not None and refused > self.most_refused:
            raise TooManyRefused(f"{refused} of {sent} documents were refused")

    def given_up(self, messages: list, batch: str) -> None:
        log.warning("%s: given up after %d tasks had delivered; it will be sent again", batch, sum(m is not None for m in messages))


class _TableWriter(_Writing, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self.done(messages, "table")

    def abort(self, messages: list) -> None:
        self.given_up(messages, "table")


class _StreamWriter(_Writing, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.done(messages, f"batch {batchId}")

    def abort(self, messages: list, batchId: int) -> None:
        self.given_up(messages, f"batch {batchId}")


class BulkSource(DataSource):
    """Options: ``sink`` (JSON: its kind and settings), ``transport`` (module:function, HTTP by default), ``most_refused`` (of a batch, any number by default)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> _TableWriter:
        return _TableWriter(dict(self.options))

    def streamWriter(self, schema: StructType, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(dict(self.options))


def options(sink: bulk.Sink, transport: str = "", most_refused: int | None = None) -> dict[str, str]:
    """The data source's options of a sink."""
    kind = next(k for k, c in KINDS.items() if isinstance(sink, c))
    return {"sink": json.dumps({"kind": kind, **asdict(sink)}), "transport": transport, "most_refused": "" if most_refused is None else str(most_refused)}


def rows(df: DataFrame, target: str, body: str, document_id: str = "") -> DataFrame:
    """The columns that the sinks read."""
    ids = [df[document_id].cast("string").alias("id")] if document_id else []
    return df.select(df[target].cast("string").alias("target"), df[body].cast("string").alias("body"), *ids)


def save(df: DataFrame, sink: bulk.Sink, target: str, body: str, document_id: str = "", **more) -> None:
    """Send a table's documents; returns when all are delivered, else raises."""
    register(df.sparkSession)
    rows(df, target, body, document_id).write.format(FORMAT).options(**options(sink, **more)).mode("append").save()


def stream_to(df: DataFrame, sink: bulk.Sink, target: str, body: str, document_id: str = "", **more) -> DataStreamWriter:
    """A stream's writer, to be given a checkpoint and started."""
    register(df.sparkSession)
    return rows(df, target, body, document_id).writeStream.format(FORMAT).options(**options(sink, **more))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BulkSource)
