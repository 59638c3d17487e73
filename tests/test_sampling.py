"""Reads from a topic's ends: windows of offsets, the sample message, lag as a table."""

import gzip

from pyspark.sql import functions as F

from logloom.operators.prefilters import PreFunction
from logloom.sources import messages


def test_windows_of_offsets():
    first, last = {"t": {"0": 5, "1": 0, "2": 7}}, {"t": {"0": 100, "1": 3, "2": 7}}
    assert messages.end_windows(first, last, 10) == ({"t": {"0": 90, "1": 0}}, {"t": {"0": 100, "1": 3}})
    assert messages.end_windows(first, last, 10, skip=90) == ({"t": {"0": 5}}, {"t": {"0": 10}})
    assert messages.end_windows(first, last, 10, latest=False) == ({"t": {"0": 5, "1": 0}}, {"t": {"0": 15, "1": 3}})
    assert messages.end_windows(first, last, 10, skip=10, latest=False) == ({"t": {"0": 15}}, {"t": {"0": 25}})
    assert messages.end_windows(first, last, 10, skip=1000) == ({}, {})
    options = messages.window_options(*messages.end_windows(first, last, 10))
    assert options == {"assign": '{"t": [0, 1]}', "startingOffsets": '{"t": {"0": 90, "1": 0}}', "endingOffsets": '{"t": {"0": 100, "1": 3}}'}


def test_sample_reads_ends_only(spark):
    """A topic of 1000 messages a partition: what is read stays within the windows, and the newest that passes is found."""
    topic = spark.range(2000).select((F.col("id") % 2).cast("int").alias("partition"), F.floor(F.col("id") / 2).alias("offset"), F.format_string("message %04d", "id").cast("binary").alias("raw"))
    first, last = {"t": {"0": 0, "1": 0}}, {"t": {"0": 1000, "1": 1000}}
    seen = []

    def read(begins, stops):
        seen.append(sum(stops["t"][p] - begins["t"][p] for p in begins["t"]))
        inside = F.lit(False)
        for p in begins["t"]:
            inside |= (F.col("partition") == int(p)) & F.col("offset").between(begins["t"][p], stops["t"][p] - 1)
        return topic.where(inside)

    match = lambda text: [PreFunction("match", text)]
    assert messages.sample_message(read, first, last, match("message 199[0-9]$")).startswith("message 199") and seen == [32]
    assert messages.sample_message(read, first, last, match("message 19[0-2][0-9]$")).startswith("message 19") and seen == [32, 32, 64]
    assert messages.sample_message(read, first, last, match("none")) is None and seen[3:] == [32, 64, 128, 256]
    assert messages.sample_message(read, first, last, match("message 00"), latest=False).startswith("message 00")
    assert messages.sample_message(read, first, {"t": {"0": 0}}, []) is None
    packed = spark.createDataFrame([(gzip.compress(b'["a message", "another"]'),)], "raw binary")
    functions = [PreFunction("decompress", "auto"), PreFunction("split_json_array"), PreFunction("contains", "another")]
    assert messages.sample_message(lambda *_: packed, first, last, functions) == "another"


def test_lag_as_a_table(spark):
    rows = messages.lag_table(spark, {"t": {"1": 9, "0": 4}}, {"t": {"0": 4}}).collect()
    assert [tuple(r) for r in rows] == [("t", 0, 4, 4, 0), ("t", 1, 9, 0, 9)]
    source = messages.KafkaSource(["h:1"], ["t"], group="g", per_trigger=5)
    assert source.options()["kafka.group.id"] == "g"
