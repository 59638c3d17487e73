"""Scans that come in fewer partitions than there are cores.

A Parquet file with one row group is read by one task, and so are decoding and parsing, which cost far more than the read.  Dealing its rows out is one
shuffle of the columns in use; tables of many row groups have partitions enough and keep the plan they have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def dealt(scan: DataFrame) -> DataFrame:
    """A scan (no shuffle before it) with its rows dealt evenly over all cores where it has fewer partitions than these; streams stay as they are.

    No row changes; only the order of rows does.
    """
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
