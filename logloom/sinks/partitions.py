"""Time-partitioned names and their retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.settings import SUFFIXES, seconds

# Seconds of a step and how many steps back a clean-up looks, by suffix.
STEPS = {"hourly": (3600, 168), "daily": (86400, 24), "weekly": (7 * 86400, 10), "monthly": (30 * 86400, 6), "quarterly": (90 * 86400, 4)}


def partition_name(stem: str, at: Column, suffix: str, zone: str = "UTC") -> Column:
    """The lower-case name of an event's partition; a missing time counts as now, an unknown suffix as daily."""
    if suffix == "none":
        return F.lit(stem.lower())
    at = F.coalesce(at, F.current_timestamp())
    local = at if zone == "UTC" else F.from_utc_timestamp(at, zone)
    if suffix == "weekly":
        monday_first = F.weekday(local) + 1
        tail = F.concat(F.date_format(local, "yyyy-MM"), F.lit("-w"), (F.floor((F.day(local) - monday_first) / 7) + F.when(F.day(local) < monday_first, 2).otherwise(1)).cast("string"))
    elif suffix == "quarterly":
        tail = F.concat(F.date_format(local, "yyyy"), F.lit("-q"), F.quarter(local).cast("string"))
    else:
        tail = F.date_format(local, {"hourly": "yyyyMMddHH", "monthly": "yyyyMM"}.get(suffix, "yyyyMMdd"))
    return F.lower(F.concat(F.lit(f"{stem}_"), tail))


def name_at(stem: str, at: dt.datetime, suffix: str) -> str:
    """The same name for one time."""
    if suffix == "none":
        return stem.lower()
    if suffix == "weekly":
        tail = f"{at:%Y-%m}-w{int((at.day - at.isoweekday()) / 7) + 1}"
    elif suffix == "quarterly":
        tail = f"{at:%Y}-q{(at.month + 2) // 3}"
    else:
        tail = at.strftime({"hourly": "%Y%m%d%H", "monthly": "%Y%m"}.get(suffix, "%Y%m%d"))
    return f"{stem}_{tail}".lower()


def expired(stem: str, suffix: str, retention: str, names: list[str], now: dt.datetime) -> list[str]:
    """Names to delete: those of the steps before ``now`` less the retention that are there; a retention of 0 keeps all."""
    if suffix not in SUFFIXES or suffix == "none":
        return []
    keep = seconds(retention)
    if keep <= 0:
        return []
    step, back = STEPS[suffix]
    there = {n for n in names if n.startswith(f"{stem}_")}
    base = now - dt.timedelta(seconds=keep)
    return sorted({n for i in range(1, back) if (n := name_at(stem, base - dt.timedelta(seconds=step * i), suffix)) in there})


def write_partitioned(df: DataFrame, folder: str, stem: str, time_column: str, suffix: str, format: str = "parquet", mode: str = "append") -> None:
    """Append rows to the folder, one partition per name."""
    named = df.withColumn("partition_name", partition_name(stem, F.col(time_column), suffix))
    named.repartition("partition_name", F.pmod(F.hash(*df.columns[:1]), F.lit(16))).write.mode(mode).partitionBy("partition_name").format(format).save(folder)


def drop_expired(spark, folder: str, stem: str, suffix: str, retention: str, now: dt.datetime) -> list[str]:
    """Delete expired partitions of a folder; the names that went."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {p.getPath().getName().removeprefix("partition_name="): p.getPath() for p in fs.listStatus(hadoop) if p.isDirectory()}
    gone = expired(stem, suffix, retention, list(found), now)
    for name in gone:
        fs.delete(found[name], True)
    return gone
