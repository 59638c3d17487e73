"""Tasks as a table of versions: running streams take up changed rules between two micro-batches, and history is worked through by the rules of its time.

A version is a whole snapshot of all tasks, a folder ``version=<n>`` of Parquet with a row per task, in force once its writer has committed it.  Two
publishers of one version can't both succeed.  Tasks that do not compile are kept with their error and do not run.  Snapshots are read by the driver, which
needs them to make plans: their size is that of the configuration, whatever the data.

A stream notes which version a micro-batch ran with before it runs, so the batch that is run again after a failure has the same rules.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.compile import compile_task
from ..plans.settings import load_task
from .manager import Writer, fan_out

CONFIGS = "id long, data_source_id long, config string"


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Tasks of JSON files, each a task or a list of them; files that are neither, and tasks without a number, are left out."""
    text = F.trim("value", F.lit(" \t\r\n"))
    each = F.when(text.startswith("["), F.from_json(text, "array<string>")).when(text.startswith("{"), F.array(text))
    rows = spark.read.text(path, wholetext=True).select(F.explode(each).alias("config"))
    number = lambda name: F.get_json_object("config", f"$.{name}").try_cast("long")
    return rows.select(number("id").alias("id"), F.coalesce(number("data_source_id"), F.lit(0)).alias("data_source_id"), "config").where("id IS NOT NULL")


def merge_tasks(*sources: DataFrame) -> DataFrame:
    """Tasks of several sources; of equal numbers the first source's counts, within a source the text that comes first."""
    rows = reduce(DataFrame.unionByName, (s.select("id", "data_source_id", "config", F.lit(n).alias("__source")) for n, s in enumerate(sources)))
    first = Window.partitionBy("id").orderBy("__source", "config")
    return rows.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__source", "__nth")


def error_of(config: str) -> str | None:
    """Why a task can't run; null where it can."""
    try:
        compile_task(load_task(config))
    except Exception as e:  # noqa: BLE001
        return f"{type(e).__name__}: {e}"
    return None


@dataclass
class Snapshot:
    """The tasks in force from a time on."""

    version: int
    since: dt.datetime
    configs: list[str]
    errors: dict[int, str] = field(default_factory=dict)

    def plans(self, source: int | None = None, **options) -> list[tuple[int, Callable[[DataFrame], DataFrame]]]:
        tasks = [load_task(c) for c in self.configs]
        return [(t.id, compile_task(t, **options)) for t in sorted(tasks, key=lambda t: t.id) if source is None or t.data_source_id == source]


def rules_as_of(df: DataFrame, at: str, snapshots: list[Snapshot], source: int | None = None, **options) -> DataFrame:
    """Each row through all tasks that were in force at its time, with ``task_id`` and ``version``.

    Rows from before the first snapshot, or without a time, have no rules and give none.  Each version and task reads its own stretch of time, which reaches the scan.
    """
    ordered, parts = sorted(snapshots, key=lambda s: s.version), []
    if any(a.since > b.since for a, b in zip(ordered, ordered[1:])):
        raise ValueError("a later version begins earlier")
    for n, one in enumerate(ordered):
        span = F.col(at) >= F.lit(one.since)
        if n + 1 < len(ordered):
            span &= F.col(at) < F.lit(ordered[n + 1].since)
        for task, plan in one.plans(source, **options):
            parts.append(plan(df.where(span)).withColumns({"task_id": F.lit(task).cast("long"), "version": F.lit(one.version).cast("long")}))
    if not parts:
        none = {"rec": F.expr("cast(map() as map<string,variant>)"), "err": F.lit(None).cast("string"), "task_id": F.lit(None).cast("long"), "version": F.lit(None).cast("long")}
        return df.where("false").withColumns(none)
    return reduce(DataFrame.unionByName, parts)


@dataclass
class TaskTable:
    """The versions below a shared folder."""

    spark: SparkSession
    folder: str

    def __post_init__(self):
        self._files = self.spark._jvm.org.apache.hadoop.fs
        self._fs = self._files.Path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        self._known: dict[int, Snapshot] = {}

    def _numbers(self, below: str, name: str) -> list[int]:
        """Committed folders ``<name>=<n>``."""
        at = self._files.Path(f"{self.folder}/{below}")
        if not self._fs.exists(at):
            return []
        found = [p.getPath() for p in self._fs.listStatus(at) if p.isDirectory() and p.getPath().getName().startswith(f"{name}=")]
        return sorted(int(p.getName().removeprefix(f"{name}=")) for p in found if self._fs.exists(self._files.Path(p, "_SUCCESS")))

    def versions(self) -> list[int]:
        return self._numbers("tasks", "version")

    def snapshot(self, version: int) -> Snapshot:
        """A version; its tasks do not change, so it is read once."""
        if version not in self._known:
            rows = self.spark.read.parquet(f"{self.folder}/tasks/version={version}").collect()
            good = [r.config for r in rows if r.config is not None and r.error is None]
            self._known[version] = Snapshot(version, rows[0].since, good, {r.id: r.error for r in rows if r.error is not None})
        return self._known[version]

    def publish(self, tasks: DataFrame, since: dt.datetime | None = None) -> Snapshot:
        """Make ``tasks`` (``CONFIGS``) the newest version, in force at once or, for work on history, from a time on; tasks equal to the newest version's make none."""
        configs = sorted((r.id, r.config) for r in tasks.select("id", "config").collect())
        if len({i for i, _ in configs}) < len(configs):
            raise ValueError("several tasks of one number: merge them first")
        numbers = self.versions()
        newest = self.snapshot(numbers[-1]) if numbers else None
        since = since or dt.datetime.now(dt.UTC).replace(tzinfo=None)
        if newest and since < newest.since:
            raise ValueError("a later version begins earlier")
        rows = [(i, c, error_of(c), since) for i, c in configs]
        if newest and sorted(newest.configs) == sorted(c for _, c, e, _ in rows if e is None) and newest.errors == {i: e for i, _, e, _ in rows if e is not None}:
            return newest
        version = numbers[-1] + 1 if numbers else 1
        rows = rows or [(None, None, None, since)]  # a version without tasks has its time
        made = self.spark.createDataFrame(rows, "id long, config string, error string, since timestamp_ntz")
        made.coalesce(1).write.mode("errorifexists").parquet(f"{self.folder}/tasks/version={version}")
        return self.snapshot(version)

    def pinned(self, stream: str, batch: int) -> Snapshot | None:
        """The version of a stream's micro-batch: the one noted for it, otherwise the newest, which is noted then; null where there is none yet."""
        notes = f"streams/{stream}"
        at = self._files.Path(f"{self.folder}/{notes}/batch={batch}")
        if batch in self._numbers(notes, "batch"):
            version = self.spark.read.parquet(at.toString()).first().version
            return self.snapshot(version) if version is not None else None
        newest = max(self.versions(), default=None)
        note = self.spark.createDataFrame([(newest,)], "version long")
        note.coalesce(1).write.mode("overwrite").parquet(at.toString())
        for old in [n for n in self._numbers(notes, "batch") if n < batch - 1]:  # Spark runs no batch but the last one again
            self._fs.delete(self._files.Path(f"{self.folder}/{notes}/batch={old}"), True)
        return self.snapshot(newest) if newest is not None else None

    def fan_out(self, stream: str, write: Writer, source: int | None = None, **options) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: each micro-batch through all tasks of its version; plans are made anew where the version changes.  Without a version a batch waits: it fails
        and Spark runs it again, so that no row is passed over."""
        made: dict[int, Callable[[DataFrame, int], None]] = {}

        def run(batch: DataFrame, number: int) -> None:
            now = self.pinned(stream, number)
            if now is None:
                self._fs.delete(self._files.Path(f"{self.folder}/streams/{stream}/batch={number}"), True)
                raise RuntimeError(f"no tasks are published in {self.folder}")
            if now.version not in made:
                tasks = [load_task(c) for c in now.configs]
                made.clear()
                made[now.version] = fan_out([t for t in tasks if source is None or t.data_source_id == source], write, **options)
            made[now.version](batch, number)

        return run


def tasks_frame(spark: SparkSession, configs: list[dict]) -> DataFrame:
    """Tasks of the driver as a table."""
    return spark.createDataFrame([(c["id"], c.get("data_source_id") or 0, json.dumps(c, sort_keys=True)) for c in configs], CONFIGS)

