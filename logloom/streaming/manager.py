"""Running tasks: fan-out of one stream to all of its tasks, and restart where a task's configuration changed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.compile import compile_task
from ..plans.settings import Task, load_task

Writer = Callable[[DataFrame, Task, int], None]


def fan_out(tasks: list[Task], write: Writer, **options) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: each micro-batch, kept once, goes through every task; one failing task does not stop the others' output."""
    plans = [(t, compile_task(t, **options)) for t in tasks]

    def run(batch: DataFrame, number: int) -> None:
        batch.persist()
        errors = []
        try:
            for task, plan in plans:
                try:
                    write(plan(batch), task, number)
                except Exception as e:  # noqa: BLE001
                    errors.append((task.id, e))
        finally:
            batch.unpersist()
        if errors:
            raise RuntimeError(f"tasks failed: {[i for i, _ in errors]}") from errors[0][1]

    return run


@dataclass
class Manager:
    """One query per data source; ``start`` makes the query of a source's tasks on that source's checkpoint.

    ``hot``: the queries read their tasks from a table of versions (``tasks.TaskTable``) and are restarted only where what they read changes: the source's settings
    or its topics.  Queries that have ended by themselves are started again.
    """

    start: Callable[[int, list[Task]], StreamingQuery]
    running: dict[int, tuple[str, StreamingQuery]] = field(default_factory=dict)
    hot: bool = False

    def _mark(self, own: list[dict], source: dict | None) -> str:
        own = sorted(own, key=lambda c: c["id"])
        what = sorted(json.dumps(c.get("topics") or {}, sort_keys=True) for c in own) if self.hot else own
        return hashlib.sha256(json.dumps([sorted(set(what)) if self.hot else what, source], sort_keys=True).encode()).hexdigest()

    def reconcile(self, configs: list[dict], sources: dict[int, dict] | None = None) -> dict[str, list[int]]:
        """Start, restart and stop queries until they are what the tasks, and the settings of their sources, say."""
        wanted: dict[int, list[dict]] = {}
        for c in configs:
            wanted.setdefault(c["data_source_id"], []).append(c)
        did = {"started": [], "restarted": [], "stopped": []}
        for source in [s for s in self.running if s not in wanted]:
            self.running.pop(source)[1].stop()
            did["stopped"].append(source)
        for source, own in wanted.items():
            mark = self._mark(own, (sources or {}).get(source))
            old = self.running.get(source)
            if old and old[0] == mark and getattr(old[1], "isActive", True):
                continue
            if old:
                old[1].stop()
            self.running[source] = (mark, self.start(source, [load_task(c) for c in own]))
            did["restarted" if old else "started"].append(source)
        return did
