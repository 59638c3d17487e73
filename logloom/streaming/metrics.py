"""Counts of what happens to log rows, as observed metrics of queries: no pass of their own over the data.

Rows are those of a plan that was compiled with ``statuses=True``: ``ok``, ``filtered``, ``error`` or ``empty_result``.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

STATUSES = ("ok", "filtered", "error", "empty_result")
PREFIX = "log_rows:"


def code(status: Column, err: Column) -> Column:
    """The code of a row: its status, or its error text with underscores."""
    return F.when(status == "error", F.coalesce(F.replace(err, F.lit(" "), F.lit("_")), F.lit("error"))).otherwise(status)


def observe(df: DataFrame, source: str, observation: Observation | None = None) -> DataFrame:
    """``df`` with counts of its statuses observed: by ``observation`` in batches, by a ``Metrics`` listener in streams."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    return df.observe(observation if observation is not None else PREFIX + source, *counts)


def kept(df: DataFrame) -> DataFrame:
    """The rows that go on to the sinks, after they were counted."""
    return df.where("status = 'ok'").drop("status")


class Metrics(StreamingQueryListener):
    """Totals by source and status over all micro-batches; add it with ``spark.streams.addListener``."""

    def __init__(self):
        self.totals: Counter = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            if name.startswith(PREFIX):
                for status in filter(row.__getitem__, STATUSES):
                    self.totals[name.removeprefix(PREFIX), status] += row[status]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def text(self) -> str:
        """The totals in the text format of metric scrapers."""
        def quoted(s: str) -> str:
            return s.replace("\\", "\\\\").replace("\"", "\\\"").replace("\n", "\\n")

        return "".join(f'log_rows_total{{source="{quoted(s)}",code="{quoted(c)}"}} {n}\n' for (s, c), n in sorted(self.totals.items()))
