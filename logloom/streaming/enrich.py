"""Enrichment by a dictionary that arrives on the same stream as the data."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEPT_SECONDS, TRIES = 24 * 3600, 3
ENRICHED = "agent_hostname string, ref string, ts timestamp, data string, account_id string"


def enrich_batch(events: DataFrame) -> DataFrame:
    """Data rows of complete input with the last identity of their (host, ref); null where none came.

    ``events``: kind (dict or data), agent_hostname, ref, account_id, ts, data.  Identities are aggregated before the join, so a key that
    many dictionary rows repeat is one row there.
    """
    known = events.where("kind = 'dict'").groupBy("agent_hostname", "ref").agg(F.max_by("account_id", F.struct("ts", "account_id")).alias("account_id"))
    rows = events.where("kind = 'data'").select("agent_hostname", "ref", "ts", "data")
    return rows.join(known, ["agent_hostname", "ref"], "left")


class Enricher(StatefulProcessor):
    """The same per key: the identity in a state that expires; data rows without one wait for a few timers and then go out as they are."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", T.StructType([T.StructField("account_id", T.StringType())]), KEPT_SECONDS * 1000)
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("millis", T.LongType()), T.StructField("data", T.StringType()), T.StructField("tries", T.IntegerType())]))

    def _frame(self, key, rows) -> pd.DataFrame:
        out = [(key[0], key[1], pd.Timestamp(m, unit="ms"), d, a) for m, d, a in rows]
        return pd.DataFrame(out, columns=[c.split()[0] for c in ENRICHED.split(", ")])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows), ignore_index=True).sort_values("ts")
        names = events[events["kind"] == "dict"]["account_id"]
        if len(names):
            self.known.update((names.iloc[-1],))
        account = self.known.get()[0] if self.known.exists() else None
        fresh = [(t.value // 1_000_000, d, 0) for t, d, k in zip(events["ts"], events["data"], events["kind"], strict=True) if k == "data"]
        waiting = [tuple(w) for w in self.waiting.get()]
        if account is not None:
            self.waiting.clear()
            yield self._frame(key, [(m, d, account) for m, d, _ in waiting + fresh])
        elif fresh:
            self.waiting.put(waiting + fresh)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 5000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = [(m, d, n + 1) for m, d, n in self.waiting.get()]
        gone, left = [r for r in rows if r[2] > TRIES], [r for r in rows if r[2] <= TRIES]
        if left:
            self.waiting.put(left)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 5000)
        else:
            self.waiting.clear()
        yield self._frame(key, [(m, d, None) for m, d, _ in gone])

    def close(self) -> None:
        pass


def enrich_stream(events: DataFrame) -> DataFrame:
    """The stream of enriched data rows; needs the RocksDB state store."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return events.groupBy("agent_hostname", "ref").transformWithStateInPandas(Enricher(), ENRICHED, "append", "ProcessingTime")
