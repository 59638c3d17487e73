"""Request and response correlation, as a join over tables and as keyed state over streams.

A response belongs to the last request of the same key (request number and host) before it, if that is no older than ``window`` seconds.  A request
is consumed by its first response whose function number is not one of those that are answered many times.  Responses without a request wait
for ``patience`` seconds of event time; then they are discarded or, with ``lone``, go out with nulls for their request.  Streams may bound how many
wait at a time: keys are then dealt to buckets, each with its share of places, and responses that find none go out at once as refused.

Events need the columns of ``COLUMNS``; those of ``OPTIONAL`` may be absent, null or empty.  Events with a null in their key or date find no partner.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

#: Functions whose requests have many responses, the function whose account may stand in its request's table, and names a table can't set.
ANSWERED_OFTEN = ("111", "112", "113")
ACCOUNT_FUNCTION, ACCOUNT_FIELD = "28017", "account_content"
RESERVED = ("date", "agent_hostname", "req_no", "func_no", "type", "tag", "data", "fund_account", "error_no", "error_info")

WINDOW_SECONDS, PATIENCE_SECONDS = 3600, 300
COLUMNS = "type string, agent_hostname string, req_no string, func_no string, date timestamp, data string"
OPTIONAL = "fund_account string, error_no string, error_info string, tag string"
PAIRED = (
    "agent_hostname string, req_no string, func_no string, request_time timestamp, response_time timestamp, elapsed_ms long, fund_account string, "
    "error_no string, error_info string, request_tag string, request_data string, response_tag string, response_data string"
)
MERGED = f"{PAIRED}, fields map<string,string>"


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def completed(events: DataFrame) -> DataFrame:
    """The columns of an event and no others; optional ones are null where they are absent."""
    return events.select(*names(COLUMNS), *(F.col(c) if c in events.columns else F.lit(None).cast("string").alias(c) for c in names(OPTIONAL)))


def filled(c: Column) -> Column:
    return F.when(c != "", c)


def paired(request: str, response: str) -> list[Column]:
    """The columns of a pair, from struct columns; the request's account goes before the response's."""
    r, s = F.col(request), F.col(response)
    made = {
        "agent_hostname": s["agent_hostname"], "req_no": s["req_no"], "func_no": s["func_no"], "request_time": r["date"], "response_time": s["date"],
        "elapsed_ms": F.unix_millis(s["date"]) - F.unix_millis(r["date"]), "fund_account": F.coalesce(filled(r["fund_account"]), filled(s["fund_account"])),
        "error_no": s["error_no"], "error_info": s["error_info"], "request_tag": r["tag"], "request_data": r["data"], "response_tag": s["tag"], "response_data": s["data"],
    }
    return [made[c].alias(c) for c in names(PAIRED)]


def merged(pairs: DataFrame, *keep: str) -> DataFrame:
    """Pairs, and columns to keep, with the fields of the request's table: names in its first line, where one line of values follows.

    Reserved names, empty names and names that stand twice are left out; a missing value is empty.  Tables of several lines give no fields.
    An account that neither side names is taken from the table for one function.
    """
    df = pairs.withColumn("__lines", F.split("request_data", "\n", -1))
    df = df.withColumn("__rows", F.filter(F.slice("__lines", F.lit(2), F.greatest(F.size("__lines") - 1, F.lit(0))), lambda x: x != ""))
    keys = F.transform(F.split(F.get("__lines", F.lit(0)), r"\|", -1), lambda k, i: F.struct(k.alias("key"), i.alias("at")))
    df = df.withColumns({"__cells": F.split(F.get("__rows", F.lit(0)), r"\|", -1), "__keys": F.array_sort(keys)})

    def other(e: Column, at: Column) -> Column:
        return F.coalesce(F.get("__keys", at)["key"] != e["key"], F.lit(True))

    lone = F.filter("__keys", lambda e, i: (e["key"] != "") & ~e["key"].isin(*RESERVED) & other(e, i - 1) & other(e, i + 1))
    table = F.map_from_entries(F.transform(lone, lambda e: F.struct(e["key"], F.coalesce(F.get("__cells", e["at"]), F.lit("")).alias("value"))))
    df = df.withColumn("fields", F.when(F.size("__rows") == 1, table).otherwise(F.create_map().cast("map<string,string>")))
    named = F.when(F.col("func_no") == ACCOUNT_FUNCTION, filled(F.try_element_at("fields", F.lit(ACCOUNT_FIELD))))
    changed = {"fund_account": F.coalesce("fund_account", named), "error_no": F.coalesce("error_no", F.lit("")), "error_info": filled(F.col("error_info"))}
    return df.select(*(changed.get(c, F.col(c)).alias(c) for c in names(PAIRED)), "fields", *keep)


def correlate_batch(events: DataFrame, window: int = WINDOW_SECONDS, lone: bool = False) -> DataFrame:
    """Merged documents of complete input; ``lone``: those of responses without a request, too.

    Time is cut into stretches of a window's length, and a request counts in its own and the next one, where all its responses are: a key
    with very many events is then spread over as many groups as it has stretches.
    """
    key = ["agent_hostname", "req_no"]
    own = completed(events).where("date IS NOT NULL AND agent_hostname IS NOT NULL AND req_no IS NOT NULL")
    asks = F.col("type") == "request"
    stretch = F.floor(F.unix_seconds("date") / max(window, 1)).cast("long")
    rows = own.select(F.struct(*own.columns).alias("event"), *key, "date", "data", asks.alias("asks"), (F.col("type") == "response").alias("answers"), F.explode(F.when(asks, F.array(stretch, stretch + 1)).otherwise(F.array(stretch))).alias("stretch"))
    order = Window.partitionBy(*key, "stretch").orderBy("date", F.when(F.col("asks"), 0).otherwise(1), "data").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answers = rows.withColumn("request", F.last(F.when(F.col("asks"), F.col("event")), ignorenulls=True).over(order)).where("answers")
    near = F.unix_millis("date") - F.unix_millis(F.col("request.date")) <= window * 1000
    answers = answers.withColumn("request", F.when(near, F.col("request")))
    answers = answers if lone else answers.where("request IS NOT NULL")
    consumes = F.when(F.coalesce(F.col("event.func_no").isin(*ANSWERED_OFTEN), F.lit(False)), 0).otherwise(1)
    # a hash stands for the request, so that rows are not sorted by its text; lone responses are groups of their own
    answers = answers.withColumn("mark", F.xxhash64(F.coalesce("request", "event"))).withColumn("since", F.col("request.date"))
    before = Window.partitionBy(*key, "since", "mark").orderBy("date", "data").rowsBetween(Window.unboundedPreceding, -1)
    free = F.coalesce(F.sum(consumes).over(before), F.lit(0)) == 0
    answers = answers.withColumn("free", free & F.col("request").isNotNull())
    answers = answers.withColumn("request", F.when(F.col("free"), F.col("request"))) if lone else answers.where("free")
    return merged(answers.select(*paired("request", "event")))


def _state(schema: str) -> T.StructType:
    kinds = {"string": T.StringType(), "long": T.LongType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])


REQUEST = "millis long, fund_account string, tag string, data string"
RESPONSE = "millis long, func_no string, fund_account string, error_no string, error_info string, tag string, data string"


Event = tuple[int, int, str, dict]


def new_events(rows: Iterator[pd.DataFrame]) -> list[Event]:
    """Requests and responses with a date as (milliseconds, whether it answers, data, texts)."""
    out = []
    for frame in rows:
        for e in frame.to_dict("records"):
            if e["type"] in ("request", "response") and not pd.isna(e["date"]):
                texts = {k: v if isinstance(v, str) else None for k, v in e.items() if k != "date"}
                out.append((pd.Timestamp(e["date"]).value // 1_000_000, int(e["type"] == "response"), texts["data"] or "", texts))
    return out


def waited(row: tuple) -> Event:
    e = dict(zip(names(RESPONSE), row, strict=True))
    return e["millis"], 1, e["data"] or "", e


def lone_row(key: tuple, row: tuple) -> tuple:
    """The columns of a pair for a response without a request."""
    e = dict(zip(names(RESPONSE), row, strict=True))
    return (*key, e["func_no"], None, pd.Timestamp(e["millis"], unit="ms"), None, e["fund_account"] or None, e["error_no"], e["error_info"], None, None, e["tag"], e["data"])


def walk(key: tuple, events: list[Event], request: dict | None, window: int) -> tuple[list[tuple], dict | None, list[tuple]]:
    """One key's events in the order of time, requests first: its pairs, the request that is left, and responses that found none."""
    pairs, waiting = [], []
    for millis, answers, _, e in sorted(events, key=lambda t: t[:3]):
        if not answers:
            request = {"millis": millis, **{c: e[c] for c in names(REQUEST)[1:]}}
        elif request is not None and 0 <= millis - request["millis"] <= window * 1000:
            account = request["fund_account"] or e["fund_account"] or None
            times = (pd.Timestamp(request["millis"], unit="ms"), pd.Timestamp(millis, unit="ms"), millis - request["millis"])
            pairs.append((*key, e["func_no"], *times, account, e["error_no"], e["error_info"], request["tag"], request["data"], e["tag"], e["data"]))
            if e["func_no"] not in ANSWERED_OFTEN:
                request = None
        else:
            waiting.append((millis, *(e[c] for c in names(RESPONSE)[1:])))
    return pairs, request, waiting


def _frame(rows: list[tuple], schema: str = PAIRED) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names(schema))
    times = {c: pd.to_datetime(frame[c]) for c in ("request_time", "response_time")}
    return frame.assign(**times, elapsed_ms=frame["elapsed_ms"].astype("Int64"))


class Correlator(StatefulProcessor):
    """The same per key: a request in value state that expires, waiting responses in list state, timers for both."""

    def __init__(self, window: int = WINDOW_SECONDS, patience: int = PATIENCE_SECONDS, lone: bool = False):
        self.window, self.patience, self.lone = window, patience, lone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.request = handle.getValueState("request", _state(REQUEST))
        self.waiting = handle.getListState("waiting", _state(RESPONSE))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        request = dict(zip(names(REQUEST), self.request.get(), strict=True)) if self.request.exists() else None
        out, request, waiting = walk((key[0], key[1]), new_events(rows) + [waited(w) for w in self.waiting.get()], request, self.window)
        if request is None:
            self.request.clear()
        else:
            self.request.update(tuple(request[c] for c in names(REQUEST)))
            self.handle.registerTimer(request["millis"] + self.window * 1000 + 1)
        if waiting:
            self.waiting.put(waiting)
            self.handle.registerTimer(max(w[0] for w in waiting) + self.patience * 1000)
        else:
            self.waiting.clear()
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        if self.request.exists() and self.request.get()[0] + self.window * 1000 < now:
            self.request.clear()
        waiting = [tuple(w) for w in self.waiting.get()]
        left = [w for w in waiting if w[0] + self.patience * 1000 > now]
        if left:
            self.waiting.put(left)
        else:
            self.waiting.clear()
        yield _frame([lone_row((key[0], key[1]), w) for w in waiting if w not in left] if self.lone else [])

    def close(self) -> None:
        pass


BOUNDED = f"{PAIRED}, status string"


class BoundedCorrelator(StatefulProcessor):
    """The same per bucket of keys, with at most ``most`` waiting responses in it.

    Places that a batch frees are free for all keys of the bucket; then new responses are admitted in the order of their time, the others go out as
    ``refused``.  Those that waited for ``patience`` seconds go out as ``lone``.  What has expired is looked for once in ``step`` milliseconds of event time at most.
    """

    def __init__(self, most: int, window: int = WINDOW_SECONDS, patience: int = PATIENCE_SECONDS):
        self.most, self.window, self.patience = most, window, patience
        self.step = max(1000, min(window, patience) * 250)

    def init(self, handle: StatefulProcessorHandle) -> None:
        key = _state("agent_hostname string, req_no string")
        self.handle = handle
        self.requests = handle.getMapState("requests", key, _state(REQUEST))
        self.waiting = handle.getMapState("waiting", key, _state("responses string"))  # a JSON list
        self.bucket = handle.getValueState("bucket", _state("waiting long, due long"))

    def _responses(self, key: tuple) -> list[tuple]:
        return [tuple(w) for w in json.loads(self.waiting.getValue(key)[0])] if self.waiting.containsKey(key) else []

    def _keep(self, key: tuple, responses: list[tuple]) -> None:
        if responses:
            self.waiting.updateValue(key, (json.dumps(responses),))
        elif self.waiting.containsKey(key):
            self.waiting.removeKey(key)

    def _timer(self, due: int | None, expiries: list[int]) -> int | None:
        """The next time to look, which has a timer."""
        if not expiries:
            return due
        at = -(-min(expiries) // self.step) * self.step
        if due is None or at < due:
            self.handle.registerTimer(at)
            return at
        return due

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events: dict[tuple, list[Event]] = {}
        for e in new_events(rows):
            events.setdefault((e[3]["agent_hostname"], e[3]["req_no"]), []).append(e)
        count, due = self.bucket.get() if self.bucket.exists() else (0, None)
        out, fresh, old, expiries = [], [], {}, []
        for k, own in events.items():
            before = self._responses(k)
            known = dict(zip(names(REQUEST), self.requests.getValue(k), strict=True)) if self.requests.containsKey(k) else None
            pairs, request, left = walk(k, own + [waited(w) for w in before], known, self.window)
            out += [(*p, "paired") for p in pairs]
            if request is not None:
                self.requests.updateValue(k, tuple(request[c] for c in names(REQUEST)))
                expiries.append(request["millis"] + self.window * 1000 + 1)
            elif known is not None:
                self.requests.removeKey(k)
            places = list(before)  # of equal responses as many stay as have waited
            old[k] = []
            for w in left:
                if w in places:
                    places.remove(w)
                    old[k].append(w)
                else:
                    fresh.append((w, k))
            count += len(old[k]) - len(before)
        fresh.sort(key=lambda f: (f[0][0], f[1], str(f[0])))
        for w, k in fresh[: max(self.most - count, 0)]:
            old[k].append(w)
            expiries.append(w[0] + self.patience * 1000)
        out += [(*lone_row(k, w), "refused") for w, k in fresh[max(self.most - count, 0) :]]
        count += min(len(fresh), max(self.most - count, 0))
        for k, responses in old.items():
            self._keep(k, responses)
        self.bucket.update((count, self._timer(due, expiries)))
        yield _frame(out, BOUNDED)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())  # one look for all that is over
        out, expiries, count = [], [], 0
        for k, value in [(tuple(k), tuple(v)) for k, v in self.requests.iterator()]:
            if value[0] + self.window * 1000 < now:
                self.requests.removeKey(k)
            else:
                expiries.append(value[0] + self.window * 1000 + 1)
        for k in [tuple(k) for k in self.waiting.keys()]:
            responses = self._responses(k)
            left = [w for w in responses if w[0] + self.patience * 1000 > now]
            out += [(*lone_row(k, w), "lone") for w in responses if w[0] + self.patience * 1000 <= now]
            expiries += [w[0] + self.patience * 1000 for w in left]
            count += len(left)
            self._keep(k, left)
        self.bucket.update((count, self._timer(None, expiries)))
        yield _frame(out, BOUNDED)

    def close(self) -> None:
        pass


def correlate_stream(events: DataFrame, delay: str = "10 minutes", window: int = WINDOW_SECONDS, patience: int = PATIENCE_SECONDS, lone: bool = False) -> DataFrame:
    """The stream of merged documents; needs the RocksDB state store."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    timed = completed(events).withWatermark("date", delay)
    return merged(timed.groupBy("agent_hostname", "req_no").transformWithStateInPandas(Correlator(window, patience, lone), PAIRED, "append", "EventTime"))


def correlate_bounded(events: DataFrame, most_waiting: int, buckets: int, delay: str = "10 minutes", window: int = WINDOW_SECONDS, patience: int = PATIENCE_SECONDS) -> DataFrame:
    """The stream of merged documents with a ``status``: ``paired``, ``lone`` or ``refused``; no more than ``most_waiting`` responses wait at a time.

    ``buckets`` share the places evenly (each has one at least) and are the most tasks that work side by side; one batch's events of a bucket are in memory together,
    so it grows with what a trigger reads.  Events with a null in their key are left out.
    """
    if most_waiting < buckets:
        raise ValueError("each bucket needs a place")
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    timed = completed(events).where("agent_hostname IS NOT NULL AND req_no IS NOT NULL").withWatermark("date", delay)
    dealt = timed.withColumn("bucket", F.pmod(F.xxhash64("agent_hostname", "req_no"), F.lit(buckets)))
    made = dealt.groupBy("bucket").transformWithStateInPandas(BoundedCorrelator(most_waiting // buckets, window, patience), BOUNDED, "append", "EventTime")
    return merged(made, "status")


def spread_table(rows: DataFrame, header: str = "header", values: str = "values") -> DataFrame:
    """Table responses as one row per line: ``header`` names the columns, ``values`` has a list per column."""
    lines = F.transform(F.sequence(F.lit(0), F.greatest(F.size(F.get(F.col(values), 0)) - 1, F.lit(0))), lambda i: F.map_from_arrays(F.col(header), F.transform(F.col(values), lambda v: F.get(v, i))))
    return rows.select("*", F.posexplode(F.when(F.size(F.get(F.col(values), 0)) > 0, lines)).alias("line", "fields"))
