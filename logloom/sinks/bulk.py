"""Bulk writers over HTTP: each task sends its partition's documents in batches through a transport.

A transport is a function (url, headers, body) -> (status, text); ``http_transport`` is the usual one, tests pass their own.  Batches are cut by
documents and bytes.  What a server refuses for now (408, 429, 5xx, no connection) is sent again after growing pauses, to the next endpoint that may be tried; while none
may, the task waits, and with it its micro-batch and source.  When tries or patience end, ``Unavailable`` ends the task, so that Spark
runs it again, or ends the batch, which a restarted query sends again: delivery is at least once.  Logins and addresses that a server refuses
(401, 403, 404, 407) end the task too.  Only a document that a server refuses for good is counted and left.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urlencode

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Transport = Callable[[str, dict, bytes], tuple[int, str]]
RETRY_STATUS = (408, 429)
#: What a server says to a wrong login or address: no document's fault.
SETUP_STATUS = (401, 403, 404, 407)


class Unavailable(ConnectionError):
    """No server took the documents; none of them may be given up."""


def for_now(status: int) -> bool:
    """Whether a refusal is one for now."""
    return status in RETRY_STATUS or status >= 500


def http_transport(url: str, headers: dict, body: bytes) -> tuple[int, str]:
    request = urllib.request.Request(url, data=body, headers=headers, method=headers.pop("X-Method", "POST"))
    try:
        with urllib.request.urlopen(request, timeout=30) as answer:
            return answer.status, answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")
    except OSError as e:
        return 503, str(e)


def batches(documents: Iterable[dict], most: int, most_bytes: int) -> Iterator[list[dict]]:
    """Documents in lists of at most ``most`` and about ``most_bytes``."""
    out, size = [], 0
    for d in documents:
        n = len(d["body"])
        if out and (len(out) >= most or size + n > most_bytes):
            yield out
            out, size = [], 0
        out.append(d)
        size += n
    if out:
        yield out


@dataclass
class Endpoint:
    """A server's address and health: one that fails is left alone for growing times."""

    url: str
    failures: int = 0
    ready_at: float = 0.0


class Endpoints:
    """The servers of a sink, taken in turn."""

    def __init__(self, urls: list[str], first_pause: float, longest_pause: float, clock: Callable[[], float] = time.monotonic):
        known: dict[str, Endpoint] = {}
        self.ring = [known.setdefault(u, Endpoint(u)) for u in urls]
        self.first_pause, self.longest_pause, self.clock, self.turn = first_pause, longest_pause, clock, 0

    def next(self) -> Endpoint | None:
        """The next server that may be tried; None while none may."""
        for _ in self.ring:
            one = self.ring[self.turn % len(self.ring)]
            self.turn += 1
            if one.ready_at <= self.clock():
                return one
        return None

    def wait(self) -> float:
        """Seconds until one may be tried."""
        return max(0.0, min(e.ready_at for e in self.ring) - self.clock())

    def failed(self, one: Endpoint) -> None:
        one.ready_at = self.clock() + min(self.first_pause * 2**one.failures, self.longest_pause)
        one.failures += 1

    def worked(self, one: Endpoint) -> None:
        one.failures, one.ready_at = 0, 0.0


@dataclass
class Sink:
    """Shared settings of the bulk writers.  ``patience``: seconds that a task waits while no server may be tried."""

    endpoints: list[str]
    most: int = 1000
    most_bytes: int = 5_000_000
    retries: int = 6
    first_pause: float = 0.2
    longest_pause: float = 10.0
    patience: float = 300.0
    headers: dict = field(default_factory=dict)

    def __post_init__(self):
        if not self.endpoints:
            raise ValueError("no endpoint")

    @property
    def pool(self) -> Endpoints:
        """The servers as this task knows them."""
        if "_pool" not in self.__dict__:
            self.__dict__["_pool"] = Endpoints(self.endpoints, self.first_pause, self.longest_pause)
        return self.__dict__["_pool"]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_pool"}

    def healthy(self, endpoint: str, transport: Transport) -> bool:
        """Whether a server may be sent to after a failure."""
        return True

    def until_taken(self, once: Callable[[str], bool], transport: Transport) -> None:
        """Call ``once`` with an endpoint until it is true; false: refused for now."""
        tries, waited, last = 0, 0.0, ""
        while tries <= self.retries:
            one = self.pool.next()
            if one is None:
                if waited >= self.patience:
                    break
                pause = max(self.pool.wait(), 0.001)
                waited += pause
                time.sleep(pause)
                continue
            last = one.url
            if (not tries or self.healthy(one.url, transport)) and once(one.url):
                self.pool.worked(one)
                return
            self.pool.failed(one)
            tries += 1
            time.sleep(min(self.first_pause * 2 ** (tries - 1), self.longest_pause) if tries <= self.retries else 0)
        raise Unavailable(f"no server took a batch after {tries} tries and {waited:.0f} s without any, the last {last}")


def _checked(status: int, endpoint: str) -> int:
    if status in SETUP_STATUS:
        raise Unavailable(f"{endpoint} says {status}")
    return status


@dataclass
class ElasticSink(Sink):
    """The _bulk API; only items that were refused for now are sent again.  Servers before version 7 want a document type.

    Rows with an ``id`` are stored under it, so that what is sent twice is stored once.
    """

    document_type: str = ""

    def send(self, rows: list[dict], transport: Transport) -> int:
        """How many documents were refused for good."""
        left, refused = rows, 0
        kind = {"_type": self.document_type} if self.document_type else {}

        def once(endpoint: str) -> bool:
            nonlocal left, refused
            body = "".join(json.dumps({"index": {"_index": r["target"], **kind, **({"_id": r["id"]} if r.get("id") else {})}}) + "\n" + r["body"] + "\n" for r in left)
            status, text = transport(f"{endpoint}/_bulk", {"Content-Type": "application/x-ndjson", **self.headers}, body.encode())
            if for_now(_checked(status, endpoint)):
                return False
            if status >= 300:
                refused, left = refused + len(left), []
                return True
            items = [next(iter(i.values())).get("status", 200) for i in json.loads(text or "{}").get("items", [])]
            refused += sum(status >= 300 and not for_now(status) for status in items)
            left = [r for r, status in zip(left, items, strict=False) if for_now(status)]
            return not left

        self.until_taken(once, transport)
        return refused


def elastic_sink(version: str, endpoints: list[str], **settings) -> ElasticSink:
    """The sink for a server's version: those of 6 get the type that their later versions fix."""
    return ElasticSink(endpoints, document_type="_doc" if version.startswith("6.") else "", **settings)


@dataclass
class DorisSink(Sink):
    """Stream load of JSON arrays; batches take the endpoints in turn.  A load that the server says failed is refused for good."""

    database: str = ""

    def has_table(self, table: str, transport: Transport = http_transport) -> bool:
        """Whether an endpoint knows the table; to be asked before a query starts."""
        for endpoint in self.endpoints:
            status, text = transport(f"{endpoint}/api/{self.database}/{table}/_schema", {"X-Method": "GET", **self.headers}, b"")
            if not for_now(status):
                return status < 300 and json.loads(text or "{}").get("code") == 0
        raise ConnectionError("no endpoint answers")

    def send(self, rows: list[dict], transport: Transport) -> int:
        refused = 0
        for table in sorted({r["target"] for r in rows}):
            own = [r["body"] for r in rows if r["target"] == table]

            def once(endpoint: str, table: str = table, own: list[str] = own) -> bool:
                nonlocal refused
                url = f"{endpoint}/api/{self.database}/{table}/_stream_load"
                status, text = transport(url, {"X-Method": "PUT", "format": "json", "strip_outer_array": "true", "Expect": "100-continue", **self.headers}, ("[" + ",".join(own) + "]").encode())
                if for_now(_checked(status, endpoint)):
                    return False
                ok = status < 300 and json.loads(text or "{}").get("Status") in ("Success", "Publish Timeout")
                refused += 0 if ok else len(own)
                return True

            self.until_taken(once, transport)
        return refused


@dataclass
class VictoriaSink(Sink):
    """JSON lines; documents without a message get a default one.  A server that failed is asked for its health before it gets more."""

    stream_fields: str = ""
    time_field: str = "_time"
    message_field: str = "_msg"

    def healthy(self, endpoint: str, transport: Transport) -> bool:
        return transport(f"{endpoint}/health", {"X-Method": "GET"}, b"")[0] < 300

    def send(self, rows: list[dict], transport: Transport) -> int:
        lines, refused = [], 0
        for r in rows:
            d = json.loads(r["body"])
            d.setdefault(self.message_field, "default message")
            lines.append(json.dumps(d, ensure_ascii=False))
        query = urlencode({"_msg_field": self.message_field, "_time_field": self.time_field, "_stream_fields": self.stream_fields})

        def once(endpoint: str) -> bool:
            nonlocal refused
            status, _ = transport(f"{endpoint}/insert/jsonline?{query}", {"Content-Type": "application/stream+json", **self.headers}, ("\n".join(lines) + "\n").encode())
            if for_now(_checked(status, endpoint)):
                return False
            refused = 0 if status < 300 else len(rows)
            return True

        self.until_taken(once, transport)
        return refused


def write(df: DataFrame, sink: Sink, target: str, body: str, transport: Transport = http_transport) -> DataFrame:
    """A frame with sent and refused documents per task; it does the sending when it is evaluated once.  ``datasource`` has the writers for tables and streams."""

    def run(frames):
        sent = refused = 0
        rows = ({"target": t, "body": b} for f in frames for t, b in zip(f["target"], f["body"], strict=True))
        for part in batches(rows, sink.most, sink.most_bytes):
            sent += len(part)
            refused += sink.send(part, transport)
        import pandas as pd

        yield pd.DataFrame({"sent": [sent], "refused": [refused]})

    return df.select(F.col(target).alias("target"), F.col(body).alias("body")).mapInPandas(run, "sent long, refused long")


def jdbc_append(df: DataFrame, url: str, table: str, **options) -> None:
    """Plain SQL inserts through Spark's JDBC writer."""
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def doris_time(at: Column, offset_hours: int = 0) -> Column:
    """An instant as Doris reads it, in the value's zone."""
    return F.date_format(at + F.expr(f"INTERVAL {offset_hours} HOURS"), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def doris_body(df: DataFrame, offset_hours: int = 0) -> Column:
    """A row's columns as a JSON document, its instants as Doris reads them."""
    shown = [doris_time(F.col(f"`{f.name}`"), offset_hours).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.to_json(F.struct(*shown))
