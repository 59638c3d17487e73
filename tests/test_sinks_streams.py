import datetime as dt
import json
import random
import time
import uuid

import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from logloom.operators.prefilters import PreFunction, from_json, key_value
from logloom.plans.compile import compile_settings
from logloom.plans.settings import Storage, load_task, seconds
from logloom.sinks import bulk, partitions
from logloom.sources import messages
from logloom.streaming import metrics
from logloom.streaming.correlate import BoundedCorrelator, Correlator, correlate_batch, correlate_bounded, correlate_stream, spread_table
from logloom.streaming.enrich import TRIES, Enricher, enrich_batch, enrich_stream
from logloom.streaming.manager import Manager, fan_out


def test_names_and_retention(spark, tmp_path):
    at = dt.datetime(2022, 8, 24, 2, 0)
    assert [partitions.name_at("n", at, s) for s in ("daily", "weekly", "quarterly", "hourly", "none")] == ["n_20220824", "n_2022-08-w4", "n_2022-q3", "n_2022082402", "n"]
    assert partitions.expired("n", "daily", "0", ["n_20220101"], at) == []
    assert partitions.expired("n", "daily", "2d", ["n_20220821", "n_20220823", "m_20220821"], at) == ["n_20220821"]
    df = spark.createDataFrame([(1, dt.datetime(2022, 8, 1)), (2, dt.datetime(2022, 8, 23))], "i int, ts timestamp")
    partitions.write_partitioned(df, str(tmp_path / "t"), "n", "ts", "daily")
    assert partitions.drop_expired(spark, str(tmp_path / "t"), "n", "daily", "2d", dt.datetime(2022, 8, 24)) == ["n_20220801"]
    assert [r.i for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [2]


def test_settings():
    assert seconds("1d12h") == 129600 and seconds("0") == 0
    for bad in ("x", "1y", ""):
        with pytest.raises(ValueError):
            seconds(bad)
    with pytest.raises(ValueError):
        Storage("Upper")
    assert load_task({"storage": {"elasticsearch": {"index_name": "a1"}}}).storage.retention_duration == "2d"
    with pytest.raises(ValueError):
        PreFunction("match")
    with pytest.raises(ValueError):
        key_value("a=b=c")
    assert from_json('[{"mode":"strip_ansi"}]') == [PreFunction("strip_ansi")]


def test_sources():
    s = messages.KafkaSource(["h:1"], ["t"], group="g", start="oldest", security="sasl_plain", user="u", secret="p")
    assert s.options()["startingOffsets"] == "earliest" and s.options()["kafka.sasl.mechanism"] == "PLAIN"
    with pytest.raises(ValueError):
        messages.KafkaSource([], ["t"])
    assert messages.topic_selected("abc", ["/^a/"], []) and not messages.topic_selected("abc", [], ["abc"])
    assert messages.lag({"t": {"0": 9}}, {"t": {"0": 4}})[0]["lag"] == 5
    assert messages.clamped_offsets({"0": 99, "1": -5}, {"0": 1, "1": 2}, {"0": 50, "1": 60}) == {"0": 50, "1": 2}
    with pytest.raises(RuntimeError):
        messages.clamped_offsets({}, {}, {}, active_members=1)
    found = messages.decode_sources([{"id": 1, "plugin_type": "kafka", "settings": '{"related_clusters":["x"]}'}, {"id": 2, "plugin_type": "doris"}, {"id": 2, "plugin_type": "kafka"}], "y")
    assert {i: s.plugin for i, s in found.items()} == {2: "doris"}


def test_bulk_retries_and_rotation():
    calls = []

    def flaky(url, headers, body):
        calls.append(url)
        if len(calls) == 1:
            return 503, ""
        lines = body.decode().strip().split("\n")[1::2]
        return 200, json.dumps({"items": [{"index": {"status": 429 if len(calls) == 2 and k == 0 else 200}} for k in range(len(lines))]})

    sink = bulk.ElasticSink(["http://a", "http://b"], first_pause=0.001)
    assert sink.send([{"target": "i", "body": "{}"}, {"target": "i", "body": "{}"}], flaky) == 0
    assert [u[:8] for u in calls] == ["http://a", "http://b", "http://a"]
    assert [len(b) for b in bulk.batches([{"body": "x" * 10}] * 5, 2, 1000)] == [2, 2, 1]
    assert bulk.VictoriaSink(["http://a"], first_pause=0.001).send([{"target": "", "body": "{}"}], lambda *a: (400, "")) == 1
    seen = []
    bulk.VictoriaSink(["http://a"]).send([{"target": "", "body": '{"a":1}'}], lambda u, h, b: (seen.append(json.loads(b)), (204, ""))[1])
    assert seen == [{"a": 1, "_msg": "default message"}]
    assert bulk.DorisSink(["http://a"], database="d").send([{"target": "t", "body": "{}"}], lambda u, h, b: (200, '{"Status":"Publish Timeout"}')) == 0


def test_bulk_variants(spark, tmp_path):
    bodies = []
    keep = lambda url, headers, body: (bodies.append((url, body.decode())), (200, "{}"))[1]
    bulk.elastic_sink("6.8.1", ["http://a"]).send([{"target": "i", "body": "{}"}], keep)
    bulk.elastic_sink("7.1", ["http://a"]).send([{"target": "i", "body": "{}"}], keep)
    assert [json.loads(b.split("\n")[0])["index"] for _, b in bodies] == [{"_index": "i", "_type": "_doc"}, {"_index": "i"}]
    bodies.clear()
    doris = bulk.DorisSink(["http://a", "http://b"], database="d")
    for _ in range(3):
        doris.send([{"target": "t", "body": "{}"}], keep)
    assert [u[:8] for u, _ in bodies] == ["http://a", "http://b", "http://a"]
    assert doris.has_table("t", lambda u, h, b: (503, "") if "//a" in u else (200, '{"code": 0}')) and not doris.has_table("t", lambda *a: (200, '{"code": 1}'))
    with pytest.raises(ConnectionError):
        doris.has_table("t", lambda *a: (503, ""))
    asked = []

    def sick(url, headers, body):
        asked.append(url)
        return (200 if "//b" in url else 503), ""

    sink = bulk.VictoriaSink(["http://a", "http://a", "http://b"], first_pause=0.001, stream_fields="a,b&c")
    assert sink.send([{"target": "", "body": "{}"}], sick) == 0
    assert [u.split("?")[0][7:] for u in asked] == ["a/insert/jsonline", "a/health", "b/health", "b/insert/jsonline"] and asked[0].endswith("_stream_fields=a%2Cb%26c")


def test_write_in_tasks(spark, tmp_path):
    """Each task sends its rows in batches; what the transport got is every row once."""
    folder = str(tmp_path)

    def store(url, headers, body):
        with open(f"{folder}/{uuid.uuid4()}", "wb") as f:
            f.write(body)
        return 200, json.dumps({"items": [{"index": {"status": 201}}] * (body.count(b"\n") // 2)})

    rows = spark.range(0, 50, 1, 3).select(F.lit("i").alias("target"), F.to_json(F.struct("id")).alias("body"))
    done = bulk.write(rows, bulk.ElasticSink(["http://a"], most=7), "target", "body", store).collect()
    assert (sum(r.sent for r in done), sum(r.refused for r in done)) == (50, 0)
    sent = [json.loads(line)["id"] for f in tmp_path.iterdir() for line in f.read_text().split("\n")[1::2] if line]
    assert sorted(sent) == list(range(50)) and len(list(tmp_path.iterdir())) >= 8
    timed = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0, 0, 5)), (2, None)], "`a.b` int, t timestamp")
    assert [json.loads(r[0]) for r in timed.select(bulk.doris_body(timed, 8)).collect()] == [{"a.b": 1, "t": "2024-01-01 08:00:00.000005"}, {"a.b": 2}]


def test_metrics(spark, tmp_path):
    plan = compile_settings({"pre_function": [{"mode": "contains", "format": "a"}]}, statuses=True)
    rows = spark.createDataFrame([('{"a":1}',), ("a",), ("b",), (None,)], "raw string")
    seen = Observation("rows")
    assert metrics.kept(metrics.observe(plan(rows), "batch", seen)).count() == 1 and seen.get == {"ok": 1, "filtered": 2, "error": 1, "empty_result": 0}
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    totals = metrics.Metrics()
    spark.streams.addListener(totals)
    try:
        counted = metrics.kept(metrics.observe(plan(spark.readStream.schema("raw string").parquet(str(tmp_path / "in"))), 's"1'))
        q = counted.select("raw").writeStream.format("memory").queryName("counted").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        until = time.monotonic() + 20
        while not totals.totals and time.monotonic() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(totals)
    assert totals.text() == 'log_rows_total{source="s\\"1",code="error"} 1\nlog_rows_total{source="s\\"1",code="filtered"} 2\nlog_rows_total{source="s\\"1",code="ok"} 1\n'


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


EVENTS = [("request", "h", "1", "5", at(0), "r1"), ("response", "h", "1", "5", at(1), "s1"), ("response", "h", "1", "5", at(2), "s2"), ("request", "h", "2", "111", at(0), "r2"), ("response", "h", "2", "111", at(1), "s3"), ("response", "h", "2", "111", at(2), "s4"), ("response", "h", "3", "5", at(1), "lost")]
COLUMNS = "type string, agent_hostname string, req_no string, func_no string, date timestamp, data string"


def test_correlation_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame(EVENTS, COLUMNS)
    want = sorted((r.request_data, r.response_data, r.elapsed_ms) for r in correlate_batch(rows).collect())
    assert want == [("r1", "s1", 60000), ("r2", "s3", 60000), ("r2", "s4", 120000)]
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(COLUMNS).parquet(str(tmp_path / "in"))
    q = correlate_stream(stream).writeStream.format("memory").queryName("pairs").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.request_data, r.response_data, r.elapsed_ms) for r in spark.table("pairs").collect()) == want


FULL = COLUMNS + ", fund_account string, error_no string, error_info string, tag string"
FULL_EVENTS = [
    ("request", "h", "1", "28017", at(0), "account_content|branch|date|twice|twice|\n77|b1|x|1|2|\n", None, None, None, "ask"),
    ("response", "h", "1", "28017", at(1), "s1", "", None, "", "reply"),
    ("request", "h", "2", "28017", at(0), "account_content|branch\n77|b2\n78|b3", "", None, None, None),
    ("response", "h", "2", "28017", at(1), "s2", "9", "12", "failed", None),
    ("request", "h", "3", "5", at(0), "account_content|gone\n77", "5", None, None, None),
    ("response", "h", "3", "112", at(1), "s3", "9", None, None, None),
    ("response", "h", "3", "5", at(2), "s4", None, None, None, None),
    ("response", "h", "3", "112", at(3), "s5", None, None, None, None),
    ("request", "h", "4", "5", at(0), None, None, None, None, None),
    ("response", "h", "4", None, at(59), None, None, None, None, None),
    ("request", None, "5", "5", at(0), "r", None, None, None, None),
    ("response", None, "5", "5", at(0), "s", None, None, None, None),
    ("request", "h", "6", "5", None, "r", None, None, None, None),
    ("other", "h", "6", "5", at(0), "r", None, None, None, None),
]


def test_merged_documents(spark, tmp_path):
    rows = spark.createDataFrame(FULL_EVENTS, FULL).withColumn("event", F.lit("own")).withColumn("stretch", F.lit(1))
    shown = ["req_no", "func_no", "elapsed_ms", "fund_account", "error_no", "error_info", "request_tag", "response_tag", "response_data", "fields"]
    want = [
        ("1", "28017", 60000, "77", "", None, "ask", "reply", "s1", {"account_content": "77", "branch": "b1"}),
        ("2", "28017", 60000, "9", "12", "failed", None, None, "s2", {}),
        ("3", "112", 60000, "5", "", None, None, None, "s3", {"account_content": "77", "gone": ""}),
        ("3", "5", 120000, "5", "", None, None, None, "s4", {"account_content": "77", "gone": ""}),
        ("4", None, 3540000, None, "", None, None, None, None, {}),
    ]
    rank = lambda t: (t[0], t[2])
    assert sorted((tuple(r) for r in correlate_batch(rows).select(*shown).collect()), key=rank) == want
    assert correlate_batch(rows.limit(0)).count() == 0
    keyed = rows.where("agent_hostname IS NOT NULL")
    keyed.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(keyed.schema).parquet(str(tmp_path / "in"))
    q = correlate_stream(stream).writeStream.format("memory").queryName("merged").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((tuple(r) for r in spark.table("merged").select(*shown).collect()), key=rank) == want


def test_batch_stretches_change_nothing(spark):
    """Requests and responses at random times of few keys, against a plain walk over each key's events."""
    random.seed(4)
    events = [(random.choice(["request", "response"]), "h", str(random.randrange(4)), random.choice(["5", "111"]), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t), f"{t:06}") for t in random.sample(range(40000), 900)]
    want, open_ = set(), {}
    for kind, _, key, func, date, data in sorted(events, key=lambda e: e[4]):
        if kind == "request":
            open_[key] = (date, data)
        elif key in open_ and (date - open_[key][0]).total_seconds() <= 600:
            want.add((open_[key][1], data))
            if func == "5":
                del open_[key]
    got = [(r.request_data, r.response_data) for r in correlate_batch(spark.createDataFrame(events, COLUMNS), 600).collect()]
    assert len(got) == len(want) and set(got) == want


def test_enrichment_stream_equals_batch(spark, tmp_path):
    schema = "kind string, agent_hostname string, ref string, account_id string, ts timestamp, data string"
    rows = spark.createDataFrame([("dict", "h", "1", "A", at(0), None), ("data", "h", "1", None, at(1), "d1"), ("dict", "h", "2", "B", at(0), None), ("data", "h", "2", None, at(3), "d2")], schema)
    want = sorted((r.data, r.account_id) for r in enrich_batch(rows).collect())
    assert want == [("d1", "A"), ("d2", "B")]
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = enrich_stream(stream).writeStream.format("memory").queryName("named").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.data, r.account_id) for r in spark.table("named").collect()) == want


def test_table_rows(spark):
    df = spark.createDataFrame([(["a", "b"], [["1", "2"], ["x", "y"]])], "header array<string>, values array<array<string>>")
    assert [r.fields for r in spread_table(df).orderBy("line").collect()] == [{"a": "1", "b": "x"}, {"a": "2", "b": "y"}]


def test_fan_out_and_reconcile(spark):
    tasks = [load_task({"id": i, "data_source_id": 1, "settings": {"version": "log_transform", "json_settings": {"prefix_match": [k]}}}) for i, k in enumerate("ab")]
    got = {}
    fan_out(tasks, lambda df, t, n: got.__setitem__(t.id, [r[0] for r in df.select(F.map_keys("rec")).collect()]))(spark.createDataFrame([('{"a":1,"b":2}',)], "raw string"), 0)
    assert got == {0: [["a"]], 1: [["b"]]}

    class Query:
        def stop(self):
            pass

    m = Manager(lambda source, own: Query())
    one = [{"id": 1, "data_source_id": 7}]
    assert m.reconcile(one)["started"] == [7] and m.reconcile(one) == {"started": [], "restarted": [], "stopped": []}
    assert m.reconcile([{"id": 2, "data_source_id": 7}])["restarted"] == [7] and m.reconcile([])["stopped"] == [7]


class Held:
    """A value or list state in memory."""

    def __init__(self):
        self.rows = None

    def exists(self):
        return self.rows is not None

    def get(self):
        return self.rows or []

    def put(self, rows):
        self.rows = rows

    update = put

    def clear(self):
        self.rows = None


class Handle:
    def __init__(self):
        self.timers = []

    def getValueState(self, *_):
        return Held()

    getListState = getValueState

    def registerTimer(self, at):
        self.timers.append(at)


class Clock:
    def __init__(self, millis):
        self.millis = millis

    def getCurrentProcessingTimeInMs(self):
        return self.millis

    getExpiryTimeInMs = getCurrentWatermarkInMs = getCurrentProcessingTimeInMs


def test_enrichment_timers():
    """Data without a dictionary row is tried again and then goes on without an account."""
    e, handle = Enricher(), Handle()
    e.init(handle)
    rows = pd.DataFrame({"kind": ["data"], "account_id": [None], "ts": [pd.Timestamp(at(1))], "data": ["d"]})
    assert list(e.handleInputRows(("h", "1"), iter([rows]), Clock(1000))) == [] and handle.timers == [6000]
    out = []
    while e.waiting.exists():
        now = handle.timers[-1]
        out += [f for f in e.handleExpiredTimer(key=("h", "1"), timerValues=Clock(now), expiredTimerInfo=Clock(now))]
    assert [f["data"].tolist() for f in out] == [[]] * TRIES + [["d"]] and out[-1]["account_id"].tolist() == [None]


def test_correlation_timers():
    """Requests go with their window, waiting responses after their patience."""
    c, handle = Correlator(window=60, patience=30), Handle()
    c.init(handle)
    texts = dict.fromkeys(["func_no", "fund_account", "error_no", "error_info", "tag"])
    rows = pd.DataFrame([{"type": "response", "date": at(0), "data": "early", **texts}, {"type": "request", "date": at(1), "data": "r", **texts}])
    assert [len(f) for f in c.handleInputRows(("h", "1"), iter([rows]), Clock(0))] == [0]
    for now in sorted(handle.timers):
        list(c.handleExpiredTimer(key=("h", "1"), timerValues=Clock(now), expiredTimerInfo=Clock(now)))
    assert not c.request.exists() and not c.waiting.exists()


class Pairs(Held):
    """A map state in memory."""

    def __init__(self):
        self.rows = {}

    def getValue(self, key):
        return self.rows[key]

    def containsKey(self, key):
        return key in self.rows

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        del self.rows[key]

    def keys(self):
        return iter(self.rows)

    def iterator(self):
        return iter(self.rows.items())


class Maps(Handle):
    def getMapState(self, *_):
        return Pairs()


def _bounded(most):
    c, handle = BoundedCorrelator(most, window=600, patience=60), Maps()
    c.init(handle)
    texts = dict.fromkeys(["fund_account", "error_no", "error_info", "tag"])

    def feed(*events):
        rows = pd.DataFrame([{"type": k, "agent_hostname": "h", "req_no": r, "func_no": "5", "date": dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), "data": d, **texts} for k, r, s, d in events])
        return shown(c.handleInputRows((0,), iter([rows]), Clock(0)))

    def shown(frames):
        return [(r.req_no, r.response_data, r.status) for f in frames for r in f.itertuples()]

    def until(seconds):
        """All timers up to a time, in their order."""
        end, out = int(dt.datetime(2024, 1, 1, tzinfo=dt.UTC).timestamp() * 1000) + seconds * 1000, []
        while handle.timers and min(handle.timers) <= end:
            now = min(handle.timers)
            handle.timers.remove(now)
            out += shown(c.handleExpiredTimer((0,), Clock(now), Clock(now)))
        return out

    return c, feed, until


def test_waiting_responses_are_bounded_across_keys():
    c, feed, until = _bounded(2)
    assert feed(("response", "3", 3, "late"), ("response", "1", 1, "a"), ("response", "2", 2, "b")) == [("3", "late", "refused")]
    assert c.bucket.get()[0] == 2
    assert feed(("response", "1", 4, "a2")) == [("1", "a2", "refused")]
    assert feed(("request", "1", 0, "r"), ("response", "4", 5, "d"), ("response", "2", 6, "b2")) == [("1", "a", "paired"), ("2", "b2", "refused")]
    assert c.bucket.get()[0] == 2 and until(30) == []
    assert sorted(until(90)) == [("2", "b", "lone"), ("4", "d", "lone")] and c.bucket.get()[0] == 0
    assert feed(("request", "5", 100, "r5")) == [] and c.requests.containsKey(("h", "5"))
    assert until(2000) == [] and not c.requests.rows and not c.waiting.rows


def test_no_response_is_lost_at_the_bound():
    """Random events in small batches: each response goes out once or waits, never more than the bound; without a bound the pairs are those of the plain processor."""
    random.seed(7)
    events = [(random.choice(["request", "response", "response"]), str(random.randrange(6)), t, f"{t:05}") for t in sorted(random.sample(range(5000), 600))]
    for most in (3, 10_000):
        c, feed, until = _bounded(most)
        out = []
        for k in range(0, len(events), 40):
            out += feed(*random.sample(events[k : k + 40], len(events[k : k + 40])))
            assert c.bucket.get()[0] == sum(len(json.loads(v[0])) for v in c.waiting.rows.values()) <= most
            out += until(events[k][2])
        out += until(10_000)
        assert sorted(d for _, d, _ in out) == [d for k, _, _, d in events if k == "response"] and not c.waiting.rows
        assert {s for _, _, s in out} == ({"paired", "lone", "refused"} if most == 3 else {"paired", "lone"})


def test_lone_responses(spark, tmp_path):
    """Responses without a request go out at the end of their patience, in batches and streams alike."""
    rows = spark.createDataFrame(EVENTS, COLUMNS)
    want = [("1", "r1", "s1", 60000), ("1", None, "s2", None), ("2", "r2", "s3", 60000), ("2", "r2", "s4", 120000), ("3", None, "lost", None)]
    got = [(r.req_no, r.request_data, r.response_data, r.elapsed_ms) for r in correlate_batch(rows, lone=True).collect()]
    assert set(got) == set(want) and len(got) == len(want)
    assert correlate_batch(rows.limit(0), lone=True).count() == 0
    later = spark.createDataFrame([("request", "z", "9", "5", at(59), "z")], COLUMNS)
    for part in (rows, later):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        correlate_bounded(rows, 1, 2)
    for name, made in (("plain", correlate_stream(stream(), "1 minute", lone=True)), ("bounded", correlate_bounded(stream(), 100, 2, "1 minute"))):
        q = made.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        got = {(r.req_no, r.request_data, r.response_data, r.elapsed_ms) for r in spark.table(name).collect()}
        assert got == set(want) and spark.table(name).count() == len(want)
    assert {r.response_data for r in spark.table("bounded").where("status = 'lone'").collect()} == {"s2", "lost"}
