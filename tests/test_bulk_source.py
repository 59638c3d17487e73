"""Delivery of documents: what happens when servers fail for a time, for good, or refuse documents."""

import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logloom.sinks import bulk, datasource

from . import transports

KEPT = "tests.transports:kept"


def sink(kind, folder, **settings):
    return kind([f"http://a{folder}", f"http://b{folder}"], most=7, **({"first_pause": 0.001, "longest_pause": 0.01, "retries": 3, "patience": 0.05} | settings))


def numbers(df, n=60):
    return df.select(F.lit("i").alias("target"), F.to_json(F.struct("id")).alias("body"), F.col("id"))


@pytest.mark.parametrize("kind", [bulk.ElasticSink, bulk.VictoriaSink])
def test_servers_that_fail_for_a_time(spark, tmp_path, kind):
    for k in range(3):
        (tmp_path / f"fail-{k}").touch()
    datasource.save(numbers(spark.range(0, 60, 1, 3)), sink(kind, tmp_path), "target", "body", transport=KEPT)
    assert sorted(d["id"] for d in transports.documents(tmp_path)) == list(range(60))


def test_a_table_that_no_server_takes(spark, tmp_path):
    (tmp_path / "down").touch()
    with pytest.raises(PySparkException, match="no server took a batch"):
        datasource.save(numbers(spark.range(9)), sink(bulk.ElasticSink, tmp_path), "target", "body", transport=KEPT)
    assert transports.documents(tmp_path) == []


def test_a_stream_loses_nothing(spark, tmp_path):
    """While servers are down the batch fails and stays uncommitted; once they are back the restarted query sends it."""
    out = tmp_path / "out"
    out.mkdir()
    source = str(tmp_path / "in")

    def run():
        rows = numbers(spark.readStream.schema("id long").parquet(source))
        writer = datasource.stream_to(rows, sink(bulk.VictoriaSink, out), "target", "body", transport=KEPT)
        q = writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)

    spark.range(0, 20, 1, 2).write.parquet(source)
    run()
    assert sorted(d["id"] for d in transports.documents(out)) == list(range(20))
    (out / "down").touch()
    spark.range(20, 40, 1, 2).write.mode("append").parquet(source)
    with pytest.raises(PySparkException):
        run()
    assert len(transports.documents(out)) == 20
    os.remove(out / "down")
    run()
    run()
    assert sorted(d["id"] for d in transports.documents(out)) == list(range(40))


def test_documents_refused_for_good(spark, tmp_path):
    rows = numbers(spark.range(10)).withColumn("body", F.when(F.col("id") == 3, F.lit('{"bad":1}')).otherwise(F.col("body")))
    datasource.save(rows, sink(bulk.ElasticSink, tmp_path), "target", "body", transport=KEPT)
    assert sorted(d["id"] for d in transports.documents(tmp_path)) == [k for k in range(10) if k != 3]
    with pytest.raises(PySparkException, match="were refused"):
        datasource.save(rows, sink(bulk.ElasticSink, tmp_path), "target", "body", transport=KEPT, most_refused=0)


def test_nothing_is_given_up():
    """Whatever the status: documents are delivered, refused for good, or the task ends."""
    row = [{"target": "t", "body": "{}", "id": "7"}]
    for kind, more in ((bulk.ElasticSink, {}), (bulk.VictoriaSink, {}), (bulk.DorisSink, {"database": "d"})):
        for status in (408, 429, 500, 502, 503, 507, 401, 403, 404):
            with pytest.raises(bulk.Unavailable):
                kind(["http://a"], first_pause=0.0, retries=2, **more).send(row, lambda *a, s=status: (s, ""))
        assert kind(["http://a"], **more).send(row, lambda *a: (400, "")) == 1
    with pytest.raises(ValueError):
        bulk.ElasticSink([])
    bodies = []
    bulk.ElasticSink(["http://a"]).send(row, lambda u, h, b: (bodies.append(b), (200, "{}"))[1])
    assert json.loads(bodies[0].split(b"\n")[0]) == {"index": {"_index": "t", "_id": "7"}}


def test_endpoints_in_turn():
    now = [0.0]
    pool = bulk.Endpoints(["a", "b"], 1.0, 3.0, lambda: now[0])
    a, b = pool.next(), pool.next()
    assert (a.url, b.url, pool.next().url) == ("a", "b", "a")
    pool.failed(a)
    assert [pool.next().url for _ in range(3)] == ["b"] * 3 and pool.wait() == 0
    pool.failed(b)
    assert pool.next() is None and pool.wait() == 1.0
    now[0] = 1.0
    assert pool.next() in (a, b)
    for _ in range(3):
        pool.failed(a)
    assert a.ready_at == 4.0  # never more than the longest pause
    pool.worked(a)
    assert a.ready_at == 0 and a.failures == 0


def test_back_pressure_waits_without_using_tries():
    """While all servers are down a task waits for them; the tries stay for servers that answer."""
    answers = iter([503, 503, 503, 200])
    s = bulk.VictoriaSink(["http://a"], first_pause=0.01, longest_pause=0.02, retries=3, patience=5)
    s.pool.failed(s.pool.ring[0])
    s.pool.failed(s.pool.ring[0])
    assert s.send([{"target": "", "body": "{}"}], lambda u, h, b: (200 if "health" in u else next(answers), "")) == 0
    gone = bulk.ElasticSink(["http://a"], first_pause=50, longest_pause=50, patience=0)
    gone.pool.failed(gone.pool.ring[0])
    with pytest.raises(bulk.Unavailable):
        gone.send([{"target": "", "body": "{}"}], lambda *a: (200, ""))
