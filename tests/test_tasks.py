import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from logloom.streaming.manager import Manager
from logloom.streaming.tasks import Snapshot, TaskTable, merge_tasks, read_tasks, rules_as_of, tasks_frame


def task(number, keys, source=1):
    return {"id": number, "data_source_id": source, "settings": {"version": "log_transform", "json_settings": {"prefix_match": keys}}}


def test_task_files(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "two").mkdir()
    (tmp_path / "one" / "a.json").write_text(json.dumps(task(1, ["a"])))
    (tmp_path / "one" / "b.json").write_text("no task")
    (tmp_path / "two" / "c.json").write_text("\n " + json.dumps([task(1, ["b"]), task(2, ["c"], 7), {"name": "without a number"}]))
    (tmp_path / "two" / "d.json").write_text("")
    first, second = (read_tasks(spark, str(tmp_path / d)) for d in ("one", "two"))
    got = {r.id: (r.data_source_id, json.loads(r.config)) for r in merge_tasks(first, second).collect()}
    assert got == {1: (1, task(1, ["a"])), 2: (7, task(2, ["c"], 7))}
    assert {r.id: json.loads(r.config) for r in merge_tasks(second, first).collect()}[1] == task(1, ["b"])
    assert merge_tasks(first.limit(0)).count() == 0


def test_versions(spark, tmp_path):
    table = TaskTable(spark, str(tmp_path / "t"))
    assert table.versions() == [] and table.pinned("s", 0) is None
    bad = {"id": 3, "settings": {"version": "log_transform", "json_settings": {"pre_function": [{"mode": "match", "format": ""}]}}}
    first = table.publish(tasks_frame(spark, [task(1, ["a"]), bad]), dt.datetime(2024, 1, 1))
    assert (first.version, first.since, [json.loads(c) for c in first.configs], list(first.errors)) == (1, dt.datetime(2024, 1, 1), [task(1, ["a"])], [3])
    assert table.publish(tasks_frame(spark, [bad, task(1, ["a"])])).version == 1  # nothing new
    with pytest.raises(ValueError):
        table.publish(tasks_frame(spark, [task(1, ["b"])]), dt.datetime(2023, 1, 1))
    with pytest.raises(ValueError):
        table.publish(tasks_frame(spark, [task(1, ["b"]), task(1, ["c"])]))
    assert table.pinned("s", 5).version == 1
    assert table.publish(tasks_frame(spark, [task(1, ["b"])]), dt.datetime(2024, 2, 1)).version == 2
    again = TaskTable(spark, str(tmp_path / "t"))  # as after a restart
    assert (again.pinned("s", 5).version, again.pinned("s", 6).version, again.pinned("other", 5).version) == (1, 2, 2)
    again.pinned("s", 7)
    assert again._numbers("streams/s", "batch") == [6, 7]
    (tmp_path / "t" / "tasks" / "version=3").mkdir()  # a writer that has not committed
    assert again.versions() == [1, 2]
    none = TaskTable(spark, str(tmp_path / "u")).publish(spark.createDataFrame([], "id long, data_source_id long, config string"))
    assert (none.version, none.configs) == (1, [])


def test_rules_change_between_two_batches(spark, tmp_path):
    """From the second batch on the changed rule acts; a batch that failed runs again by its own version; every row comes once."""
    table = TaskTable(spark, str(tmp_path / "t"))
    source, out, broken = str(tmp_path / "in"), {}, {1}

    def put(k):
        spark.createDataFrame([(f'{{"a":{k}{n},"b":{n}}}',) for n in range(3)], "raw string").coalesce(1).write.mode("append").parquet(source)

    def write(df, t, number):
        rows = sorted(json.loads(r[0]).popitem() for r in df.select(F.to_json(F.to_variant_object("rec"))).collect())
        if number in broken:
            broken.remove(number)
            raise RuntimeError("sink is away")
        out[number, t.id] = rows

    def drain(tasks):
        q = spark.readStream.schema("raw string").parquet(source).writeStream.foreachBatch(tasks.fan_out("s", write, source=1)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return q

    put(1)
    with pytest.raises(Exception, match="no tasks are published"):
        drain(table)
    table.publish(tasks_frame(spark, [task(1, ["a"]), task(2, ["b"], source=2)]))
    drain(table)
    put(2)
    with pytest.raises(Exception, match="sink is away"):
        drain(table)
    table.publish(tasks_frame(spark, [task(1, ["b"])]))
    drain(TaskTable(spark, str(tmp_path / "t")))  # the failed batch, by the rules it began with
    put(3)
    drain(table)
    assert out == {(0, 1): [("a", 10), ("a", 11), ("a", 12)], (1, 1): [("a", 20), ("a", 21), ("a", 22)], (2, 1): [("b", 0), ("b", 1), ("b", 2)]}


def test_history_by_the_rules_of_its_time(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = spark.createDataFrame([(n, day(d) if d else None, '{"a":1,"b":2}') for n, d in enumerate([1, 2, 3, 4, None])], "n int, at timestamp_ntz, raw string").withColumn("version", F.lit("own"))
    snaps = [Snapshot(1, day(2), [json.dumps(task(1, ["a"]))]), Snapshot(2, day(3), []), Snapshot(3, day(4), [json.dumps(task(1, ["b"])), json.dumps(task(9, ["a"], 2))])]
    got = sorted((r.n, r.version, r.task_id, r.k) for r in rules_as_of(rows, "at", snaps).select("n", "version", "task_id", F.map_keys("rec").alias("k")).collect())
    assert got == [(1, 1, 1, ["a"]), (3, 3, 1, ["b"]), (3, 3, 9, ["a"])]
    assert [r.n for r in rules_as_of(rows, "at", snaps, source=2).collect()] == [3]
    assert rules_as_of(rows, "at", []).count() == 0 and rules_as_of(rows.limit(0), "at", snaps).count() == 0
    with pytest.raises(ValueError):
        rules_as_of(rows, "at", [Snapshot(1, day(3), []), Snapshot(2, day(2), [])])


def test_queries_restart_only_where_their_source_changes():
    class Query:
        isActive = True

        def stop(self):
            self.isActive = False

    m = Manager(lambda source, own: Query(), hot=True)
    one, changed = [task(1, ["a"], 7)], [task(1, ["b"], 7), task(2, ["c"], 7)]
    assert m.reconcile(one, {7: {"brokers": ["h:1"]}})["started"] == [7]
    assert m.reconcile(changed, {7: {"brokers": ["h:1"]}})["restarted"] == []
    assert m.reconcile([changed[0] | {"topics": {"include": ["t"]}}], {7: {"brokers": ["h:1"]}})["restarted"] == [7]
    assert m.reconcile(changed, {7: {"brokers": ["h:2"]}})["restarted"] == [7]
    m.running[7][1].isActive = False  # it has ended by itself
    assert m.reconcile(changed, {7: {"brokers": ["h:2"]}})["restarted"] == [7]
