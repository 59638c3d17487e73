"""Dictionaries of tasks: literal, joined, and as of the event's time."""

import datetime as dt
import json

from pyspark.sql import functions as F

from logloom.functions import record as R
from logloom.operators import transforms
from logloom.plans.compile import compile_settings


def rule(parent="__root__", conflict=False):
    return {"fields_transform": [{"rule_type": "append", "ignore_if_conflict": conflict, "append_settings": {"append_type": "label_mapping", "label_mapping": {"schema_id": 1, "parent_field": parent, "srcs": ["b", "a"], "dsts": ["x", "y"]}}}]}


def run(df, config, dictionary):
    rows = compile_settings(config, dictionaries={1: dictionary})(df)
    assert set(rows.columns) == {*df.columns, "rec", "err"}
    return sorted((r.k, json.loads(r.j)) for r in rows.select("k", R.encode(F.col("rec")).alias("j")).collect())


def test_literal_and_joined_are_one(spark, monkeypatch):
    """The same entries as a literal map, as a broadcast table and as a shuffled one; rows without a whole key among them."""
    docs = [{"a": "1", "b": "2", "x": "own"}, {"a": "1"}, {"a": "9", "b": "9"}, {"a": 1, "b": "2"}, {"o": {"a": "1", "b": "2"}}]
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "k int, raw string")
    entries = {"a=1,b=2": {"x": "X", "y": ""}, "a=3,b=4": {"x": "Z"}}
    for config in (rule(), rule(conflict=True), rule("o")):
        want = run(df, config, entries)
        monkeypatch.setattr(transforms, "LITERAL_ROWS", 0)
        assert run(df, config, entries) == want
        monkeypatch.setattr(transforms, "BROADCAST_KEYS", 0)
        assert run(df, config, entries) == want
        monkeypatch.undo()
    assert run(df, rule(), entries)[0] == (0, docs[0] | {"x": "X", "y": ""}) and run(df, rule("o"), entries) == [(4, {"o": {"a": "1", "b": "2", "x": "X", "y": ""}})]


def test_as_of_the_events_time(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    entries = [("a=1,b=2", {"x": "old"}, None, day(10)), ("a=1,b=2", {"x": "b"}, day(10), day(20)), ("a=1,b=2", {"x": "a"}, day(10), day(20)), ("a=1,b=2", {"x": "late"}, day(15), day(18)), (None, {"x": "none"}, None, None)]
    table = spark.createDataFrame(entries, "src_key string, dst map<string,string>, valid_from timestamp, valid_to timestamp")
    times = [day(1), day(10), day(16), day(19), day(20), None]
    df = spark.createDataFrame([(k, '{"a":"1","b":"2"}', t) for k, t in enumerate(times)], "k int, raw string, at timestamp")
    assert [d["x"] for _, d in run(df, rule(), transforms.Dictionary(table, at="at"))] == ["old", "a", "late", "a", "", ""]
    assert [d["x"] for _, d in run(df, rule(), transforms.Dictionary(table))] == [""] * 6
    still = table.withColumn("valid_to", F.when(F.col("dst")["x"] != "late", F.col("valid_to")))
    assert [d["x"] for _, d in run(df, rule(), transforms.Dictionary(still))] == ["late"] * 6
    assert run(df, rule(), transforms.Dictionary(table.limit(0), at="at"))[0][1] == {"a": "1", "b": "2", "x": "", "y": ""}
