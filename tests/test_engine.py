import json

import pytest
from pyspark.sql import functions as F

from logloom.functions import formats as M
from logloom.functions import record as R
from logloom.functions.formats import uri_patterns
from logloom.plans.compile import compile_settings, compile_task, project
from logloom.plans.settings import load_task


def run(spark, docs, config, **options):
    df = spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "raw string")
    rows = compile_settings(config, **options)(df).select(R.encode(F.col("rec")).alias("j")).collect()
    return [json.loads(r.j) for r in rows]


def rules(*items, **more):
    return {"fields_transform": list(items), **more}


def fmt(field, kind="text", **settings):
    return {"rule_type": "format", "origin_field": field, "target_type": kind, "format_settings": settings}


def kv(**options):
    return {"pre_extract": [{"mode": "key_value", "field": "m", "format": json.dumps(options)}], "overwrite_origin": True}


GOLDEN = {
    "clone": ({"a": {"b": "1"}}, rules({"rule_type": "clone", "origin_field": "a.b", "target_field": "z"}), {"a": {"b": "1", "z": "1"}}),
    "target parents are not followed": ({"a": {"b": "1"}}, rules({"rule_type": "clone", "origin_field": "a", "target_field": "a.z"}), {"a": {"b": "1"}, "z": {"b": "1"}}),
    "rename": ({"a": {"b": "1", "c": "2"}}, rules({"rule_type": "rename", "origin_field": "a.b", "target_field": "a.d"}), {"a": {"c": "2", "d": "1"}}),
    "to root": ({"a": {"b": "1"}, "x": "2"}, rules({"rule_type": "rename", "origin_field": "a", "target_field": "__root__"}), {"b": "1", "x": "2"}),
    "scalar to root": ({"a": {"b": "1"}}, rules({"rule_type": "clone", "origin_field": "a.b", "target_field": "__root__"}), {"a": {"b": "1"}, "b": "1"}),
    "conflict": ({"a": "1", "b": "2"}, rules({"rule_type": "rename", "origin_field": "a", "target_field": "b", "ignore_if_conflict": True}), {"a": "1", "b": "2"}),
    "append": ({"a": "1"}, rules({"rule_type": "append", "target_field": "b.c.d", "target_type": "long", "append_settings": {"input_value": "7"}}), {"a": "1", "b": {"c": {"d": 7}}}),
    "fused deletes": ({"a": "1", "b": "2", "c": "3"}, rules({"rule_type": "delete", "origin_field": "a"}, {"rule_type": "delete", "origin_field": "b"}, {"rule_type": "delete", "origin_field": "x"}), {"c": "3"}),
    "long": ({"a": "12x"}, rules(fmt("a", "long")), {"a": 0}),
    "no regexp match": ({"a": "zz"}, rules(fmt("a", format_type="regexp", regexp=r"(\d+)")), {"a": "zz"}),
    "number to text": ({"a": 1.655e12}, rules(fmt("a")), {"a": "1655000000000"}),
    "skip": ({"a": "1"}, rules({**fmt("b"), "drop_if_not_found": True}, skip_extract_error=True), {"a": "1", "log_transform_failure": "origin field not found"}),
    "split": ({"m": "x,y"}, {"pre_extract": [{"mode": "split", "field": "m", "format": ","}]}, {"m": "x,y", "m_split_0": "x", "m_split_1": "y"}),
    "sibling clash": ({"m": "k=1", "k": "0"}, {"pre_extract": [{"mode": "key_value", "field": "m"}]}, {"m": "k=1", "k": "0", "m_key_value_k": "1"}),
    "value spaces": ({"m": "k=v ,q= w"}, kv(), {"m": {"k": "v ", "q": " w"}}),
    "key pattern": ({"m": "a=1,x,b=2,c d=3"}, kv(key_pattern="[a-z]+"), {"m": {"a": "1,x", "b": "2,c d=3"}}),
    "no such mode": ({"m": "a=1"}, kv(mode="delimiter_in_value"), {"m": {}}),
    "json": ({"m": '{"a":1}'}, {"pre_extract": [{"mode": "regexp", "field": "m", "format": "^(?P<x_y>z+)$"}, {"mode": "json", "field": "m"}]}, {"m": {"a": 1}}),
    "paths": ({"u": "GET /api/v1/users/123?x=1 HTTP/1.1", "s": "/s/app.0ad6.js", "n": "id=1"}, rules(*[fmt(f, format_type="uripath") for f in "usn"]), {"u": "/api/v1/users/:id", "s": "/s/:static.js", "n": "-"}),
    "equal keys": ('{"a":1,"a":2}', {}, {"a": 2}),
    "prefix": ({"a": "1", "b": "2"}, {"prefix_match": ["b"]}, {"b": "2"}),
    "wrapped": ("no json", {"pre_function": [{"mode": "format_to_json"}]}, {"message": "no json"}),
}


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_golden(spark, name):
    doc, config, want = GOLDEN[name]
    assert run(spark, [doc], config) == [want]


def test_dropped_and_filtered(spark):
    assert run(spark, [{"a": "1"}], rules({**fmt("b"), "drop_if_not_found": True})) == []
    assert run(spark, ["no json", "[1]"], {}) == []
    df = spark.createDataFrame([('{"a":{"b":"c"}}',), ('{"a":{"b":"d"}}',), ("x",), (None,)], "raw string")
    rows = compile_settings({"pre_function": [{"mode": "contains", "format": "{"}, {"mode": "match_key_value", "format": "a.b = c"}]}, statuses=True)(df)
    assert sorted(r.status for r in rows.collect()) == ["filtered", "filtered", "filtered", "ok"]


def test_label_miss(spark):
    rule = {"rule_type": "append", "append_settings": {"append_type": "label_mapping", "label_mapping": {"schema_id": 1, "parent_field": "__root__", "srcs": ["a"], "dsts": ["b", "c"]}}}
    assert run(spark, [{"a": "9"}, {"a": "8"}], rules(rule), dictionaries={1: {"a=8": {"b": "x"}}}) == [{"a": "9", "b": "", "c": ""}, {"a": "8", "b": "x", "c": ""}]


def test_layouts():
    assert M.strftime_to_layout("%Y-%m-%d %H:%M:%S") == "2006-01-02 15:04:05"
    assert M.layout_to_strftime("2006-01-02T15:04:05.999") == "%Y-%m-%dT%H:%M:%S.%3N"
    assert M.layout_to_strftime("02 January 2006") == "%d %B %Y"
    assert M.layout_to_strftime("unix_milli") == "%s%3N"


def test_oldest_engine_keeps_declared_keys(spark):
    task = load_task({"id": 1, "data_source_id": 2, "settings": {"version": "", "json_settings": {"fields": [{"rule_type": "submatch", "origin_field": "a", "key": "n", "value_type": "long", "extention": {}}]}}})
    df = spark.createDataFrame([('{"a":"5","b":"x"}',)], "raw string")
    assert [json.loads(r.j) for r in compile_task(task)(df).select(R.encode(F.col("rec")).alias("j")).collect()] == [{"n": 5}]


def test_long_chains_stay_small(spark):
    """Twenty dependent rules: the filter at the end is not pushed into a huge expression."""
    items = [{"rule_type": "clone", "origin_field": "a" if k == 0 else f"c{k - 1}", "target_field": f"c{k}"} for k in range(20)]
    assert run(spark, [{"a": "1"}], rules(*items))[0]["c19"] == "1"


def test_uri_patterns_of_a_task(spark):
    """The first pattern whose prefix fits names its parts; the rest of the path is treated as ever."""
    found = uri_patterns('[{"prefix": "/oms", "pattern": "/oms/(?P<shop>[a-z]+)/(?P<no>[0-9]+)", "order": 2}, {"prefix": "/oms/x", "pattern": "/oms/(?P<first>x+)", "order": 1}, {"prefix": ""}]')
    assert [p for p, _ in found] == ["/oms/x", "/oms"] and uri_patterns("") == []
    paths = ["GET /oms/abc/17/18", "/oms/xx/17", "/oms/17", "/:123456789/a", "no path", "//", "/a/b1234567.js", "/a/.js", "/a/bundle.js", "/oms/aa/5/index1.html", None]
    rows = spark.createDataFrame([(i, json.dumps({"u": p})) for i, p in enumerate(paths)], "i int, raw string")
    rule = {"rule_type": "format", "origin_field": "u", "target_type": "text", "format_settings": {"format_type": "uripath"}}
    made = project(compile_settings({"fields_transform": [rule]}, uri_patterns=found)(rows), {"u": ("u", "string")}, ["i"])
    want = ["/oms/:shop/:no/:id", "/oms/:first/:id", "/oms/:id", "/:uuid/a", "-", "/", "/a/:uuid", "/a/.js", "/a/:static.js", "/oms/:shop/:no/:static.html", None]
    assert [r.u for r in made.orderBy("i").collect()] == want


@pytest.mark.parametrize("skip", [False, True])
def test_addresses_without_a_place(spark, skip):
    """Private addresses and texts that are no address are errors; unknown public ones stay as they are."""
    ranges = spark.createDataFrame([(8 << 24, (9 << 24) - 1, "Here")], "ip_from long, ip_to long, city_name string")
    docs = [{"ip": a} for a in ("8.1.1.1", "10.0.0.1", "127.0.0.1", "::1", "nowhere", "9.9.9.9", "2001:db8::1", None)] + [{"other": 1}]
    got = run(spark, docs, {"pre_extract": [{"mode": "geoip", "field": "ip"}], "skip_extract_error": skip}, ranges=ranges)
    shown = {d.get("ip"): (d.get("geoip", {}).get("city_name"), d.get("log_transform_failure")) for d in got}
    good = {"8.1.1.1": ("Here", None), "9.9.9.9": (None, None), "2001:db8::1": (None, None), None: (None, None)}
    private, none = (None, "must be public ip address"), (None, "not an ip address")
    assert shown == (good | {"10.0.0.1": private, "127.0.0.1": private, "::1": private, "nowhere": none} if skip else good)
