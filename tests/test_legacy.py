import json

import pytest
from pyspark.sql import functions as F

from logloom.functions import formats as M
from logloom.functions import record as R
from logloom.plans.compile import compile_settings, compile_task
from logloom.operators.geoip import geoip
from logloom.operators.transforms import with_dictionary
from logloom.plans.settings import load_task
from logloom.sources.messages import KafkaSource


def rule(origin, key, kind="text", required=False, **more):
    return {"rule_type": "submatch", "origin_field": origin, "key": key, "value_type": kind, "required": required, "extention": {"regexp": "(.*)"} | more}


def run(spark, version, docs, fields, **settings):
    task = load_task({"id": 1, "data_source_id": 2, "settings": {"version": version, "json_settings": {"fields": fields, **settings}}})
    df = spark.createDataFrame([(k, d if isinstance(d, str) else json.dumps(d), "mine") for k, d in enumerate(docs)], "k int, raw string, __src string")
    rows = compile_task(task)(df)
    assert "__src" in rows.columns
    return {r.k: json.loads(r.j) for r in rows.select("k", R.encode(F.col("rec")).alias("j")).collect()}


CASES = {
    "default for null and empty, not for missing": ("", [{"a": None}, {"a": ""}, {"b": 1}], [rule("a", "x", default_value="d")], {0: {"x": "d"}, 1: {"x": "d"}}),
    "required": ("", [{"a": "1"}, {"a": None}, {"b": "1"}, {"a": ""}], [rule("a", "x", "long", True)], {0: {"x": 1}}),
    "kinds": ("", [{"a": "1.5x", "b": 2.9, "c": 7}], [rule("a", "x", "float"), rule("b", "y", "long"), rule("c", "z")], {0: {"x": 0.0, "y": 2, "z": "7"}}),
    "no number or text": ("", [{"a": True}, {"a": {"b": 1}}], [rule("a", "x")], {}),
    "trim": ("", [{"a": " \t v "}], [rule("a", "x", preset_filter="allmatch")], {0: {"x": "v"}}),
    "objects in texts, dots in keys": ("", [{"a.b": json.dumps({"c": json.dumps({"d.e": "v"})})}], [rule("a_b.c.d_e", "x")], {0: {"x": "v"}}),
    "levels of prefixes": ("", [{"a": {"b": "1", "c": "2"}}], [rule("a.b", "x"), rule("a.c", "y")], {0: {"x": "1"}}),
    "nulls go": ("log_prune", [{"a": None, "b": "1", "": "x"}], [rule("b", "b", "long")], {0: {"b": 1}}),
    "a moved value leaves no empty object": ("log_prune", [{"a": {"b": "1"}}], [rule("a.b", "c.d", "long")], {0: {"c": {"d": 1}}}),
    "two rules of one field": ("log_prune", [{"a": "5"}], [rule("a", "a", "long"), rule("a", "b")], {0: {"a": 5, "b": "5"}}),
    "graft of scalars, and none to the root": ("log_prune_v2", [{"a": "5", "b": {"c": 1}}, {"a": "5", "b": "x"}], [{"rule_type": "graft", "origin_field": "b", "key": "__root__"}], {0: {"a": "5", "c": 1}, 1: {"a": "5"}}),
    "removal of a written key does not run": ("log_prune", [{"a": "5", "b": "x"}], [rule("a", "b"), {"rule_type": "remove", "origin_field": "b"}], {0: {"b": "5"}}),
    "append needs a value": ("log_prune", [{"a": "5"}], [{"rule_type": "append", "key": "x", "value_type": "text"}], {}),
}


def parser(mode, field, format=""):
    return {"mode": mode, "field": field, "format": format}


PAIR = parser("regexp", "m", r"(?P<x>\d+)-(?P<y>\w+)")
# name: version, documents, fields, parsers and other settings, what comes out
PARSERS = {
    "a parser's result stands in the field's place": ("", [{"m": "12-ab"}, {"m": "none"}, {"m": ""}, {"k": 1}], [rule("m.x", "x", "long"), rule("m.__origin__", "o")], [PAIR], {0: {"x": 12, "o": "12-ab"}}),
    "an object in a text with a parser inside": ("", [{"m": json.dumps({"l": "12-ab", "n": {"z": "q"}})}], [rule("m.l.x", "x"), rule("m.n.z", "z")], [parser("regexp", "m.l", PAIR["format"])], {0: {"x": "12", "z": "q"}}),
    "a parser inside a parser's result": ("", [{"m": "a=12-ab;b=q"}], [rule("m.a.y", "y"), rule("m.b", "b"), rule("m.a.__origin__", "o")], [parser("key_value", "m", '{"field_delimiter":";"}'), parser("regexp", "m.a", PAIR["format"])], {0: {"y": "ab", "b": "q", "o": "12-ab"}}),
    "texts inside a parser's result are no objects": ("", [{"m": 'a={"b":"c"};d=e'}], [rule("m.a.b", "x"), rule("m.d", "d")], [parser("key_value", "m", '{"field_delimiter":";"}')], {0: {"d": "e"}}),
    "below an object a failure is none": ("", [{"o": {"m": "none", "k": "v"}}], [rule("o.k", "k"), rule("o.m.x", "x")], [parser("regexp", "o.m", PAIR["format"])], {0: {"k": "v"}}),
    "levels stop at a parser": ("", [{"m": "12-ab", "k": "v"}], [rule("m.x", "x"), rule("k", "k")], [PAIR], {0: {"x": "12"}}),
    "colours go before decoding": ("", ['{"a":"\\u001b[31mred\\u001b[0m"}'], [rule("a", "a")], [parser("strip_ansi", "")], {0: {"a": "red"}}),
    "first pruning engine": ("log_prune", [{"m": "12-ab", "n": None}, {"m": "none"}, {"m": ""}], [rule("m.x", "x", "long")], [PAIR], {0: {"m": {"y": "ab"}, "x": 12}, 2: {"m": ""}}),
    "with the text itself": ("log_prune", [{"m": "12-ab"}], [rule("m.__origin__", "o"), {"rule_type": "remove", "origin_field": "m.x"}], [PAIR], {0: {"m": {"y": "ab"}, "o": "12-ab"}}),
    "outer and inner parsers": ("log_prune", [{"m": json.dumps({"l": "12-ab", "n": None, "k": 1})}], [rule("m.l.y", "y"), {"rule_type": "graft", "origin_field": "m.k", "key": "k"}], [parser("regexp", "m.l", PAIR["format"]), parser("json", "m")], {0: {"m": {"l": {"x": "12"}}, "y": "ab", "k": 1}}),
    "nulls go where parsers pass": ("log_prune", [{"o": {"m": "12-ab", "n": None}, "p": {"n": None}}], [rule("z", "z")], [parser("regexp", "o.m", PAIR["format"])], {0: {"o": {"m": {"x": "12", "y": "ab"}}, "p": {"n": None}}}),
    "only the pieces that rules read": ("log_prune", [{"m": "a/b/c"}], [rule("m.1", "one")], [parser("split", "m", "/")], {0: {"one": "b"}}),
    "all pieces without such rules": ("log_prune", [{"m": "a/b"}], [], [parser("split", "m", "/")], {0: {"m": {"0": "a", "1": "b"}}}),
    "nulls go without rules too": ("log_prune", [{"a": None, "b": 1}, {"a": None}], [], [], {0: {"b": 1}}),
    "second pruning engine: beside the field": ("log_prune_v2", [{"m": "12-ab", "n": None}], [rule("x", "x", "long")], [PAIR], {0: {"m": "12-ab", "x": 12, "y": "ab"}}),
    "the first that parses": ("log_prune_v2", [{"m": "12-ab"}, {"m": '{"j":1}'}, {"m": "none"}], [], [parser("json", "m"), PAIR], {0: {"m": "12-ab", "x": "12", "y": "ab"}, 1: {"m": {"j": 1}}}),
    "all that parse": ("log_prune_v2", [{"m": "12-ab"}], [], [parser("split", "m", "-"), PAIR], {0: {"m": "12-ab", "m_split_0": "12", "m_split_1": "ab", "x": "12", "y": "ab"}}, {"multi_pre_extract": True}),
    "all that parse, the last fails": ("log_prune_v2", [{"m": "none"}], [], [parser("split", "m", "-"), PAIR], {}, {"multi_pre_extract": True}),
}


@pytest.mark.parametrize("name", PARSERS)
def test_legacy_parsers(spark, name):
    version, docs, fields, parsers, want, *more = PARSERS[name]
    settings = {"pre_extract": parsers} | (more[0] if more else {}) | ({"prefix_match": ["m.q"]} if name == "levels stop at a parser" else {})
    assert run(spark, version, docs, fields, **settings) == want


def test_empty_results(spark):
    """A record without fields is no result in any engine, and is counted."""
    gone = {"fields_transform": [{"rule_type": "delete", "origin_field": "a"}]}
    df = spark.createDataFrame([('{"a":1}',), ('{"a":1,"b":2}',), ("{}",)], "raw string")
    assert compile_settings(gone)(df).count() == 1
    assert sorted(r.status for r in compile_settings(gone, statuses=True)(df).collect()) == ["empty_result", "empty_result", "ok"]
    with pytest.raises(ValueError):
        compile_settings({}, version="")


SLOW = r"""#\s+Time:\s+(?P<Time>.+)\n#\s+User@Host:\s+(?P<user>\w+)\[\w+\]\s+@\s+(?P<proxyHost>(\w|\[|\]|\.|\s)+)\s+Id:\s+(?P<threadID>\d+)\n# Schema: (?P<Killed>\w+)  Killed: (?P<Killed>\d+)\n(use\s+(?P<use>.*);\n)?SET\s+timestamp=(?P<at>\d+);\n(?P<sqlText>(.|\n)*)"""
STATEMENT = "SELECT\n a,b \n FROM orders\n\nAND (code = '' AND item IN (7));"
APP = r"(?P<time>\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3})\s+\[(?P<pod>(.*?))\]\s+(?P<level>.*)\s+(?P<class>.*)\s+\-\s+\[(?P<id>.*)\]\-\[(?P<trace>.*)\]\s+\[(?P<fields>.*)\]\s+(?P<msg>[\s\S]*)"
GOLDEN = {
    "app log": ({"log": '2024-05-07 11:50:11.758 [pod-1] INFO  c.m.Handler - []-[a4d5] [{"k":"v"}] url=http://h/x, request=null\nmore', "env": "test"}, [parser("regexp", "log", APP)], {"time": "2024-05-07 11:50:11.758", "pod": "pod-1", "level": "INFO ", "class": "c.m.Handler", "id": "", "trace": "a4d5", "fields": '{"k":"v"}', "msg": "url=http://h/x, request=null\nmore"}),
    "slow statement": ({"message": f"# Time: 2024-11-06T08:40:05.5Z\n# User@Host: app[app] @  [10.1.1.2]  Id: 95\n# Schema: shop  Killed: 0\nuse shop;\nSET timestamp=1730882405;\n{STATEMENT * 60_000}", "tags": '{"env":"x","n":{"z":1}}'}, [parser("regexp", "message", SLOW), parser("json", "tags")], {"Time": "2024-11-06T08:40:05.5Z", "user": "app", "proxyHost": "[10.1.1.2] ", "threadID": "95", "Killed": "0", "use": "shop", "at": "1730882405", "sqlText": STATEMENT * 60_000, "tags": {"env": "x", "n": {"z": 1}}}),
    "ingress line": ({"log": json.dumps({"log": '10.0.0.1 - - [15/Apr/2025] "GET /o/1 HTTP/2.0" 200 [up-80] [] 10.2.3.4:8080 0.001 1023202\n', "stream": "out"}), "f": 1}, [parser("json", "log"), parser("gonx", "log.log", '$addr - $user [$time] "$request" $status [$up] [$other] $to $took $id')], None),
}


@pytest.mark.parametrize("overwrite", [False, True])
@pytest.mark.parametrize("version", ["log_prune_v2", "log_transform"])
@pytest.mark.parametrize("name", GOLDEN)
def test_golden_documents(spark, name, version, overwrite):
    """Whole documents through the second pruning engine and, converted, through the transformer: one result."""
    doc, parsers, found = GOLDEN[name]
    got = run(spark, version, [doc], [], pre_extract=parsers, overwrite_origin=overwrite)[0]
    if name == "ingress line":
        inner = {"addr": "10.0.0.1", "user": "-", "time": "15/Apr/2025", "request": "GET /o/1 HTTP/2.0", "status": "200", "up": "up-80", "other": "", "to": "10.2.3.4:8080", "took": "0.001", "id": "1023202\n"}
        log = json.loads(doc["log"])
        assert got == {"f": 1, "log": {"log": inner, "stream": "out"} if overwrite else log | inner}
        return
    field = parsers[0]["field"]
    rest = {k: v for k, v in found.items() if k != "tags"}
    tags = {"tags": found["tags"]} if "tags" in found else {}
    assert got == (doc | {field: rest} | tags if overwrite else doc | rest | tags)


@pytest.mark.parametrize("name", CASES)
def test_legacy_rules(spark, name):
    version, docs, fields, want = CASES[name]
    more = {"prefix_match": ["a.b"]} if name == "levels of prefixes" else {}
    assert run(spark, version, docs, fields, **more) == want


def test_now(spark):
    fields = [{"rule_type": "append", "key": "t", "value_type": "date", "extention": {"append_value": "NOW"}}]
    for version in ("", "log_prune", "log_prune_v2"):
        assert run(spark, version, [{"a": "1"}], fields)[0]["t"].startswith("20")


def test_flatten_reaches_every_depth(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":{"c":{"d":{"e":1,"n":null}}}},"x":[1]}'), (2, "{}")], "k int, raw string")
    rows = R.flatten(df.select("k", R.decode(F.col("raw")).alias("rec")), keep=["k"]).collect()
    assert {(r.k, r.path, r.kind, r.value) for r in rows} == {(1, "a.b.c.d.e"[:n], "object", None) for n in (1, 3, 5, 7)} | {(1, "a.b.c.d.e", "number", "1"), (1, "x", "array", "[1]")}
    assert R.flatten(df.where("k > 5").select(R.decode(F.col("raw")).alias("rec"))).count() == 0


def test_typed_getters(spark):
    df = spark.createDataFrame([('{"a":1.5,"b":"7","c":"x","d":"0.5","e":true}',)], "raw string").select(R.decode(F.col("raw")).alias("rec"))
    got = df.select(*(f(R.get(F.col("rec"), k)).alias(f"{f.__name__}_{k}") for f in (M.get_float, M.get_long, M.get_text) for k in "abcde")).first().asDict()
    assert [got[f"get_float_{k}"] for k in "abcde"] == [1.5, 7.0, None, 0.5, None]
    assert [got[f"get_long_{k}"] for k in "abcde"] == [1, 7, None, None, None]
    assert [got[f"get_text_{k}"] for k in "abcd"] == ["1.5", "7", "x", "0.5"]


def test_own_columns_stay(spark):
    df = spark.createDataFrame([('{"a":"k=1","b":"x"}', "mine")], "raw string, __src string")
    made = compile_settings({"pre_extract": [{"mode": "key_value", "field": "a", "format": "{}"}], "fields_transform": [{"rule_type": "format", "origin_field": "b", "target_type": "text", "format_settings": {"format_type": "allmatch"}}]})(df)
    assert made.select("__src").first()[0] == "mine" and set(made.columns) == {"raw", "__src", "rec", "err"}


def test_an_address_has_one_place(spark):
    ranges = spark.createDataFrame([(16777216, 16843007, "wide"), (16777472, 16777727, "narrow"), (16777472, 16777727, "narrow"), (33554432, 33554433, "two")], "ip_from long, ip_to long, country string")
    df = spark.createDataFrame([("1.0.0.5",), ("1.0.1.7",), ("1.0.2.0",), ("2.0.0.1",), ("2.0.0.2",), ("10.0.0.1",), (None,)], "a string")
    rows = geoip(df, "a", ranges).collect()
    assert sorted((r.a or "", r.geoip.country if r.geoip else "") for r in rows) == [("", ""), ("1.0.0.5", "wide"), ("1.0.1.7", "narrow"), ("1.0.2.0", "wide"), ("10.0.0.1", ""), ("2.0.0.1", "two"), ("2.0.0.2", "")]


def test_repeated_dictionary_keys_do_not_multiply_rows(spark):
    dictionary = spark.createDataFrame([("k=1", {"v": "b"}), ("k=1", {"v": "a"}), ("k=2", {"v": "c"})], "src_key string, dst map<string,string>")
    df = spark.createDataFrame([('{"k":"1"}',), ('{"k":"3"}',)], "raw string").withColumn("rec", R.decode(F.col("raw")))
    assert sorted(r.j for r in with_dictionary(df, dictionary, ["k"], ["v"]).select(R.encode(F.col("rec")).alias("j")).collect()) == ['{"k":"1","v":"a"}', '{"k":"3","v":""}']


def test_logins_are_escaped_and_encrypted():
    out = KafkaSource(["b:9092"], ["t"], security="sasl_plain", user='a"b', secret="c\\d").options()
    assert out["kafka.security.protocol"] == "SASL_SSL" and 'username="a\\"b" password="c\\\\d";' in out["kafka.sasl.jaas.config"]


def test_edits_on_deep_paths_grow_with_depth_only(spark):
    """Twice the levels take about twice the steps of the plan, not their square."""

    def steps(depth):
        path = [f"k{n}" for n in range(depth)]
        fields = [{"rule_type": "remove", "origin_field": ".".join([*path, "gone"])}]
        text = json.dumps({"gone": 1, "stays": 2})
        for name in reversed(path):
            text = f'{{"{name}": {text}}}'
        rows = spark.createDataFrame([(text,)], "raw string")
        made = compile_task(load_task({"id": 1, "data_source_id": 1, "settings": {"version": "log_prune", "json_settings": {"fields": fields}}}))(rows)
        shown = made.select(R.encode(F.col("rec")).alias("out"))
        assert json.loads(shown.first().out) == json.loads(text.replace('"gone": 1, ', ""))
        return shown._jdf.queryExecution().optimizedPlan().toString().count("variant_get(")

    assert steps(8) <= 2.5 * steps(4)
