"""The automaton and the rewritten Java patterns against RE2 itself."""

import time
from dataclasses import replace

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logloom.functions import re2, regex
from logloom.operators.parsers import key_value_parser, regexp_parser, split_parser

DB = duckdb.connect()


def re2_groups(pattern, text, count):
    """The match and its groups by RE2, "" for those that took no part; None without a match."""
    if not DB.execute("select regexp_matches(?, ?)", [text, pattern]).fetchone()[0]:
        return None
    return [DB.execute(f"select regexp_extract(?, ?, {k})", [text, pattern]).fetchone()[0] for k in range(count + 1)]


PATTERNS = [
    r"(.|\n)*", r"(a|b)*c", r"(a|ab)(c|bcd)(d*)", r"(a+)+b", r"(a*)*", r"(a|b*)*c?", r"((a|\[|\]|\.|\s)+)x?", r"x(?:/[a-z]*)+y?", r"(?P<a>ab|a)(?P<b>b?)", r"a*?b", r"(a{2,3}?)(a*)", r"(?:a|b){3}$",
    r"\ba\b", r"\Bb", r"(?m)^b(.*)$", r"(?i)aB+", r"(?s)a.b", r"[^a]b", r"(|a)+b", r"(?:(a)|b)*", r"^(a|b|ab)*c$", r"\d+(?:\.\d+)*", r"(a|\b)*c", r"[[:alpha:]]+\W", r"\pL+x", r"(.*?)c(.*)", r"(?:ab|c)*a", r"\Qa|b\E|c",
]
TEXTS = ["", "a", "b", "ab", "abc", "abcd", "aaab", "aab\nb", "ba b", "c", "x/ab//cy", "a.b", "[a].x", "1.2.33.", "ABb", "äbx", "a|b", "bb\nbc", "aaaaaa", "ababac"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_automaton_equals_re2(pattern):
    m = re2.Machine(pattern)
    for text in TEXTS:
        assert m.groups(text) == re2_groups(pattern, text, len(m.names)), text


def test_java_equals_re2(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    compiled = [re2.compile_pattern(p) for p in PATTERNS]
    shown = [F.when(F.col("t").rlike(c.java), F.array(*(F.regexp_extract("t", c.java, k) for k in range(c.groups + 1)))).alias(f"p{n}") for n, c in enumerate(compiled)]
    for r in rows.select("t", *shown).collect():
        for n, (p, c) in enumerate(zip(PATTERNS, compiled, strict=True)):
            if c.limit == -1:  # Java never sees these
                continue
            assert r[f"p{n}"] == re2_groups(p, r.t, c.groups), (p, r.t, c.java)


def patterns():
    atom = st.sampled_from(["a", "b", "c", ".", "[ab]", "[^a]", r"\w", r"\s", r"\b", "^", "$", "(?:a|b)", "ab", r"\n"])
    grow = lambda inner: st.one_of(
        st.builds("({})".format, inner), st.builds("{}{}".format, inner, inner), st.builds("(?:{}|{})".format, inner, inner), st.builds("(?:{}){}".format, inner, st.sampled_from(["*", "+", "?", "*?", "+?", "??", "{2}", "{1,3}", "{2,}"])),
    )
    return st.recursive(atom, grow, max_leaves=8)


@settings(max_examples=400, deadline=None)
@given(patterns(), st.text(alphabet="abc \n", max_size=12))
def test_any_pattern_equals_re2(pattern, text):
    m = re2.Machine(pattern)
    assert m.groups(text) == re2_groups(pattern, text, len(m.names))


@settings(max_examples=40, deadline=None)
@given(patterns(), st.text(alphabet="abc \n", min_size=1, max_size=6), st.integers(200, 4000))
def test_long_texts_equal_re2(pattern, text, times):
    m = re2.Machine(pattern)
    assert m.groups(text * times + "ac") == re2_groups(pattern, text * times + "ac", len(m.names))


def test_replacement_and_split_of_long_texts(spark):
    """Java and the automaton give the same on the same texts, whichever is asked."""
    texts = [(t * n,) for t in ("ab, c;b ", "aab.b-", "x", "b,b", "") for n in (1, 3, 40)]
    rows = spark.createDataFrame(texts, "t string")
    for source in (r"((?:ab|a|b)+)[,;]?", r"(a|bb)*c?", r"(?:\s*[,;]\s*)+", "b*"):
        java = replace(re2.compile_pattern(source), limit=None)
        slow = replace(java, limit=-1)
        t = F.col("t")
        pair = [(regex.replaced(t, p, "<$1>"), regex.split_by(t, p), regex.split_by(t, p, 2), regex.found(t, p), regex.group(t, p, 0)) for p in (java, slow)]
        cols = [c.alias(f"c{k}_{n}") for k, own in enumerate(pair) for n, c in enumerate(own)]
        for r in rows.select("t", *cols).collect():
            assert [r[f"c0_{n}"] for n in range(5)] == [r[f"c1_{n}"] for n in range(5)], (source, r)


SLOW = r"""#\s+Time:\s+(?P<Time>.+)\n#\s+User@Host:\s+(?P<user>\w+)\[\w+\]\s+@\s+(?P<host>(\w|\[|\]|\.|\s)+)\s+Id:\s+(?P<id>\d+)\n(use\s+(?P<use>.*);\n)?SET\s+timestamp=(?P<at>\d+);\n(?P<sql>(.|\n)*)"""


def slow_line(n):
    return "# Time: 2024-11-06T08:40:05Z\n# User@Host: app[app] @  [10.1.1.2]  Id: 77\nuse shop;\nSET timestamp=1730882405;\n" + "SELECT a,\n b FROM t;\n" * (n // 20)


def test_a_statement_of_a_megabyte(spark):
    """A slow query's log with a long statement, one with a host of many names, and loops that Java can't run: all in seconds."""
    long, hosts = slow_line(1_000_000), slow_line(10).replace("[10.1.1.2]", "h. " * 100_000)
    rows = spark.createDataFrame([(1, long), (2, hosts), (3, "no such line" * 50_000)], "k int, t string")
    began = time.time()
    got = {r.k: r.m for r in rows.select("k", regex.named_groups(F.col("t"), regex.translate(SLOW)).alias("m")).collect()}
    assert got[1]["sql"] == long.split(";\n", 2)[2] and got[1]["use"] == "shop" and got[2]["host"].startswith("h. h.") and got[3] is None
    for pattern in (r"((?:ab|a|b|\n)*?)c", r"(a|b|ab)*$", r"^(?:(?:a|b)+\n?)*$", r"((\w|\[|\]|\.|\s)+)"):
        text = "ab\n" * 100_000
        one = spark.createDataFrame([(text,)], "t string").select(regex.found(F.col("t"), regex.translate(pattern)).alias("m")).first().m
        assert one == DB.execute("select regexp_matches(?, ?)", [text, pattern]).fetchone()[0]
    assert time.time() - began < 60


def test_parsers_with_deep_loops(spark):
    long = "k=" + "ab" * 5000
    rows = spark.createDataFrame([(1, f"{long};x=1;junk y;z=2"), (2, "k=1;9q=2"), (3, None)], "k int, t string")
    key = key_value_parser('{"field_delimiter": ";", "key_pattern": "(?:[a-z]|ab|b)+"}')
    got = {r.k: r.m for r in rows.select("k", F.to_json(key(F.col("t"))).alias("m")).collect()}
    assert got == {1: '{"k":"' + "ab" * 5000 + '","x":"1;junk y","z":"2"}', 2: '{"k":"1;9q=2"}', 3: None}
    parts = split_parser('{"delimiter": "/(?:;|, |,)+/"}')
    assert [r.n for r in rows.select(F.size(parts(F.col("t"))).alias("n")).where("n > 0").collect()] == [4, 2]
    deep = regexp_parser(r"^k=(?P<v>(?:a|ab|b)*)(?P<rest>;.*)$")
    found = {r.k: r.m for r in rows.select("k", F.to_json(deep(F.col("t"))).alias("m")).collect()}
    assert found[1].startswith('{"rest":";x=1;junk y;z=2"') or '"rest":";x=1;junk y;z=2"' in found[1]
    assert found[2] is None and found[3] is None


def test_empty_matches_as_in_go(spark):
    """Empty matches just behind others do not count; pieces are those of Go's Split."""
    row = spark.createDataFrame([("abaabaccadaaae",)], "t string")
    t, p = F.col("t"), regex.translate("a*")
    assert row.select(regex.split_by(t, p, 5)).first()[0] == ["", "b", "b", "c", "cadaaae"]
    assert row.select(regex.replaced(t, regex.translate("x*"), "-")).first()[0] == "-" + "-".join("abaabaccadaaae") + "-"
    assert row.select(regex.replaced(t, regex.translate("b*"), "-")).first()[0] == "-a-a-a-a-c-c-a-d-a-a-a-e-"


def test_which_patterns_leave_the_jvm():
    limit = lambda p: re2.compile_pattern(p).limit
    assert [limit(p) for p in (r"(.|\n)*", r"(?:/[a-z]*)+", r"(\w|\.)+@", r"c=(?P<n>\d+) \[(\w)\] (.*)$", r'"[^\\"]*(?:\\.[^\\"]*)*"')] == [None] * 5
    assert limit(r"((a|b)+|c)+d") is None and limit(r"(ab|a)*c") == 400 and limit(r"((a|ab)+|c)+d") == limit(r"(a*)*") == -1 and limit(r"(.*) (.*) x") == re2.AMBIGUOUS
    with pytest.raises(re2.UnsupportedPattern):
        re2.Machine("(?:(?:a{1000}){1000})*")


@pytest.mark.parametrize("pattern", ["a**", "*a", "a{2}{3}", "a{1001}", "a{3,2}", "[b-a]", "[a", "(a", "a)", r"\8", r"\y", "[[:nope:]]", "(?z)a", r"\p{nope}", "a+*"])
def test_what_re2_refuses(pattern):
    with pytest.raises(re2.UnsupportedPattern):
        re2.compile_pattern(pattern)
    with pytest.raises(Exception):
        DB.execute("select regexp_matches('a', ?)", [pattern]).fetchone()
