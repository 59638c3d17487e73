import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logloom.functions import regex

PATTERNS = [r"^a.c$", r"(?P<x_y>\d+)-(\w)", r"[[:alpha:]]+\s", r"(?i)AB", r"[a&&b\]]x", r"\x{41}b", r"a$|b", r"(a|b)*c", r"\bfoo\b", r"\bfo", r"o\B", r"[^\s]x", r"(?s)a.b", r"(?m)^b$"]
TEXTS = ["abc", "a\rc", "abc\n", "12-q", "ab ", "xAb", "&x", "Ab", "a\n", "ababc", "foo bar", "äfoo", "fooß", "a\nb", "", "b", "\vx", "]x"]


def test_same_matches_as_re2(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    c = duckdb.connect()
    for p in PATTERNS:
        got = {r.t: r.m for r in rows.select("t", regex.matches(F.col("t"), p).alias("m")).collect()}
        want = {t: c.execute("select regexp_matches(?, ?)", [t, p]).fetchone()[0] for t in TEXTS}
        assert got == want, p


@pytest.mark.parametrize("pattern", [r"(?<=a)b", r"(?!a)", r"(a)\1", "a*+", r"(?>a)", "a\\Z", "(?U)a*"])
def test_what_re2_lacks_is_refused(pattern):
    with pytest.raises(regex.UnsupportedPattern):
        regex.translate(pattern)


def test_last_of_equal_names_counts(spark):
    p = regex.translate(r"(?P<a>\d)(?P<a>\d)?")
    row = spark.createDataFrame([("12",), ("3",)], "t string").select(regex.named_groups(F.col("t"), p).alias("m")).collect()
    assert [r.m for r in row] == [{"a": "2"}, {"a": ""}]


def test_replacement_templates():
    assert regex.replacement("$1****$2", (None, None)) == "$1****$2"
    assert regex.replacement("<${w}>$x$$", ("w",)) == r"<$1>\$"
    assert regex.replacement("$1x", (None,)) == ""


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc.$|()*+?[]\\d^{}1", max_size=8))
def test_translation_never_breaks_otherwise(pattern):
    try:
        regex.translate(pattern)
    except regex.UnsupportedPattern:
        pass


SAMPLES = [
    "0011.2233.4455", "00-11-22-33-44-55", "00:11:22:33:44:55", "10.1.2.3", "fe80::1:2", "web-1.example.org.", "a.b+c@host", "/var/log/a b", "/dev/pts/3", "C:\\x\\y", "http://u:p@h:80/p?q=1", "März", "May", "June",
    "23:59", "23:59:60.5", "2024-02-03T04:05:06Z", "03.02.2024 04:05:06", "Mon Feb 3 04:05:06 UTC 2024", "Feb  3 04:05:06 h app[12]: x", "wArN", "WARNING", "Emergency", "'a \\' b'", '"open', "-1.5", ".5", "0xff", "",
    '10.0.0.1 - bob [03/Feb/2024:04:05:06 +0100] "GET /x HTTP/1.1" 200 12 "-" "agent 1"',
]


def test_grok_definitions_match_as_in_re2(spark):
    """Each definition finds in each sample what RE2 finds by it."""

    def plain(text):
        return re.sub(r"%\{(\w+)(?::\w+)?\}", lambda m: f"(?:{plain(regex.GROK[m[1]])})", text)

    found = [F.regexp_extract("t", f"({regex.from_grok(f'%{{{n}}}')[0].java})", 1).alias(n) for n in regex.GROK]
    got = {r.t: r for r in spark.createDataFrame([(t,) for t in SAMPLES], "t string").select("t", *found).collect()}
    c = duckdb.connect()
    for name in regex.GROK:
        for t in SAMPLES:
            assert got[t][name] == c.execute("select regexp_extract(?, ?)", [t, plain(regex.GROK[name])]).fetchone()[0], (name, t)


def test_grok_open_quote_is_cheap(spark):
    texts = spark.createDataFrame([("'" + "a" * 200_000,), ('"' + "a" * 200_000 + '"',)], "t string")
    assert [r.m for r in texts.select(regex.matches(F.col("t"), regex.GROK["QUOTEDSTRING"]).alias("m")).collect()] == [False, True]
