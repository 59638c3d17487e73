"""RE2 patterns on columns of text, and the template languages that compile to them.

Texts that Java's engine can match without harm stay in the JVM; longer ones, where a pattern's loops could exhaust its stack or its time, go through an
automaton in Arrow batches (``re2``).  Patterns without such loops have no Python in their plan.
"""

from __future__ import annotations

import re
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .re2 import Pattern, UnsupportedPattern, compile_pattern, machine

__all__ = ["GROK", "Pattern", "UnsupportedPattern", "from_grok", "from_nginx_template", "group", "matches", "named_groups", "replacement", "replaced", "split_by", "translate"]


def translate(pattern: str) -> Pattern:
    """A Java pattern with RE2's meaning: named groups by position, ``$`` only at the very end, ``.`` without line feeds alone."""
    return compile_pattern(pattern)


def _template(template: str, names: tuple[str | None, ...]) -> list[str | int]:
    """A Go replacement template (``$1``, ``${1}``, ``$name``) as texts and numbers of groups; unknown groups are left out."""
    out, at = [], 0
    for m in re.finditer(r"\$\$|\$\{(\w+)\}|\$(\w+)", template):
        out.append(template[at : m.start()])
        at, name = m.end(), m[1] or m[2]
        if name is None:
            out.append("$")
            continue
        number = int(name) if name.isdigit() else (max((i for i, n in enumerate(names, 1) if n == name), default=-1))
        if 0 <= number <= len(names):
            out.append(number)
    return [p for p in [*out, template[at:]] if p != ""]


def replacement(template: str, names: tuple[str | None, ...]) -> str:
    """The template as Java's."""
    # Java reads on through further digits as long as such a group exists
    return "".join(f"${p}" if isinstance(p, int) else re.sub(r"[\\$]", r"\\\g<0>", p) for p in _template(template, names))


def _groups(source: str):
    """Arrow function: the first match of each text and its groups."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(machine(source).groups, na_action="ignore").astype(object)

    return run


def _long(text: Column, pattern: Pattern) -> Column:
    """The texts that are not for Java; null for the others."""
    return F.when(F.char_length(text) > pattern.limit, text)


def _either(text: Column, pattern: Pattern, java: Column, other: Column) -> Column:
    return F.when(F.char_length(text) <= pattern.limit, java).otherwise(other)


def found(text: Column, pattern: Pattern) -> Column:
    """True where the pattern is found."""
    java = text.rlike(pattern.java)
    if pattern.limit is None:
        return java
    return _either(text, pattern, java, F.when(text.isNotNull(), _groups(pattern.source)(_long(text, pattern)).isNotNull()))


def matches(text: Column, pattern: str) -> Column:
    """True where RE2 would find the pattern."""
    return found(text, translate(pattern))


def group(text: Column, pattern: Pattern, number: int) -> Column:
    """What a group of the first match holds; "" where it took no part, or nothing matches."""
    java = F.regexp_extract(text, pattern.java, number)
    if pattern.limit is None:
        return java
    other = F.coalesce(F.element_at(_groups(pattern.source)(_long(text, pattern)), number + 1), F.when(text.isNotNull(), ""))
    return _either(text, pattern, java, other)


def named_groups(text: Column, pattern: Pattern, keep: set[str] | None = None) -> Column:
    """Map of the named groups of the first match; null without a match.  Of equal names the last counts."""
    last = {n: i for i, n in enumerate(pattern.names, 1) if n and (keep is None or n in keep)}
    pairs = [x for n, i in last.items() for x in (F.lit(n), group(text, pattern, i))]
    made = F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string,string>)")
    return F.when(found(text, pattern), made)


def _without_empty(pattern: Pattern) -> Pattern:
    """A pattern that can match nothing goes through the automaton where all matches count."""
    return replace(pattern, limit=-1) if pattern.empty else pattern


def replaced(text: Column, pattern: Pattern, template: str, deep: Column | None = None) -> Column:
    """All matches replaced by a Go template.  ``deep`` says which texts are not for Java, where more is known of the pattern than its limit."""
    java, pattern = F.regexp_replace(text, pattern.java, replacement(template, pattern.names)), _without_empty(pattern)
    if pattern.limit is None:
        return java
    source, parts = pattern.source, _template(template, pattern.names)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str) -> str:
            out, at = [], 0
            for slots in machine(source).matches(t):
                out.append(t[at : slots[0]])
                out += [p if isinstance(p, str) else t[slots[2 * p] : slots[2 * p + 1]] if slots[2 * p] >= 0 else "" for p in parts]
                at = slots[1]
            return "".join([*out, t[at:]])

        return texts.map(one, na_action="ignore").astype(object)

    if deep is not None:
        return F.when(deep, run(F.when(deep, text))).otherwise(java)
    return _either(text, pattern, java, run(_long(text, pattern)))


def split_by(text: Column, pattern: Pattern, limit: int = -1) -> Column:
    """Pieces between the matches, at most ``limit`` where that is positive."""
    java, pattern = F.split(text, pattern.java, limit), _without_empty(pattern)
    if pattern.limit is None:
        return java
    source = pattern.source

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str) -> list[str]:
            out, at, end = [], 0, -1
            for slots in machine(source).matches(t):
                if len(out) == limit - 1:
                    break
                end = slots[0]
                if slots[1]:
                    out.append(t[at:end])
                at = slots[1]
            return out if t and end == len(t) else [*out, t[at:]]

        return texts.map(one, na_action="ignore").astype(object)

    return _either(text, pattern, java, run(_long(text, pattern)))


def found_in_each(texts: Column, pattern: Pattern) -> Column:
    """For each text of an array, whether the pattern is found."""
    java = F.transform(texts, lambda t: t.rlike(pattern.java))
    if pattern.limit is None:
        return java
    source = pattern.source
    short = F.forall(texts, lambda t: t.isNull() | (F.char_length(t) <= pattern.limit))

    @F.pandas_udf("array<boolean>")
    def run(lists: pd.Series) -> pd.Series:
        return lists.map(lambda own: [None if t is None else machine(source).search(t) is not None for t in own], na_action="ignore").astype(object)

    return F.when(short, java).otherwise(run(F.when(~short, texts)))


def from_nginx_template(template: str) -> Pattern:
    """``$name`` stands for all characters up to the next literal one, the last for all up to a blank (line ends among them); more may follow."""
    out, at = ["^"], 0
    found = list(re.finditer(r"\$([A-Za-z0-9_]+)", template))
    if not found:
        raise UnsupportedPattern("no field in the template")
    names = []
    for k, m in enumerate(found):
        out.append(re.sub(r"([^A-Za-z0-9 ])", r"\\\1", template[at : m.start()]))
        follows = template[m.end() : m.end() + 1]
        out.append("([^ ]*)" if not follows else "([^" + re.sub(r"([^A-Za-z0-9 ])", r"\\\1", follows) + "]*)")
        names.append(m[1])
        at = m.end()
    out.append(re.sub(r"([^A-Za-z0-9 ])", r"\\\1", template[at:]))
    return Pattern("(?d)" + "".join(out), tuple(names))


# The public default definitions of grok libraries whose engine has no lookaround.  Quoted texts are written without nested
# repeats: the same texts match, but an open quote takes no exponential time, and only escapes take space on the stack.
GROK = {
    "USERNAME": r"[a-zA-Z0-9._-]+",
    "USER": r"%{USERNAME}",
    "EMAILLOCALPART": r"[a-zA-Z][a-zA-Z0-9_.+-=:]+",
    "EMAILADDRESS": r"%{EMAILLOCALPART}@%{HOSTNAME}",
    "HTTPDUSER": r"%{EMAILADDRESS}|%{USER}",
    "INT": r"(?:[+-]?(?:[0-9]+))",
    "BASE10NUM": r"([+-]?(?:[0-9]+(?:\.[0-9]+)?)|\.[0-9]+)",
    "NUMBER": r"(?:%{BASE10NUM})",
    "BASE16NUM": r"(0[xX]?[0-9a-fA-F]+)",
    "POSINT": r"\b(?:[1-9][0-9]*)\b",
    "NONNEGINT": r"\b(?:[0-9]+)\b",
    "WORD": r"\b\w+\b",
    "NOTSPACE": r"\S+",
    "SPACE": r"\s*",
    "DATA": r".*?",
    "GREEDYDATA": r".*",
    "QUOTEDSTRING": r"""(?:"[^\\"]*(?:\\.[^\\"]*)*"|'[^\\']*(?:\\.[^\\']*)*'|`[^\\`]*(?:\\.[^\\`]*)*`)""",
    "UUID": r"[A-Fa-f0-9]{8}-(?:[A-Fa-f0-9]{4}-){3}[A-Fa-f0-9]{12}",
    "MAC": r"(?:%{CISCOMAC}|%{WINDOWSMAC}|%{COMMONMAC})",
    "CISCOMAC": r"(?:(?:[A-Fa-f0-9]{4}\.){2}[A-Fa-f0-9]{4})",
    "WINDOWSMAC": r"(?:(?:[A-Fa-f0-9]{2}-){5}[A-Fa-f0-9]{2})",
    "COMMONMAC": r"(?:(?:[A-Fa-f0-9]{2}:){5}[A-Fa-f0-9]{2})",
    "IPV6": r"(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}",
    "IPV4": r"(?:(?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2})[.](?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2})[.](?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2})[.](?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2}))",
    "IP": r"(?:%{IPV6}|%{IPV4})",
    "HOSTNAME": r"\b(?:[0-9A-Za-z][0-9A-Za-z-]{0,62})(?:\.(?:[0-9A-Za-z][0-9A-Za-z-]{0,62}))*(\.?|\b)",
    "HOST": r"%{HOSTNAME}",
    "IPORHOST": r"(?:%{IP}|%{HOSTNAME})",
    "HOSTPORT": r"%{IPORHOST}:%{POSINT}",
    "PATH": r"(?:%{UNIXPATH}|%{WINPATH})",
    "UNIXPATH": r"(/[\w_%!$@:.,-]?/?)(\S+)?",
    "TTY": r"(?:/dev/(pts|tty([pq])?)(\w+)?/?(?:[0-9]+))",
    "WINPATH": r"([A-Za-z]:|\\)(?:\\[^\\?*]*)+",
    "URIPROTO": r"[A-Za-z]+(\+[A-Za-z+]+)?",
    "URIHOST": r"%{IPORHOST}(?::%{POSINT:port})?",
    "URIPATH": r"(?:/[A-Za-z0-9$.+!*'(){},~:;=@#%_\-]*)+",
    "URIPARAM": r"\?[A-Za-z0-9$.+!*'|(){},~@#%&/=:;_?\-\[\]<>]*",
    "URIPATHPARAM": r"%{URIPATH}(?:%{URIPARAM})?",
    "URI": r"%{URIPROTO}://(?:%{USER}(?::[^@]*)?@)?(?:%{URIHOST})?(?:%{URIPATHPARAM})?",
    "MONTH": r"\b(?:Jan(?:uary|uar)?|Feb(?:ruary|ruar)?|M(?:a|ä)?r(?:ch|z)?|Apr(?:il)?|Ma(?:y|i)?|Jun(?:e|i)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|O(?:c|k)?t(?:ober)?|Nov(?:ember)?|De(?:c|z)(?:ember)?)\b",
    "MONTHNUM": r"(?:0?[1-9]|1[0-2])",
    "MONTHNUM2": r"(?:0[1-9]|1[0-2])",
    "MONTHDAY": r"(?:(?:0[1-9])|(?:[12][0-9])|(?:3[01])|[1-9])",
    "DAY": r"(?:Mon(?:day)?|Tue(?:sday)?|Wed(?:nesday)?|Thu(?:rsday)?|Fri(?:day)?|Sat(?:urday)?|Sun(?:day)?)",
    "YEAR": r"(\d\d){1,2}",
    "HOUR": r"(?:2[0123]|[01]?[0-9])",
    "MINUTE": r"(?:[0-5][0-9])",
    "SECOND": r"(?:(?:[0-5]?[0-9]|60)(?:[:.,][0-9]+)?)",
    "TIME": r"([^0-9]?)%{HOUR}:%{MINUTE}(?::%{SECOND})([^0-9]?)",
    "DATE_US": r"%{MONTHNUM}[/-]%{MONTHDAY}[/-]%{YEAR}",
    "DATE_EU": r"%{MONTHDAY}[./-]%{MONTHNUM}[./-]%{YEAR}",
    "ISO8601_TIMEZONE": r"(?:Z|[+-]%{HOUR}(?::?%{MINUTE}))",
    "ISO8601_SECOND": r"(?:%{SECOND}|60)",
    "TIMESTAMP_ISO8601": r"%{YEAR}-%{MONTHNUM}-%{MONTHDAY}[T ]%{HOUR}:?%{MINUTE}(?::?%{SECOND})?%{ISO8601_TIMEZONE}?",
    "DATE": r"%{DATE_US}|%{DATE_EU}",
    "DATESTAMP": r"%{DATE}[- ]%{TIME}",
    "TZ": r"(?:[PMCE][SD]T|UTC)",
    "DATESTAMP_RFC822": r"%{DAY} %{MONTH} %{MONTHDAY} %{YEAR} %{TIME} %{TZ}",
    "DATESTAMP_RFC2822": r"%{DAY}, %{MONTHDAY} %{MONTH} %{YEAR} %{TIME} %{ISO8601_TIMEZONE}",
    "DATESTAMP_OTHER": r"%{DAY} %{MONTH} %{MONTHDAY} %{TIME} %{TZ} %{YEAR}",
    "DATESTAMP_EVENTLOG": r"%{YEAR}%{MONTHNUM2}%{MONTHDAY}%{HOUR}%{MINUTE}%{SECOND}",
    "HTTPDERROR_DATE": r"%{DAY} %{MONTH} %{MONTHDAY} %{TIME} %{YEAR}",
    "HTTPDATE": r"%{MONTHDAY}/%{MONTH}/%{YEAR}:%{TIME} %{INT}",
    "SYSLOGTIMESTAMP": r"%{MONTH} +%{MONTHDAY} %{TIME}",
    "PROG": r"[\x21-\x5a\x5c\x5e-\x7e]+",
    "SYSLOGPROG": r"%{PROG:program}(?:\[%{POSINT:pid}\])?",
    "SYSLOGHOST": r"%{IPORHOST}",
    "SYSLOGFACILITY": r"<%{NONNEGINT:facility}.%{NONNEGINT:priority}>",
    "SYSLOGBASE": r"%{SYSLOGTIMESTAMP:timestamp} (?:%{SYSLOGFACILITY} )?%{SYSLOGHOST:logsource} %{SYSLOGPROG}:",
    "QS": r"%{QUOTEDSTRING}",
    "LOGLEVEL": r"([Aa]lert|ALERT|[Tt]race|TRACE|[Dd]ebug|DEBUG|[Nn]otice|NOTICE|[Ii]nfo|INFO|[Ww]arn?(?:ing)?|WARN?(?:ING)?|[Ee]rr?(?:or)?|ERR?(?:OR)?|[Cc]rit?(?:ical)?|CRIT?(?:ICAL)?|[Ff]atal|FATAL|[Ss]evere|SEVERE|EMERG(?:ENCY)?|[Ee]merg(?:ency)?)",
    "COMMONAPACHELOG": r'%{IPORHOST:clientip} %{HTTPDUSER:ident} %{USER:auth} \[%{HTTPDATE:timestamp}\] "(?:%{WORD:verb} %{NOTSPACE:request}(?: HTTP/%{NUMBER:httpversion})?|%{DATA:rawrequest})" %{NUMBER:response} (?:%{NUMBER:bytes}|-)',
    "COMBINEDAPACHELOG": r"%{COMMONAPACHELOG} %{QS:referrer} %{QS:agent}",
}


def from_grok(expression: str, more: dict[str, str] | None = None) -> tuple[Pattern, dict[str, str]]:
    """The pattern of a grok expression, and the types of its typed fields."""
    known, kinds = GROK | (more or {}), {}

    def expand(text: str, depth: int) -> str:
        if depth > 20:
            raise UnsupportedPattern("patterns refer to each other")

        def one(m: re.Match) -> str:
            if m[1] not in known:
                raise UnsupportedPattern(f"no pattern {m[1]}")
            name = re.sub(r"\W", "_", m[2]) if m[2] else None
            if name and m[3]:
                kinds[name] = m[3]
            body = expand(known[m[1]], depth + 1)
            return f"(?P<{name}>{body})" if name else f"(?:{body})"

        return re.sub(r"%\{(\w+)(?::([\w.\[\]@-]+))?(?::(\w+))?\}", one, text)

    return translate(expand(expression, 0)), kinds
