"""Scalar formats: text and number values to text, whole numbers, fractions and dates, as Column builders."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .record import kind, text, variant
from .regex import found, group, matches, replaced, translate

SPACES = " \t\n\v\f\r\x85\xa0"

# What the built-in masks look for and put in its place.
MASKS = {
    "phone": (r"([\+86]*1[3-9]{1}\d{1})\d{4}(\d{4,11})", "$1****$2"),
    "email": (r"[A-Za-z\d]+([-_.][A-Za-z\d]+)*(@([A-Za-z\d]+[-.])+[A-Za-z\d]{2,4})", "****$2"),
    "ip": (r"(\d{1,3}).\d{1,3}.\d{1,3}.\d{1,3}", "$1.****"),
    "bank_card": (r"([1-9]{1})(\d{11}|\d{13}|\d{14})(\d{4})", "****$3"),
    "id_card": (r"([\d]{4})[\d]{11}([\d]{2}[\d|Xx])", "$1****"),
    "access_key": (r"([a-zA-Z0-9]{4})(([a-zA-Z0-9]{26})|([a-zA-Z0-9]{12}))", "$1****"),
}
# Date directives and what they are in Go's reference time and in Java; longer ones come before their parts.
UNIX = {"%s%6N": ("unix_micro", 1_000_000), "%s%3N": ("unix_milli", 1000), "%s": ("unix", 1)}
DIRECTIVES = [("%Y", "2006", "yyyy"), ("%m", "01", "MM"), ("%b", "Jan", "MMM"), ("%B", "January", "MMMM"), ("%d", "02", "dd"), ("%H", "15", "HH"), ("%M", "04", "mm"), ("%S", "05", "ss"), ("%z", "0700", "xx"), ("%:z", "07:00", "xxx"), ("%N", "999999999", "SSSSSSSSS"), ("%3N", "999", "SSS")]


def strftime_to_layout(layout: str) -> str:
    """Directives as a layout of Go's reference time; the first of each counts."""
    for directive, (name, _) in UNIX.items():
        layout = layout.replace(directive, name, 1)
    for directive, go, _ in DIRECTIVES:
        layout = layout.replace(directive, go, 1)
    return layout


def layout_to_strftime(layout: str) -> str:
    """The way back; full month names come out as they went in."""
    for directive, (name, _) in UNIX.items():
        if layout == name:
            return directive
    for directive, go, _ in sorted(DIRECTIVES, key=lambda d: -len(d[1])):
        layout = layout.replace(go, directive, 1)
    return layout


def java_layout(directives: str) -> str:
    """A Java date pattern of directives; fractions of a second may follow the seconds even where the layout has none."""
    out, at = [], 0
    known = {d: j for d, _, j in DIRECTIVES}
    for m in re.finditer("%3N|%:z|%[A-Za-z]", directives):
        literal = directives[at : m.start()]
        out.append(re.sub(r"[^\W\d_]+", lambda x: f"'{x[0]}'", literal.replace("'", "''").replace("[", "'['").replace("]", "']'")))
        out.append(known.get(m[0], f"'{m[0]}'"))
        at = m.end()
        if m[0] == "%S" and not re.match(r"[.,]%", directives[at:]):
            out.append("[.SSSSSSSSS][.SSSSSS][.SSS][,SSSSSS][,SSS]")
    out.append(re.sub(r"[^\W\d_]+", lambda x: f"'{x[0]}'", directives[at:]))
    return "".join(out)


@dataclass
class TimeFormat:
    date_format: str = ""
    date_location: str = ""
    convert_to_utc8: bool = False


@dataclass
class FormatSettings:
    """One format: its type, what that needs, and the time format of date targets."""

    format_type: str = "allmatch"
    regexp: str = ""
    regexp_mapping: list[tuple[str, str]] = field(default_factory=list)
    method: str = ""
    replace: str = ""
    time_format: TimeFormat = field(default_factory=TimeFormat)


def is_unix(layout: str) -> bool:
    """Whether a layout's name or directive is one of whole numbers since 1970."""
    return layout in (*UNIX, *(n for n, _ in UNIX.values()))


def plain_number(value: Column) -> Column:
    """A number in its shortest decimal form, never with an exponent."""
    number = value.cast("double")
    short = number.cast("string")
    whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
    long_form = F.rtrim(number.cast("decimal(38,18)").cast("string"), F.lit("0"))
    return F.when(whole, number.cast("bigint").cast("string")).when(~short.contains("E"), short).otherwise(F.regexp_replace(F.coalesce(long_form, short), r"\.$", ""))


def to_long(value: Column) -> Column:
    """Base-10 whole numbers as BIGINT, all other text as 0."""
    return F.coalesce(F.when(value.rlike(r"^[+-]?[0-9]+\z"), value.try_cast("bigint")), F.lit(0).cast("bigint"))


def to_float(value: Column) -> Column:
    """Decimal and exponent notation as DOUBLE, all other text as 0."""
    return F.coalesce(F.when(value.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"), value.try_cast("double")), F.lit(0.0))


def to_date(value: Column, settings: TimeFormat) -> Column:
    """The instant of a text in a layout; null where it does not parse.  A layout without zone is in ``date_location``, UTC by default."""
    unit = {**{d: s for d, (_, s) in UNIX.items()}, **{n: s for n, s in UNIX.values()}}.get(settings.date_format)
    if unit:
        return F.when(value.rlike(r"^[+-]?[0-9]+\z"), F.timestamp_micros(value.try_cast("bigint") * F.lit(1_000_000 // unit)))
    pattern = java_layout(settings.date_format)
    zoned = "xx" in pattern
    at = F.try_to_timestamp(value, F.lit(pattern))
    if zoned or settings.date_location in ("", "UTC"):
        return at
    return F.to_utc_timestamp(at, settings.date_location)


def render_date(value: Column, directives: str, utc8: bool = False) -> Column:
    """An instant written with directives, at UTC or at +08:00."""
    for directive, (_, scale) in UNIX.items():
        if directives == directive:
            return F.floor(F.unix_micros(value) / F.lit(1_000_000 // scale)).cast("string")
    shown = java_layout(directives).replace("[.SSSSSSSSS][.SSSSSS][.SSS][,SSSSSS][,SSS]", "")
    moved = value + F.expr("INTERVAL 8 HOURS") if utc8 else value
    out = F.date_format(moved, shown.replace("xxx", "'@@:@@'").replace("xx", "'@@@@'"))
    return F.replace(F.replace(out, F.lit("@@:@@"), F.lit("+08:00" if utc8 else "+00:00")), F.lit("@@@@"), F.lit("+0800" if utc8 else "+0000"))


def extract(value: Column, regexp: str, legacy: bool = False) -> Column:
    """Group 1 of the first match; without a match, or without a group, the text as it is (the legacy form: empty)."""
    if legacy and regexp == "(.*)":
        return value
    pattern = translate(regexp)
    made = group(value, pattern, 1) if pattern.groups else (F.lit("") if legacy else value)
    return F.when(found(value, pattern), made).otherwise(F.lit("") if legacy else value)


def map_by_regexp(value: Column, rules: list[tuple[str, str]]) -> Column:
    """The constant of the first rule that matches, or the text as it is."""
    out = None
    for regexp, constant in rules:
        out = F.when(matches(value, regexp), constant) if out is None else out.when(matches(value, regexp), constant)
    return value if out is None else out.otherwise(value)


#: What a text must hold for a mask to find anything: cheap to look for, so that most texts skip the mask's own search.
GUARDS = {"phone": "[0-9]{11}", "email": "@", "bank_card": "[0-9]{16}", "id_card": "[0-9]{17}", "access_key": "[a-zA-Z0-9]{16}"}

#: What a text must hold for Java's engine to call itself often; such texts go through the automaton, however short.
CHAINS = {"email": r"@(?:[A-Za-z0-9]++[-.]){100}"}


def mask(value: Column, method: str, regexp: str = "", replace: str = "") -> Column:
    """Masked text."""
    if method == "md5":
        return F.md5(value)
    if method == "keep_first_last":
        return F.when(F.char_length(value) <= 2, value).otherwise(F.concat(F.left(value, F.lit(1)), F.lit("****"), F.right(value, F.lit(1))))
    if method == "keep_last_four":
        return F.when(F.char_length(value) <= 4, value).otherwise(F.concat(F.lit("****"), F.right(value, F.lit(4))))
    if method == "custom":
        pattern = translate(regexp)
        return replaced(value, pattern, replace)
    if method not in MASKS:
        raise ValueError(f"unknown mask {method}")
    regexp, replace = MASKS[method]
    masked = replaced(value, translate(regexp), replace, value.rlike(CHAINS[method]) if method in CHAINS else None)
    return F.when(value.rlike(GUARDS[method]), masked).otherwise(value) if method in GUARDS else masked


#: What counts as a path inside a text, and static files by extension.
PATH_PATTERN = r"(?:/[A-Za-z0-9$.+!*'(){},~:;=#%_\-]*)+"
STATIC = "gif|jpg|jpeg|png|svg|css|js|ico"
_UUID = r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"


def uri_path(value: Column, prefixes: list[tuple[str, str]] | None = None) -> Column:
    """The first path in a text with its variable segments named; "-" where there is none.

    ``prefixes`` are (path prefix, pattern with named groups): by the first that fits, what a group captures becomes ``:name``.
    """
    path = F.regexp_extract(value, translate(PATH_PATTERN).java, 0)
    named, hit = path, F.lit(False)
    for prefix, regexp in reversed(prefixes or []):
        pattern = translate(regexp)
        here = path.startswith(prefix) & found(path, pattern)
        made = path
        for i, name in enumerate(pattern.names, 1):
            if name:
                piece = group(path, pattern, i)
                made = F.when(piece != "", F.replace(made, piece, F.lit(f":{name}"))).otherwise(made)
        named, hit = F.when(here, made).otherwise(named), here | hit

    def segment(s: Column) -> Column:
        digits = F.char_length(F.regexp_replace(s, "[^0-9]", ""))
        length = F.char_length(s)
        return (
            F.when(hit & s.startswith(":"), s)
            .when(s.rlike(r"^[0-9]+\z"), ":id")
            .when((length > 8) & ((digits > 6) | (digits > length / 2)), ":uuid")
            .when((length >= 32) & s.rlike(_UUID), ":uuid")
            .otherwise(s)
        )

    parts = F.transform(F.split(F.regexp_replace(named, "^/+", ""), "/"), segment)
    last = F.element_at(parts, -1)
    extension = F.regexp_extract(last, rf"^.+\.({STATIC})\z", 1)
    page = F.when(last.rlike(r"^.{6,}\.html\z"), ":static.html")
    shown_last = F.when(extension != "", F.concat(F.lit(":static."), extension)).otherwise(F.coalesce(page, last))
    joined = F.concat(F.lit("/"), F.array_join(F.concat(F.slice(parts, F.lit(1), F.size(parts) - 1), F.array(shown_last)), "/"))
    return F.when(path == "", "-").when(path.rlike(r"^/+\z"), "/").otherwise(joined)


def uri_patterns(config: str) -> list[tuple[str, str]]:
    """(prefix, pattern) pairs of a JSON list of objects with prefix, pattern and order, in that order; incomplete ones go."""
    known = sorted(json.loads(config) if config else [], key=lambda e: e.get("order") or 0)
    return [(e["prefix"], e["pattern"]) for e in known if e.get("prefix") and e.get("pattern")]


def format_text(value: Column, settings: FormatSettings, prefixes: list[tuple[str, str]] | None = None) -> Column:
    """The text that a format type makes of a text."""
    kind_ = settings.format_type
    if kind_ == "allmatch":
        return value
    if kind_ == "regexp":
        return extract(value, settings.regexp)
    if kind_ == "regexp_mapping":
        return map_by_regexp(value, settings.regexp_mapping)
    if kind_ == "uripath":
        return uri_path(value, prefixes)
    if kind_ == "desensitize":
        return mask(value, settings.method, settings.regexp, settings.replace)
    raise ValueError(f"unknown format {kind_}")


def format_column(df: DataFrame, value: str, settings: FormatSettings, target: str, prefixes: list[tuple[str, str]] | None = None) -> DataFrame:
    """``df`` with __kind, __out (the VARIANT column ``value`` in its target type, as VARIANT) and __bad (an error text or null).

    Each step is a projection of its own: an expression that is used several times is then made once.
    """
    if target not in ("text", "long", "float", "date"):
        raise ValueError(f"unknown target type {target}")
    if target == "date" and not settings.time_format.date_format:
        raise ValueError("date_format is required")
    df = df.withColumns({"__kind": kind(F.col(value)), "__number": F.try_variant_get(value, "$", "double")})
    what, number = F.col("__kind"), F.col("__number")
    df = df.withColumn("__read", F.when(what == "string", text(F.col(value))).when(what == "number", plain_number(number)))
    df = df.withColumn("__made", format_text(F.col("__read"), settings, prefixes))
    made, good = F.col("__made"), what.isin("string", "number")
    as_number = (what == "number") & F.lit(settings.format_type == "allmatch")
    bad = F.when(~good, F.lit("origin value type not supported"))
    if target == "text":
        out = F.when(good, variant(made))
    elif target == "long":
        out = F.when(as_number, variant(number.try_cast("bigint"))).when(good, variant(to_long(made)))
    elif target == "float":
        out = F.when(as_number, variant(number)).when(good, variant(to_float(made)))
    else:
        unix = settings.time_format.date_format in (*UNIX, *(n for n, _ in UNIX.values()))
        source = F.when(as_number, number.try_cast("bigint").cast("string") if unix else F.lit(None)).otherwise(made)
        df = df.withColumn("__at", to_date(source, settings.time_format))
        bad = F.when(~good, F.lit("origin value type not supported")).when((what == "string") & (made == ""), F.lit("value was empty")).when(F.col("__at").isNull(), F.lit("invalid date string"))
        out = F.when(bad.isNull(), variant(F.col("__at")))
    return df.withColumns({"__out": out, "__bad": bad}).drop("__number", "__read", "__made", "__at")


def trim_space(value: Column) -> Column:
    """Without white space at both ends (the legacy allmatch)."""
    return F.btrim(value, F.lit(SPACES))


_CLOCK = r"([0-9]{1,2}):([0-9]{2}):([0-9]{2})(?:[.,][0-9]+)?"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
#: The layouts of detected times, in order: a pattern of three date parts and the clock, and whether the day comes first.  Only the first has a zone.
DETECTED = [
    (r"([0-9]{4})-([0-9]{2})-([0-9]{2})T" + _CLOCK + r"([+-])([0-9]{2}):([0-9]{2})", False),
    (r"([0-9]{4})-([0-9]{2})-([0-9]{2}) +" + _CLOCK, False),
    (r"([0-9]{4})-([0-9]{2})-([0-9]{2})T" + _CLOCK, False),
    (r"([0-9]{2})/([A-Za-z]{3})/([0-9]{4}):" + _CLOCK, True),
    (r"([0-9]{2})/([A-Za-z]{3})/([0-9]{4}) +" + _CLOCK, True),
    (r"([0-9]{2})-([A-Za-z]{3})-([0-9]{4}):" + _CLOCK, True),
    (r"([0-9]{2})-([A-Za-z]{3})-([0-9]{4}) +" + _CLOCK, True),
    (r"([0-9]{4})/([0-9]{2})/([0-9]{2}) +" + _CLOCK, False),
    (r"([0-9]{4})/([0-9]{2})/([0-9]{2}) +- +" + _CLOCK, False),
]


def detect_timestamp(value: Column) -> Column:
    """Unix seconds of a text: ten digits, thirteen digits, or one of the nine layouts; 0 if none.

    As in Go, hours may have one digit, a fraction of a second may follow, and a blank stands for several; times without a
    zone are the session's.
    """
    digits = value.try_cast("bigint")
    number = F.when(value.rlike(r"^[0-9]{10}\z") & (digits > 1_000_000_000), digits).when(value.rlike(r"^[0-9]{13}\z") & (digits > 1_000_000_000_000), F.floor(digits / 1000))
    layouts = []
    for layout, day_first in DETECTED:
        whole = rf"^{layout}\z"
        part = lambda k: F.regexp_extract(value, whole, k)  # noqa: B023, E731
        year, month, day = (part(3), part(2), part(1)) if day_first else (part(1), part(2), part(3))
        if day_first:
            place = F.instr(F.lit(_MONTHS), F.lower(month))
            month = F.when(place % 3 == 1, F.lpad(F.floor((place + 2) / 3).cast("string"), 2, "0"))
        time = F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), F.lpad(part(4), 2, "0"), F.lit(":"), part(5), F.lit(":"), part(6))
        if "[+-]" in layout:
            hours, minutes = part(8).try_cast("int"), part(9).try_cast("int")
            east = F.when((hours <= 24) & (minutes <= 60), (hours * 3600 + minutes * 60) * F.when(part(7) == "-", -1).otherwise(1))
            seconds = F.unix_seconds(F.concat(time, F.lit("Z")).try_cast("timestamp")) - east
        else:
            seconds = F.unix_seconds(time.try_cast("timestamp"))
        layouts.append(F.when(value.rlike(whole), seconds))
    return F.coalesce(number, *layouts, F.lit(0)).cast("bigint")


def get_text(value: Column) -> Column:
    """A VARIANT as text, numbers in plain form."""
    return F.when(kind(value) == "number", plain_number(F.try_variant_get(value, "$", "double"))).otherwise(text(value))


def get_float(value: Column) -> Column:
    return F.when(kind(value) == "number", F.try_variant_get(value, "$", "double")).when(kind(value) == "string", text(value).try_cast("double"))


def get_long(value: Column) -> Column:
    return F.when(kind(value) == "number", F.try_variant_get(value, "$", "double").try_cast("bigint")).when(kind(value) == "string", F.when(text(value).rlike(r"^[+-]?[0-9]+\z"), text(value).try_cast("bigint")))


def legacy_extract(value: Column, regexp: str = "", preset: str = "", default: str = "", required: bool = False) -> tuple[Column, Column]:
    """The legacy submatch on text: default for missing or empty values, preset before regexp; value and error."""
    filled = F.when(F.coalesce(value, F.lit("")) == "", F.lit(default) if default else value).otherwise(value)
    error = F.when(F.coalesce(filled, F.lit("")) == "", F.lit("required, but not matched")) if required else F.lit(None).cast("string")
    if preset == "allmatch":
        made = trim_space(filled)
    elif preset == "uripath":
        made = uri_path(filled)
    else:
        made = extract(filled, regexp, legacy=True) if regexp else filled
    return made, error
