"""Text parsers: a text column to a map column, null where the text does not parse."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import record as R
from ..functions.formats import trim_space
from ..functions.regex import found, found_in_each, from_grok, from_nginx_template, group, named_groups, split_by, translate

Parser = Callable[[Column], Column]
STRINGS = "map<string,string>"


def _variants(strings: Column) -> Column:
    return F.transform_values(strings, lambda _, v: v.cast("variant"))


def _quoted(literal: str) -> str:
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _options(text: str) -> dict:
    try:
        found = json.loads(text) if text else {}
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def json_parser(format: str = "", keep: set[str] | None = None) -> Parser:
    """An object's members; control characters go first if ``strip_control`` is set."""
    strip = bool(_options(format).get("strip_control"))
    return lambda s: R.decode(F.regexp_replace(s, r"[\x00-\x1f]", "") if strip else s)


def regexp_parser(format: str, keep: set[str] | None = None) -> Parser:
    """Named groups of the first match; no match is an error."""
    pattern = translate(format)
    return lambda s: _variants(named_groups(s, pattern, keep))


def gonx_parser(format: str, keep: set[str] | None = None) -> Parser:
    """Fields of an nginx-style template."""
    pattern = from_nginx_template(format)
    return lambda s: _variants(named_groups(s, pattern, keep))


def grok_parser(format: str, keep: set[str] | None = None) -> Parser:
    """Named patterns, typed where they say int or float; no match is an empty map."""
    pattern, kinds = from_grok(format)
    last = {n: i for i, n in enumerate(pattern.names, 1) if n and (keep is None or n in keep)}

    def parse(s: Column) -> Column:
        pairs = []
        for name, i in last.items():
            piece = group(s, pattern, i)
            typed = {"int": piece.try_cast("bigint"), "float": piece.try_cast("double")}.get(kinds.get(name, ""), piece)
            pairs += [F.lit(name), typed.cast("variant")]
        made = F.create_map(*pairs) if pairs else R.empty()
        return F.when(found(s, pattern), made).when(s.isNotNull(), R.empty())

    return parse


def split_parser(format: str, keep: set[str] | None = None) -> Parser:
    """Pieces by number, "0" first; the delimiter is literal, or a pattern between slashes."""
    if not format:
        raise ValueError("empty delimiter")
    try:
        options = json.loads(format)
    except ValueError:
        options = {"delimiter": format}
    if not isinstance(options, dict):
        options = {"delimiter": format} if not isinstance(options, (int, float)) else {"delimiter": str(format)}
    delimiter, most = options.get("delimiter", ""), int(options.get("num_of_substring", 0) or 0)
    if not delimiter:
        raise ValueError("empty delimiter")
    regexp = len(delimiter) > 2 and delimiter.startswith("/") and delimiter.endswith("/")
    pattern = translate(delimiter[1:-1]) if regexp else None
    limit = most if most > 0 else -1

    def parse(s: Column) -> Column:
        pieces = split_by(s, pattern, limit) if pattern else F.split(s, _quoted(delimiter), limit)
        numbers = F.transform(F.sequence(F.lit(0), F.size(pieces) - 1), lambda i: i.cast("string"))
        made = F.map_from_arrays(numbers, pieces)
        if keep is not None:
            wanted = sorted(keep)
            made = F.map_filter(made, lambda k, _: k.isin(wanted))
        return F.when(s == "", R.empty()).otherwise(_variants(made))

    return parse


def _cut_pairs(pieces: Column, delimiter: str) -> Column:
    """key (untrimmed) and value of the pieces that hold the delimiter."""
    some = F.filter(pieces, lambda p: p.contains(delimiter))
    return F.transform(some, lambda p: F.struct(F.substring_index(p, delimiter, 1).alias("key"), F.substr(p, F.locate(delimiter, p) + len(delimiter)).alias("value")))


def _last_wins(pairs: Column) -> Column:
    return F.map_from_entries(pairs)


def _simple_pairs(options: dict) -> Parser:
    between, inside = options.get("field_delimiter") or ",", options.get("key_value_delimiter") or "="
    pattern = options.get("key_pattern") or ""

    def parse(s: Column) -> Column:
        pieces = F.split(s, _quoted(between), -1)
        if not pattern:
            pairs = F.transform(_cut_pairs(pieces, inside), lambda e: F.struct(trim_space(e["key"]).alias("key"), e["value"]))
            return _last_wins(pairs)
        key = translate(("" if pattern.startswith("^") else "^") + pattern + ("" if pattern.endswith("$") else "$"))
        kind = "array<struct<key:string,value:string>>"
        # whether the text before the delimiter is a key, for all pieces at once
        named = F.arrays_zip(pieces.alias("text"), found_in_each(F.transform(pieces, lambda p: F.substring_index(p, inside, 1)), key).alias("key"))

        def glue(done: Column, one: Column) -> Column:
            piece = one["text"]
            name = F.substring_index(piece, inside, 1)
            fresh = piece.contains(inside) & one["key"]
            pair = F.struct(name.alias("key"), F.substr(piece, F.locate(inside, piece) + len(inside)).alias("value"))
            last = F.element_at(done, -1)
            longer = F.struct(last["key"].alias("key"), F.concat(last["value"], F.lit(between), piece).alias("value"))
            return F.when(fresh, F.concat(done, F.array(pair)).cast(kind)).when(F.size(done) == 0, done).otherwise(F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer)).cast(kind))

        pairs = F.aggregate(named, F.array().cast(kind), glue)
        return _last_wins(F.transform(pairs, lambda e: F.struct(trim_space(e["key"]).alias("key"), e["value"])))

    return lambda s: _variants(parse(s))


def _cut(column: Column, characters: str) -> Column:
    return F.btrim(column, F.lit(characters)) if characters else column


def _table(options: dict) -> Parser:
    row, head, cell = options.get("table_row_delimiter") or "\n", options.get("table_key_delimiter") or "|", options.get("table_value_delimiter") or "|"
    key_trim, value_trim = options.get("table_key_trim") or "", options.get("table_value_trim") or ""
    many, wanted = bool(options.get("table_value_multiline")), options.get("table_value_pattern") or ""

    def parse(s: Column) -> Column:
        lines = F.split(s, _quoted(row), -1)
        keys = F.transform(F.split(F.element_at(lines, 1), _quoted(head), -1), lambda k: _cut(k, key_trim))
        named = F.filter(F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("at"))), lambda e: e["key"] != "")

        def value(line: Column, at: Column) -> Column:
            return _cut(F.coalesce(F.get(F.split(line, _quoted(cell), -1), at), F.lit("")), value_trim)

        if not many:
            made = F.map_from_entries(F.transform(named, lambda e: F.struct(e["key"], value(F.element_at(lines, 2), e["at"]).alias("value"))))
            return F.when(F.size(lines) < 2, R.empty()).otherwise(_variants(made))
        rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
        if wanted:
            rest = F.filter(F.arrays_zip(rest.alias("line"), found_in_each(rest, translate(wanted)).alias("fits")), lambda x: (x["line"] != "") & x["fits"])
            rest = F.transform(rest, lambda x: x["line"])
        else:
            rest = F.filter(rest, lambda x: x != "")
        made = F.map_from_entries(F.transform(named, lambda e: F.struct(e["key"], F.transform(rest, lambda x: value(x, e["at"])).cast("variant").alias("value"))))
        return F.when(F.size(lines) < 2, R.empty()).otherwise(F.when(F.size(rest) > 0, made).otherwise(R.empty()))

    return parse


def _vertical_table(options: dict) -> Parser:
    row, column = options.get("table_row_delimiter") or "\n", options.get("table_column_delimiter") or "\t"
    key_at, value_at = int(options.get("table_key_index") or 0), int(options.get("table_value_index") or 0)
    if key_at == 0 and value_at == 0:
        value_at = 1
    if key_at == value_at or min(key_at, value_at) < 0:
        raise ValueError("key and value are in one column")
    key_trim, value_trim = options.get("table_key_trim") or "", options.get("table_value_trim") or ""

    def parse(s: Column) -> Column:
        rows = F.filter(F.transform(F.split(s, _quoted(row), -1), lambda x: F.split(x, _quoted(column), -1)), lambda c: F.size(c) > max(key_at, value_at))
        pairs = F.transform(rows, lambda c: F.struct(_cut(F.get(c, key_at), key_trim).alias("key"), _cut(F.get(c, value_at), value_trim).alias("value")))
        return _variants(F.map_from_entries(F.filter(pairs, lambda e: e["key"] != "")))

    return parse


def key_value_parser(format: str = "", keep: set[str] | None = None) -> Parser:
    """Pairs in a text, or in a table of one of two shapes; keys are trimmed, values are not, the last of equal keys counts."""
    options = json.loads(format) if format else {}
    mode = options.get("mode") or ""
    if mode == "table":
        return _table(options)
    if mode == "vertical_table":
        return _vertical_table(options)
    if mode:
        return lambda s: F.when(s.isNotNull(), R.empty())
    return _simple_pairs(options)


_START, _END = "startTimeUnixNano", "endTimeUnixNano"
_SPAN = "struct<resourceSpans:array<struct<resource:map<string,variant>,scopeSpans:array<struct<scope:variant,spans:array<map<string,variant>>>>>>>"


def otel_parser(format: str = "", keep: set[str] | None = None) -> Parser:
    """Trace spans: the service's name beside its resource, nanoseconds as whole numbers; an error without spans, name and both times."""

    def nanos(span: Column, name: str) -> Column:
        return R.text(F.try_element_at(span, F.lit(name))).try_cast("bigint")

    def service(resource: Column) -> Column:
        attributes = F.try_variant_get(F.try_element_at(resource, F.lit("attributes")), "$", "array<struct<key:string,value:struct<stringValue:string>>>")
        return F.get(F.filter(attributes, lambda a: a["key"] == "service.name"), 0)["value"]["stringValue"]

    def read(resource: Column) -> Column:
        """The parts of a resource's spans; its name and their times are looked up here, once."""
        timed = lambda x: F.struct(x.alias("span"), nanos(x, _START).alias("start"), nanos(x, _END).alias("end"))
        scopes = F.transform(resource["scopeSpans"], lambda c: F.struct(c["scope"], F.transform(c["spans"], timed).alias("spans")))
        return F.struct(resource["resource"], service(resource["resource"]).alias("name"), scopes.alias("scopes"))

    def written(x: Column) -> Column:
        times = F.create_map(F.lit(_START), x["start"].cast("variant"), F.lit(_END), x["end"].cast("variant"))
        return F.to_variant_object(R.merge(x["span"], F.map_filter(times, lambda _, v: v.isNotNull())))

    def whole(r: Column) -> Column:
        resource = F.when(r["name"].isNotNull(), R.merge(r["resource"], F.create_map(F.lit("serviceName"), r["name"].cast("variant")))).otherwise(r["resource"])
        scopes = F.transform(r["scopes"], lambda c: F.to_variant_object(F.create_map(F.lit("scope"), c["scope"], F.lit("spans"), F.transform(c["spans"], written).cast("variant"))))
        return F.to_variant_object(F.create_map(F.lit("resource"), F.to_variant_object(resource), F.lit("scopeSpans"), scopes.cast("variant")))

    def result(parts: Column) -> Column:
        has = lambda field: F.exists(parts, lambda r: F.exists(r["scopes"], lambda c: F.exists(c["spans"], lambda x: x[field].isNotNull())))
        good = F.exists(parts, lambda r: r["name"].isNotNull()) & has("start") & has("end")
        return F.when(F.coalesce(good, F.lit(False)), F.create_map(F.lit("resourceSpans"), F.transform(parts, whole).cast("variant")))

    def parse(s: Column) -> Column:
        # as a lambda's variable the parts are read once, whatever is made of them
        return F.get(F.transform(F.array(F.transform(F.from_json(s, _SPAN)["resourceSpans"], read)), result), 0)

    return parse


PARSERS: dict[str, Callable[..., Parser]] = {"json": json_parser, "regexp": regexp_parser, "gonx": gonx_parser, "grok": grok_parser, "split": split_parser, "key_value": key_value_parser, "otel_trace_spans": otel_parser}


@dataclass(frozen=True)
class PreExtract:
    """One parser rule: its mode, the field it reads and its configuration."""

    mode: str
    field: str
    format: str = ""

    def parser(self, keep: set[str] | None = None) -> Parser | None:
        """None for geoip, which is a join and not an expression."""
        if self.mode == "geoip":
            return None
        if self.mode not in PARSERS:
            raise ValueError(f"unknown parser {self.mode}")
        return PARSERS[self.mode](self.format, keep)
