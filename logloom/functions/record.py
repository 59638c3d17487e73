"""Records as MAP<STRING, VARIANT>: reading and editing values at dotted paths.

Every function builds a Column; paths are known when a plan is made, so edits are unrolled per level.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP = "map<string,variant>"
ROOT = "__root__"


def split_path(path: str | list[str]) -> list[str]:
    return list(path) if isinstance(path, list) else path.split(".")


def empty() -> Column:
    return F.expr(f"cast(map() as {MAP})")


def decode(text: Column) -> Column:
    """The record of a JSON object, null for anything else; of equal keys the last counts."""
    return F.map_from_entries(F.map_entries(F.from_json(text, MAP)))


def encode(record: Column) -> Column:
    """JSON text with keys in order."""
    return F.to_json(F.to_variant_object(record))


def _json_path(keys: list[str]) -> str:
    return "$" + "".join(f".{k}" if re.fullmatch(r"[A-Za-z_]\w*", k) else "['" + k.replace("'", "\\'") + "']" for k in keys)


def get(record: Column, path: str | list[str]) -> Column:
    """The value at a path as VARIANT; null where there is none."""
    head, *rest = split_path(path)
    top = F.try_element_at(record, F.lit(head))
    return F.try_variant_get(top, _json_path(rest), "variant") if rest else top


def as_map(value: Column) -> Column:
    """A VARIANT object as a map; null for other kinds."""
    return F.try_variant_get(value, "$", MAP)


def has(record: Column, path: str | list[str]) -> Column:
    """True where every part of the path is there, the last with any value, null too."""
    keys = split_path(path)
    if len(keys) == 1:
        return F.coalesce(F.map_contains_key(record, F.lit(keys[0])), F.lit(False))
    return F.coalesce(F.map_contains_key(as_map(get(record, keys[:-1])), F.lit(keys[-1])), F.lit(False))


def is_value(value: Column) -> Column:
    """Neither missing nor JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


#: What VARIANT types are called here; others are numbers.
_KINDS = {"VOID": "null", "STRING": "string", "BOOLEAN": "bool", "OBJECT": "object", "ARRAY": "array", "TIMESTAMP": "date", "TIMESTAMP_NTZ": "date", "DATE": "date"}


def kind(value: Column) -> Column:
    """string, number, bool, object, array or null; the value stands in the expression once, so it is computed once."""
    name = F.substring_index(F.schema_of_variant(value), "<", 1)
    known = F.create_map(*(F.lit(x) for pair in _KINDS.items() for x in pair))
    return F.coalesce(F.try_element_at(known, F.coalesce(name, F.lit("VOID"))), F.lit("number"))


def text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def variant(value: Column) -> Column:
    return value.cast("variant")


def without(record: Column, keys: Column | list[str]) -> Column:
    """The record less top-level keys."""
    if isinstance(keys, list):
        names = list(keys)
        return F.map_filter(record, lambda k, _: ~k.isin(names))
    return F.map_filter(record, lambda k, _: ~F.array_contains(keys, k))


def merge(record: Column, other: Column) -> Column:
    """Both records; values of ``other`` win."""
    return F.map_concat(without(record, F.map_keys(other)), other)


def put(record: Column, path: str | list[str], value: Column) -> Column:
    """The record with a value at a path; missing parents are made, parents of other kinds replaced."""
    head, *rest = split_path(path)
    if rest:
        child = F.coalesce(as_map(F.try_element_at(record, F.lit(head))), empty())
        value = F.to_variant_object(put(child, rest, value)).cast("variant")
    return F.map_concat(without(record, [head]), F.create_map(F.lit(head), value))


def remove(record: Column, path: str | list[str]) -> Column:
    """The record without what is at a path."""
    head, *rest = split_path(path)
    if not rest:
        return without(record, [head])
    child = as_map(F.try_element_at(record, F.lit(head)))
    smaller = F.map_concat(without(record, [head]), F.create_map(F.lit(head), F.to_variant_object(remove(child, rest)).cast("variant")))
    return F.when(child.isNull(), record).otherwise(smaller)


def put_all(record: Column, path: list[str], values: Column) -> Column:
    """The record with all pairs of a map put beside each other at a path, the root where it is empty."""
    if not path:
        return merge(record, values)
    child = F.coalesce(as_map(get(record, path)), empty())
    return put(record, path, F.to_variant_object(merge(child, values)).cast("variant"))


def flatten(df: DataFrame, record: str = "rec", keep: list[str] | None = None) -> DataFrame:
    """A row (path, kind, value) for each value of a record at any depth, beside the columns to keep; nulls are left out.

    One step for each level that the data have: the loop ends when a level holds no object.
    """
    keep = keep or []

    def level(rows: DataFrame, entries: Column, path: Column) -> DataFrame:
        each = rows.select(*keep, *([] if rows is df else ["path"]), F.explode(entries).alias("__key", "__value"))
        named = each.select(*keep, path.alias("path"), kind(F.col("__value")).alias("kind"), F.col("__value"))
        return named.where("kind != 'null'")

    rows = level(df, F.col(record), F.col("__key"))
    shown = lambda rows: rows.select(*keep, "path", "kind", F.when(F.col("kind") != "object", F.to_json("__value")).alias("value"))
    out = shown(rows)
    while not (nested := rows.where("kind = 'object'")).isEmpty():
        rows = level(nested, as_map(F.col("__value")), F.concat("path", F.lit("."), "__key"))
        out = out.unionByName(shown(rows))
    return out
