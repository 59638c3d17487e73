"""Field transforms: ordered edits of a record, with an error column threaded through.

A rule works on a frame with a ``rec`` column and gives back the new record and an error; where an error is already set and
aborts, the record stays as it was.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import record as R
from ..functions.formats import FormatSettings, format_column, to_float, to_long

NOT_FOUND = "origin field not found"


@dataclass
class LabelMapping:
    schema_id: int = 0
    parent_field: str = ""
    srcs: list[str] = field(default_factory=list)
    dsts: list[str] = field(default_factory=list)


@dataclass
class Append:
    append_type: str = "input"
    input_value: str = ""
    label_mapping: LabelMapping = field(default_factory=LabelMapping)


@dataclass
class Transform:
    """One rule."""

    rule_type: str
    origin_field: str = ""
    target_field: str = ""
    target_type: str = "text"
    format_settings: FormatSettings = field(default_factory=FormatSettings)
    append_settings: Append = field(default_factory=Append)
    drop_if_not_found: bool = False
    ignore_if_conflict: bool = False


def constant(value: str, target: str) -> Column:
    """A configured constant in its type, as VARIANT; numbers that do not parse are 0."""
    made = {"long": to_long, "float": to_float}.get(target, lambda c: c)(F.lit(value))
    return made.cast("variant")


def _place(df: DataFrame, rule: Transform, base: Column) -> tuple[DataFrame, Column, Column]:
    """``base`` with column __out at the rule's target beside its origin, and whether a target key is in ``rec`` already."""
    origin, rec = R.split_path(rule.origin_field), F.col("rec")
    if rule.target_field != R.ROOT:
        at = [*origin[:-1], R.split_path(rule.target_field)[-1]]
        return df, R.put(base, at, F.col("__out")), R.has(rec, at)
    df = df.withColumn("__members", F.coalesce(R.as_map(F.col("__out")), F.create_map(F.lit(origin[-1]), F.col("__out"))))
    return df, R.merge(base, F.col("__members")), F.exists(F.map_keys("__members"), lambda k: F.map_contains_key(rec, k))


def _missing(rule: Transform) -> Column:
    return F.when(~F.col("__there"), NOT_FOUND) if rule.drop_if_not_found else F.lit(None).cast("string")


def _moved(df: DataFrame, rule: Transform, formatted: bool, keep: bool, prefixes: list[tuple[str, str]] | None) -> tuple[DataFrame, Column, Column]:
    """clone, rename and clone_and_format."""
    rec = F.col("rec")
    df = df.withColumn("__value", R.get(rec, rule.origin_field)).withColumn("__there", F.coalesce(R.is_value(F.col("__value")), F.lit(False)))
    df = format_column(df, "__value", rule.format_settings, rule.target_type, prefixes) if formatted else df.withColumns({"__out": F.col("__value"), "__bad": F.lit(None).cast("string")})
    df, placed, clash = _place(df, rule, rec if keep else R.remove(rec, rule.origin_field))
    good = F.col("__there") & F.col("__bad").isNull()
    if rule.ignore_if_conflict:
        good &= ~F.coalesce(clash, F.lit(False))
    return df, F.when(good, placed).otherwise(rec), F.coalesce(_missing(rule), F.when(F.col("__there"), F.col("__bad")))


def _format(df: DataFrame, rule: Transform, prefixes: list[tuple[str, str]] | None) -> tuple[DataFrame, Column, Column]:
    rec = F.col("rec")
    df = df.withColumn("__value", R.get(rec, rule.origin_field)).withColumn("__there", F.coalesce(R.is_value(F.col("__value")), F.lit(False)))
    df = format_column(df, "__value", rule.format_settings, rule.target_type, prefixes)
    made = F.when(F.col("__there") & F.col("__bad").isNull(), R.put(rec, rule.origin_field, F.col("__out"))).otherwise(rec)
    return df, made, F.coalesce(_missing(rule), F.when(F.col("__there"), F.col("__bad")))


def _append_input(df: DataFrame, rule: Transform) -> tuple[DataFrame, Column, Column]:
    rec, path = F.col("rec"), R.split_path(rule.target_field.removeprefix(R.ROOT + "."))
    placed = R.put(rec, path, constant(rule.append_settings.input_value, rule.target_type))
    if rule.ignore_if_conflict:
        placed = F.when(R.has(rec, path), rec).otherwise(placed)
    return df, placed, F.lit(None).cast("string")


def dictionary_key(parent: Column, srcs: list[str]) -> Column:
    """``src=value`` of all sources in order of their names; null where one is missing or no text."""
    parts = []
    for name in sorted(srcs):
        value = F.try_element_at(parent, F.lit(name))
        parts.append(F.concat(F.lit(f"{name}="), F.when(R.kind(value) == "string", R.text(value))))
    whole = parts[0]
    for part in parts[1:]:
        whole = F.concat(whole, F.lit(","), part)
    return whole


@dataclass
class Dictionary:
    """A dictionary as a table: src_key, dst (a map of texts) and, for entries that change, valid_from and valid_to (null: open).

    ``at`` names the column of the rows that holds an event's time: the entry that was valid then counts, of several the one that began last, else the
    one whose text comes first.  Without it the entries that are valid without end count.
    """

    table: DataFrame
    at: str = ""


#: Entries of a dictionary that may stand in a plan as a literal map; larger ones are joined.
LITERAL_ROWS = 1000
#: Keys of a dictionary that may be broadcast.
BROADCAST_KEYS = 100_000
#: Keys that rows without one are spread over, so that they do not meet in one task.
SPREAD = 4096


def _versions(dictionary: Dictionary) -> DataFrame:
    """One row a key, with all its versions: time and text order."""
    table = dictionary.table
    time = lambda name: (table[name] if name in table.columns else F.lit(None)).cast("timestamp")
    version = F.struct(time("valid_from").alias("valid_from"), F.to_json("dst").alias("text"), time("valid_to").alias("valid_to"), F.col("dst"))
    return table.where("src_key IS NOT NULL").groupBy(F.col("src_key").alias("__src")).agg(F.collect_list(version).alias("__versions"))


def looked_up(df: DataFrame, key: Column, dictionary: Dictionary, name: str) -> DataFrame:
    """``df`` with a column of what the dictionary holds for a key at the row's time; null where it holds nothing.

    A key is a row on the dictionary's side, so rows are never multiplied; a key that many rows share is left to the skew join, and rows without one are spread.
    """
    versions = _versions(dictionary)
    if versions.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        versions = F.broadcast(versions)
    spread = F.concat(F.lit("\0"), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("string"))
    rows = df.withColumn("__src", F.coalesce(key, spread)).join(versions, "__src", "left")
    at = df[dictionary.at].cast("timestamp") if dictionary.at else F.lit(None).cast("timestamp")
    begun = lambda v: v["valid_from"].isNull() | (v["valid_from"] <= at) if dictionary.at else F.lit(True)
    open_ = lambda v: v["valid_to"].isNull() | (v["valid_to"] > at) if dictionary.at else v["valid_to"].isNull()
    valid = F.filter("__versions", lambda v: begun(v) & open_(v))
    first = lambda v: F.coalesce(v["valid_from"], F.lit("0001-01-01").cast("timestamp"))
    better = lambda best, v: best.isNull() | (first(v) > first(best)) | ((first(v) == first(best)) & (v["text"] < best["text"]))
    none = F.lit(None).cast("struct<valid_from:timestamp,text:string,valid_to:timestamp,dst:map<string,string>>")
    rows = rows.withColumn("__valid", valid)
    return rows.withColumn(name, F.aggregate("__valid", none, lambda best, v: F.when(better(best, v), v).otherwise(best))["dst"]).drop("__src", "__versions", "__valid")


def _literal(schema: dict[str, dict[str, str]], key: Column, dsts: list[str]) -> Column:
    pairs = [x for k, values in sorted(schema.items()) for x in (F.lit(k), F.create_map(*(y for d in dsts for y in (F.lit(d), F.lit(values.get(d, ""))))))]
    return F.try_element_at(F.create_map(*pairs), key) if pairs else F.lit(None).cast("map<string,string>")


def _append_labels(df: DataFrame, rule: Transform, dictionaries: dict[int, dict | Dictionary]) -> tuple[DataFrame, Column, Column]:
    """A dictionary's texts: from a literal map if it has few entries, else from a join."""
    rec, s = F.col("rec"), rule.append_settings.label_mapping
    if s.schema_id not in dictionaries:
        return df, rec, F.lit("dict mapping schema not found")
    path = [] if s.parent_field == R.ROOT else R.split_path(s.parent_field)
    df = df.withColumn("__value", R.as_map(R.get(rec, path)) if path else rec)
    parent, schema = F.col("__value"), dictionaries[s.schema_id]
    if isinstance(schema, dict) and len(schema) > LITERAL_ROWS:
        schema = Dictionary(df.sparkSession.createDataFrame(sorted(schema.items()), "src_key string, dst map<string,string>"))
    if not s.srcs:
        df = df.withColumn("__found", F.lit(None).cast("map<string,string>"))
    elif isinstance(schema, dict):
        df = df.withColumn("__found", _literal(schema, dictionary_key(parent, s.srcs), s.dsts))
    else:
        df = looked_up(df, dictionary_key(parent, s.srcs), schema, "__found")
    values = F.create_map(*(x for d in s.dsts for x in (F.lit(d), F.coalesce(F.try_element_at(F.col("__found"), F.lit(d)), F.lit("")).cast("variant"))))
    if rule.ignore_if_conflict:
        values = F.map_filter(values, lambda k, _: ~F.map_contains_key(parent, k))
    df = df.withColumn("__members", values)
    return df, F.when(parent.isNull(), rec).otherwise(R.put_all(rec, path, F.col("__members"))), F.when(parent.isNull(), "parent field not found")


def change(df: DataFrame, rule: Transform, dictionaries: dict | None = None, prefixes: list[tuple[str, str]] | None = None) -> tuple[DataFrame, Column, Column]:
    """The frame with what one rule needs, the record it makes and its error; unknown rule types change nothing."""
    kind = rule.rule_type
    if kind == "format":
        return _format(df, rule, prefixes)
    if kind == "append":
        return _append_labels(df, rule, dictionaries or {}) if rule.append_settings.append_type == "label_mapping" else _append_input(df, rule)
    if kind == "delete":
        return df, R.remove(F.col("rec"), rule.origin_field), F.lit(None).cast("string")
    if kind in ("clone", "rename", "clone_and_format"):
        return _moved(df, rule, formatted=kind == "clone_and_format", keep=kind != "rename", prefixes=prefixes)
    return df, F.col("rec"), F.lit(None).cast("string")


def fuse(rules: list[Transform]) -> list[list[Transform]]:
    """Runs of rules that one edit can carry out: top-level deletes, or top-level constant appends that need no conflict check."""
    out: list[list[Transform]] = []
    for rule in rules:
        shape = _fusible(rule)
        if shape and out and _fusible(out[-1][-1]) == shape:
            out[-1].append(rule)
        else:
            out.append([rule])
    return out


def _fusible(rule: Transform) -> str:
    if rule.rule_type == "delete" and "." not in rule.origin_field:
        return "delete"
    plain = rule.rule_type == "append" and rule.append_settings.append_type == "input" and not rule.ignore_if_conflict
    return "append" if plain and "." not in rule.target_field.removeprefix(R.ROOT + ".") else ""


def fused(rec: Column, rules: list[Transform]) -> Column:
    """A run of more than one fusible rule as one edit."""
    if rules[0].rule_type == "delete":
        return R.without(rec, [r.origin_field for r in rules])
    values = {r.target_field.removeprefix(R.ROOT + "."): constant(r.append_settings.input_value, r.target_type) for r in rules}
    return F.map_concat(R.without(rec, list(values)), F.create_map(*(x for k, v in values.items() for x in (F.lit(k), v))))


def with_dictionary(df: DataFrame, dictionary: DataFrame, srcs: list[str], dsts: list[str], record: str = "rec") -> DataFrame:
    """The texts of a dictionary table in a record; misses give empty texts, of rows that repeat a key the one whose text comes first counts."""
    found = looked_up(df, dictionary_key(F.col(record), srcs), Dictionary(dictionary.select("src_key", "dst")), "__found")
    values = F.create_map(*(x for d in dsts for x in (F.lit(d), F.coalesce(F.try_element_at(F.col("__found"), F.lit(d)), F.lit("")).cast("variant"))))
    return found.withColumn(record, R.merge(F.col(record), values)).drop("__found")
