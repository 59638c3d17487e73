"""Message-level filters and rewrites, before anything is decoded."""

from __future__ import annotations

import gzip
import json
import zlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import record as R
from ..functions.formats import get_text
from ..functions.regex import matches

STRING_FILTERS = ("match", "not_match", "contains", "not_contains")
KEY_VALUE_FILTERS = ("match_key_value", "not_match_key_value")
REWRITES = ("strip_ansi", "format_to_json")
INPUT_STAGE = ("decompress", "split_json_array")
MODES = STRING_FILTERS + KEY_VALUE_FILTERS + REWRITES + INPUT_STAGE
NEED_FORMAT = tuple(m for m in MODES if m not in ("format_to_json", "strip_ansi", "split_json_array"))

#: Fixed value: terminal escape sequences written as the six characters \u001b and what follows.
ANSI = r"\\u001b(?:8|7|H|>|\[(?:\?\d+(?:h|l)|[0-2]?(?:K|J)|\d*(?:A|B|C|D\D|E|F|G|g|i|m|n|S|s|T|u)|1000D\d+|\d*;\d*(?:f|H|r|m)|\d+;\d+;\d+m))"


@dataclass(frozen=True)
class PreFunction:
    mode: str
    format: str = ""

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"unknown pre-function {self.mode}")
        if self.mode in NEED_FORMAT and not self.format:
            raise ValueError(f"{self.mode} needs a format")
        if self.mode in KEY_VALUE_FILTERS:
            key_value(self.format)


def key_value(rule: str) -> tuple[list[str], str]:
    """Path and wanted text of a rule like ``a.b = v``."""
    parts = rule.split("=")
    if len(parts) != 2:
        raise ValueError(f"not a key and a value: {rule}")
    return [p.strip() for p in parts[0].strip().split(".")], parts[1].strip()


def keeps(text: Column, f: PreFunction) -> Column:
    """The condition of a filter on the raw text."""
    if f.mode in ("match", "not_match"):
        found = matches(text, f.format)
    else:
        found = text.contains(f.format)
    return ~found if f.mode.startswith("not_") else found


def keeps_record(rec: Column, f: PreFunction) -> Column:
    """The condition of a key-value filter on the decoded record; a missing path is no match."""
    path, wanted = key_value(f.format)
    value = R.get(rec, path)
    same = F.coalesce(F.when(R.is_value(value), F.coalesce(get_text(value), F.to_json(value)) == wanted), F.lit(False))
    return ~same if f.mode.startswith("not_") else same


def strip_ansi(text: Column) -> Column:
    return F.regexp_replace(text, ANSI, "")


def format_to_json(text: Column) -> Column:
    """JSON objects as they are, any other text as the message of one."""
    valid = text.contains("{") & (F.try_parse_json(text).isNotNull() | F.from_json(text, R.MAP).isNotNull())
    return F.when(valid, text).otherwise(F.to_json(F.struct(text.alias("message"))))


def rewrite(text: Column, f: PreFunction) -> Column:
    return strip_ansi(text) if f.mode == "strip_ansi" else format_to_json(text)


@F.pandas_udf(T.StringType())
def inflate(data: pd.Series) -> pd.Series:
    """gzip or zlib by its first bytes, other bytes as text; null where the data is broken."""

    def one(raw):
        if raw is None:
            return None
        try:
            if raw[:2] == b"\x1f\x8b":
                raw = gzip.decompress(raw)
            elif raw[:2] == b"\x78\x9c":
                raw = zlib.decompress(raw)
            return raw.decode("utf-8", "replace")
        except (OSError, EOFError, zlib.error):
            return None

    return data.map(one)


def split_json_array(text: Column) -> Column:
    """Elements of a JSON array as texts: non-empty strings as they are, non-empty objects as JSON; all others are left out."""
    items = F.from_json(text, "array<variant>")
    some = F.filter(items, lambda v: ((R.kind(v) == "string") & (R.text(v) != "")) | ((R.kind(v) == "object") & (F.to_json(v) != "{}")))
    return F.transform(some, lambda v: F.when(R.kind(v) == "string", R.text(v)).otherwise(F.to_json(v)))


def input_stage(df: DataFrame, functions: list[PreFunction], raw: str = "raw") -> DataFrame:
    """Decompress, then split arrays into rows; nothing where no function asks for it.  Broken messages are dropped."""
    modes = {f.mode for f in functions}
    if "decompress" in modes:
        df = df.withColumn(raw, inflate(df[raw].cast("binary"))).where(F.col(raw).isNotNull())
    if "split_json_array" in modes:
        source = strip_ansi(F.col(raw)) if "strip_ansi" in modes else F.col(raw)
        df = df.withColumn(raw, F.explode(split_json_array(source)))
    return df


def text_stage(df: DataFrame, functions: list[PreFunction], raw: str = "raw") -> DataFrame:
    """All string filters on the original text, then the rewrites in their order."""
    for f in functions:
        if f.mode in STRING_FILTERS:
            df = df.where(keeps(F.col(raw), f))
    text = F.col(raw)
    for f in functions:
        if f.mode in REWRITES:
            text = rewrite(text, f)
    return df.withColumn(raw, text)


def from_json(items: str | list) -> list[PreFunction]:
    """Pre-functions of their JSON configuration."""
    items = json.loads(items) if isinstance(items, str) else items
    return [PreFunction(i.get("mode", ""), i.get("format", "") or "") for i in items or []]
