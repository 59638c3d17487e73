"""Tasks: the JSON configuration of a log transformation as dataclasses."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from ..functions.formats import FormatSettings, TimeFormat
from ..operators import prefilters
from ..operators.parsers import PreExtract
from ..operators.transforms import Append, LabelMapping, Transform

#: Engines by the version that a task names; all of them run as one plan.
VERSIONS = {"log_prune": "prune", "log_prune_v2": "prune_v2", "log_transform": "transform", "": "extract"}
# Suffix formats of time-partitioned names.
SUFFIXES = ("none", "hourly", "daily", "weekly", "monthly", "quarterly")
_NAME = re.compile(r"^[.\da-z][.\d\-_a-z]+$")
_DURATION = re.compile(r"(\d+(?:\.\d+)?)(ns|us|ms|s|m|h|d|w)")
_SECONDS = {"ns": 1e-9, "us": 1e-6, "ms": 1e-3, "s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


@dataclass
class TransformSettings:
    pre_function: list[prefilters.PreFunction] = field(default_factory=list)
    prefix_match: list[str] = field(default_factory=list)
    pre_extract: list[PreExtract] = field(default_factory=list)
    multi_pre_extract: bool = False
    skip_extract_error: bool = False
    overwrite_origin: bool = False
    fields_transform: list[Transform] = field(default_factory=list)
    fields: list[dict] = field(default_factory=list)


@dataclass
class Storage:
    """Where results go: the name's stem, its time suffix and how long partitions stay."""

    index_name: str
    index_suffix_format: str = "daily"
    retention_duration: str = "2d"

    def __post_init__(self):
        if self.index_suffix_format in ("", "default"):
            self.index_suffix_format = "daily"
        if self.retention_duration in ("", "default"):
            self.retention_duration = "2d"
        if not self.index_name:
            raise ValueError("index_name missing")
        if not _NAME.match(self.index_name):
            raise ValueError("index names begin with [. a-z 0-9] and hold only [._- a-z 0-9]")
        if self.index_suffix_format not in SUFFIXES:
            raise ValueError(f"unknown suffix format {self.index_suffix_format}")
        seconds(self.retention_duration)


@dataclass
class Task:
    id: int
    data_source_id: int
    version: str
    settings: TransformSettings
    storage: Storage | None = None
    include_topics: list[str] = field(default_factory=list)
    exclude_topics: list[str] = field(default_factory=list)


def seconds(duration: str) -> float:
    """Seconds of a duration like ``1d12h``; ``0`` is for ever."""
    if duration.strip() == "0":
        return 0.0
    parts = _DURATION.findall(duration)
    if not parts or "".join(n + u for n, u in parts) != duration:
        raise ValueError(f"not a duration: {duration}")
    return sum(float(n) * _SECONDS[u] for n, u in parts)


def format_settings(d: dict) -> FormatSettings:
    d = d or {}
    time, mask = d.get("time_format") or {}, d.get("desensitize") or {}
    rules = (d.get("regexp_mapping") or {}).get("rules") or []
    return FormatSettings(
        format_type=d.get("format_type") or "allmatch",
        regexp=mask.get("regexp") or d.get("regexp") or "",
        regexp_mapping=[(r.get("regexp", ""), r.get("mapping", "")) for r in rules],
        method=mask.get("method") or "",
        replace=mask.get("replace") or "",
        time_format=TimeFormat(time.get("date_format") or "", time.get("date_location") or "", bool(time.get("convert_to_utc8"))),
    )


def transform(d: dict) -> Transform:
    a = d.get("append_settings") or {}
    m = a.get("label_mapping") or {}
    return Transform(
        rule_type=d.get("rule_type") or "",
        origin_field=d.get("origin_field") or "",
        target_field=d.get("target_field") or "",
        target_type=d.get("target_type") or "text",
        format_settings=format_settings(d.get("format_settings")),
        append_settings=Append(a.get("append_type") or "input", a.get("input_value") or "", LabelMapping(m.get("schema_id") or 0, m.get("parent_field") or "", m.get("srcs") or [], m.get("dsts") or [])),
        drop_if_not_found=bool(d.get("drop_if_not_found")),
        ignore_if_conflict=bool(d.get("ignore_if_conflict")),
    )


def load(config: str | dict) -> TransformSettings:
    """Transform settings of their JSON."""
    d = json.loads(config) if isinstance(config, str) else config
    return TransformSettings(
        pre_function=prefilters.from_json(d.get("pre_function") or []),
        prefix_match=list(d.get("prefix_match") or []),
        pre_extract=[PreExtract(p.get("mode", ""), p.get("field", ""), p.get("format") or "") for p in d.get("pre_extract") or []],
        multi_pre_extract=bool(d.get("multi_pre_extract")),
        skip_extract_error=bool(d.get("skip_extract_error")),
        overwrite_origin=bool(d.get("overwrite_origin")),
        fields_transform=[transform(t) for t in d.get("fields_transform") or []],
        fields=list(d.get("fields") or []),
    )


def load_task(config: str | dict) -> Task:
    d = json.loads(config) if isinstance(config, str) else config
    s, store = d.get("settings") or {}, (d.get("storage") or {}).get("elasticsearch")
    topics = d.get("topics") or {}
    storage = Storage(store.get("index_name", ""), store.get("index_suffix_format", ""), store.get("retention_duration", "")) if store else None
    return Task(d.get("id", 0), d.get("data_source_id", 0), s.get("version", ""), load(s.get("json_settings") or {}), storage, topics.get("include") or [], topics.get("exclude") or [])
