"""Legacy field rules as canonical transforms."""

from __future__ import annotations

from ..functions.formats import layout_to_strftime
from .settings import TransformSettings, transform

UTC8_SECONDS = 8 * 3600


def field_rule(rule: dict) -> tuple[dict, list[str]]:
    """The transform of one legacy rule, and the fields to delete afterwards."""
    kind, more = rule.get("rule_type") or "", rule.get("extention") or {}
    origin, key = rule.get("origin_field") or "", rule.get("key") or ""
    if kind == "append":
        return {"rule_type": "append", "target_field": key, "target_type": rule.get("value_type"), "append_settings": {"append_type": "input", "input_value": more.get("append_value", "")}, "drop_if_not_found": bool(rule.get("required"))}, []
    if kind == "remove":
        return {"rule_type": "delete", "origin_field": origin}, []
    if kind == "graft":
        return {"rule_type": "rename", "origin_field": origin, "target_field": key}, []
    if kind != "submatch":
        return {"rule_type": ""}, []
    how = {"format_type": more["preset_filter"]} if more.get("preset_filter") else {"format_type": "regexp", "regexp": more["regexp"]} if more.get("regexp") else {"format_type": "allmatch"}
    if rule.get("value_type") == "date":
        how["time_format"] = {"date_format": layout_to_strftime(more.get("date_format") or ""), "date_location": more.get("date_location") or "", "convert_to_utc8": more.get("date_utc_offset") == UTC8_SECONDS}
    out = {"origin_field": origin, "target_type": rule.get("value_type"), "drop_if_not_found": bool(rule.get("required")), "format_settings": how}
    if origin == key:
        return out | {"rule_type": "format"}, []
    return out | {"rule_type": "clone_and_format", "target_field": key}, [origin]


def to_transforms(settings: TransformSettings) -> TransformSettings:
    """Settings with their legacy rules as transforms: edits first, then deletes of what was moved, renames last."""
    if not settings.fields:
        return settings
    rules, renames, gone = [], [], {}
    for rule in settings.fields:
        made, deletes = field_rule(rule)
        (renames if made["rule_type"] == "rename" else rules).append(transform(made))
        gone |= dict.fromkeys(deletes)
    deletes = [transform({"rule_type": "delete", "origin_field": f}) for f in gone]
    return TransformSettings(settings.pre_function, settings.prefix_match, settings.pre_extract, settings.multi_pre_extract, settings.skip_extract_error, settings.overwrite_origin, [*settings.fields_transform, *rules, *deletes, *renames])
