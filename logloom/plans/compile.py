"""Tasks as DataFrame plans: the same plan runs over tables and over streams.

Text filters come before anything is decoded; first-level keys are pruned before parsers run; edits of one level that do
not depend on each other are one edit.  Every record ends in one of four ways: kept, filtered out, dropped for an error, or
dropped because no field is left; ``statuses=True`` keeps all of them with a ``status`` column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import record as R
from ..operators import prefilters
from ..operators.geoip import address_error, geoip, language, with_digits
from ..operators.parsers import PreExtract
from ..operators.transforms import change, fuse, fused
from . import legacy
from .convert import to_transforms
from .settings import Task, TransformSettings, load

FAILURE = "log_transform_failure"


def _parser_groups(rules: list[PreExtract]) -> list[list[PreExtract]]:
    """Rules of one field together, where the first of them stands: they are tried in turn."""
    out: dict[str, list[PreExtract]] = {}
    for rule in rules:
        out.setdefault(rule.field if rule.mode != "geoip" else f"{rule.field}\0geoip", []).append(rule)
    return list(out.values())


def _used_pieces(settings: TransformSettings, rule: PreExtract) -> set[str] | None:
    """Numbers of the split pieces that later rules read; None where all have to stay."""
    stem = f"{rule.field.split('.')[-1]}_split_"
    if not settings.fields_transform or settings.overwrite_origin:
        return None
    used = {t.origin_field.split(".")[-1].removeprefix(stem) for t in settings.fields_transform if t.origin_field.split(".")[-1].startswith(stem)}
    return used or None


def _parse(df: DataFrame, group: list[PreExtract], settings: TransformSettings, every: bool = False) -> DataFrame:
    """One field's parsers: the first that gives something wins, the last one's failure is the error.  ``every``: each that finds something counts,
    all of them on the text as it came."""
    before = df.columns
    path = R.split_path(group[0].field)
    df = df.withColumn("__value", R.get(F.col("rec"), path)).withColumn("__there", R.has(F.col("rec"), path))
    df = df.withColumn("__text", F.when(R.kind(F.col("__value")) == "string", R.text(F.col("__value"))))
    text, found, mode = F.col("__text"), None, None
    for k, one in enumerate(group):
        parsed = one.parser(_used_pieces(settings, one) if one.mode == "split" else None)(text)
        name, last = f"__parsed{k}", k == len(group) - 1
        df = df.withColumn(name, F.when(text == "", R.empty()).otherwise(parsed))
        if every:
            df = _placed(df, path, F.col(name), F.lit(one.mode), settings, last)
            continue
        good = F.col(name) if last else F.when(F.size(name) > 0, F.col(name))
        wins = F.col(name).isNotNull() & ((F.size(name) > 0) | F.lit(last))
        found = good if found is None else F.coalesce(found, good)
        mode = F.when(wins, one.mode) if mode is None else mode.when(wins, one.mode)
    if not every:
        df = _placed(df, path, found, mode, settings, True)
    return df.drop(*(c for c in df.columns if c not in before))


def _placed(df: DataFrame, path: list[str], found: Column, mode: Column, settings: TransformSettings, strict: bool) -> DataFrame:
    """``rec`` with what a parser found, and ``err``; ``strict``: where it found nothing, that is an error."""
    rec, there, text, field = F.col("rec"), F.col("__there"), F.col("__text"), ".".join(path)
    df = df.withColumn("__found", found).withColumn("__mode", mode)
    error = F.when(there & text.isNull(), F.lit(f"field[{field}] is not a string")).when(there & F.col("__found").isNull() & F.lit(strict), F.lit(f"field[{field}] does not parse"))
    parent, leaf = path[:-1], path[-1]
    beside = R.as_map(R.get(rec, parent)) if parent else rec
    named = F.transform_keys(F.col("__found"), lambda k, _: F.when(F.col("__mode") == "split", F.concat(F.lit(f"{leaf}_split_"), k)).otherwise(k))
    df = df.withColumn("__named", named).withColumn("__beside", beside)
    free = F.map_from_entries(
        F.transform(
            F.map_entries("__named"),
            lambda e: F.struct(
                F.when(F.map_contains_key(F.col("__beside"), e["key"]), F.concat(F.lit(f"{leaf}_"), F.col("__mode"), F.lit("_"), F.regexp_replace(e["key"], f"^\\Q{leaf}_split_\\E", ""))).otherwise(e["key"]).alias("key"),
                e["value"],
            ),
        )
    )
    replaced = R.put(rec, path, F.to_variant_object(F.col("__found")).cast("variant"))
    merged = R.put_all(rec, parent, free)
    overwrite = F.lit(settings.overwrite_origin) | (F.col("__mode") == "json")
    ok = F.col("err").isNull() | F.lit(settings.skip_extract_error)
    changed = F.when(ok & there & F.col("__found").isNotNull() & error.isNull(), F.when(overwrite, replaced).otherwise(merged)).otherwise(rec)
    first = F.coalesce(error, F.col("err")) if settings.skip_extract_error else F.coalesce(F.col("err"), error)
    df = df.withColumn("__rec", changed).withColumn("__err", first)
    return df.withColumn("rec", F.col("__rec")).withColumn("err", F.col("__err"))


def _locate(df: DataFrame, rule: PreExtract, settings: TransformSettings, ranges: DataFrame | None, strict: bool = True) -> DataFrame:
    """The geoip parser as a join; without a table of ranges the rule does nothing.  Addresses that are private or none are errors, if ``strict``."""
    if ranges is None:
        return df
    path = R.split_path(rule.field)
    rows = with_digits(df.withColumn("__address", R.text(R.get(F.col("rec"), path))), "__address", "__digits")
    rows = geoip(rows, "__address", ranges, lang=language(rule.format), digits="__digits")
    placed = R.put_all(F.col("rec"), path[:-1], F.create_map(F.lit("geoip"), F.to_variant_object(F.col("geoip")).cast("variant")))
    error = address_error(F.col("__address"), F.col("__digits")) if strict else F.lit(None).cast("string")
    err = F.coalesce(error, F.col("err")) if settings.skip_extract_error else F.coalesce(F.col("err"), error)
    return rows.withColumns({"rec": F.when(F.col("geoip").isNotNull(), placed).otherwise(F.col("rec")), "err": err}).drop("geoip", "__address", "__digits")


def _edit(df: DataFrame, settings: TransformSettings, dictionaries: dict, prefixes: list[tuple[str, str]] | None) -> DataFrame:
    ok = F.col("err").isNull() | F.lit(settings.skip_extract_error)
    before = df.columns
    for run in fuse(settings.fields_transform):
        if len(run) > 1:
            df = df.withColumn("rec", F.when(ok, fused(F.col("rec"), run)).otherwise(F.col("rec")))
            continue
        df, record, error = change(df, run[0], dictionaries, prefixes)
        err = F.coalesce(error, F.col("err")) if settings.skip_extract_error else F.coalesce(F.col("err"), error)
        df = df.withColumns({"rec": F.when(ok, record).otherwise(F.col("rec")), "err": err})
        df = df.drop(*(c for c in df.columns if c not in before))
    return df


def compile_settings(config: str | dict | TransformSettings, dictionaries: dict | None = None, ranges: DataFrame | None = None, raw: str = "raw", statuses: bool = False, version: str = "log_transform", uri_patterns: list[tuple[str, str]] | None = None) -> Callable[[DataFrame], DataFrame]:
    """A function from a DataFrame with a text (or, for compressed messages, binary) column to one with ``rec`` and ``err``.

    ``dictionaries`` by schema number are maps from keys to texts, or tables (``transforms.Dictionary``), whose entries may depend on the event's time.
    ``uri_patterns`` (``formats.uri_patterns`` reads them) name parts of paths for all uripath formats.  Field rules of the older versions run as those engines ran them; ``log_transform`` converts them to transforms.
    """
    settings = config if isinstance(config, TransformSettings) else load(config)
    old = version in legacy.VERSIONS
    if version == "" and not settings.fields:
        raise ValueError("the oldest engine needs fields")
    settings = settings if old else to_transforms(settings)

    def plan(df: DataFrame) -> DataFrame:
        df.sparkSession.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        df = prefilters.input_stage(df, settings.pre_function, raw)
        if statuses:
            kept = F.lit(True)
            for f in settings.pre_function:
                if f.mode in prefilters.STRING_FILTERS:
                    kept &= prefilters.keeps(F.col(raw), f)
            df = df.withColumn("status", F.when(~F.coalesce(kept, F.lit(False)), "filtered"))
            rest = [f for f in settings.pre_function if f.mode in prefilters.REWRITES]
        else:
            rest = settings.pre_function
        df = prefilters.text_stage(df, rest, raw)
        if version == "" and any(r.mode == "strip_ansi" for r in settings.pre_extract):
            df = df.withColumn(raw, prefilters.strip_ansi(F.col(raw)))
        df = df.withColumn("rec", R.decode(F.col(raw))).withColumn("err", F.when(F.col("rec").isNull(), "not a JSON object"))
        for f in settings.pre_function:
            if f.mode in prefilters.KEY_VALUE_FILTERS:
                good = prefilters.keeps_record(F.col("rec"), f)
                df = df.withColumn("status", F.when(F.col("status").isNull() & ~good, "filtered").otherwise(F.col("status"))) if statuses else df.where(good)
        keys = [k for k in settings.prefix_match if k]
        if keys and not (old and version == ""):  # the oldest engine prunes by level
            df = df.withColumn("rec", F.map_filter("rec", lambda k, _: k.isin(keys)))
        for group in _parser_groups([r for r in settings.pre_extract if not (old and r.mode == "strip_ansi")]):
            if group[0].mode == "geoip":
                df = _locate(df, group[0], settings, ranges, strict=not old)
            elif not old or version == "log_prune_v2":
                df = _parse(df, group, settings, every=old and settings.multi_pre_extract)
        df = legacy.edit(df, settings, version) if old else _edit(df, settings, dictionaries or {}, uri_patterns)
        if settings.skip_extract_error:
            tagged = F.map_concat(R.without(F.col("rec"), [FAILURE]), F.create_map(F.lit(FAILURE), F.col("err").cast("variant")))
            df = df.withColumn("rec", F.when(F.col("rec").isNotNull() & F.col("err").isNotNull(), tagged).otherwise(F.col("rec")))
        lost = F.col("rec").isNull() if settings.skip_extract_error else F.col("err").isNotNull()
        empty = F.size("rec") == 0  # a record without fields is no result
        # Catalyst would push this and later filters down through all steps, and write every step's expression into them;
        # it does not push through a projection that is not deterministic
        df = df.withColumn("__wall", F.rand(0))
        if statuses:
            df = df.withColumn("status", F.coalesce("status", F.when(lost, "error").when(empty, "empty_result"), F.lit("ok"))).where("__wall >= 0")
        else:
            df = df.where((F.col("__wall") >= 0) & ~lost & ~empty)
        return df.drop("__wall")

    return plan


def compile_task(task: Task, **options) -> Callable[[DataFrame], DataFrame]:
    """The plan of a task, by the engine that its version names."""
    return compile_settings(task.settings, version=task.version, **options)


def project(df: DataFrame, columns: dict[str, tuple[str, str]], keep: list[str] | None = None) -> DataFrame:
    """Typed columns of a record: name to (path, type), where text is "string" with numbers in plain form."""
    made: list[Column] = []
    for name, (path, kind) in columns.items():
        value = R.get(F.col("rec"), path)
        made.append((F.try_variant_get(value, "$", kind)).alias(name))
    return df.select(*(keep or []), *made)


def prune_nulls(rec: Column) -> Column:
    """The pruning engines' clean-up: nulls and empty-text keys go."""
    return F.map_filter(rec, lambda k, v: (k != "") & R.is_value(v))


def prune_levels(rec: Column, prefixes: list[str]) -> Column:
    """Keys kept level by level, as the first, second and further parts of dotted prefixes name them."""
    heads: dict[str, list[str]] = {}
    for p in prefixes:
        head, _, rest = p.partition(".")
        heads.setdefault(head, [])
        if rest:
            heads[head].append(rest)
    names = sorted(heads)
    out = F.map_filter(rec, lambda k, _: k.isin(names))
    for head, rest in heads.items():
        if rest:
            child = R.as_map(F.try_element_at(out, F.lit(head)))
            smaller = F.map_concat(R.without(out, [head]), F.create_map(F.lit(head), F.to_variant_object(prune_levels(child, rest)).cast("variant")))
            out = F.when(child.isNull(), out).otherwise(smaller)
    return out


def expand_json_strings(rec: Column) -> Column:
    """Texts that hold JSON objects as those objects (the oldest engine)."""

    def one(_, v: Column) -> Column:
        parsed = F.when((R.kind(v) == "string") & R.text(v).contains("{"), F.try_parse_json(R.text(v)))
        return F.when(parsed.isNotNull() & (R.kind(parsed) == "object"), parsed).otherwise(v)

    return F.transform_values(rec, one)
