"""Rule sets of the older engines as DataFrame plans.

``extract`` (no version) gives declared keys only, and looks through texts that hold JSON objects; ``log_prune`` and
``log_prune_v2`` edit the record in place.  All of them share one way to read a field: a default stands for null and empty
values, a missing required field drops the record, text that is no number counts as 0.  Values are read from the record as it
came in; then edits are made in the order of the rules, renames and deletes last.

Parsers of the two oldest engines put what they find in the place of the text, with the text itself as ``__origin__`` where it is asked for
(``extract``: always).  They form a trie of paths: outer ones run first, and inner ones look into what the outer ones have found.  A
parser that fails drops the record, except below an object of ``extract``; one that finds nothing leaves the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import formats as M
from ..functions import record as R
from ..operators.parsers import PreExtract
from .settings import TransformSettings

VERSIONS = ("", "log_prune", "log_prune_v2")
UTC8_SECONDS = 8 * 3600
# The text that stands for the present time, the regular expression that takes all, and the name of a parsed text.
NOW, ALL, ORIGIN = "NOW", "(.*)", "__origin__"


def _typed(matched: Column, kind: str, more: dict) -> tuple[Column, Column]:
    """A matched text as VARIANT of the rule's type, and the error."""
    none = F.lit(None).cast("string")
    if kind == "text":
        return R.variant(matched), none
    if kind == "long":
        return R.variant(M.to_long(matched)), none
    if kind == "float":
        return R.variant(M.to_float(matched)), none
    if kind != "date":
        return F.lit(None).cast("variant"), F.lit("value type not supported")
    layout = M.layout_to_strftime(more.get("date_format") or "")
    if not layout:
        return F.lit(None).cast("variant"), F.lit("date_format is missing")
    at = M.to_date(matched, M.TimeFormat(layout, more.get("date_location") or "", more.get("date_utc_offset") == UTC8_SECONDS))
    at = F.when(matched == NOW, F.current_timestamp()).otherwise(at)
    return R.variant(at), F.when(matched == "", "value was empty").when(at.isNull(), "invalid date string")


def matched_text(rule: dict, what: Column, text: Column) -> Column:
    """The part of a value's text (of kind ``what``) that a rule asks for, or its default."""
    more = rule.get("extention") or {}
    default, regexp, preset = more.get("default_value") or "", (more.get("regexp") or "").strip(), more.get("preset_filter") or ""
    if preset:
        matched = {"allmatch": M.trim_space, "uripath": M.uri_path}[preset](text)
    else:
        matched = text if regexp in ("", ALL) else M.extract(text, regexp, legacy=True)
    matched = F.when(what == "null", F.lit(default)).otherwise(matched)
    return F.coalesce(F.nullif(matched, F.lit("")), F.when(matched.isNotNull(), F.lit(default))) if default else matched


def read_field(rule: dict, value: Column, what: Column | None = None, matched: Column | None = None) -> tuple[Column, Column]:
    """What a rule makes of a value (null: there is none), as VARIANT, and the error; its kind and its matched text may be columns that are there already."""
    more, kind, required = rule.get("extention") or {}, rule.get("value_type") or "", bool(rule.get("required"))
    default = more.get("default_value") or ""
    what = R.kind(value) if what is None else what
    matched = matched_text(rule, what, R.text(value)) if matched is None else matched
    from_text, bad = _typed(matched, kind, more)
    if required:
        bad = F.when(matched == "", "required, but not there").otherwise(bad)
    number = F.try_variant_get(value, "$", "double")
    if kind == "long":
        from_number, no_number = R.variant(number.try_cast("bigint")), F.lit(None).cast("string")
    elif kind == "float":
        from_number, no_number = R.variant(number), F.lit(None).cast("string")
    elif kind == "text":
        from_number, no_number = R.variant(M.plain_number(number)), F.lit(None).cast("string")
    else:
        whole = F.format_string("%d", number.try_cast("bigint"))
        from_number, no_number = _typed(whole, kind, more) if M.is_unix(more.get("date_format") or "") else (F.lit(None).cast("variant"), F.lit("unknown unix date format"))
    as_text = (what == "string") | ((what == "null") & F.lit(bool(default)))
    error = F.when(as_text, bad).when(what == "number", no_number).when(what != "null", "value type not supported")
    if required:
        error = F.when((what == "null") & F.lit(not default), "required, but not there").otherwise(error)
    made = F.when(as_text, from_text).when(what == "number", from_number)
    return F.when(error.isNull(), made), error


def appended(rule: dict) -> tuple[Column, Column]:
    """A constant of the rule's type, or the present time."""
    value = (rule.get("extention") or {}).get("append_value") or ""
    if not value:
        return F.lit(None).cast("variant"), F.lit("append_value is missing")
    if rule.get("value_type") == "date" and value == NOW:
        return R.variant(F.current_timestamp()), F.lit(None).cast("string")
    return read_field(rule | {"extention": (rule.get("extention") or {}) | {"regexp": ALL, "preset_filter": ""}}, R.variant(F.lit(value)))


def _named(entries: Column) -> Column:
    """A map with "_" for "." in its keys."""
    return F.transform_keys(entries, lambda k, _: F.replace(k, F.lit("."), F.lit("_")))


def _levels(prefixes: list[str]) -> list[set[str]]:
    """Names that stay, by level; a level without names keeps all."""
    out: list[set[str]] = []
    for prefix in prefixes:
        for level, part in enumerate(prefix.split(".") if prefix else []):
            while len(out) <= level:
                out.append(set())
            if part:
                out[level].add(part)
    return out


def parser_trie(settings: TransformSettings) -> dict[tuple[str, ...], PreExtract]:
    """The parsers by their paths, outer ones first; of several for one path the last counts."""
    found = {tuple(rule.field.split(".")): rule for rule in settings.pre_extract if rule.mode not in ("strip_ansi", "geoip")}
    return dict(sorted(found.items(), key=lambda item: len(item[0])))


def _pieces(settings: TransformSettings, rule: PreExtract) -> set[str] | None:
    """Numbers of the pieces that field rules read; None where all stay."""
    stem = f"{rule.field}."
    used = {o.removeprefix(stem).split(".")[0] for f in settings.fields if (o := f.get("origin_field") or "").startswith(stem)}
    return {u for u in used if u.isdigit()} or None


def _parsed(text: Column, rule: PreExtract, settings: TransformSettings, origin: bool) -> Column:
    """What a parser finds in a text that is not empty; null where it fails."""
    made = rule.parser(_pieces(settings, rule) if rule.mode == "split" else None)(text)
    if origin:
        made = F.map_concat(R.without(made, [ORIGIN]), F.create_map(F.lit(ORIGIN), text.cast("variant")))
    return F.when(text == "", R.empty()).otherwise(made)


def _failed(rule: PreExtract) -> Column:
    return F.lit(f"field[{rule.field}] parser[{rule.mode}] extract failed")


def parse_within(df: DataFrame, settings: TransformSettings) -> DataFrame:
    """The parsers of ``log_prune``: each path of the trie in its turn, nulls going on each level that the trie passes."""
    trie = parser_trie(settings)
    passed = {path[:n] for path in trie for n in range(1, len(path))}
    asked = {(f.get("origin_field") or "").removesuffix(f".{ORIGIN}") for f in settings.fields if (f.get("origin_field") or "").endswith(f".{ORIGIN}") and f.get("rule_type") != "append"}
    objects = _Opened("__parsed")
    for path in sorted({*trie, *passed}, key=lambda p: (len(p), p)):
        df = df.withColumn("__at", objects.at(path))
        inner = R.as_map(F.col("__at"))
        if path in trie:
            rule = trie[path]
            df = df.withColumn("__text", F.when(R.kind(F.col("__at")) == "string", R.text(F.col("__at"))))
            df = df.withColumn("__found", _parsed(F.col("__text"), rule, settings, rule.field in asked))
            df = df.withColumn("err", F.coalesce("err", F.when(F.col("__text").isNotNull() & F.col("__found").isNull(), _failed(rule))))
            inner = F.when(F.col("__text").isNotNull(), F.when(F.size("__found") > 0, F.col("__found"))).otherwise(inner)
        if path in passed:
            inner = F.map_filter(inner, lambda _, v: R.is_value(v))
        df = objects.add(df, path, inner).drop("__at", "__text", "__found")
    return objects.close(df)


class _Objects:
    """Columns of the objects that paths of ``extract`` go through, texts that hold JSON objects or have a parser among them; each is
    opened once, in steps that Catalyst keeps apart, so that no expression repeats another."""

    def __init__(self, settings: TransformSettings, levels: list[set[str]]):
        self.settings, self.levels, self.trie = settings, levels, parser_trie(settings)
        self.names: dict[tuple, str] = {}
        self.depth: dict[tuple, int] = {(): 0}  # how many parsers an object came through
        self.errors: list[str] = []

    def reached(self, path: tuple[str, ...]) -> bool:
        """Whether the level filters keep a path; they do not look into what a parser found."""
        for level, part in enumerate(path):
            if level and path[:level] in self.trie:
                return True
            if level < len(self.levels) and self.levels[level] and part not in self.levels[level]:
                return False
        return True

    def open(self, df: DataFrame, prefix: tuple[str, ...]) -> DataFrame:
        if prefix in self.names:
            return df
        if not prefix:
            self.names[()] = "__legacy_object0"
            return df.withColumn("__legacy_object0", _named(F.col("rec")))
        df = self.open(df, prefix[:-1])
        n, parents = len(self.names), self.depth[prefix[:-1]]
        name = self.names[prefix] = f"__legacy_object{n}"
        rule = self.trie.get(prefix) if parents < 2 else None
        df = df.withColumn("__legacy_at", F.try_element_at(F.col(self.names[prefix[:-1]]), F.lit(prefix[-1])))
        df = df.withColumn("__legacy_text", F.when(R.kind(F.col("__legacy_at")) == "string", R.text(F.col("__legacy_at"))))
        self.depth[prefix] = parents + 1 if rule or parents else 0
        inner = R.as_map(F.col("__legacy_at"))
        if rule:
            df = df.withColumn("__legacy_parsed", _parsed(F.col("__legacy_text"), rule, self.settings, True))
            if len(prefix) == 1 or parents:
                self.errors.append(f"__legacy_failed{n}")
                df = df.withColumn(self.errors[-1], F.when(F.col("__legacy_text").isNotNull() & F.col("__legacy_parsed").isNull(), _failed(rule)))
            inner = F.coalesce(F.when(F.size("__legacy_parsed") > 0, F.col("__legacy_parsed")), inner if parents else _named(inner))
        elif parents:
            df = df.withColumn("__legacy_parsed", F.lit(None))
        else:
            df = df.withColumn("__legacy_parsed", F.when(F.col("__legacy_text").contains("{"), F.try_parse_json("__legacy_text")))
            inner = _named(F.coalesce(inner, R.as_map(F.col("__legacy_parsed"))))
        return df.withColumn(name, inner).drop("__legacy_at", "__legacy_text", "__legacy_parsed")

    def value(self, path: tuple[str, ...]) -> Column:
        """The value at a path whose parent is open; a text that a parser or JSON has made an object is that object."""
        value = F.try_element_at(F.col(self.names[path[:-1]]), F.lit(path[-1]))
        return F.coalesce(F.to_variant_object(F.col(self.names[path])).cast("variant"), value) if path in self.names else value


def _computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.withColumns(columns) if columns else df


def _read(df: DataFrame, rules: dict[int, dict], inputs: dict[str, Column]) -> tuple[DataFrame, dict[int, tuple[Column, Column]], list[str]]:
    """``df`` with the inputs (``__legacy_in`` and the rule's number) and with what reading them needs, each once; what each rule makes of its own; the columns added."""
    df = _computed(df, inputs)
    what = {f"__legacy_kind{k}": R.kind(F.col(f"__legacy_in{k}")) for k in rules}
    df = _computed(df, what)
    matched = {f"__legacy_matched{k}": matched_text(rule, F.col(f"__legacy_kind{k}"), R.text(F.col(f"__legacy_in{k}"))) for k, rule in rules.items()}
    df = _computed(df, matched)
    read = {k: read_field(rule, F.col(f"__legacy_in{k}"), F.col(f"__legacy_kind{k}"), F.col(f"__legacy_matched{k}")) for k, rule in rules.items()}
    return df, read, [*inputs, *what, *matched]


class _Opened:
    """Objects of ``rec`` as columns of their own, each a map that is null where there is no object.

    An edit changes one small map, not all objects around it, and steps that Catalyst keeps apart repeat no work of each other; ``close`` puts the
    objects back, inner ones first.  A parent keeps an entry for each open object in it, whose value does not count.
    """

    def __init__(self, stem: str):
        self.stem, self.names = stem, {(): "rec"}

    def __getitem__(self, path: tuple[str, ...]) -> Column:
        return F.col(self.names[path])

    def at(self, path: tuple[str, ...]) -> Column:
        """The value at a path whose parent is open, where it is not open itself."""
        return F.try_element_at(self[path[:-1]], F.lit(path[-1]))

    def add(self, df: DataFrame, path: tuple[str, ...], value: Column) -> DataFrame:
        self.names[path] = f"{self.stem}{len(self.names)}"
        return df.withColumn(self.names[path], value)

    def open(self, df: DataFrame, paths: set[tuple[str, ...]]) -> DataFrame:
        """Opens the objects at the paths; all their parents are among these."""
        for path in sorted(paths, key=lambda p: (len(p), p)):
            df = self.add(df, path, R.as_map(self.at(path)))
        return df

    def _set(self, df: DataFrame, where: Column, changes: dict[tuple[str, ...], Column]) -> DataFrame:
        return df.withColumns({self.names[p]: F.when(where, c).otherwise(self[p]) for p, c in changes.items()})

    def _below(self, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        return sorted((p for p in self.names if p[: len(path)] == path and p), key=len)

    def remove(self, df: DataFrame, where: Column, path: tuple[str, ...]) -> DataFrame:
        gone = {p: F.lit(None).cast(R.MAP) for p in self._below(path)}
        return self._set(df, where, {path[:-1]: R.without(self[path[:-1]], [path[-1]])} | gone)

    def put(self, df: DataFrame, where: Column, path: tuple[str, ...], value: Column) -> DataFrame:
        changes = {}
        for n in range(len(path)):
            here = F.coalesce(self[path[:n]], R.empty()) if n else self[()]
            changes[path[:n]] = R.put(here, [path[n]], value if n == len(path) - 1 else R.variant(F.lit("")))
        return self._reopen(self._set(df, where, changes), where, path)

    def _reopen(self, df: DataFrame, where: Column, path: tuple[str, ...]) -> DataFrame:
        for p in self._below(path):
            df = self._set(df, where, {p: R.as_map(self.at(p))})
        return df

    def merge(self, df: DataFrame, where: Column, value: Column) -> DataFrame:
        """An object's entries beside those of the root; other values change nothing."""
        df = df.withColumn(f"{self.stem}more", R.as_map(value))
        more = F.col(f"{self.stem}more")
        df = self._set(df, where & more.isNotNull(), {(): R.merge(self[()], more)})
        for top in sorted({p[0] for p in self.names if p}):
            df = self._reopen(df, where & F.coalesce(F.map_contains_key(more, F.lit(top)), F.lit(False)), (top,))
        return df.drop(f"{self.stem}more")

    def close(self, df: DataFrame) -> DataFrame:
        for path in sorted((p for p in self.names if p), key=len, reverse=True):
            df = self._set(df, self[path].isNotNull(), {path[:-1]: R.put(self[path[:-1]], [path[-1]], F.to_variant_object(self[path]).cast("variant"))})
            df = df.drop(self.names[path])
        return df


def extract(df: DataFrame, settings: TransformSettings) -> DataFrame:
    """``rec`` with the declared keys, and ``err``."""
    objects, values, errors, inputs, there, read = _Objects(settings, _levels(settings.prefix_match)), {}, {}, {}, {}, {}
    for path in objects.trie:
        if objects.reached(path):
            df = objects.open(df, path)
    for k, rule in enumerate(settings.fields):
        if (rule.get("rule_type") or "") == "append":
            made, error = appended(rule)
        else:
            path = tuple((rule.get("origin_field") or "").split("."))
            if path == ("",) or not objects.reached(path):
                made, error = F.lit(None).cast("variant"), F.lit(None).cast("string")
            else:
                df = objects.open(df, path[:-1])
                parent = F.col(objects.names[path[:-1]])
                inputs[f"__legacy_in{k}"] = objects.value(path)
                there[f"__legacy_there{k}"] = F.coalesce(F.map_contains_key(parent, F.lit(path[-1])), F.lit(False))
                read[k] = rule
                continue
        values[f"__legacy_value{k}"], errors[f"__legacy_error{k}"] = made, error
    df, found, helpers = _read(df, read, inputs | there)
    for k, pair in found.items():
        values[f"__legacy_value{k}"], errors[f"__legacy_error{k}"] = (F.when(F.col(f"__legacy_there{k}"), c) for c in pair)
    errors = {f"__legacy_error{k}": errors[f"__legacy_error{k}"] for k in range(len(settings.fields))}  # the first rule's counts
    df = _computed(df, values | errors)
    pairs = [F.create_map(F.lit(rule.get("key") or ""), F.col(f"__legacy_value{k}")) for k, rule in enumerate(settings.fields)]
    made = F.map_filter(F.map_concat(R.empty(), *pairs), lambda _, v: v.isNotNull())
    needed = {rule.get("key") or "" for rule in settings.fields if rule.get("required") or rule.get("system_required")}
    got = sum((F.col(f"__legacy_value{k}").isNotNull().cast("int") for k, rule in enumerate(settings.fields) if (rule.get("key") or "") in needed), F.lit(0))
    short = F.when(got < len(needed), "one or more required fields missing")
    bad = F.coalesce(F.col("err"), *objects.errors, *errors, short)
    return df.withColumns({"err": bad, "rec": F.when(bad.isNull(), made).otherwise(F.col("rec"))}).drop(*values, *errors, *helpers, *objects.names.values(), *objects.errors)


def prune(df: DataFrame, settings: TransformSettings) -> DataFrame:
    """``rec`` edited in place, and ``err``."""
    rules = settings.fields
    kinds = [rule.get("rule_type") or "" for rule in rules]
    targets = [(rule.get("key") or "").removeprefix(f"{R.ROOT}.") for rule in rules]
    origins = [rule.get("origin_field") or "" for rule in rules]
    written = {rule.get("key") or "" for rule, kind in zip(rules, kinds, strict=True) if kind != "remove"}
    # keys without a name go where there are rules at all
    df = df.withColumn("rec", F.map_filter("rec", lambda k, v: ((k != "") | F.lit(not rules)) & R.is_value(v)))
    rec, made, inputs, read = F.col("rec"), {}, {}, {}
    for k, (rule, kind) in enumerate(zip(rules, kinds, strict=True)):
        if kind == "append":
            made[f"__legacy_value{k}"], made[f"__legacy_error{k}"] = appended(rule)
        elif kind in ("submatch", "graft") and origins[k]:
            value = R.get(rec, origins[k])
            if kind == "graft":
                made[f"__legacy_value{k}"], made[f"__legacy_error{k}"] = F.when(R.is_value(value), value), F.lit(None).cast("string")
            else:
                inputs[f"__legacy_in{k}"], read[k] = value, rule
                made[f"__legacy_value{k}"] = made[f"__legacy_error{k}"] = None  # its place: the first rule's error counts
    df, found, helpers = _read(df, read, inputs)
    for k, pair in found.items():
        fits = F.col(f"__legacy_kind{k}").isin("string", "number")
        made[f"__legacy_value{k}"], made[f"__legacy_error{k}"] = (F.when(fits, c) for c in pair)
    df = _computed(df, made).drop(*helpers)
    stays = {origins[k] for k, kind in enumerate(kinds) if kind == "submatch" and targets[k] == origins[k]}
    needed = [k for k, rule in enumerate(rules) if rule.get("required")]
    got = sum((F.col(f"__legacy_value{k}").isNotNull().cast("int") for k in needed if f"__legacy_value{k}" in made), F.lit(0))
    short = F.when(got < len(needed), "one or more required fields missing")
    df = df.withColumn("err", F.coalesce(F.col("err"), *(c for c in made if "error" in c), short))

    split = lambda text: tuple(R.split_path(text))
    moved = {k for k, kind in enumerate(kinds) if f"__legacy_value{k}" in made and (kind in ("append", "submatch") or targets[k] != origins[k])}
    dropped = [k for k, kind in enumerate(kinds) if kind == "remove" and origins[k] and origins[k] not in written]
    used = [split(o) for o in origins] + [split(targets[k]) for k in moved if targets[k] != R.ROOT]
    objects, good = _Opened("__pruned"), F.col("err").isNull()
    df = objects.open(df, {path[:n] for path in used for n in range(1, len(path))})
    for k in sorted(moved, key=lambda k: (kinds[k] == "graft", k)):
        value, origin, target = F.col(f"__legacy_value{k}"), split(origins[k]), split(targets[k])
        if kinds[k] == "append":
            df = objects.put(df, good & objects[target[:-1]].isNotNull(), target, value)
            continue
        there = good & value.isNotNull()
        if kinds[k] == "graft" or not (origins[k] in stays or targets[k] == origins[k]):
            df = objects.remove(df, there, origin)
        df = objects.merge(df, there, value) if targets[k] == R.ROOT else objects.put(df, there, target, value)
    for k in dropped:
        df = objects.remove(df, good, split(origins[k]))
    parents = {".".join(path[:n]) for o in origins for path in [R.split_path(o)] for n in range(1, len(path))}
    for parent in sorted(parents, key=lambda p: (-p.count("."), p)):
        df = objects.remove(df, good & (F.size(objects[split(parent)]) == 0), split(parent))
    return objects.close(df).drop(*made)


def edit(df: DataFrame, settings: TransformSettings, version: str) -> DataFrame:
    """``rec`` by the engine of a version, its parsers among its work but for those of ``log_prune_v2``, which ran before."""
    if version == "":
        return extract(df, settings)
    return prune(parse_within(df, settings) if version == "log_prune" else df, settings)
