"""Places of addresses: IPv4 and IPv6 addresses joined with a table of ranges, of which the narrowest counts.

An address is 32 hexadecimal digits, an IPv4 address that of its IPv6 form (``::ffff:a.b.c.d``), so that text order is the order of numbers.  Ranges are
cut into bins by leading digits.  A bin with more than ``CROWDED`` ranges inside is split by further digits, again and again, so that neither a
busy /16 nor a busy IPv6 block meets in one task; counts for all lengths come from one aggregation.  Inside a bin ranges become stretches that do
not overlap, each of the narrowest range there, so an address has one place.  The stretches are broadcast if they are few, else both sides are
shuffled by the bin.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Leading digits of the bins, coarse ones first, for IPv4 (whose first 24 digits are fixed) and for IPv6.
LENGTHS = {True: (28, 30, 32), False: (4, 8, 12, 16, 20, 24, 28, 32)}
#: Ranges inside a bin before it is split.
CROWDED = 128
#: Most crowded bins that the driver holds and that are broadcast; more are joined by a shuffle.
FEW_BINS = 20_000
#: The first digits of IPv4 addresses.
MAPPED = "0" * 20 + "ffff"
# Private and loopback networks, and those that have no place either.
PRIVATE = [("10.0.0.0", 8), ("127.0.0.0", 8), ("172.16.0.0", 12), ("192.168.0.0", 16)]
NOWHERE = [("169.254.0.0", 16), ("0.0.0.0", 8)]


def ip_number(address: Column) -> Column:
    """An IPv4 address as a whole number; null for other texts, numbers with a leading zero among them."""
    parts = F.split(address, r"\.")
    numbers = [F.get(parts, k).try_cast("bigint") for k in range(4)]
    value = numbers[0] * (1 << 24) + numbers[1] * (1 << 16) + numbers[2] * (1 << 8) + numbers[3]
    return F.when(address.rlike(r"^(?:(?:0|[1-9][0-9]{0,2})\.){3}(?:0|[1-9][0-9]{0,2})\z") & (F.greatest(*numbers) <= 255), value)


def _hex(number: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.hex(number)), digits, "0")


def _pad(text: Column, digit: str) -> Column:
    return F.rpad(text, 32, digit)


def with_digits(df: DataFrame, address: str, name: str) -> DataFrame:
    """``df`` with an IPv4 or IPv6 address as 32 hexadecimal digits; null for other texts.  Each step is a projection of its own, so that no expression repeats another."""
    text, tail, plain, sides = F.col(address), F.col("__tail"), F.col("__plain"), F.col("__sides")
    df = df.withColumn("__four", ip_number(text)).withColumn("__tail", ip_number(F.regexp_extract(text, r":([0-9.]+)\z", 1)))
    embedded = F.concat(F.regexp_replace(text, r"[0-9.]+\z", ""), F.hex(F.shiftright(tail, 16)), F.lit(":"), F.hex(tail.bitwiseAND(65_535)))
    df = df.withColumn("__plain", F.when(text.contains("."), embedded).otherwise(text))
    groups = "(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,7})?"
    shape = plain.rlike(f"^{groups}(?:::)?{groups}\\z") & plain.contains(":")
    df = df.withColumn("__sides", F.when(shape, F.transform(F.split(plain, "::", -1), lambda side: F.filter(F.split(side, ":", -1), lambda g: g != ""))))
    df = df.withColumn("__many", F.size(F.flatten(sides)))
    df = df.withColumn("__written", F.transform(sides, lambda side: F.array_join(F.transform(side, lambda g: F.lpad(F.lower(g), 4, "0")), "")))
    short = F.when((F.size(sides) == 2) & F.col("__many").between(0, 7), F.concat(F.get("__written", 0), F.repeat(F.lit("0000"), 8 - F.col("__many")), F.get("__written", 1)))
    six = F.when((F.size(sides) == 1) & (F.col("__many") == 8), F.get("__written", 0)).otherwise(short)
    return df.withColumn(name, F.coalesce(F.concat(F.lit(MAPPED), _hex(F.col("__four"), 8)), six)).drop("__four", "__tail", "__plain", "__sides", "__many", "__written")


def _within(digits: Column, networks: list[tuple[str, int]]) -> Column:
    out = F.lit(False)
    for base, bits in networks:
        a, b, c, d = map(int, base.split("."))
        low = a << 24 | b << 16 | c << 8 | d
        out |= digits.between(f"{MAPPED}{low:08x}", f"{MAPPED}{low + (1 << 32 - bits) - 1:08x}")
    return out


def is_private(digits: Column) -> Column:
    """Private or loopback."""
    return _within(digits, PRIVATE) | (digits == "0" * 31 + "1") | digits.startswith("fc") | digits.startswith("fd")


def address_error(address: Column, digits: Column) -> Column:
    """What is wrong with an address text: private or loopback, or no address at all; null for texts that may be looked up."""
    return F.when(is_private(digits), "must be public ip address").when(address.isNotNull() & digits.isNull(), "not an ip address")


def language(format: str) -> str:
    """The language that a rule's configuration asks for."""
    try:
        found = json.loads(format) if format else {}
    except ValueError:
        return "en"
    return (found.get("lang") if isinstance(found, dict) else None) or "en"


def _with_ends(ranges: DataFrame) -> DataFrame:
    """First and last address of a range, from whole numbers (IPv4) or a network with the length of its prefix."""
    if "network" not in ranges.columns:
        return ranges.where("ip_from <= ip_to").withColumns({"__first": F.concat(F.lit(MAPPED), _hex(F.col("ip_from"), 8)), "__last": F.concat(F.lit(MAPPED), _hex(F.col("ip_to"), 8))})
    df = with_digits(ranges.withColumn("__text", F.substring_index("network", "/", 1)), "__text", "__base")
    bits = F.substring_index("network", "/", -1).try_cast("int") + F.when(F.col("__text").contains(":"), 0).otherwise(96)
    df = df.withColumn("__bits", bits).withColumn("__bits", F.when(F.col("__bits").between(0, 128), F.col("__bits")))
    df = df.withColumns({"__whole": F.floor(F.col("__bits") / 4).cast("int"), "__rest": F.col("__bits") % 4})
    df = df.withColumns({"__digit": F.conv(F.substring(F.col("__base"), F.col("__whole") + 1, F.lit(1)), 16, 10).cast("int"), "__span": F.element_at(F.array(*map(F.lit, (16, 8, 4, 2))), F.col("__rest") + 1), "__kept": F.substring(F.col("__base"), F.lit(1), F.col("__whole"))})
    low = F.col("__digit") - F.col("__digit") % F.col("__span")
    at = lambda d: F.when(F.col("__rest") == 0, F.lit("")).otherwise(F.lower(F.hex(d)))
    df = df.withColumns({"__first": _pad(F.concat("__kept", at(low)), "0"), "__last": _pad(F.concat("__kept", at(low + F.col("__span") - 1)), "f")})
    # filters that Catalyst infers further up would be pushed down here, with every step's expression written into them; it does not push
    # through a projection that is not deterministic
    df = df.withColumn("__wall", F.rand(0)).where("__wall >= 0")
    return df.drop("__text", "__base", "__bits", "__whole", "__rest", "__digit", "__span", "__kept", "__wall")


def _length(digits: Column, level: int) -> Column:
    """Digits of the bins of a level; past the last level of IPv4 bins are whole addresses."""
    four = LENGTHS[True]
    return F.when(digits.startswith(MAPPED), four[min(level, len(four) - 1)]).otherwise(LENGTHS[False][level])


def _cut(cells: DataFrame, level: int, busy: Column) -> DataFrame:
    """Cells (bin, first, last and what is known) of busy bins cut at the borders of a level's bins; the others as they are."""
    cells = cells.withColumns({"__n": _length(F.col("first"), level), "__had": F.length("bin"), "__cut": busy})
    part = lambda c: F.conv(F.substring(F.col(c), F.col("__had") + 1, F.col("__n") - F.col("__had")), 16, 10).cast("bigint")
    bins = F.transform(F.sequence(part("first"), part("last")), lambda k: F.concat("bin", F.lpad(F.lower(F.hex(k)), F.col("__n") - F.col("__had"), F.lit("0"))))
    out = cells.select(F.explode(F.when(F.col("__cut"), bins).otherwise(F.array("bin"))).alias("bin"), "first", "last", "known")
    return out.select("bin", F.greatest("first", _pad(F.col("bin"), "0")).alias("first"), F.least("last", _pad(F.col("bin"), "f")).alias("last"), "known")


def _crowded(ranges: DataFrame, crowded: int) -> DataFrame:
    """level and bin of the bins with more ranges inside than ``crowded``, whatever their length."""
    levels = range(len(LENGTHS[False]) - 1)
    inside = F.filter(F.array(*(F.struct(F.lit(k).alias("level"), F.substring(F.col("first"), F.lit(1), _length(F.col("first"), k)).alias("bin"), (F.substring(F.col("first"), F.lit(1), _length(F.col("first"), k)) == F.substring(F.col("last"), F.lit(1), _length(F.col("first"), k))).alias("fits")) for k in levels)), lambda e: e["fits"] & (F.length(e["bin"]) < 32))
    each = ranges.select(F.explode(inside).alias("e")).select("e.level", "e.bin")
    return each.groupBy("level", "bin").agg(F.count("*").alias("n")).where(F.col("n") > crowded).select("level", "bin")


def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def geoip(df: DataFrame, address: str, ranges: DataFrame, small_rows: int = 200_000, lang: str = "en", crowded: int = CROWDED, digits: str = "") -> DataFrame:
    """``df`` with a struct column ``geoip`` from a table of ranges and what is known of them.

    Ranges are ``network`` texts (``2001:db8::/32``, ``1.2.3.0/24``) or whole numbers ``ip_from`` and ``ip_to`` (IPv4).  Columns that hold names by language
    (maps) give that of ``lang``.  ``digits`` is a column of ``with_digits``, where there is one.  Private addresses, texts that are none and those in no range have no place (null).
    """
    columns = [f for f in ranges.schema.fields if f.name not in ("ip_from", "ip_to", "network")]
    shown = [F.coalesce(F.try_element_at(F.col(f.name), F.lit(lang)), F.lit("")).alias(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in columns]
    known = [f.name for f in columns]
    cells = _with_ends(ranges).select(F.col("__first").alias("first"), F.col("__last").alias("last"), *shown)
    cells = cells.select("first", "last", F.struct("first", "last", *known).alias("known"))
    split = _crowded(cells, crowded)
    few = split.limit(FEW_BINS + 1).collect()
    if len(few) <= FEW_BINS:  # as a table of its own it is not counted again at each level
        split = df.sparkSession.createDataFrame(few, "level int, bin string")
        deep = sorted({r.level for r in few})
    else:
        deep = sorted(r.level for r in split.select("level").distinct().collect())  # at most a row for each level
    start = F.when(F.col("first").startswith(MAPPED), F.lit(MAPPED)).otherwise(F.lit(""))
    cells = _cut(cells.withColumn("bin", start), 0, F.lit(True))
    rows = df.withColumn("__ip", F.col(digits)) if digits else with_digits(df, address, "__ip")
    rows = rows.withColumn("__ip", F.when(~is_private(F.col("__ip")) & ~_within(F.col("__ip"), NOWHERE), F.col("__ip")))
    rows = rows.withColumn("__bin", F.substring(F.col("__ip"), F.lit(1), _length(F.col("__ip"), 0)))
    for level in deep:
        busy = split.where(F.col("level") == level).select(F.col("bin").alias("__busy"))
        busy = F.broadcast(busy) if len(few) <= FEW_BINS else busy
        cells = _cut(cells.join(busy, F.col("bin") == F.col("__busy"), "left"), level + 1, F.col("__busy").isNotNull())
        rows = rows.join(busy, F.col("__bin") == F.col("__busy"), "left")
        finer = F.substring(F.col("__ip"), F.lit(1), _length(F.col("__ip"), level + 1))
        rows = rows.withColumn("__bin", F.when(F.col("__busy").isNotNull(), finer).otherwise(F.col("__bin"))).drop("__busy")
    # "g" comes after all digits: the place just behind a range
    borders = cells.select("bin", F.explode(F.array("first", F.concat("last", F.lit("g")))).alias("__from")).distinct()
    stretches = borders.withColumn("__to", F.lead("__from").over(Window.partitionBy("bin").orderBy("__from"))).where("__to IS NOT NULL")
    # of overlapping ranges the narrowest: the one that begins last, then the one that ends first
    narrow = F.struct(F.translate("known.first", "0123456789abcdef", "fedcba9876543210"), "known.last", F.to_json("known"))
    inner = stretches.join(cells.withColumnRenamed("bin", "__own"), F.col("bin") == F.col("__own")).where((F.col("first") <= F.col("__from")) & (F.col("__from") < F.concat("last", F.lit("g"))))
    cut = inner.groupBy("bin", "__from", "__to").agg(F.min_by("known", narrow).alias("__range"))
    cut = _few(cut.withColumnRenamed("bin", "__place"), small_rows)
    inside = (F.col("__bin") == F.col("__place")) & (F.col("__ip") >= F.col("__from")) & (F.col("__ip") < F.col("__to"))
    joined = rows.join(cut, inside, "left")
    place = [F.col(f"__range.{c}").alias(c) for c in known]
    if {"latitude", "longitude"} <= set(known):
        place.append(F.struct(F.col("__range.latitude").alias("lat"), F.col("__range.longitude").alias("lon")).alias("location"))
    found = F.when(F.col("__range").isNotNull(), F.struct(F.col(address).alias("ip"), *place))
    return joined.withColumn("geoip", found).drop("__ip", "__bin", "__range", "__from", "__to", "__place")
