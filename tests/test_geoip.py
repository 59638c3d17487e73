"""Addresses and ranges against Python's ipaddress."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from logloom.operators.geoip import address_error, geoip, with_digits

TEXTS = [
    "1.2.3.4", "255.255.255.255", "256.1.1.1", "01.2.3.4", "1.2.3", "1.2.3.4.5", "", "::", "::1", "1::", "2001:db8::1", "2001:DB8:0:0:0:0:0:1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1::2::3", ":1::2", "1:::2",
    "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4::5:6:7:8", "::ffff:10.0.0.1", "::ffff:1.2.3.4", "64:ff9b::1.2.3.4", "::1.2.3", "1.2.3.4::", "fe80::1%eth0", "12345::", "g::", "foo:bar", "fd12::9", "fc00::", "fb00::", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", ":", "1:", "::ffff:a00:1",
]


def parsed(text):
    try:
        ip = ipaddress.ip_address(text)
    except ValueError:
        return None
    if "%" in text:
        return None
    return f"{int(ip):032x}" if ip.version == 6 else "0" * 20 + "ffff" + f"{int(ip):08x}"


def test_addresses(spark):
    rows = with_digits(spark.createDataFrame([(t,) for t in TEXTS] + [(None,)], "t string"), "t", "h")
    got = {r.t: r.h for r in rows.collect()}
    assert got == {t: parsed(t) for t in TEXTS} | {None: None}
    bad = {r.t: r.e for r in rows.select("t", address_error(F.col("t"), F.col("h")).alias("e")).collect()}
    assert {t for t, e in bad.items() if e == "not an ip address"} == {t for t in TEXTS if parsed(t) is None}
    assert {t for t, e in bad.items() if e == "must be public ip address"} == {"::1", "::ffff:10.0.0.1", "fd12::9", "fc00::", "::ffff:a00:1"} and bad[None] is None


@pytest.mark.parametrize("crowded, small", [(128, 200_000), (5, 0)])
def test_narrowest_network(spark, monkeypatch, crowded, small):
    """Networks inside each other, crowded and not, broadcast and shuffled: the longest prefix counts."""
    if not small:
        monkeypatch.setattr("logloom.operators.geoip.FEW_BINS", 2)
    r = random.Random(3)
    networks = {ipaddress.ip_network("2001:db8::/32"), ipaddress.ip_network("20.0.0.0/8"), ipaddress.ip_network("2000::/3")}
    for _ in range(60):
        bits = r.choice([33, 40, 47, 48, 50, 64, 127, 128])
        networks.add(ipaddress.ip_network((0x20010DB8 << 96 | r.getrandbits(8) << 80 | r.getrandbits(3) << 60, bits), strict=False))
        networks.add(ipaddress.ip_network((20 << 24 | r.choice([5, r.getrandbits(8)]) << 16 | r.getrandbits(16), r.choice([9, 15, 16, 20, 24, 31, 32])), strict=False))
    addresses = [str(n[r.randrange(min(n.num_addresses, 1 << 30))]) for n in networks for _ in range(3)] + ["9.9.9.9", "4000::1", None, "x"]
    ranges = spark.createDataFrame([(str(n), str(n)) for n in networks], "network string, name string")
    df = spark.createDataFrame(list(enumerate(addresses)), "i int, a string")
    rows = geoip(df, "a", ranges, small_rows=small, crowded=crowded).collect()
    assert len(rows) == len(addresses)
    for row in rows:
        fits = [n for n in networks if row.a and row.a != "x" and ipaddress.ip_address(row.a) in n]
        want = str(max(fits, key=lambda n: n.prefixlen)) if fits else None
        assert (row.geoip.name if row.geoip else None) == want, row.a


def test_no_ranges(spark):
    df = spark.createDataFrame([("1.2.3.4",)], "a string")
    assert geoip(df, "a", spark.createDataFrame([], "network string, name string")).first().geoip is None
