from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import number, ranges, rows, views
from viewmill.functions.network import ip_key, ipv4_number, key_position
from viewmill.operators.geo import (
    assert_disjoint,
    geo_lookup,
    overlapping_ranges,
    range_blocks,
    ranges_fit_broadcast,
)
from viewmill.operators.sizing import BroadcastLimit, broadcast_if_small, fits_broadcast
from viewmill.schemas import LOCATION_FIELDS

UNKNOWN, ERROR = ("UNKNOWN",) * 4, ("ERROR",) * 4


def lookup(spark, ip, table, **how):
    found = geo_lookup(views(spark, {"ip": ip}), table, **how)
    return [tuple(r) for r in found.select(*LOCATION_FIELDS).collect()]


@pytest.fixture(scope="module")
def table(spark):
    return ranges(
        spark,
        ("10.0.0.0", "10.0.255.255", "A"),
        ("10.1.0.10", "10.1.0.20", "B"),
        ("11.0.0.0", "13.255.255.255", "W"),
        (number("20.0.0.0"), number("20.0.0.255"), "C", None, "-", "Town"),
    )


@pytest.mark.parametrize("how", [{}, {"broadcast": False, "rows_per_split": 1}])
def test_lookup_cases(spark, table, how):
    a, w = ("A", "A name", "A region", "UNKNOWN"), ("W", "W name", "W region", "UNKNOWN")
    b = ("B", "B name", "B region", "UNKNOWN")
    cases = {
        None: UNKNOWN,
        "": UNKNOWN,
        "10.26.0.1": UNKNOWN,
        "::1": UNKNOWN,
        "x.y": ERROR,
        "1.2.3": ERROR,
        "1.2.3.999": ERROR,
        "10.0.0.0": a,
        "10.0.255.255": a,
        "10.1.0.9": UNKNOWN,
        "10.1.0.10": b,
        "10.1.0.20": b,
        "10.1.0.21": UNKNOWN,
        "11.0.0.0": w,
        "12.200.3.4": w,
        "13.255.255.255": w,
        "14.0.0.0": UNKNOWN,
        "20.0.0.7": ("C", None, "UNKNOWN", "Town"),
    }
    found = geo_lookup(views(spark, *[{"id": str(i), "ip": ip} for i, ip in enumerate(cases)]), table, **how)
    assert {r.ip: tuple(r[c] for c in LOCATION_FIELDS) for r in found.collect()} == cases
    assert found.count() == len(cases)


def random_ranges(seed):
    """Disjoint ranges of width 1 to over 2**24 with gaps between some of them."""
    rng, at, out = random.Random(seed), 0, []
    while at < 2**32:
        width = min(2 ** rng.randint(0, 25) + rng.randint(0, 9), 2**32 - at)
        if rng.random() < 0.7:
            out.append((at, at + width - 1, f"C{len(out)}", "n", "r", "c"))
        at += width
    return out


@pytest.mark.parametrize("how", [{"broadcast": True}, {"broadcast": False, "rows_per_split": 50}])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_between(spark, seed, how):
    listed = random_ranges(seed)
    rng = random.Random(seed + 100)
    points = [rng.randrange(2**32) for _ in range(1500)]
    for low, high, *_ in rng.sample(listed, min(200, len(listed))):
        points += [low, high, max(low - 1, 0), min(high + 1, 2**32 - 1)]
    points += [points[0]] * 500  # one address far more often than any other
    text = [".".join(str(p >> s & 255) for s in (24, 16, 8, 0)) for p in points]
    table = ranges(spark, *listed)
    probe = spark.createDataFrame([(i, ip) for i, ip in enumerate(text)], "n int, ip string")
    found = rows(geo_lookup(probe, table, **how), "n", "country_code")
    plain = probe.withColumn("v", ipv4_number(F.col("ip"))).join(
        table, F.col("v").between(F.col("ip_from"), F.col("ip_to")), "left"
    )
    assert found == rows(plain.select("n", F.coalesce("country_code", F.lit("UNKNOWN"))))


@pytest.mark.parametrize("how", [{"broadcast": True}, {"broadcast": False, "rows_per_split": 50}])
def test_narrowest_of_nested_ranges(spark, how):
    rng = random.Random(5)
    listed = [(0, 2**24, "ALL", "n", "r", "c")]
    for i in range(150):
        low = rng.randrange(2**16)
        listed.append((low, low + rng.choice([0, 3, 40, 5000, 9000]), f"C{i}", "n", "r", "c"))
    points = [rng.randrange(2**16 + 9000) for _ in range(600)]
    want = []
    for n, p in enumerate(points):
        best = min((h - lo, lo, c) for lo, h, c, *_ in listed if lo <= p <= h)
        want.append((n, best[2]))
    text = [".".join(str(p >> s & 255) for s in (24, 16, 8, 0)) for p in points]
    probe = spark.createDataFrame(list(enumerate(text)), "n int, ip string")
    assert rows(geo_lookup(probe, ranges(spark, *listed), **how), "n", "country_code") == sorted(want, key=repr)


def test_hot_block_is_split(spark):
    """Every row equal in all columns: they still go to several tasks."""
    same = spark.range(1000).select(F.lit("10.0.0.1").alias("ip"))
    found = geo_lookup(same, ranges(spark, ("10.0.0.0", "10.0.0.9", "A")), broadcast=False, rows_per_split=100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # With the looked-up country, as counting rows alone would not need the lookup.
        per_task = found.groupBy("country_code", F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in per_task) == 1000
        assert len(per_task) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_listing_is_bounded(spark):
    everything = ranges(spark, ("0.0.0.0", "255.255.255.255", "ALL"))
    assert range_blocks(everything).count() == 2**20
    wrong = ranges(spark, ("10.0.0.9", "10.0.0.1", "X"))
    assert range_blocks(wrong).count() == 0


def test_overlaps(spark, table):
    assert overlapping_ranges(table).count() == 0
    assert_disjoint(table)
    nested = table.union(ranges(spark, ("12.0.0.0", "12.0.0.255", "N")))
    assert rows(overlapping_ranges(nested), "country_code") == [("N",)]
    with pytest.raises(ValueError, match="overlapping"):
        assert_disjoint(nested)


def test_size_is_measured_before_a_broadcast(spark, table):
    assert ranges_fit_broadcast(table)
    assert fits_broadcast(table, BroadcastLimit(rows=4))
    assert not fits_broadcast(table, BroadcastLimit(rows=3))
    assert not fits_broadcast(table, BroadcastLimit(bytes=100))
    assert broadcast_if_small(table, BroadcastLimit(rows=3)) is table
    assert fits_broadcast(table.filter("false"), BroadcastLimit(rows=0))


# --- merge in the order of addresses ----------------------------------------------------------


def test_keys_of_addresses(spark):
    import ipaddress

    rng = random.Random(8)
    good = ["::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "2001:DB8::a", "::1.2.3.4", "1::5.6.7.8"]
    good += ["::ffff:9.8.7.6", "::ffff:0908:0706", "1:2:3:4:5:6:1.2.3.4", "0.0.0.0", "255.255.255.255"]
    for _ in range(150):
        value = rng.getrandbits(128) & rng.choice([2**128 - 1, rng.getrandbits(128), 2**70 - 1, 2**128 - 2**60])
        good += [str(ipaddress.IPv6Address(value)), ipaddress.IPv6Address(value).exploded]
    bad = ["", ":", ":::", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1::2::3", "12345::", "g::", "1:2:3:4:5:6:7:8::", "::1.2.3", "1.2.3.4::"]
    bad += ["1:2:3:4:5:6:7:1.2.3.4", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "fe80::1%eth0", " ::1", "::1\n", "1::2:", "\u0661::", None]
    found = spark.createDataFrame([(g,) for g in good + bad], "ip string").select("ip", ip_key(F.col("ip")).alias("key"))
    found = found.withColumn("at", key_position(F.col("key"))).collect()

    def want(text):
        try:
            address = ipaddress.ip_address(text)
        except ValueError:
            return None
        if "%" in text:
            return None
        address = getattr(address, "ipv4_mapped", None) or address
        return (b"\x04" if address.version == 4 else b"\x06") + address.packed

    for r in found:
        assert (None if r["key"] is None else bytes(r["key"])) == (want(r["ip"]) if r["ip"] else None), r["ip"]
    placed = sorted((bytes(r["key"]), r["at"]) for r in found if r["key"] is not None)
    assert [p for _, p in placed] == sorted(p for _, p in placed)
    assert sum(r["key"] is not None for r in found) == len(good)


def both_families(spark):
    import ipaddress

    def v6(text):
        return int(ipaddress.IPv6Address(text))

    rng = random.Random(3)
    listed, at = [], v6("2001:db8::")
    for i in range(120):
        width = 2 ** rng.choice([0, 3, 40, 64, 66, 80])
        if rng.random() < 0.7:
            first, last = (str(ipaddress.IPv6Address(n)) for n in (at, at + width - 1))
            listed.append((first, last, f"S{i}", "n", "r", "c"))
        at += width
    for i, (low, high, *_) in enumerate(rng.sample(random_ranges(7), 40)):
        first, last = (str(ipaddress.IPv4Address(n)) for n in (low, high))
        listed.append((first, last, f"V{i}", "n", "r", "c"))
    listed.append(("::ffff:0:0", "::", "backwards", "n", "r", "c"))
    schema = "first_ip string, last_ip string, country_code string, country_name string, region_name string, city_name string"
    points = [str(ipaddress.IPv6Address(rng.randrange(v6("2001:db7::"), at + 2**70))) for _ in range(500)]
    for first, last, *_ in listed[:-1]:
        ends = [int(ipaddress.ip_address(x)) for x in (first, last)]
        kind = type(ipaddress.ip_address(first))
        points += [str(kind(n)) for n in (ends[0], ends[1], max(ends[0] - 1, 0), min(ends[1] + 1, 2**32 - 1 if kind is ipaddress.IPv4Address else 2**128 - 1))]
    points += [points[0]] * 300 + [listed[0][0]] * 300 + ["x.y", None, "", "zz::1"] * 40
    return listed, spark.createDataFrame(listed, schema), points


@pytest.mark.parametrize("rows_per_range", [10, 130, 10_000])
def test_both_families_by_merge(spark, rows_per_range):
    import ipaddress

    listed, table, points = both_families(spark)
    bounds = [(*map(ipaddress.ip_address, r[:2]), r[2]) for r in listed[:-1]]

    def want(ip):
        if not ip:
            return "UNKNOWN"
        try:
            address = ipaddress.ip_address(ip)
        except ValueError:
            return "UNKNOWN" if ":" in ip else "ERROR"
        return next((c for a, b, c in bounds if a.version == address.version and a <= address <= b), "UNKNOWN")

    # Half of the rows are there many times over, equal in all columns.
    probe = spark.createDataFrame([(i if i % 2 else -1, ip) for i, ip in enumerate(points)], "n int, ip string")
    found = geo_lookup(probe, table, rows_per_split=rows_per_range)
    assert rows(found, "n", "ip", "country_code") == sorted(((i if i % 2 else -1, ip, want(ip)) for i, ip in enumerate(points)), key=repr)


def test_a_hot_address_goes_to_several_tasks(spark):
    """Also if a third of all rows is one address; and parts do not depend on how rows arrive."""
    from viewmill.operators.asof import _folded, _layout, _ranged

    cold = F.concat(F.lit("10.1."), F.col("id") % 200, F.lit("."), F.col("id") % 7)
    ip = F.when(F.col("id") % 3 == 0, F.lit("10.0.0.1")).otherwise(cold)
    hot = spark.range(3000).select(F.col("id").alias("n"), ip.alias("ip"))
    found = geo_lookup(hot, ranges(spark, ("10.0.0.0", "10.0.0.9", "A")), broadcast=False, rows_per_split=100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = found.filter("ip = '10.0.0.1'").groupBy("country_code", F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in per_task) == 1000 and len(per_task) >= 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")

    def placed(df):
        keyed = df.select(ip_key(F.col("ip")).alias("_key"), F.struct("n", "ip").alias("_row"))
        return keyed.withColumn("_position", key_position(F.col("_key")))

    borders, spread = _layout(placed(hot), 100)

    def dealt(df):
        parts = F.when(F.col("_range").isin(list(spread)), 7).otherwise(1)
        found = _folded(_ranged(placed(df), borders), spread, parts, 100)
        return rows(found, "_row", "_range", "_part", "_copies")

    assert spread and dealt(hot) == dealt(hot.repartition(7, "n").sortWithinPartitions(F.desc("n")))


def test_ranges_by_address_must_be_apart(spark):
    schema = "first_ip string, last_ip string, country_code string, country_name string, region_name string, city_name string"

    def table(*pairs):
        return spark.createDataFrame([(a, b, "C", "n", "r", "c") for a, b in pairs], schema)

    probe = spark.createDataFrame([("::5",)], "ip string")
    assert rows(geo_lookup(probe, table(("::1", "::9"), ("::a", "::f"))), "country_code") == [("C",)]
    for pairs in ([("::1", "::9"), ("::9", "::f")], [("::1", "::f"), ("::3", "::4")], [("::1", "::9"), ("::1", "::2")]):
        with pytest.raises(ValueError, match="IP ranges"):
            geo_lookup(probe, table(*pairs))
