"""Point-in-range lookup of IP addresses.

``view.ip BETWEEN range.ip_from AND range.ip_to`` alone can only run as a nested loop. A table too big to broadcast, or
with ranges of both families, is merged with the views in the order of addresses (see ``operators.asof``). For one that
can be broadcast, cutting the address space into /20 blocks adds an equality: a range is listed once per block it touches, an
address lies in one block. Ranges that overlap are cut into disjoint pieces there, so

* the listing is at most one row per block (2**20) longer than the range table, however wide ranges are;
* an address is compared with the ranges of its block only, 4,096 at the very most and a handful in a
  table of some million ranges. Wider blocks would be cheaper to list but dearer to search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from viewmill.functions.network import ip_key, ipv4_key, ipv4_number, key_position
from viewmill.functions.text import is_blank
from viewmill.operators.asof import ROWS_PER_RANGE, last_start_before
from viewmill.operators.sizing import fits_broadcast
from viewmill.schemas import ERROR, LOCATION_FIELDS, UNKNOWN

BLOCK_BITS = 12
_LAST_IPV4 = 2**32 - 1


def range_blocks(ranges: DataFrame) -> DataFrame:
    """``ranges`` listed once per block they touch, with the block number in ``_block``."""
    low = F.greatest(F.col("ip_from"), F.lit(0))
    high = F.least(F.col("ip_to"), F.lit(_LAST_IPV4))
    return (
        ranges.select("ip_from", "ip_to", *LOCATION_FIELDS)
        .filter(low <= high)
        .withColumn("_block", F.explode(F.sequence(F.shiftright(low, BLOCK_BITS), F.shiftright(high, BLOCK_BITS))))
    )


def narrowest_blocks(ranges: DataFrame) -> DataFrame:
    """:func:`range_blocks` cut into disjoint pieces, each with the narrowest range that holds it.

    In every block the pieces start where a range starts or after one ends. They are joined with the ranges of their
    block, on the range table alone; views are never multiplied. Of equally narrow ranges the first by bounds, then by
    location, wins. A table without overlaps keeps its rows, cut at the borders of blocks.
    """
    blocks = range_blocks(ranges)
    first = F.shiftleft(F.col("_block").cast("bigint"), BLOCK_BITS)
    blocks = blocks.select(
        "_block",
        F.greatest("ip_from", first).alias("_low"),
        F.least("ip_to", first + (2**BLOCK_BITS - 1)).alias("_high"),
        F.struct((F.col("ip_to") - F.col("ip_from")).alias("width"), "ip_from", F.struct(*LOCATION_FIELDS).alias("range")).alias(
            "_held"
        ),
    )
    border = F.explode(F.array(F.col("_low"), F.col("_high") + 1)).alias("ip_from")
    borders = blocks.select(F.col("_block").alias("_of"), border).distinct()
    until = F.lead("ip_from").over(W.partitionBy("_of").orderBy("ip_from")) - 1
    pieces = borders.withColumn("ip_to", until).filter(F.col("ip_to").isNotNull())
    held = (F.col("_block") == F.col("_of")) & F.col("ip_from").between(F.col("_low"), F.col("_high"))
    return (
        pieces.join(blocks, held)
        .groupBy("_block", "ip_from", "ip_to")
        .agg(F.min("_held").alias("_held"))
        .select("_block", "ip_from", "ip_to", F.col("_held.range").alias("_range"))
    )


def overlapping_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges that start inside an earlier one.

    Checked per block, so that the sort is spread over the cluster.
    """
    earlier = W.partitionBy("_block").orderBy("ip_from", "ip_to").rowsBetween(W.unboundedPreceding, -1)
    return (
        range_blocks(ranges)
        .withColumn("_reached", F.max("ip_to").over(earlier))
        .filter(F.col("_reached") >= F.col("ip_from"))
        .select("ip_from", "ip_to", *LOCATION_FIELDS)
        .distinct()
    )


def overlaps(ranges: DataFrame) -> bool:
    """Whether any address lies in two ranges; only then they are cut."""
    return not overlapping_ranges(ranges).isEmpty()


def ranges_fit_broadcast(ranges: DataFrame) -> bool:
    """Whether the listing of ``ranges`` per block is small enough for every executor to hold."""
    return fits_broadcast(range_blocks(ranges))


def assert_disjoint(ranges: DataFrame) -> None:
    """Raise ``ValueError`` if an address could be found twice."""
    found = overlapping_ranges(ranges).take(1)
    if found:
        raise ValueError(f"overlapping IP ranges, for example {found[0].asDict()}")


def _location(name: str) -> Column:
    """One output field: blank address and no hit are UNKNOWN, unreadable is ERROR, "-" is UNKNOWN."""
    found = F.col(f"_range.{name}")
    return (
        F.when(is_blank(F.col("ip")), F.lit(UNKNOWN))
        # IPv6 is no error, there are just no ranges for it.
        .when(F.col("_number").isNull() & ~F.col("ip").contains(":"), F.lit(ERROR))
        .when(F.col("_range").isNull() | (found == "-"), F.lit(UNKNOWN))
        .otherwise(found)
    )


def geo_lookup(
    views: DataFrame,
    ranges: DataFrame,
    broadcast: bool | None = None,
    rows_per_split: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add country, region and city of ``views.ip``; every view is kept and none is repeated. Where ranges overlap
    the narrowest counts (see ``narrowest_blocks``).

    Unless ``broadcast`` says so already, the listing of the range table per block is measured. If it is small it is
    broadcast and the views are never shuffled. If not, or if the table has ranges of both families, both sides are merged
    in the order of addresses (see :func:`geo_lookup_merged`), in parts of about ``rows_per_split`` views.
    """
    if "first_ip" in ranges.columns or broadcast is False:
        return geo_lookup_merged(views, ranges, rows_per_split)
    blocks = narrowest_blocks(ranges) if overlaps(ranges) else range_blocks(ranges).select(
        "_block", "ip_from", "ip_to", F.struct(*LOCATION_FIELDS).alias("_range")
    )
    if broadcast is None and not fits_broadcast(blocks.select("_block", "ip_from", "ip_to", "_range.*")):
        return geo_lookup_merged(views, ranges, rows_per_split)
    probe = views.withColumn("_number", ipv4_number(F.col("ip")))
    inside = F.col("_number").between(F.col("ip_from"), F.col("ip_to"))
    joined = probe.join(F.broadcast(blocks), (F.shiftright("_number", BLOCK_BITS) == F.col("_block")) & inside, "left")
    return joined.select(*views.columns, *[_location(name).alias(name) for name in LOCATION_FIELDS])


def address_ranges(ranges: DataFrame) -> DataFrame:
    """A range table of either family by keys: ``_low``, ``_high`` and the location fields in ``_range``.

    ``ranges`` has numbers ``ip_from`` and ``ip_to`` (IPv4), or addresses ``first_ip`` and ``last_ip`` as text, of both
    families if need be; a range lies within one family. Ranges that cannot be read or hold nothing are left out.
    """
    if "first_ip" in ranges.columns:
        low, high = ip_key(F.col("first_ip")), ip_key(F.col("last_ip"))
    else:
        low = ipv4_key(F.greatest(F.col("ip_from"), F.lit(0)))
        high = F.when(F.col("ip_to") >= 0, ipv4_key(F.least(F.col("ip_to"), F.lit(_LAST_IPV4))))
    fields = F.struct(*LOCATION_FIELDS).alias("_range")
    keyed = ranges.select(low.alias("_low"), high.alias("_high"), fields)
    return keyed.filter((F.col("_low") <= F.col("_high")) & (F.substring("_low", 1, 1) == F.substring("_high", 1, 1)))


def geo_lookup_merged(views: DataFrame, ranges: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """:func:`geo_lookup` for range tables of any size, by one merge in the order of addresses.

    Ranges given by addresses (see :func:`address_ranges`) may be of both families and must be disjoint: ``ValueError`` if
    two start at one address or one reaches into the next. For ranges given by numbers all IPv6 addresses are unknown.
    """
    keyed = address_ranges(ranges)
    if "first_ip" in ranges.columns:
        _assert_apart(keyed)
        return _merge_join(views, ip_key(F.col("ip")), keyed, rows_per_range)
    if overlaps(ranges):
        pieces = narrowest_blocks(ranges)
        keyed = pieces.select(ipv4_key(F.col("ip_from")).alias("_low"), ipv4_key(F.col("ip_to")).alias("_high"), "_range")
    return _merge_join(views, ipv4_key(ipv4_number(F.col("ip"))), keyed, rows_per_range)


def _assert_apart(keyed: DataFrame) -> None:
    """Raise ``ValueError`` if a range starts before the one that starts last before it has ended."""
    starts = keyed.withColumn("_at", F.col("_low"))
    if not keyed.groupBy("_low").count().filter("count > 1").isEmpty():
        raise ValueError("two IP ranges start at the same address")
    ends = keyed.select(F.col("_high").alias("_at"), F.col("_low").alias("_own"))
    reached = last_start_before(ends, starts, "_at", key_position)
    found = reached.filter(F.col("_start._low") != F.col("_own")).take(1)
    if found:
        raise ValueError(f"overlapping IP ranges, for example one that ends at key {found[0]['_at'].hex()}")


def _merge_join(views: DataFrame, key: Column, keyed: DataFrame, rows_per_range: int) -> DataFrame:
    probe = views.withColumn("_at", key)
    starts = keyed.withColumn("_at", F.col("_low"))
    found = last_start_before(probe, starts, "_at", key_position, rows_per_range)
    inside = F.col("_at") <= F.col("_start._high")
    found = found.withColumn("_range", F.when(inside, F.col("_start._range"))).withColumnRenamed("_at", "_number")
    return found.select(*views.columns, *[_location(name).alias(name) for name in LOCATION_FIELDS])
