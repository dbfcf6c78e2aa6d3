"""Point-in-range lookup by merging: the last range that starts at or before a key, for tables of any size.

Keys and starts are dealt out by ranges of keys in one shuffle and merged in order, so nothing is listed per block and no
side is broadcast. Where a range of keys begins, the last start before it is added, one row per range. A position
that holds more rows than a range should is a range of its own, spread over several tasks by the contents of its rows, to
all of which its starts go. Every row's place follows from its contents, so a task that is repeated deals them out alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import reduce
from math import inf, nextafter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Rows that one task should merge, and the most ranges that are laid out; more rows then make longer ranges.
ROWS_PER_RANGE = 1_000_000
MOST_RANGES = 8192
# Borders that are at hand once the rows are counted.
_GRID = 256
# The range of rows without a key, in which no start lies.
_NO_KEY = -1


def _layout(probe: DataFrame, rows_per_range: int) -> tuple[list[float], dict[int, int]]:
    """Borders between ranges of positions, and over how many parts a range with more rows is spread."""
    chances = [i / _GRID for i in range(1, _GRID)]
    seen = probe.agg(
        F.count("_position").alias("placed"),
        F.count(F.lit(1)).alias("rows"),
        F.percentile_approx("_position", chances, 10 * _GRID).alias("grid"),
    ).first()
    spread = {_NO_KEY: -(-(seen.rows - seen.placed) // rows_per_range)}
    ranges = min(-(-seen.placed // rows_per_range), MOST_RANGES)
    if ranges <= _GRID:
        found = [seen.grid[i * _GRID // ranges - 1] for i in range(1, ranges)]
    else:
        chances = [i / ranges for i in range(1, ranges)]
        found = probe.agg(F.percentile_approx("_position", chances, 10 * ranges)).first()[0]
    times = Counter(found)
    often = {p: n for p, n in times.items() if n > 1}
    # A position that is many borders at once is a range of its own.
    borders = sorted({*times, *(max(nextafter(p, inf), p + 1) for p in often)})
    spread |= {borders.index(p) + 1: n for p, n in often.items()}
    return borders, {at: n for at, n in spread.items() if n > 1}


def _ranged(df: DataFrame, borders: list[float]) -> DataFrame:
    """``df`` with the number of each position's range."""
    none = F.col("_position").isNull()
    if not borders:
        return df.withColumn("_range", F.when(none, _NO_KEY).otherwise(0))
    cut = Bucketizer(splits=[-inf, *borders, inf], inputCol="_placed", outputCol="_cut")
    placed = cut.transform(df.withColumn("_placed", F.coalesce("_position", F.lit(0.0))))
    return placed.withColumn("_range", F.when(none, _NO_KEY).otherwise(F.col("_cut").cast("int"))).drop("_placed", "_cut")


def _folded(rows: DataFrame, spread: dict[int, int], parts: Column, rows_per_range: int) -> DataFrame:
    """``rows`` with the part each goes to and how many ``_copies`` it stands for.

    Equal rows would all go to one part. Those that are more than a task should merge are counted instead, and travel as
    one row per ``rows_per_range`` of them.
    """
    rows = rows.withColumn("_content", F.xxhash64("_row"))
    single = F.lit(1).cast("bigint").alias("_copies")
    part = F.pmod("_content", parts).cast("int").alias("_part")
    if not spread:
        return rows.select("_key", "_range", part, single, "_row")
    crowded = rows.filter(F.col("_range").isin(list(spread))).groupBy("_content").agg(F.count(F.lit(1)).alias("_times"))
    # At most one in ``rows_per_range`` rows.
    crowded = crowded.filter(F.col("_times") >= rows_per_range).select("_content")
    counted = rows.join(crowded, "_content", "left_semi").groupBy("_key", "_range", "_row").agg(F.count(F.lit(1)).alias("_times"))
    chunk = F.col("_chunk") * rows_per_range
    counted = counted.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_times") - 1) / rows_per_range)))
    ).select(
        "_key",
        "_range",
        F.pmod("_chunk", parts).cast("int").alias("_part"),
        F.least(F.col("_times") - chunk, F.lit(rows_per_range)).cast("bigint").alias("_copies"),
        "_row",
    )
    return rows.join(crowded, "_content", "left_anti").select("_key", "_range", part, single, "_row").unionAll(counted)


def last_start_before(
    probe: DataFrame,
    starts: DataFrame,
    key: str,
    position: Callable[[Column], Column],
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``probe`` with ``_start``: the row of ``starts`` with the greatest key that does not exceed the row's own.

    Both have a column ``key``, NULL in rows of ``probe`` that match nothing; ``starts`` holds a key once. ``position``
    turns a key into a number that never falls as keys rise.
    """
    placed = probe.select(F.col(key).alias("_key"), F.struct(*probe.columns).alias("_row")).withColumn(
        "_position", position(F.col("_key"))
    )
    begun = starts.select(F.col(key).alias("_key"), F.struct(*starts.columns).alias("_begun")).withColumn(
        "_position", position(F.col("_key"))
    )
    borders, spread = _layout(placed, rows_per_range)
    parts = reduce(lambda rest, at: F.when(F.col("_range") == at, spread[at]).otherwise(rest), spread, F.lit(1))
    rows = _folded(_ranged(placed, borders), spread, parts, rows_per_range)
    begun = _ranged(begun.filter(F.col("_key").isNotNull()), borders)
    # One row per range with starts: its last one. What begins a range is the last of all before it.
    last = begun.groupBy("_range").agg(F.max(F.struct("_key", "_begun")).alias("_last"))
    every = probe.sparkSession.range(len(borders) + 1).select(F.col("id").cast("int").alias("_range"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        # At most one row per range that is laid out.
        every.join(F.broadcast(last), "_range", "left")
        .withColumn("_last", F.last("_last", ignorenulls=True).over(before))
        .filter(F.col("_last").isNotNull())
        .select("_last._key", "_last._begun", "_range")
    )
    begun = begun.select("_key", "_begun", "_range").unionAll(carried)
    begun = begun.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    nothing = {c: F.lit(None).cast(df.schema[c].dataType).alias(c) for c, df in (("_begun", begun), ("_row", rows))}
    merged = begun.select("_key", "_range", "_part", F.lit(0).cast("bigint").alias("_copies"), "_begun", nothing["_row"])
    merged = merged.unionAll(rows.select("_key", "_range", "_part", "_copies", nothing["_begun"], "_row"))
    upto = (
        W.partitionBy("_range", "_part").orderBy("_key", "_copies").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    found = merged.withColumn("_start", F.last("_begun", ignorenulls=True).over(upto)).filter("_copies > 0")
    if spread:
        found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    return found.select("_row.*", "_start")
