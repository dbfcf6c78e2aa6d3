"""Roll-ups that loads add to, so that a day is brought up to date without its earlier facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmill.operators.sizing import DEFAULT_LIMIT, BroadcastLimit, fits_broadcast
from viewmill.schemas import UNKNOWN


def counted_join(
    fact: DataFrame,
    by: Sequence[str],
    dim: DataFrame,
    key: str,
    how: str,
    limit: BroadcastLimit = DEFAULT_LIMIT,
) -> DataFrame:
    """Fact rows joined to ``dim`` on ``key``, folded to columns ``by`` with their number in ``_views``.

    A dimension within ``limit`` is broadcast and the facts stay where they are. For a bigger one the
    facts are counted per ``by`` before the join: what is then shuffled by ``key`` is one row per
    combination, so a product or place with a third of all views is as light as any other.
    """
    if fits_broadcast(dim, limit):
        return fact.select(*by, F.lit(1).cast("bigint").alias("_views")).join(F.broadcast(dim), key, how)
    return fact.groupBy(*by).agg(F.count(F.lit(1)).alias("_views")).join(dim, key, how)


def country_increments(
    facts: DataFrame, dim_location: DataFrame, numbers: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT
) -> DataFrame:
    """Per day, country and bucket of product numbers: the views, and which products they show as a bitmap.

    ``numbers`` gives every product a number of its own. Bitmaps of several loads unite, which counts do not: a product
    that two loads show is one product. A bucket holds 32,768 numbers, so a bitmap has 4 KB whatever the views.
    """
    place = dim_location.select("sk_location", "country_code", "country_name")
    placed = counted_join(facts, ["sk_date", "sk_location", "sk_product"], place, "sk_location", "left", limit)
    placed = (
        placed.withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in ("country_code", "country_name")})
        .groupBy("sk_date", "country_code", "country_name", "sk_product")
        .agg(F.sum("_views").alias("_views"))
    )
    return (
        placed.join(numbers.select("sk_product", "number"), "sk_product", "left")
        .groupBy("sk_date", "country_code", "country_name", F.bitmap_bucket_number("number").alias("bucket"))
        .agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("products"),
            F.sum("_views").alias("view_count"),
        )
    )


def merged_products(increments: DataFrame, *by: str) -> DataFrame:
    """Views and distinct products per ``by``, exactly, from increments of any number of loads."""
    return (
        increments.groupBy(*by, "bucket")
        .agg(F.bitmap_or_agg("products").alias("products"), F.sum("view_count").alias("view_count"))
        .groupBy(*by)
        .agg(
            F.sum("view_count").alias("view_count"),
            F.sum(F.bitmap_count("products")).alias("unique_products"),
        )
    )
