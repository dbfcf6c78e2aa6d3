"""Daily roll-ups of the star and their upkeep, from facts or from what loads have counted."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmill.functions.dates import sk_date_for
from viewmill.operators.merge import upsert
from viewmill.operators.quality import assert_unique
from viewmill.operators.ranking import top_n_per_group
from viewmill.operators.sizing import DEFAULT_LIMIT, BroadcastLimit
from viewmill.plans.increments import counted_join, merged_products
from viewmill.schemas import COUNTRY_INCREMENTS, DIMENSIONS, FACT, LOADS, MART_LOADS, MARTS, UNKNOWN
from viewmill.sources.store import StarStore

TOP_N = 50


def views_by_country(fact: DataFrame, dim_location: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Views and distinct products per day and country; views without a known place count as UNKNOWN."""
    place = dim_location.select("sk_location", "country_code", "country_name")
    placed = counted_join(fact, ["sk_date", "sk_location", "sk_product"], place, "sk_location", "left", limit)
    return (
        placed.withColumns(
            {c: F.coalesce(c, F.lit(UNKNOWN)) for c in ("country_code", "country_name")}
        )
        .groupBy("sk_date", "country_code", "country_name")
        .agg(
            F.sum("_views").alias("view_count"),
            F.count_distinct("sk_product").alias("unique_products"),
        )
    )


def product_counts(fact: DataFrame, dim_product: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Views per day and product; facts whose product is not stored are left out."""
    names = dim_product.select("sk_product", "product_id")
    named = counted_join(fact, ["sk_date", "sk_product"], names, "sk_product", "inner", limit)
    return named.groupBy("sk_date", "product_id").agg(F.sum("_views").alias("view_count"))


def top_products(
    fact: DataFrame, dim_product: DataFrame, top_n: int = TOP_N, limit: BroadcastLimit = DEFAULT_LIMIT
) -> DataFrame:
    """The ``top_n`` most viewed products of each day."""
    counts = product_counts(fact, dim_product, limit)
    return top_n_per_group(counts, "sk_date", "view_count", "product_id", top_n)


def traffic_breakdown(
    fact: DataFrame, dim_traffic_source: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT
) -> DataFrame:
    """Views per day and traffic type."""
    types = dim_traffic_source.select("sk_traffic", "traffic_type")
    typed = counted_join(fact, ["sk_date", "sk_traffic"], types, "sk_traffic", "left", limit)
    return (
        typed.withColumn("traffic_type", F.coalesce("traffic_type", F.lit(UNKNOWN)))
        .groupBy("sk_date", "traffic_type")
        .agg(F.sum("_views").alias("view_count"))
    )


def daily_marts(store: StarStore, fact: DataFrame, top_n: int = TOP_N) -> dict[str, DataFrame]:
    """The three marts over ``fact``. Each reads the two or three fact columns it needs."""
    return {
        "agg_daily_views_by_country": views_by_country(fact, store.table("dim_location")),
        "agg_daily_top_products": top_products(fact, store.table("dim_product"), top_n),
        "agg_daily_traffic_breakdown": traffic_breakdown(fact, store.table("dim_traffic_source")),
    }


def run_daily(store: StarStore, ds: str, top_n: int = TOP_N, mode: str = "replace") -> dict[str, int]:
    """Recompute the marts of day ``ds`` (``yyyy-MM-dd``); returns the number of rows of each.

    ``replace`` makes the result the day's content. ``upsert`` overwrites and adds rows but keeps
    stored ones that are no longer in the result, such as products that fell out of the top.
    """
    if mode not in ("replace", "upsert"):
        raise ValueError(f"unknown mode {mode!r}")
    day = sk_date_for(ds)
    written = {}
    for name, mart in daily_marts(store, store.fact_for_day(day), top_n).items():
        # A mart's day is small (countries, top products, traffic types) and used three times.
        rows = mart.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            written[name] = rows.count()
            assert_unique(rows, MARTS[name].key, name)
            if mode == "upsert":
                stored = store.read_days(name, [day]).select(*MARTS[name].columns)
                store.write_days(name, upsert(stored, rows, MARTS[name].key))
            elif written[name]:
                store.write_days(name, rows)
            else:
                store.clear_day(name, day)
        finally:
            rows.unpersist()
    return written


def waiting_loads(store: StarStore) -> DataFrame:
    """Committed loads that the marts do not hold yet, with the days they touch."""
    loads = store.table(LOADS.name).select("load_id", "days")
    return loads.join(store.table(MART_LOADS.name), "load_id", "left_anti")


def refresh_marts(store: StarStore, top_n: int = TOP_N) -> list[int]:
    """Bring the marts up to date with all loads committed since the last refresh; returns the days that were touched.

    A load says which days its facts are of, so a late view brings up its own day and no other. Views and products per
    country are merged from what each load counted (see ``plans.increments``); top products and traffic are counted
    again from the facts of those days. Loads are marked as held after their days are written: if that fails, the next
    refresh does the same days again, with the same result.
    """
    waiting = waiting_loads(store).collect()
    days = sorted({day for load in waiting for day in load["days"]})
    if days:
        fact = store.read_days(FACT.name, days).select(*FACT.columns)
        increments = store.read_days(COUNTRY_INCREMENTS.name, days)
        marts = {
            "agg_daily_views_by_country": merged_products(increments, "sk_date", "country_code", "country_name"),
            "agg_daily_top_products": top_products(fact, store.table("dim_product"), top_n),
            "agg_daily_traffic_breakdown": traffic_breakdown(fact, store.table("dim_traffic_source")),
        }
        for name, mart in marts.items():
            _replace_days(store, name, mart)
    if waiting:
        held = store.spark.createDataFrame([(load["load_id"],) for load in waiting], MART_LOADS.schema)
        held.coalesce(1).write.mode("append").parquet(store.path(MART_LOADS.name))
    return days


def _replace_days(store: StarStore, name: str, mart: DataFrame) -> None:
    """Check the key of new mart rows and write them over their days."""
    # A few rows per day (countries, top products, traffic types), used twice.
    rows = mart.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        assert_unique(rows, MARTS[name].key, name)
        store.write_days(name, rows)
    finally:
        rows.unpersist()


def run_sql(store: StarStore, sql: str, ds: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """A roll-up given as SQL text over the star's table names.

    ``:sk_date`` stands for the day ``ds`` and ``:top_n`` for the top size; ``params`` adds to them.
    """
    for name in (*DIMENSIONS, FACT.name, *MARTS):
        store.table(name).createOrReplaceTempView(name)
    args = {"sk_date": sk_date_for(ds), "top_n": TOP_N, **(params or {})}
    used = {name: value for name, value in args.items() if f":{name}" in sql}
    return store.spark.sql(sql, args=used)
