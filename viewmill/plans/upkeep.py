"""Upkeep of a star that is loaded all the time: many small loads become one of large, clustered files, in place."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmill.operators.stored_ids import ID_LAYOUT, in_order
from viewmill.plans.star import in_parallel, rows_of_loads
from viewmill.schemas import COUNTRY_INCREMENTS, DIMENSIONS, FACT, LOADS, MART_LOADS, PRODUCT_NUMBERS, VIEW_IDS
from viewmill.sources.store import StarStore

# Facts of a day lie together by product and place, so that statistics of row groups and pages tell where one of them is.
CLUSTERED_BY = ("sk_date", "sk_product", "sk_location")
FACT_LAYOUT = {"parquet.block.size": str(32 * 1024 * 1024)}

# Merged dimensions and ids lie in buckets of up to this many rows, of which there are at most so many; Spark allows
# 100,000. Smaller tables are not cut.
BUCKET_ROWS, MOST_BUCKETS = 1_000_000, 1 << 16


def clustered(facts: DataFrame) -> DataFrame:
    """Facts by ranges of day, product and place, sorted within each. The id splits a product that most views are of."""
    order = [*CLUSTERED_BY, "view_id"]
    return facts.repartitionByRange(*order).sortWithinPartitions(*order)


def bucket_count(rows: int, bucket_rows: int) -> int:
    """The power of two that cuts so many rows into buckets of at most ``bucket_rows``."""
    return min(1 << max(0, (rows - 1) // bucket_rows).bit_length(), MOST_BUCKETS)


def without_order(spans: list[tuple[str, str]]) -> bool:
    """Whether most loads hold ids between those of another, so that spans of ids leave nothing out when they are read."""
    spans = sorted(spans)
    return 2 * sum(low <= high for (_, high), (low, _) in zip(spans, spans[1:], strict=False)) > max(len(spans) - 1, 0)


def merge_loads(
    store: StarStore, layout: Mapping[str, str] = FACT_LAYOUT, bucket_rows: int = BUCKET_ROWS
) -> list[str]:
    """Rewrite all loads that the marts hold as one; returns the loads that it replaces, none if there are fewer than two.

    The new load is written beside the old ones, which readers see until it takes their place in one file operation. Old
    files stay until :func:`sweep_replaced`, for queries that are still reading them. A merge that fails has changed
    nothing that readers see, and the next one starts over. As for loads, one writer at a time is assumed.

    Dimensions of more than ``bucket_rows`` are dealt into sorted buckets of their key, and so are ids that come without
    order: later loads join what is new to them where they lie. Ids that grow with time stay in order, by which all but
    few of them are left out.
    """
    held = store.table(LOADS.name).join(store.table(MART_LOADS.name).distinct(), "load_id", "left_semi")
    spans = {r.load_id: (r.low_id, r.high_id) for r in held.select("load_id", "low_id", "high_id").collect()}
    merged = sorted(spans)
    if len(merged) < 2:
        return []
    name = store.begin_load("merged", replaces=merged)

    def old(table: str) -> DataFrame:
        return store.read_loads(table, merged)

    increments = (
        old(COUNTRY_INCREMENTS.name)
        .groupBy("sk_date", "country_code", "country_name", "bucket")
        .agg(F.bitmap_or_agg("products").alias("products"), F.sum("view_count").alias("view_count"))
    )
    log = old(LOADS.name).agg(
        F.sum("views").alias("views"),
        F.sum("facts").alias("facts"),
        F.max("last_inserted_at").alias("last_inserted_at"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("days")))).alias("days"),
        F.min("low_id").alias("low_id"),
        F.max("high_id").alias("high_id"),
    )
    facts = clustered(old(FACT.name).drop("load_id"))
    jobs = [
        partial(store.add_as_is, FACT.name, facts, name, layout),
        partial(store.add_as_is, COUNTRY_INCREMENTS.name, increments.hint("rebalance", "sk_date"), name),
        partial(store.add_as_is, LOADS.name, log.coalesce(1), name),
    ]
    sizes = rows_of_loads(store, [*DIMENSIONS, VIEW_IDS.name], merged)
    buckets = {table: bucket_count(size, bucket_rows) for table, size in sizes.items()}
    ids = old(VIEW_IDS.name)
    if buckets[VIEW_IDS.name] > 1 and without_order([s for s in spans.values() if s[0] is not None]):
        jobs.append(partial(store.add_buckets, VIEW_IDS.name, ids, name, buckets[VIEW_IDS.name], ID_LAYOUT))
    else:
        jobs.append(partial(store.add_as_is, VIEW_IDS.name, in_order(ids, "view_id"), name, ID_LAYOUT))
    for table in DIMENSIONS:
        if buckets[table] > 1:
            jobs.append(partial(store.add_buckets, table, old(table), name, buckets[table]))
        else:
            jobs.append(partial(store.add_rows, table, old(table), name))
    jobs.append(partial(store.add_rows, PRODUCT_NUMBERS.name, old(PRODUCT_NUMBERS.name), name))
    in_parallel(store, jobs)
    hold = store.spark.createDataFrame([(name,)], MART_LOADS.schema)
    hold.coalesce(1).write.mode("append").parquet(store.path(MART_LOADS.name))
    store.commit_load(name)
    return merged


def sweep_replaced(store: StarStore) -> list[str]:
    """Delete the files of loads that a merge has replaced; to be run when no query can still be reading them."""
    swept = []
    for marker, replaced in store.loads.replaced().items():
        for load_id in replaced:
            store.delete_load(load_id)
        store.loads.forget(marker)
        swept += replaced
    return sorted(swept)
