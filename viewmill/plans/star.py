"""From product views to seven dimensions and one fact table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from viewmill.operators.enrich import enrich
from viewmill.operators.merge import absent_rows, distinct_per_key, first_per_key
from viewmill.operators.quality import reject_reason
from viewmill.operators.stored_ids import ID_LAYOUT, IdSpan, id_span, in_order
from viewmill.plans.increments import country_increments
from viewmill.schemas import (
    COUNTRY_INCREMENTS,
    DIMENSIONS,
    FACT,
    FACT_KEYS,
    LOADS,
    MARTS,
    PRODUCT_NUMBERS,
    REJECTED,
    VIEW_IDS,
    VIEW_MAX_LENGTH,
    VIEW_REQUIRED,
)
from viewmill.session import scratch_dir
from viewmill.sources.store import StarStore

# Up to this many views with ids of so many bytes, the ids are broadcast to find the stored ones; beyond it the stored
# ids are shuffled.
BROADCAST_VIEW_IDS = 500_000
BROADCAST_ID_BYTES = 64 * 1024 * 1024

# Only loads that may hold ids of a batch are read; more of them than this are read as one table.
NAMED_LOADS = 1000

# Event fields no table but that of rejected views has.
REJECT_ONLY = ("ip", "user_agent", "current_url", "referrer_url", "collection")


def dimension(enriched: DataFrame, name: str) -> DataFrame:
    """The rows of one dimension, one per key."""
    table = DIMENSIONS[name]
    return distinct_per_key(enriched.select(*table.columns), table.key)


def fact_views(enriched: DataFrame) -> DataFrame:
    """One fact row per ``view_id``; among copies the earliest ``local_time`` wins."""
    rows = enriched.select("local_time", *FACT_KEYS)
    return first_per_key(rows, FACT.key, ["local_time"]).select(*FACT_KEYS)


@dataclass(frozen=True)
class LoadOptions:
    """How a load behaves.

    strict: raise on invalid views instead of storing them in ``rejected_views``.
    staged: keep the enriched views in a table below the scratch folder rather than in executor
        memory; for loads too big to cache.
    broadcast_ranges: whether the range table may be broadcast; measured when not given.
    """

    strict: bool = False
    staged: bool = False
    broadcast_ranges: bool | None = None


def load_star(
    store: StarStore,
    views: DataFrame,
    load_id: str,
    ranges: DataFrame,
    internal_keywords: Iterable[str],
    options: LoadOptions = LoadOptions(),
    inserted_at: datetime | None = None,
) -> dict[str, int]:
    """Enrich ``views`` and load them, see :func:`load_enriched`.

    Enrichment, and all that reads its result, would run in the partitions ``views`` come in, be it a single one, as of a
    file that cannot be split. They are dealt out first, while rows are short, into as many parts as there are cores, or
    into more of the advisory size; few views stay together.
    """
    enriched = enrich(views.hint("rebalance"), ranges, internal_keywords, options.broadcast_ranges)
    return load_enriched(store, enriched, load_id, options, inserted_at)


def load_enriched(
    store: StarStore,
    enriched: DataFrame,
    load_id: str,
    options: LoadOptions = LoadOptions(),
    inserted_at: datetime | None = None,
) -> dict[str, int]:
    """Insert what is new in enriched views into the star; returns the rows inserted per table.

    Rows already stored win. Nothing that readers have seen is ever removed. Dimensions, facts and what is kept beside
    them become visible together, when all are written: of a load that fails half-way readers see nothing, and it is
    simply repeated. A committed load that is delivered again, with the same, fewer or more views, adds what is missing.
    The rejected views of a load are those of its last attempt.
    """
    judged = enriched.withColumn("reason", reject_reason(VIEW_REQUIRED, VIEW_MAX_LENGTH))
    # The long texts of an event are of use for rejected views only; valid ones are kept without.
    judged = judged.withColumns({c: F.when(F.col("reason").isNotNull(), F.col(c)) for c in REJECT_ONLY})
    judged, release = _stage(store, judged, options.staged)
    try:
        valid_id = F.when(F.col("reason").isNull(), F.col("view_id"))
        size = judged.agg(
            F.count(F.lit(1)).alias("views"),
            F.count("reason").alias("rejected"),
            F.coalesce(F.sum(F.octet_length(valid_id)), F.lit(0)).alias("id_bytes"),
            F.min(valid_id).alias("low_id"),
            F.max(valid_id).alias("high_id"),
        ).first()
        done = {"views": size.views, REJECTED.name: size.rejected}
        if size.rejected and options.strict:
            raise ValueError(f"load {load_id}: {size.rejected} of {size.views} views are invalid")
        store.replace_load(REJECTED.name, judged.filter(F.col("reason").isNotNull()), load_id)
        if size.views == size.rejected:
            return done
        valid = judged.filter(F.col("reason").isNull())
        name = store.begin_load(load_id)
        _write_star(store, valid, name, size, inserted_at)
        done |= _describe_load(store, name, size.views)
        store.commit_load(name)
        return done
    finally:
        release()


def _stage(store: StarStore, judged: DataFrame, staged: bool):
    """The enriched views evaluated once, since nine writes read them; and how to let go of them."""
    if staged:
        path = scratch_dir(store.spark, "views")
        judged.write.parquet(path)
        return store.spark.read.schema(judged.schema).parquet(path), lambda: store.drop_folder(path)
    kept = judged.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.unpersist


def in_parallel(store: StarStore, jobs: Iterable[Callable[[], object]]) -> list:
    """Results of jobs that do not depend on each other, submitted at the same time."""
    jobs = list(jobs)
    spread = inheritable_thread_target(store.spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [job.result() for job in [pool.submit(spread(job)) for job in jobs]]


def _write_star(store: StarStore, valid: DataFrame, load_id: str, size: Row, inserted_at: datetime | None) -> None:
    """Dimensions and facts. No order is needed, as none of them counts before the load is committed."""
    in_parallel(
        store,
        [partial(_load_fact, store, valid, load_id, size, inserted_at)]
        + [partial(_load_dimension, store, valid, name, load_id) for name in DIMENSIONS],
    )


def _load_dimension(store: StarStore, valid: DataFrame, name: str, load_id: str) -> None:
    new = dimension(valid, name)
    for part in store.read_parts(name):
        new = absent_rows(new, part, DIMENSIONS[name].key)
    store.add_rows(name, new, load_id)


def _load_fact(store: StarStore, valid: DataFrame, load_id: str, size: Row, inserted_at: datetime | None) -> None:
    few = size.views <= BROADCAST_VIEW_IDS and size.id_bytes <= BROADCAST_ID_BYTES
    loads = loads_between(store, size.low_id, size.high_id)
    span = IdSpan(size.low_id, size.high_id)
    if few and loads:
        span = id_span(valid, "view_id", size.views - size.rejected, size.low_id, size.high_id)
    new = fact_views(valid)
    if few:
        # Few views: reduce the stored ids to those at issue where they are read, without a shuffle.
        stored = stored_matches(store, span, loads).join(F.broadcast(valid.select("view_id")), "view_id", "left_semi")
        new = absent_rows(new, stored, FACT.key)
    else:
        # Merged, whatever size Spark expects: as files, ids in order are far smaller than in memory, and would be
        # broadcast by the million.
        for part in store.read_parts(VIEW_IDS.name, loads_to_read(span, loads)):
            new = absent_rows(new, part.filter(span.may_hold("view_id")).hint("merge"), FACT.key)
    now = F.current_timestamp() if inserted_at is None else F.lit(inserted_at)
    store.add_rows(FACT.name, new.withColumn("inserted_at", now.cast("timestamp")), load_id)


def loads_between(store: StarStore, low: str, high: str) -> list[Row]:
    """Committed loads with ids from ``low`` to ``high``, and one too many if there are more than ``NAMED_LOADS``."""
    loads = store.table(LOADS.name).select("load_id", "low_id", "high_id")
    return loads.filter((F.col("high_id") >= low) & (F.col("low_id") <= high)).limit(NAMED_LOADS + 1).collect()


def loads_to_read(span: IdSpan, loads: list[Row]) -> list[str] | None:
    """Which of ``loads`` can hold ids of a span; ``None`` if they are too many to be named."""
    return [r.load_id for r in loads if span.may_overlap(r.low_id, r.high_id)] if len(loads) <= NAMED_LOADS else None


def stored_matches(store: StarStore, span: IdSpan, loads: list[Row] | None = None) -> DataFrame:
    """Stored ids that can be in a batch, from the loads and row groups that can hold any of it. ``loads`` are those
    between the ends of the span, if they are known."""
    if loads is None:
        loads = loads_between(store, span.low, span.high)
    named = loads_to_read(span, loads)
    ids = store.read(VIEW_IDS.name) if named is None else store.read_loads(VIEW_IDS.name, named)
    return ids.filter(span.may_hold("view_id")).select("view_id")


def rows_of_loads(store: StarStore, names: Iterable[str], load_ids: list[str]) -> dict[str, int]:
    """Rows per table in the files of some loads; no column is read."""
    parts = [store.read_loads(n, load_ids).select(F.lit(n).alias("name")) for n in names]
    counted = reduce(DataFrame.unionAll, parts).groupBy("name").count().collect()
    return dict.fromkeys(names, 0) | {r["name"]: r["count"] for r in counted}


def _describe_load(store: StarStore, load_id: str, views: int) -> dict[str, int]:
    """What later loads, roll-ups and checks need to know of a load, from the files it has written; returns its rows per
    table. Files are read back because a counter inside the plan counts the rows of a repeated task twice."""
    facts = store.read_loads(FACT.name, [load_id])

    def of_facts() -> Row:
        return facts.agg(
            F.count(F.lit(1)).alias("facts"),
            F.max("inserted_at").alias("last_inserted_at"),
            F.array_sort(F.collect_set("sk_date")).alias("days"),
            F.min("view_id").alias("low_id"),
            F.max("view_id").alias("high_id"),
        ).first()

    def ids() -> None:
        store.add_as_is(VIEW_IDS.name, in_order(facts, "view_id"), load_id, ID_LAYOUT)

    def increments() -> None:
        _number_products(store, load_id)
        numbers = store.read(PRODUCT_NUMBERS.name).unionByName(store.read_loads(PRODUCT_NUMBERS.name, [load_id]))
        places = store.read("dim_location").unionByName(store.read_loads("dim_location", [load_id]))
        store.add_as_is(COUNTRY_INCREMENTS.name, country_increments(facts, places, numbers), load_id)

    dimensions, found, *_ = in_parallel(store, [partial(rows_of_loads, store, DIMENSIONS, [load_id]), of_facts, ids, increments])
    row = {"load_id": load_id, "views": views, **found.asDict()}
    described = store.spark.createDataFrame([tuple(row[c] for c in LOADS.columns)], LOADS.schema)
    store.add_as_is(LOADS.name, described.coalesce(1), load_id)
    return {**dimensions, FACT.name: found.facts}


def _number_products(store: StarStore, load_id: str) -> None:
    """Give each product that a load adds a number of its own, for bitmaps of products.

    Numbers go on from the greatest one; each task of the write has a stretch of its own. They are written once and
    never change.
    """
    last = store.read(PRODUCT_NUMBERS.name).agg(F.max("number")).first()[0] or 0
    new = store.read_loads("dim_product", [load_id]).select("sk_product")
    numbered = new.withColumn("number", F.monotonically_increasing_id() + F.lit(last + 1))
    store.add_as_is(PRODUCT_NUMBERS.name, numbered, load_id)


def compact_into(store: StarStore, target: StarStore) -> dict[str, int]:
    """Copy a star into the empty ``target`` as one load of well-sized files.

    Frequent small loads leave many small files behind; readers switch to ``target`` when it is done.
    """
    target.init()
    load_id = target.begin_load("compacted")
    facts = first_per_key(store.table(FACT.name), FACT.key, ["inserted_at"])
    target.add_rows(FACT.name, facts, load_id)
    for name in DIMENSIONS:
        target.add_rows(name, distinct_per_key(store.table(name), DIMENSIONS[name].key), load_id)
    target.add_rows(REJECTED.name, store.table(REJECTED.name), load_id)
    for name in MARTS:
        target.write_days(name, store.table(name))
    views = store.table(LOADS.name).agg(F.coalesce(F.sum("views"), F.lit(0))).first()[0]
    done = _describe_load(target, load_id, views)
    target.commit_load(load_id)
    return done
