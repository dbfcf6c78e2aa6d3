"""One query per operator. All of them run over whole tables and return a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewmill.functions.dates import date_key, sk_date_for
from viewmill.functions.text import url_authority
from viewmill.operators.enrich import enrich, enrich_in_place, with_device, with_time, with_traffic
from viewmill.operators.geo import geo_lookup
from viewmill.operators.merge import add_column_if_missing, first_per_key, insert_if_absent, upsert
from viewmill.operators.quality import duplicate_keys, freshness, orphans, overlong_values, split_valid
from viewmill.operators.stored_ids import id_span
from viewmill.operators.ranking import rank_in_group, top_n_per_group
from viewmill.plans.checks import check_tables
from viewmill.plans.increments import merged_products
from viewmill.plans.marts import (
    product_counts,
    refresh_marts,
    run_sql,
    top_products,
    traffic_breakdown,
    views_by_country,
)
from viewmill.plans.upkeep import merge_loads, sweep_replaced
from viewmill.plans.star import dimension, fact_views, load_star, stored_matches
from viewmill.schemas import DIMENSIONS, EVENT_FIELDS, FACT, FACT_KEYS, LOCATION_FIELDS, SURROGATE_KEYS, VIEW_REQUIRED
from viewmill.session import scratch_dir
from viewmill.sources import events as ev
from viewmill.sources import testdata as td
from viewmill.sources.buckets import read_buckets, write_buckets
from viewmill.sources.commits import Folders
from viewmill.sources.store import StarStore
from viewmill.streaming.load import start_star_stream

Query = Callable[[SparkSession, str], DataFrame]

# The first of two loads ends here; the second one brings everything.
FIRST_LOAD_UNTIL = "2024-01-16 12:00:00"
ROLLUP_DAY = "2024-01-05"
CHECKED_AT = datetime(2024, 1, 31)
BACKFILLED_AT = datetime(2024, 2, 1)
FIRST_LOAD_AT, SECOND_LOAD_AT = datetime(2024, 1, 30, 23, 52, 30), datetime(2024, 1, 30, 23, 53, 20)

# The daily top products as SQL text, the form in which roll-ups are handed to ``run_sql``.
TOP_PRODUCTS_SQL = """
WITH counted AS (
    SELECT v.sk_date, d.product_id, count(*) AS view_count
    FROM fact_product_views AS v
    INNER JOIN dim_product AS d USING (sk_product)
    WHERE v.sk_date = :sk_date
    GROUP BY ALL
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY sk_date ORDER BY view_count DESC, product_id) AS rank
    FROM counted
)
SELECT * FROM numbered WHERE rank <= :top_n
"""


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, which compares alike in every engine."""
    patterns = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    return df.select(
        *[
            F.date_format(name, patterns[kind]).alias(name) if kind in patterns else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.raw_views(spark, sf_dir)


def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.product_views(_raw(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(_views(spark, sf_dir), td.ip_ranges(spark, sf_dir), td.INTERNAL_KEYWORDS)


def _enriched_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For results that need no location, which thus need no lookup either."""
    return enrich_in_place(_views(spark, sf_dir), td.INTERNAL_KEYWORDS)


def _enriched_for(name: str) -> Query:
    return _enriched if name == "dim_location" else _enriched_in_place


def _records(raw: DataFrame) -> DataFrame:
    """Events as a message queue would deliver them: JSON bytes in ``value``."""
    return raw.select(F.to_json(F.struct(*EVENT_FIELDS)).cast("binary").alias("value"))


_stars: dict[tuple[str, str], StarStore] = {}


def stored_star(spark: SparkSession, sf_dir: str) -> StarStore:
    """A star on disk holding all views of ``sf_dir``; built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stars:
        store = StarStore(spark, scratch_dir(spark, "star")).init()
        ranges = td.ip_ranges(spark, sf_dir)
        load_star(store, _views(spark, sf_dir), "initial", ranges, td.INTERNAL_KEYWORDS)
        _stars[key] = store
    return _stars[key]


_two_load_stars: dict[tuple[str, str], StarStore] = {}


def two_load_star(spark: SparkSession, sf_dir: str) -> StarStore:
    """A star of two loads, the later one with all views again, whose marts were brought up to date after each."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _two_load_stars:
        store = StarStore(spark, scratch_dir(spark, "loads")).init()
        ranges, views = td.ip_ranges(spark, sf_dir), _views(spark, sf_dir)
        early = views.filter(F.col("local_time") < FIRST_LOAD_UNTIL)
        for load_id, delivered, at in (("early", early, FIRST_LOAD_AT), ("later", views, SECOND_LOAD_AT)):
            load_star(store, delivered, load_id, ranges, td.INTERNAL_KEYWORDS, inserted_at=at)
            refresh_marts(store)
        _two_load_stars[key] = store
    return _two_load_stars[key]


# --- sources, decoding, projection ------------------------------------------------------------


def decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = td.table(spark, sf_dir, "events").select("event_id", F.col("props").cast("binary").alias("value"))
    return ev.decode_payload(records)


def parse_event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ev.parse_events(ev.decode_payload(_records(_raw(spark, sf_dir))))
    return parsed.select(*[F.col(f"data.{c}").alias(f"data_{c}") for c in EVENT_FIELDS])


def flatten_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.flatten_events(ev.parse_events(ev.decode_payload(_records(_raw(spark, sf_dir)))))


def filter_product_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _views(spark, sf_dir)


def views_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.views_from_records(_records(_raw(spark, sf_dir)))


def preview_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(ev.preview(td.table(spark, sf_dir, "events").select("event_id", "event_type", "props"), 5, "event_id"))


# --- enrichment -------------------------------------------------------------------------------


def time_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("timestamp_obj", "sk_date", "full_date", "day", "month", "year", "sk_time", "hour", "minute")
    return portable(with_time(_raw(spark, sf_dir)).select("id", *fields))


def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.table(spark, sf_dir, "pages").select("page_id", url_authority(F.col("url")).alias("domain"))


def traffic_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = with_traffic(_raw(spark, sf_dir), td.INTERNAL_KEYWORDS)
    return views.select("id", "domain", "referrer_domain", "traffic_type")


def device_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_device(_raw(spark, sf_dir)).select("id", "os", "browser")


def geo_lookup_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = _raw(spark, sf_dir).select("id", "ip")
    return geo_lookup(views, td.ip_ranges(spark, sf_dir)).select("id", *LOCATION_FIELDS)


def geo_lookup_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup as for a range table too big to broadcast, with every block split."""
    views = _raw(spark, sf_dir).select("id", "ip")
    located = geo_lookup(views, td.ip_ranges(spark, sf_dir), broadcast=False, rows_per_split=100)
    return located.select("id", *LOCATION_FIELDS)


def geo_lookup_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup in ranges of both families, by merge; every third view comes from an IPv6 address of its country."""
    ip = F.col("ip")
    country, rest = F.split(ip, r"\.")[1], F.split(ip, r"\.")[2]
    v6 = F.concat(F.lit("2001:db8:"), F.lower(F.hex(country.cast("int"))), F.lit("::"), F.lower(F.hex(rest.cast("int"))))
    views = _raw(spark, sf_dir).select("id", F.when(F.col("id").cast("bigint") % 3 == 0, v6).otherwise(ip).alias("ip"))
    v4 = td.ip_ranges(spark, sf_dir)
    nation = F.lower(F.hex(F.shiftright("ip_from", 16) - 2560))
    first = F.concat(F.lit("2001:db8:"), nation, F.lit("::"))
    last = F.concat(F.lit("2001:DB8:"), nation, F.lit(":ffff:ffff:ffff:ffff:ffff"))

    def dotted(column: str) -> Column:
        return F.concat_ws(".", *[F.shiftright(column, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)])

    by_address = v4.select(first.alias("first_ip"), last.alias("last_ip"), *LOCATION_FIELDS).unionAll(
        v4.select(dotted("ip_from"), dotted("ip_to"), *LOCATION_FIELDS)
    )
    return geo_lookup(views, by_address, rows_per_split=1000).select("id", *LOCATION_FIELDS)


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select("view_id", *SURROGATE_KEYS)


def enriched_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(_enriched(spark, sf_dir))


def sk_date_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = td.table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("ds")).distinct()
    return days.select("ds", date_key(F.to_date("ds")).alias("sk_date"))


# --- star -------------------------------------------------------------------------------------


def _dimension(name: str) -> Query:
    return lambda spark, sf_dir: portable(dimension(_enriched_for(name)(spark, sf_dir), name))


def fact_product_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_views(_enriched(spark, sf_dir))


def _two_loads(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The views of an early load, and those of a later one that repeats them and adds the rest."""
    return enriched.filter(F.col("local_time") < FIRST_LOAD_UNTIL), enriched


def _dimension_insert(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        early, later = _two_loads(_enriched_for(name)(spark, sf_dir))
        stored = dimension(early, name).withColumn("load", F.lit(1))
        source = dimension(later, name).withColumn("load", F.lit(2))
        return portable(insert_if_absent(stored, source, DIMENSIONS[name].key))

    return query


def fact_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, later = _two_loads(_enriched(spark, sf_dir))
    stored = fact_views(early).withColumn("load", F.lit(1))
    source = fact_views(later).withColumn("load", F.lit(2))
    return insert_if_absent(stored, source, ["view_id"])


def lineitem_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source with repeated keys, some of them stored already."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = td.table(spark, sf_dir, "lineitem").select(*keys, "l_partkey", "l_suppkey", "l_linestatus")
    stored = first_per_key(lines.filter(F.col("l_linestatus") == "O"), keys).withColumn("load", F.lit(1))
    return insert_if_absent(stored, lines.withColumn("load", F.lit(2)), keys)


def lineitem_insert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``lineitem_insert_if_absent``, with what is stored in buckets of the key, which are joined where they lie."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = td.table(spark, sf_dir, "lineitem").select(*keys, "l_partkey", "l_suppkey", "l_linestatus")
    first = first_per_key(lines.filter(F.col("l_linestatus") == "O"), keys).withColumn("load", F.lit(1))
    folder = f"{scratch_dir(spark, 'lines')}/stored"
    folders = Folders(spark, folder)
    write_buckets(folders, first, folder, keys, 32)
    stored = read_buckets(spark, folders, folder, keys, first.schema)
    return insert_if_absent(stored, lines.withColumn("load", F.lit(2)), keys)


def backfill_inserted_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = fact_views(_enriched(spark, sf_dir))
    return portable(add_column_if_missing(old, "inserted_at", BACKFILLED_AT, "timestamp"))


# --- star joins, aggregates and marts, on the stored star -------------------------------------


def fact_for_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_star(spark, sf_dir).fact_for_day(sk_date_for(ROLLUP_DAY)).select(*FACT_KEYS)


def _fact(store: StarStore) -> DataFrame:
    return store.table("fact_product_views")


def fact_join_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored_star(spark, sf_dir)
    joined = _fact(store).join(store.table("dim_product"), "sk_product", "inner")
    return joined.select("view_id", "sk_date", "product_id")


def fact_join_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored_star(spark, sf_dir)
    joined = _fact(store).join(store.table("dim_location"), "sk_location", "left")
    return joined.select("view_id", "sk_date", *LOCATION_FIELDS)


def fact_join_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored_star(spark, sf_dir)
    joined = _fact(store).join(store.table("dim_traffic_source"), "sk_traffic", "left")
    return joined.select("view_id", "sk_date", "referrer_domain", "traffic_type")


def count_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _fact(stored_star(spark, sf_dir))
    return fact.groupBy("sk_date", "sk_traffic").agg(F.count(F.lit(1)).alias("view_count"))


def distinct_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _fact(stored_star(spark, sf_dir))
    return fact.groupBy("sk_date").agg(F.count_distinct("sk_product").alias("unique_products"))


def product_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored_star(spark, sf_dir)
    counts = product_counts(_fact(store), store.table("dim_product"))
    return rank_in_group(counts, "sk_date", "view_count", "product_id")


def top_n_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 event kinds and products per day over all events, not just the views."""
    counts = (
        with_time(_raw(spark, sf_dir))
        .withColumn("item", F.concat_ws("/", "collection", "product_id"))
        .groupBy("sk_date", "item")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return top_n_per_group(counts, "sk_date", "events", "item", 10)


def daily_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored_star(spark, sf_dir)
    return top_products(_fact(store), store.table("dim_product"))


def daily_views_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored_star(spark, sf_dir)
    return views_by_country(_fact(store), store.table("dim_location"))


def daily_traffic_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored_star(spark, sf_dir)
    return traffic_breakdown(_fact(store), store.table("dim_traffic_source"))


def rollup_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(stored_star(spark, sf_dir), TOP_PRODUCTS_SQL, ROLLUP_DAY)


def mart_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart built half-way through a day, then brought up to date from that day on."""
    store = stored_star(spark, sf_dir)
    fact, types = _fact(store), store.table("dim_traffic_source")
    until = datetime.fromisoformat(FIRST_LOAD_UNTIL)
    day, time = sk_date_for(f"{until:%Y-%m-%d}"), until.hour * 100 + until.minute
    known = (F.col("sk_date") < day) | ((F.col("sk_date") == day) & (F.col("sk_time") < time))
    stored = traffic_breakdown(fact.filter(known), types)
    fresh = traffic_breakdown(fact.filter(F.col("sk_date") >= day), types)
    return upsert(stored, fresh, ["sk_date", "traffic_type"], ["view_count"])


# --- loads and what they leave behind ---------------------------------------------------------


def _refreshed(name: str) -> Query:
    return lambda spark, sf_dir: two_load_star(spark, sf_dir).table(name)


def merged_distinct_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct products per day, from the bitmaps that two loads made per day and country."""
    increments = two_load_star(spark, sf_dir).table("country_increments")
    return merged_products(increments, "sk_date")


def loads_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = two_load_star(spark, sf_dir).table("loads")
    return portable(loads.withColumn("days", F.size("days")))


def fresh_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = two_load_star(spark, sf_dir).table("loads")
    return portable(freshness(loads, "last_inserted_at", CHECKED_AT, count_col="facts"))


def known_view_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the ids of all events, views or not, those that are stored."""
    store = two_load_star(spark, sf_dir)
    ids = _raw(spark, sf_dir).select(F.col("id").alias("view_id")).filter(F.col("view_id").isNotNull())
    low, high, n = ids.agg(F.min("view_id"), F.max("view_id"), F.count(F.lit(1))).first()
    if not n:
        return ids
    return stored_matches(store, id_span(ids, "view_id", n, low, high)).join(ids, "view_id", "left_semi")


def merged_star_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that became one, with the files of the old ones deleted."""
    store = StarStore(spark, scratch_dir(spark, "merged")).init()
    ranges, views = td.ip_ranges(spark, sf_dir), _views(spark, sf_dir)
    for load_id, delivered in (("early", views.filter(F.col("local_time") < FIRST_LOAD_UNTIL)), ("later", views)):
        load_star(store, delivered, load_id, ranges, td.INTERNAL_KEYWORDS)
    refresh_marts(store)
    merge_loads(store)
    sweep_replaced(store)
    return _star_rows(store)


# --- quality ----------------------------------------------------------------------------------


def duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(td.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def rejected_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views judged by rules stricter than the star's, which all test views satisfy."""
    required = (*VIEW_REQUIRED, "user_agent", "referrer_url")
    _, rejected = split_valid(with_time(_views(spark, sf_dir)), required, {"current_url": 45})
    return rejected.select("view_id", "reason")


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts whose minute of day is missing in a dimension that stopped at the early load."""
    store = stored_star(spark, sf_dir)
    early, _ = _two_loads(_enriched_in_place(spark, sf_dir))
    return orphans(_fact(store), dimension(early, "dim_time"), "sk_time").select("view_id", "sk_time")


def star_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All constraints of the facts and of dimensions that stopped at the early load."""
    early, _ = _two_loads(_enriched(spark, sf_dir))
    dims = {name: dimension(early, name) for name in DIMENSIONS}
    return check_tables({**dims, FACT.name: _fact(stored_star(spark, sf_dir)).select(*FACT_KEYS)})


def overlong(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = td.table(spark, sf_dir, "documents")
    return overlong_values(documents, ["doc_id"], {"text": 1000, "source": 5})


def fresh_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(freshness(td.table(spark, sf_dir, "events"), "ts", CHECKED_AT))


# --- streaming --------------------------------------------------------------------------------


def _stream_into(store: StarStore, spark: SparkSession, sf_dir: str, remember: str | None = None) -> None:
    # The pattern matches just the events table, be it one file or a folder of them; a plain path
    # would have to be a folder.
    events = spark.readStream.schema(td.EVENT_COLUMNS).parquet(f"{sf_dir}/events.parque[t]")
    records = _records(td.raw_views_of(events, td.table(spark, sf_dir, "pages")))
    if remember:
        # Every event is delivered twice.
        records = records.unionAll(records)
    start_star_stream(
        store,
        records,
        scratch_dir(spark, "offsets"),
        td.ip_ranges(spark, sf_dir),
        td.INTERNAL_KEYWORDS,
        trigger={"availableNow": True},
        remember=remember,
    ).awaitTermination()


def _star_rows(store: StarStore) -> DataFrame:
    """Stored facts with the attributes their keys lead to."""
    rows = _fact(store)
    for name, key in (
        ("dim_product", "sk_product"),
        ("dim_store", "sk_store"),
        ("dim_location", "sk_location"),
        ("dim_device", "sk_device"),
        ("dim_traffic_source", "sk_traffic"),
        ("dim_date", "sk_date"),
        ("dim_time", "sk_time"),
    ):
        rows = rows.join(store.table(name), key)
    return portable(rows.drop("inserted_at"))


def stream_star_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = StarStore(spark, scratch_dir(spark, "streamed")).init()
    _stream_into(store, spark, sf_dir)
    return _star_rows(store)


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch, a part of it and all of it delivered again, then everything once more through a stream."""
    store = StarStore(spark, scratch_dir(spark, "replayed")).init()
    views, ranges = _views(spark, sf_dir), td.ip_ranges(spark, sf_dir)
    shortened = views.filter(F.col("local_time") < FIRST_LOAD_UNTIL)
    for delivered in (views, shortened, views):
        load_star(store, delivered, "replayed", ranges, td.INTERNAL_KEYWORDS)
    _stream_into(store, spark, sf_dir)
    return _star_rows(store)


def stream_remembering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that delivers every event twice and drops the second ones by keyed state."""
    store = StarStore(spark, scratch_dir(spark, "remembering")).init()
    _stream_into(store, spark, sf_dir, "1 hour")
    return _star_rows(store)


QUERIES: dict[str, Query] = {
    "filter_product_views": filter_product_views,
    "time_dims": time_dims,
    "surrogate_keys": surrogate_keys,
    **{name: _dimension(name) for name in DIMENSIONS},
    "fact_views": fact_product_views,
    "fact_for_day": fact_for_day,
    "fact_join_product": fact_join_product,
    "fact_join_location": fact_join_location,
    "fact_join_traffic": fact_join_traffic,
    "count_by_group": count_by_group,
    "distinct_products": distinct_products,
    "product_rank": product_rank,
    "top_products": top_n_by_day,
    "daily_top_products": daily_top_products,
    "daily_views_by_country": daily_views_by_country,
    "daily_traffic_breakdown": daily_traffic_breakdown,
    "rollup_sql": rollup_sql,
    "url_domain": url_domain,
    "traffic_source": traffic_source,
    "geo_lookup": geo_lookup_broadcast,
    "geo_lookup_shuffled": geo_lookup_shuffled,
    "geo_lookup_families": geo_lookup_families,
    "device_dims": device_dims,
    "enriched_views": enriched_views,
    **{f"{name}_insert_if_absent": _dimension_insert(name) for name in DIMENSIONS},
    "fact_insert_if_absent": fact_insert_if_absent,
    "lineitem_insert_if_absent": lineitem_insert_if_absent,
    "lineitem_insert_bucketed": lineitem_insert_bucketed,
    "mart_upsert": mart_upsert,
    "backfill_inserted_at": backfill_inserted_at,
    "duplicate_keys": duplicate_lines,
    "rejected_views": rejected_views,
    "fk_orphans": fk_orphans,
    "star_constraints": star_constraints,
    "overlong_values": overlong,
    "freshness": fresh_events,
    "sk_date_for": sk_date_of_day,
    "decode_payload": decode_payload,
    "parse_event_json": parse_event_json,
    "flatten_event": flatten_event,
    "views_from_json": views_from_json,
    "preview_events": preview_events,
    "stream_star_load": stream_star_load,
    "stream_replay": stream_replay,
    "stream_remembering": stream_remembering,
    "refreshed_views_by_country": _refreshed("agg_daily_views_by_country"),
    "refreshed_top_products": _refreshed("agg_daily_top_products"),
    "refreshed_traffic_breakdown": _refreshed("agg_daily_traffic_breakdown"),
    "merged_distinct_products": merged_distinct_products,
    "loads_log": loads_log,
    "freshness_of_loads": fresh_loads,
    "known_view_ids": known_view_ids,
    "merged_star_rows": merged_star_rows,
}
