"""Event schema, star schema and marts, with the constraints a warehouse would declare on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PRODUCT_VIEW = "view_product_detail"
UNKNOWN = "UNKNOWN"
ERROR = "ERROR"

EVENT_FIELDS = (
    "id",
    "ip",
    "user_agent",
    "resolution",
    "store_id",
    "local_time",
    "current_url",
    "referrer_url",
    "collection",
    "product_id",
)
EVENT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in EVENT_FIELDS])

LOCATION_FIELDS = ("country_code", "country_name", "region_name", "city_name")

IP_RANGE_SCHEMA = T.StructType(
    [T.StructField("ip_from", T.LongType(), False), T.StructField("ip_to", T.LongType(), False)]
    + [T.StructField(name, T.StringType()) for name in LOCATION_FIELDS]
)

# Surrogate key -> the attributes hashed into it, in order.
SURROGATE_KEYS = {
    "sk_product": ("product_id",),
    "sk_store": ("store_id", "domain"),
    "sk_device": ("os", "browser", "resolution"),
    "sk_location": ("city_name", "region_name", "country_code"),
    "sk_traffic": ("referrer_domain", "traffic_type"),
}


@dataclass(frozen=True)
class Table:
    """A stored table: its columns, and what must hold for its rows."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    required: tuple[str, ...]
    max_length: dict[str, int]
    partitions: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stored_schema(self) -> T.StructType:
        """``schema`` plus the partition columns that are not part of it."""
        extra = [T.StructField(p, T.StringType()) for p in self.partitions if p not in self.columns]
        return T.StructType(self.schema.fields + extra)


def _table(name: str, key: str, columns: dict, not_null: str = "", partitions: str = "") -> Table:
    """``columns`` maps a name to a Spark type, or to an int for a string of at most that length."""
    keys = tuple(key.split())
    required = keys + tuple(c for c in not_null.split() if c not in keys)
    fields = [
        T.StructField(c, T.StringType() if isinstance(t, int) else t, True) for c, t in columns.items()
    ]
    limits = {c: t for c, t in columns.items() if isinstance(t, int)}
    return Table(name, T.StructType(fields), keys, required, limits, tuple(partitions.split()))


_INT, _LONG = T.IntegerType(), T.LongType()

DIMENSIONS = {
    t.name: t
    for t in (
        _table("dim_product", "sk_product", {"sk_product": 255, "product_id": 255}, "product_id", "load_id"),
        _table(
            "dim_store",
            "sk_store",
            {"sk_store": 255, "store_id": 255, "domain": 255},
            "store_id",
            "load_id",
        ),
        _table(
            "dim_location",
            "sk_location",
            {
                "sk_location": 255,
                "city_name": 255,
                "region_name": 255,
                "country_name": 255,
                "country_code": 10,
            },
            partitions="load_id",
        ),
        _table(
            "dim_device",
            "sk_device",
            {"sk_device": 255, "os": 100, "browser": 100, "resolution": 50},
            partitions="load_id",
        ),
        _table(
            "dim_traffic_source",
            "sk_traffic",
            {"sk_traffic": 255, "referrer_domain": 500, "traffic_type": 100},
            partitions="load_id",
        ),
        _table(
            "dim_date",
            "sk_date",
            {"sk_date": _INT, "full_date": T.DateType(), "day": _INT, "month": _INT, "year": _INT},
            "full_date",
            "load_id",
        ),
        _table("dim_time", "sk_time", {"sk_time": _INT, "hour": _INT, "minute": _INT}, partitions="load_id"),
    )
}

FACT = _table(
    "fact_product_views",
    "view_id",
    {
        "view_id": 255,
        "sk_date": _INT,
        "sk_time": _INT,
        "sk_product": 255,
        "sk_store": 255,
        "sk_location": 255,
        "sk_device": 255,
        "sk_traffic": 255,
        "inserted_at": T.TimestampType(),
    },
    "inserted_at",
    "sk_date load_id",
)
FACT_KEYS = [c for c in FACT.columns if c != "inserted_at"]

MARTS = {
    t.name: t
    for t in (
        _table(
            "agg_daily_views_by_country",
            "sk_date country_code",
            {
                "sk_date": _INT,
                "country_code": 10,
                "country_name": 255,
                "view_count": _LONG,
                "unique_products": _LONG,
            },
            "view_count unique_products",
            "sk_date",
        ),
        _table(
            "agg_daily_top_products",
            "sk_date product_id",
            {"sk_date": _INT, "product_id": 255, "view_count": _LONG, "rank": _INT},
            "view_count rank",
            "sk_date",
        ),
        _table(
            "agg_daily_traffic_breakdown",
            "sk_date traffic_type",
            {"sk_date": _INT, "traffic_type": 100, "view_count": _LONG},
            "view_count",
            "sk_date",
        ),
    )
}

REJECTED = _table(
    "rejected_views",
    "view_id",
    {
        "view_id": T.StringType(),
        **{f: T.StringType() for f in EVENT_FIELDS if f != "id"},
        "reason": T.StringType(),
    },
    partitions="load_id",
)

# What a load leaves beside the star, so that later loads, roll-ups and checks need not read the facts again.
LOADS = _table(
    "loads",
    "load_id",
    {
        "load_id": T.StringType(),
        "views": _LONG,
        "facts": _LONG,
        "last_inserted_at": T.TimestampType(),
        "days": T.ArrayType(_INT),
        "low_id": 255,
        "high_id": 255,
    },
    "views facts",
    "load_id",
)
VIEW_IDS = _table("view_ids", "view_id", {"view_id": 255}, partitions="load_id")
PRODUCT_NUMBERS = _table(
    "product_numbers", "sk_product", {"sk_product": 255, "number": _LONG}, "number", "load_id"
)
COUNTRY_INCREMENTS = _table(
    "country_increments",
    "sk_date country_code country_name bucket load_id",
    {
        "sk_date": _INT,
        "country_code": 10,
        "country_name": 255,
        "bucket": _LONG,
        "products": T.BinaryType(),
        "view_count": _LONG,
        "load_id": T.StringType(),
    },
    "view_count",
    "sk_date load_id",
)
MART_LOADS = _table("mart_loads", "load_id", {"load_id": T.StringType()})
LOAD_RESULTS = {t.name: t for t in (LOADS, VIEW_IDS, PRODUCT_NUMBERS, COUNTRY_INCREMENTS, MART_LOADS)}

TABLES = {**DIMENSIONS, FACT.name: FACT, **MARTS, REJECTED.name: REJECTED, **LOAD_RESULTS}

# What an enriched view must satisfy before it may enter the star: the NOT NULL columns fed from the
# event (an unreadable local_time shows up as a NULL sk_date) and every bounded string.
VIEW_REQUIRED = ("view_id", "product_id", "store_id", "sk_date")
VIEW_MAX_LENGTH = {
    column: limit
    for table in (FACT, *DIMENSIONS.values())
    for column, limit in table.max_length.items()
    if not column.startswith("sk_")
}
