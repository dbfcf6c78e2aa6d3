"""Small hand-written inputs."""

from __future__ import annotations

from viewmill.schemas import EVENT_FIELDS, EVENT_SCHEMA, IP_RANGE_SCHEMA

CHROME = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/120.0.0.0 Safari/537.36"
)

DEFAULT_EVENT = {
    "id": "v1",
    "ip": "10.0.0.1",
    "user_agent": CHROME,
    "resolution": "1920x1080",
    "store_id": "s1",
    "local_time": "2024-01-05 10:20:30",
    "current_url": "https://shop.example/a",
    "referrer_url": None,
    "collection": "view_product_detail",
    "product_id": "p1",
}

INTERNAL = ("mybrand",)


def events(spark, *changes):
    """One event per dict in ``changes``, each the default event with those fields changed."""
    rows = [tuple({**DEFAULT_EVENT, **change}[f] for f in EVENT_FIELDS) for change in changes]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def views(spark, *changes):
    return events(spark, *changes).withColumnRenamed("id", "view_id")


def number(ip):
    a, b, c, d = map(int, ip.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def ranges(spark, *rows):
    """Rows of (first ip, last ip, country) or of all six fields after numbers."""
    full = [
        (number(r[0]), number(r[1]), r[2], f"{r[2]} name", f"{r[2]} region", "-") if len(r) == 3 else r
        for r in rows
    ]
    return spark.createDataFrame(full, IP_RANGE_SCHEMA)


def home(spark):
    """A range table that knows 10.0.0.0/16 only."""
    return ranges(spark, ("10.0.0.0", "10.0.255.255", "HM"))


def rows(df, *columns):
    """All rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
