"""Product-view events and IP ranges derived from the generated test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewmill.schemas import PRODUCT_VIEW

INTERNAL_KEYWORDS = ("shop-internal",)

# The user agents and referrers events are given in turn.
USER_AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
    "Version/16.5 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Linux; Android 13; SM-G991B) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/112.0.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) "
    "Version/16.1 Safari/605.1.15",
    "",
    None,
)
REFERRERS = (
    None,
    "",
    "https://www.google.com/search?q=ring",
    "https://m.facebook.com/x",
    "https://www.shop-internal.example/home",
    "no-scheme/path",
    "http://blog.example.org:8080/a b",
)
RESOLUTIONS = ("1920x1080", "375x812", "1366x768")

EVENT_COLUMNS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _in_turn(number, choices):
    """``choices[number % len(choices)]``."""
    turn = F.pmod(number, F.lit(len(choices)))
    pick = F.when(turn == 0, F.lit(choices[0]))
    for i, choice in enumerate(choices[1:], start=1):
        pick = pick.when(turn == i, F.lit(choice))
    return pick.cast("string")


def raw_views_of(events: DataFrame, pages: DataFrame) -> DataFrame:
    """All ``events`` in the shape of the web event schema; they show all pages in turn."""
    event, user = F.col("event_id"), F.col("user_id")
    shown = pages.select("page_id", "url")
    # Without pages there is nothing to divide by, and no event shows one.
    turn = event % F.lit(max(pages.count(), 1))
    return events.join(shown, turn == F.col("page_id"), "left").select(
        event.cast("string").alias("id"),
        F.concat_ws(
            ".",
            F.lit("10"),
            (user % 27).cast("string"),
            (event % 256).cast("string"),
            (user % 256).cast("string"),
        ).alias("ip"),
        _in_turn(event, USER_AGENTS).alias("user_agent"),
        _in_turn(user, RESOLUTIONS).alias("resolution"),
        (user % 5).cast("string").alias("store_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("local_time"),
        F.col("url").alias("current_url"),
        _in_turn(event, REFERRERS).alias("referrer_url"),
        F.when(F.col("event_type") == "view", PRODUCT_VIEW)
        .otherwise(F.col("event_type"))
        .alias("collection"),
        F.get_json_object("props", "$.k").alias("product_id"),
    )


def raw_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_views_of(table(spark, sf_dir, "events"), table(spark, sf_dir, "pages"))


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One /16 per nation."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    start = (F.lit(10 * 256).cast("bigint") + F.col("n_nationkey")) * 65536
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        start.alias("ip_from"),
        (start + 65535).alias("ip_to"),
        F.col("n_name").alias("country_code"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("region_name"),
        F.lit("-").alias("city_name"),
    )
