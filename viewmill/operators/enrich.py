"""Row enrichment of product views: time, device, traffic source, location and keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmill.functions.dates import date_key, parse_local_time, time_key
from viewmill.functions.device import BROWSER_RULES, OS_RULES, Rules, classify
from viewmill.functions.hashing import surrogate_key
from viewmill.functions.text import blank_to, contains_any, is_blank, url_authority
from viewmill.operators.geo import geo_lookup
from viewmill.schemas import SURROGATE_KEYS, UNKNOWN

# Referrers that count as social networks or search engines.
SOCIAL_KEYWORDS = (
    "google",
    "youtube",
    "facebook",
    "bing",
    "twitter",
    "linkedin",
    "instagram",
    "tiktok",
)


def with_time(views: DataFrame) -> DataFrame:
    """Calendar fields of ``local_time``; all NULL where it cannot be read."""
    ts = F.col("timestamp_obj")
    return views.withColumn("timestamp_obj", parse_local_time(F.col("local_time"))).withColumns(
        {
            "sk_date": date_key(ts),
            "full_date": ts.cast("date"),
            "day": F.dayofmonth(ts),
            "month": F.month(ts),
            "year": F.year(ts),
            "sk_time": time_key(ts),
            "hour": F.hour(ts),
            "minute": F.minute(ts),
        }
    )


def with_device(
    views: DataFrame, os_rules: Rules = OS_RULES, browser_rules: Rules = BROWSER_RULES
) -> DataFrame:
    """``os`` and ``browser`` families of ``user_agent``."""
    agent = F.col("user_agent")
    return views.withColumns({"os": classify(agent, os_rules), "browser": classify(agent, browser_rules)})


def with_traffic(
    views: DataFrame,
    internal_keywords: Iterable[str],
    social_keywords: Iterable[str] = SOCIAL_KEYWORDS,
) -> DataFrame:
    """Shop domain, referrer domain and traffic type.

    A keyword counts wherever it occurs in the lower-cased referrer domain. Social wins over
    ``internal_keywords`` (the shop's own brand). Without a referrer the visit is direct.
    """
    page, referrer = F.col("current_url"), F.col("referrer_url")
    # The authorities get columns of their own, so that each is extracted once.
    found = views.withColumns({"_page": url_authority(page), "_referrer": url_authority(referrer)})
    source = F.lower("referrer_domain")
    return (
        found.withColumns(
            {
                "domain": F.when(is_blank(page), F.lit(UNKNOWN)).otherwise(F.col("_page")),
                "referrer_domain": F.when(is_blank(referrer), F.lit("DIRECT")).otherwise(
                    blank_to(F.col("_referrer"), UNKNOWN)
                ),
            }
        )
        .withColumn(
            "traffic_type",
            F.when(is_blank(referrer), "Direct")
            .when(contains_any(source, social_keywords), "Social/Search")
            .when(contains_any(source, internal_keywords), "Internal")
            .otherwise("Referral"),
        )
        .drop("_page", "_referrer")
    )


def with_location(views: DataFrame, ranges: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Country, region and city of ``ip``."""
    return geo_lookup(views, ranges, broadcast)


def with_keys(views: DataFrame, keys: Iterable[str] = tuple(SURROGATE_KEYS)) -> DataFrame:
    """Content-hash keys; ``keys`` limits them to those whose attributes are at hand."""
    return views.withColumns({k: surrogate_key(*[F.col(c) for c in SURROGATE_KEYS[k]]) for k in keys})


def enrich_in_place(views: DataFrame, internal_keywords: Iterable[str]) -> DataFrame:
    """All enrichments that need no other table, thus everything but the location."""
    keys = [k for k in SURROGATE_KEYS if k != "sk_location"]
    return with_keys(with_traffic(with_time(with_device(views)), internal_keywords), keys)


def enrich(
    views: DataFrame,
    ranges: DataFrame,
    internal_keywords: Iterable[str],
    broadcast_ranges: bool | None = None,
) -> DataFrame:
    """All enrichments in one narrow pass: no shuffle while the range table can be broadcast.

    The location comes first, while rows are still short.
    """
    located = with_location(views, ranges, broadcast_ranges)
    return enrich_in_place(with_keys(located, ["sk_location"]), internal_keywords)
