from __future__ import annotations

import pytest

from tests.helpers import INTERNAL, home, rows, views
from viewmill.operators.enrich import enrich, with_time, with_traffic
from viewmill.schemas import EVENT_FIELDS

TRAFFIC = [
    (None, "DIRECT", "Direct"),
    ("", "DIRECT", "Direct"),
    ("no-scheme/path", "UNKNOWN", "Referral"),
    ("https://climbing.example/", "climbing.example", "Social/Search"),
    ("https://google.mybrand.example/", "google.mybrand.example", "Social/Search"),
    ("https://www.MyBrand.example/", "www.MyBrand.example", "Internal"),
    ("HTTP://WWW.GOOGLE.COM/x", "WWW.GOOGLE.COM", "Social/Search"),
    ("http://u:p@h.example:8080/x", "u:p@h.example:8080", "Referral"),
    ("https://h.example/?from=google", "h.example", "Referral"),
]


@pytest.mark.parametrize(("url", "domain", "kind"), TRAFFIC)
def test_traffic_source(spark, url, domain, kind):
    found = with_traffic(views(spark, {"referrer_url": url}), INTERNAL)
    assert rows(found, "referrer_domain", "traffic_type") == [(domain, kind)]


@pytest.mark.parametrize(
    ("url", "domain"), [(None, "UNKNOWN"), ("", "UNKNOWN"), ("www.x.example/a", ""), ("https://X.example", "X.example")]
)
def test_shop_domain(spark, url, domain):
    assert rows(with_traffic(views(spark, {"current_url": url}), INTERNAL), "domain") == [(domain,)]


def test_time_fields(spark):
    fields = ("sk_date", "day", "month", "year", "sk_time", "hour", "minute")
    good = with_time(views(spark, {"local_time": "2024-03-09 00:05:01"}))
    assert rows(good, *fields) == [(20240309, 9, 3, 2024, 5, 0, 5)]
    assert rows(good.selectExpr("cast(full_date as string)")) == [("2024-03-09",)]
    bad = with_time(views(spark, {"local_time": "2020-1-2 3:4:5"}))
    assert rows(bad, "timestamp_obj", "full_date", *fields) == [(None,) * 9]


def test_enriched_view_has_all_fields(spark):
    found = enrich(views(spark, {}), home(spark), INTERNAL)
    added = "os browser domain referrer_domain traffic_type country_code country_name region_name city_name"
    added += " timestamp_obj sk_date full_date day month year sk_time hour minute"
    added += " sk_product sk_store sk_device sk_location sk_traffic"
    assert set(found.columns) == {*EVENT_FIELDS[1:], "view_id", *added.split()}
    assert rows(found, "country_code", "city_name") == [("HM", "UNKNOWN")]
