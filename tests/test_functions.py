from __future__ import annotations

import hashlib
from urllib.parse import urlparse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viewmill.functions.dates import date_key, parse_local_time, sk_date_for, time_key
from viewmill.functions.device import BROWSER_RULES, OS_RULES, classify
from viewmill.functions.hashing import surrogate_key
from viewmill.functions.network import ipv4_number
from viewmill.functions.text import blank_to, contains_any, url_authority

URLS = [
    "http://u:p@h.example:8080/x",
    "HTTP://WWW.GOOGLE.COM/x",
    "no-scheme/path",
    "www.x.example/a",
    "//cdn.example/lib.js",
    "https://a.example?q=//b.example",
    "https://a.example#//b",
    "mailto:me@a.example",
    "  https://blank.example/x",
    "1http://digit.example/",
    "ht-tp+x.y://odd.example/",
    "http:///no-host",
    "http://exa\tmple.example/tab",
    "http://line\n.example/",
    "http://blog.example.org:8080/a b",
    "",
    "://x",
    "http://ünï.example/",
]


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n int, c {kind}")
    return [r.out for r in df.select("n", expression(F.col("c")).alias("out")).orderBy("n").collect()]


def test_url_authority_equals_urlparse(spark):
    assert column(spark, URLS, url_authority) == [urlparse(u).netloc for u in URLS]
    assert column(spark, [None], url_authority) == [None]


@given(st.lists(st.text(alphabet="aZ9+.-:/?#@ \t\n%_", max_size=30), min_size=30, max_size=60))
@settings(max_examples=5, deadline=None)
def test_url_authority_equals_urlparse_on_random_text(spark, urls):
    assert column(spark, urls, url_authority) == [urlparse(u).netloc for u in urls]


def test_blank_and_keywords(spark):
    assert column(spark, [None, "", " ", "x"], lambda c: blank_to(c, "U")) == ["U", "U", " ", "x"]
    assert column(spark, ["climbing", "x"], lambda c: contains_any(c, ["bing", "tok"])) == [True, False]
    assert column(spark, ["x"], lambda c: contains_any(c, [])) == [False]


def test_local_time(spark):
    good, bad = "2024-01-01 00:05:59", ["bad", "2020-1-2 3:4:5", None, "", "2024-02-30 00:00:00", good_with_zone()]
    assert column(spark, [good], lambda c: date_key(parse_local_time(c))) == [20240101]
    assert column(spark, [good], lambda c: time_key(parse_local_time(c))) == [5]
    assert column(spark, bad, parse_local_time) == [None] * len(bad)


def good_with_zone():
    return "2024-01-01 00:05:59+01:00"


def test_sk_date_for():
    assert sk_date_for("2026-01-05") == 20260105
    with pytest.raises(ValueError):
        sk_date_for("2026-02-30")


def test_surrogate_key_skips_nulls(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "b"), (None, None)], "x string, y string")
    keys = [r.k for r in df.select(surrogate_key(F.col("x"), F.col("y")).alias("k")).collect()]
    md5 = [hashlib.md5(t.encode()).hexdigest() for t in ("a", "a", "a_b", "")]
    assert keys == md5
    assert column(spark, [None, "a"], surrogate_key) == [None, md5[0]]


def test_ipv4_number(spark):
    good = {"0.0.0.0": 0, "10.1.2.3": 167838211, "255.255.255.255": 4294967295, "001.2.3.4": 16909060}
    assert column(spark, list(good), ipv4_number) == list(good.values())
    bad = ["x.y", "1.2.3", "1.2.3.999", "1.2.3.4.5", "", None, " 1.2.3.4", "1.2.3.4\n", "::1", "1..2.3", "-1.2.3.4"]
    assert column(spark, bad, ipv4_number) == [None] * len(bad)


AGENTS = {
    None: ("UNKNOWN", "UNKNOWN"),
    "": ("UNKNOWN", "UNKNOWN"),
    "curl/8.0": ("Other", "Other"),
    "Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36": ("Windows", "Chrome"),
    "Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36 Edg/120.0": ("Windows", "Edge"),
    "Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36 OPR/106.0": ("Windows", "Opera"),
    "Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko": ("Windows", "IE"),
    "Mozilla/5.0 (Windows Phone 10.0; Android 6.0.1) Chrome/52 Mobile Safari/537 Edge/15": ("Windows Phone", "Edge"),
    "Mozilla/5.0 (Linux; Android 13; SM-G991B) Chrome/112.0 Mobile Safari/537.36": ("Android", "Chrome Mobile"),
    "Mozilla/5.0 (Linux; Android 13; SM-G9; wv) Chrome/112.0 Safari/537.36": ("Android", "Chrome Mobile WebView"),
    "Mozilla/5.0 (Linux; Android 13) SamsungBrowser/20.0 Chrome/106 Safari/537": ("Android", "Samsung Internet"),
    "Mozilla/5.0 (Android 13; Mobile) Gecko/115.0 Firefox/115.0": ("Android", "Firefox Mobile"),
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) Version/16.5 Safari/604.1": ("iOS", "Mobile Safari"),
    "Mozilla/5.0 (iPad; CPU OS 16_5 like Mac OS X) CriOS/120.0 Safari/604.1": ("iOS", "Chrome Mobile iOS"),
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) FxiOS/115.0 Safari/605": ("iOS", "Firefox iOS"),
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) [FBAN/FBIOS;FBAV/400]": ("iOS", "Facebook"),
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) Version/16.1 Safari/605.1.15": ("Mac OS X", "Safari"),
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64) Gecko/20100101 Firefox/120.0": ("Ubuntu", "Firefox"),
    "Mozilla/5.0 (X11; CrOS x86_64 14541) Chrome/120.0 Safari/537.36": ("Chrome OS", "Chrome"),
    "Mozilla/5.0 (X11; Linux x86_64) Chrome/120.0 Safari/537.36": ("Linux", "Chrome"),
    "Mozilla/5.0 (compatible; Googlebot/2.1)": ("Other", "Googlebot"),
}


def test_device_families(spark):
    agents = list(AGENTS)
    assert column(spark, agents, lambda c: classify(c, OS_RULES)) == [AGENTS[a][0] for a in agents]
    assert column(spark, agents, lambda c: classify(c, BROWSER_RULES)) == [AGENTS[a][1] for a in agents]
