from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from viewmill.operators.quality import (
    assert_fresh,
    assert_unique,
    duplicate_keys,
    freshness,
    orphans,
    overlong_values,
    split_valid,
)

LAST = datetime(2024, 1, 1, 12, 0, 0)


def test_split_valid_is_complete(spark):
    df = spark.createDataFrame([("a", "ok"), (None, "toolong"), ("b", None), ("c", "sixsix")], "k string, v string")
    valid, rejected = split_valid(df, ["k", "v"], {"v": 5})
    assert rows(valid) == [("a", "ok")]
    assert dict(rows(rejected, "v", "reason")) == {
        "toolong": "k is null; v exceeds 5",
        None: "v is null",
        "sixsix": "v exceeds 5",
    }


def test_length_counts_characters(spark):
    df = spark.createDataFrame([("ÄÖÜ",)], "v string")
    assert overlong_values(df, [], {"v": 3}).count() == 0
    assert rows(overlong_values(df, [], {"v": 2})) == [("v", 3, 2)]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "b"), (None, "b")], "k int, v string")
    assert rows(duplicate_keys(df, ["k", "v"])) == [(1, "a", 2), (None, "b", 2)]
    assert_unique(df.filter("k = 2"), ["k"], "t")
    with pytest.raises(ValueError, match="t: duplicate key"):
        assert_unique(df, ["k", "v"], "t")


def test_orphans_let_null_pass(spark):
    fact = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("x",), (None,)], "k string")
    assert rows(orphans(fact, dim, "k"), "id") == [(2,)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_freshness(spark, kind):
    df = spark.createDataFrame([("2024-01-01 12:00:00",), ("2023-12-31 00:00:00",)], "t string").select(
        F.col("t").cast(kind).alias("inserted_at")
    )
    limit = LAST + timedelta(minutes=10)
    found = freshness(df, now=limit).first()
    assert (found.total, found.lag_seconds, found.status) == (2, 600, "OK")
    aware = (limit + timedelta(microseconds=1)).replace(tzinfo=timezone.utc)
    assert freshness(df, now=aware).first().status == "STALE"
    assert freshness(df.filter("false"), now=limit).first().status == "EMPTY"
    assert assert_fresh(df, now=limit)["status"] == "OK"
    with pytest.raises(RuntimeError, match="no new rows"):
        assert_fresh(df, now=aware)
    with pytest.raises(RuntimeError, match="loaded yet"):
        assert_fresh(df.filter("false"))


def test_freshness_uses_the_current_time(spark):
    now = spark.range(1).select(F.current_timestamp().alias("inserted_at"))
    assert freshness(now).first().status == "OK"


def test_freshness_of_a_log_of_loads(spark, store):
    from tests.helpers import INTERNAL, home, views
    from viewmill.plans.star import load_star

    loads = store.table("loads")
    with pytest.raises(RuntimeError, match="loaded yet"):
        assert_fresh(loads, "last_inserted_at", count_col="facts")
    load_star(store, views(spark, {}, {"id": "v2"}), "a", home(spark), INTERNAL, inserted_at=LAST)
    load_star(store, views(spark, {}), "b", home(spark), INTERNAL)
    loads = store.table("loads")
    limit = LAST + timedelta(minutes=10)
    found = assert_fresh(loads, "last_inserted_at", limit, count_col="facts")
    assert (found["last_seen"], found["total"]) == (LAST, 2)
    with pytest.raises(RuntimeError, match="no new rows"):
        assert_fresh(loads, "last_inserted_at", limit + timedelta(seconds=1), count_col="facts")
    assert all("/loads/" in file for file in loads.inputFiles())
    assert found == assert_fresh(store.table("fact_product_views"), now=limit)
