from __future__ import annotations

import pytest

from tests.helpers import INTERNAL, home, rows, views
from viewmill.operators.sizing import BroadcastLimit
from viewmill.plans import marts
from viewmill.plans.increments import country_increments, merged_products
from viewmill.plans.marts import refresh_marts, run_daily, run_sql, top_products, traffic_breakdown, views_by_country
from viewmill.plans.star import load_star
from viewmill.schemas import MARTS

LIMITS = [BroadcastLimit(), BroadcastLimit(rows=-1)]
FACT = "sk_date int, sk_location string, sk_product string, sk_traffic string"


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame(
        [
            (1, "l1", "p1", "t1"),
            (1, "l1", "p1", "t1"),
            (1, "l2", "p2", "t2"),
            (1, "l3", "p2", "t9"),
            (1, "gone", "gone", "t1"),
            (1, None, "p3", None),
            (2, "l1", "p1", "t1"),
        ],
        FACT,
    )


@pytest.mark.parametrize("limit", LIMITS)
def test_views_by_country(spark, fact, limit):
    dim = spark.createDataFrame(
        [("l1", "A", "Aa"), ("l2", "A", "Aa"), ("l3", "UNKNOWN", "UNKNOWN")],
        "sk_location string, country_code string, country_name string",
    )
    assert rows(views_by_country(fact, dim, limit)) == [
        (1, "A", "Aa", 3, 2),
        (1, "UNKNOWN", "UNKNOWN", 3, 3),
        (2, "A", "Aa", 1, 1),
    ]


@pytest.mark.parametrize("limit", LIMITS)
def test_top_products(spark, fact, limit):
    dim = spark.createDataFrame([("p1", "z"), ("p2", "a"), ("p3", "m")], "sk_product string, product_id string")
    found = top_products(fact, dim, 2, limit)
    assert rows(found) == [(1, "a", 2, 1), (1, "z", 2, 2), (2, "z", 1, 1)]


@pytest.mark.parametrize("limit", LIMITS)
def test_traffic_breakdown(spark, fact, limit):
    dim = spark.createDataFrame([("t1", "Direct"), ("t2", "Direct")], "sk_traffic string, traffic_type string")
    assert rows(traffic_breakdown(fact, dim, limit)) == [(1, "Direct", 4), (1, "UNKNOWN", 2), (2, "Direct", 1)]


def mart(store, name):
    return rows(store.table(name))


def test_daily_run(store, spark):
    day = {"local_time": "2024-01-05 08:00:00"}
    changes = [{**day, "id": f"v{i}", "product_id": f"p{i % 3}"} for i in range(7)]
    other = {"id": "x", "local_time": "2024-01-06 08:00:00"}
    load_star(store, views(spark, *changes, other), "a", home(spark), INTERNAL)
    sizes = {
        "agg_daily_views_by_country": 1,
        "agg_daily_top_products": 2,
        "agg_daily_traffic_breakdown": 1,
    }
    assert run_daily(store, "2024-01-05", top_n=2) == sizes
    assert mart(store, "agg_daily_top_products") == [(20240105, "p0", 3, 1), (20240105, "p1", 2, 2)]
    assert mart(store, "agg_daily_views_by_country") == [(20240105, "HM", "HM name", 7, 3)]
    assert mart(store, "agg_daily_traffic_breakdown") == [(20240105, "Direct", 7)]
    run_daily(store, "2024-01-06")
    assert store.table("agg_daily_traffic_breakdown").count() == 2

    # p2 overtakes p1: an upsert keeps the product that fell out, a replacement drops it.
    load_star(store, views(spark, *[{**day, "id": f"n{i}", "product_id": "p2"} for i in range(9)]), "b", home(spark), INTERNAL)
    run_daily(store, "2024-01-05", top_n=2, mode="upsert")
    first_day = [r for r in mart(store, "agg_daily_top_products") if r[0] == 20240105]
    assert first_day == [(20240105, "p0", 3, 2), (20240105, "p1", 2, 2), (20240105, "p2", 11, 1)]
    run_daily(store, "2024-01-05", top_n=2)
    first_day = [r for r in mart(store, "agg_daily_top_products") if r[0] == 20240105]
    assert first_day == [(20240105, "p0", 3, 2), (20240105, "p2", 11, 1)]

    for table in MARTS.values():
        kept = [c for c in table.columns if c != "sk_date"]
        store.write_days(table.name, store.table(table.name).selectExpr("20240107 AS sk_date", *kept).limit(1))
    assert set(run_daily(store, "2024-01-07").values()) == {0}
    assert store.table("agg_daily_traffic_breakdown").filter("sk_date = 20240107").count() == 0
    assert store.table("agg_daily_traffic_breakdown").count() == 2


def test_one_code_with_two_names_fails_clearly(store, spark):
    from tests.helpers import ranges

    table = ranges(spark, (1, 1, "CC", "Zeta", "r", "c"), (2, 2, "CC", "Alpha", "q", "c"))
    load_star(store, views(spark, {"ip": "0.0.0.1"}, {"id": "w", "ip": "0.0.0.2"}), "a", table, INTERNAL)
    with pytest.raises(ValueError, match="agg_daily_views_by_country: duplicate key"):
        run_daily(store, "2024-01-05")


def test_wrong_arguments(store):
    with pytest.raises(ValueError):
        run_daily(store, "2024-13-05")
    with pytest.raises(ValueError, match="mode"):
        run_daily(store, "2024-01-05", mode="merge")


def test_run_sql(store, spark):
    load_star(store, views(spark, {}, {"id": "v2"}), "a", home(spark), INTERNAL)
    sql = "SELECT count(*) AS n, :wanted AS w FROM fact_product_views WHERE sk_date = :sk_date"
    assert rows(run_sql(store, sql, "2024-01-05", {"wanted": "x"})) == [(2, "x")]
    assert rows(run_sql(store, sql, "2024-01-06", {"wanted": "x"})) == [(0, "x")]


# --- marts of touched days --------------------------------------------------------------------


def day_files(store, day):
    found = [store.folders.matching(f"{store.path(name)}/sk_date={day}/*.parquet") for name in MARTS]
    return {file for files in found for file in files}


def recomputed(store, *days):
    """What computing days from all of their facts gives, left in the marts."""
    for day in days:
        run_daily(store, day)
    return {name: mart(store, name) for name in MARTS}


def test_a_late_view_brings_up_its_own_day(store, spark):
    def load(load_id, *changes):
        load_star(store, views(spark, *changes), load_id, home(spark), INTERNAL)

    def view(i, day, **more):
        return {"id": f"v{i}", "local_time": f"2024-01-0{day} 10:00:00", "product_id": f"p{i % 4}", **more}

    assert refresh_marts(store) == []
    load("a", *[view(i, 5 + i % 2) for i in range(12)], view(50, 5, ip="9.9.9.9"))
    assert refresh_marts(store) == [20240105, 20240106]
    assert refresh_marts(store) == []
    untouched, touched = day_files(store, 20240106), day_files(store, 20240105)
    # Products that the day has already and one that it has not, in two loads.
    load("b", view(20, 5), view(21, 5, product_id="new"), view(0, 5))
    load("c", view(22, 5, product_id="new"), view(23, 7), view(24, 5, ip="9.9.9.9"))
    assert refresh_marts(store) == [20240105, 20240107]
    assert day_files(store, 20240106) == untouched and day_files(store, 20240105) != touched
    # Nothing new: the load is held, no day is touched.
    load("d", view(0, 5))
    assert refresh_marts(store) == []
    assert store.table("mart_loads").count() == 4
    assert {name: mart(store, name) for name in MARTS} == recomputed(store, "2024-01-05", "2024-01-06", "2024-01-07")


def test_refresh_that_fails_is_done_again(store, spark, monkeypatch):
    load_star(store, views(spark, {}, {"id": "v2", "product_id": "p2"}), "a", home(spark), INTERNAL)

    def broken(*_):
        raise OSError("disk full")

    real = marts._replace_days
    with monkeypatch.context() as patch:
        patch.setattr(marts, "_replace_days", lambda s, name, m: broken() if "top" in name else real(s, name, m))
        with pytest.raises(OSError):
            refresh_marts(store)
    assert refresh_marts(store) == [20240105]
    assert {name: mart(store, name) for name in MARTS} == recomputed(store, "2024-01-05")


def test_no_old_fact_is_read_for_views_by_country(store, spark):
    load_star(store, views(spark, {}), "a", home(spark), INTERNAL)
    increments = store.read_days("country_increments", [20240105])
    merged = merged_products(increments, "sk_date", "country_code", "country_name")
    assert rows(merged) == [(20240105, "HM", "HM name", 1, 1)]
    assert not any("fact_product_views" in file for file in merged.inputFiles())


def test_merged_distinct_counts_of_many_loads(spark):
    """Numbers that lie far apart, products in several loads and places, facts without a place or product."""
    import random

    rng = random.Random(2)
    products = [f"p{i}" for i in range(60)]
    numbers = spark.createDataFrame(
        [(p, 1 + i * 9000 + (i % 3 << 33)) for i, p in enumerate(products)], "sk_product string, number long"
    )
    dim = spark.createDataFrame(
        [("l1", "A", "Aa"), ("l2", "A", "Aa"), ("l3", "B", None)],
        "sk_location string, country_code string, country_name string",
    )
    facts = [
        (rng.randint(1, 2), rng.choice(["l1", "l2", "l3", "l4", None]), rng.choice([*products, None]), "t")
        for _ in range(400)
    ]
    loads = [spark.createDataFrame(facts[i::4], FACT) for i in range(4)]
    for limit in LIMITS:
        union = None
        for load in loads:
            part = country_increments(load, dim, numbers, limit)
            union = part if union is None else union.unionByName(part)
        merged = merged_products(union, "sk_date", "country_code", "country_name")
        whole = views_by_country(spark.createDataFrame(facts, FACT), dim)
        columns = ("sk_date", "country_code", "country_name", "view_count", "unique_products")
        assert rows(merged, *columns) == rows(whole, *columns)
