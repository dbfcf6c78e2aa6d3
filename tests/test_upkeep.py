from __future__ import annotations

import pytest

from tests.helpers import INTERNAL, home, rows, views
from tests.test_star import content, scanned_rows
from viewmill.plans import upkeep
from viewmill.plans.checks import check_star
from viewmill.plans.marts import refresh_marts, run_daily
from viewmill.plans.star import load_star
from viewmill.plans.upkeep import clustered, merge_loads, sweep_replaced
from viewmill.schemas import MARTS

FACT = "fact_product_views"


def load(store, load_id, *changes):
    return load_star(store, views(store.spark, *changes), load_id, home(store.spark), INTERNAL)


def view(i, day=5, **more):
    return {"id": f"v{i}", "local_time": f"2024-01-0{day} 10:00:00", "product_id": f"p{i % 3}", **more}


def seen(store):
    beside = ("product_numbers", "view_ids", *MARTS)
    return content(store) | {name: rows(store.table(name)) for name in beside}


def test_merged_loads_show_the_same(store, monkeypatch):
    load(store, "a", *[view(i) for i in range(6)])
    load(store, "b=1", view(6), view(7, 6), view(0))
    assert merge_loads(store) == []
    refresh_marts(store)
    load(store, "c", view(8, 6), view(9, 7, product_id="new"))
    before, facts = seen(store), store.table(FACT)

    def broken(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(upkeep, "in_parallel", broken)
        with pytest.raises(OSError):
            merge_loads(store)
    assert seen(store) == before
    # The load that the marts do not hold yet stays by itself.
    assert merge_loads(store) == ["a", "b=1"]
    assert seen(store) == before
    assert rows(store.read(FACT).select("load_id").distinct()) == [("c",), ("merged",)]
    assert facts.count() == 10
    assert sweep_replaced(store) == ["a", "b=1"]
    assert seen(store) == before and sweep_replaced(store) == []
    assert not store.folders.matching(f"{store.path(FACT)}/*/load_id=a")
    log = rows(store.table("loads"), "load_id", "views", "facts", "days")
    assert log == [("c", 2, 2, [20240106, 20240107]), ("merged", 9, 8, [20240105, 20240106])]
    assert refresh_marts(store) == [20240106, 20240107]
    marts = {name: rows(store.table(name)) for name in MARTS}
    for day in ("2024-01-05", "2024-01-06", "2024-01-07"):
        run_daily(store, day)
    assert {name: rows(store.table(name)) for name in MARTS} == marts
    assert not any(r["violations"] for r in check_star(store).collect())

    # Loads go on, what was loaded before is known, and what was merged is merged again.
    assert load(store, "a", *[view(i) for i in range(10)], view(11))[FACT] == 1
    refresh_marts(store)
    before = seen(store)
    assert merge_loads(store) == ["a", "c", "merged"]
    assert sweep_replaced(store) == ["a", "c", "merged"]
    assert seen(store) == before
    assert rows(store.table("loads"), "load_id", "facts") == [("merged+1", 11)]


def test_one_product_of_a_day_is_found_by_statistics(spark, store):
    """What is read for one product of one day follows its rows, not those of the day."""
    schema = store.table(FACT).schema
    many = spark.range(40_000).selectExpr(
        "cast(id as string) view_id", "20240105 sk_date", "1000 sk_time", "md5(cast(id % 400 as string)) sk_product",
        "'s' sk_store", "md5(cast(id % 7 as string)) sk_location", "'d' sk_device", "'t' sk_traffic",
        "timestamp'2024-02-01' inserted_at",
    )
    pages = {"parquet.page.row.count.limit": "500", "parquet.block.size": "200000"}
    for name, table in (("plain", many), ("sorted", clustered(many.coalesce(4)))):
        load_id = store.begin_load(name)
        store.add_as_is(FACT, table.select(*schema.names), load_id, pages)
        store.commit_load(load_id)
    read = {}
    for name in ("plain", "sorted"):
        one = store.read_loads(FACT, [name]).filter("sk_date = 20240105 AND sk_product = md5('17')").select("view_id")
        read[name] = scanned_rows(one)
        assert one.count() == 100
    assert 100 <= read["sorted"] <= 2000 < 20_000 < read["plain"]
