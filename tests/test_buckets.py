from __future__ import annotations

import pytest

from tests.helpers import rows
from tests.test_upkeep import FACT, load, seen, view
from viewmill.operators.merge import absent_rows
from viewmill.plans import star
from viewmill.plans.marts import refresh_marts
from viewmill.plans.upkeep import bucket_count, merge_loads, sweep_replaced, without_order
from viewmill.schemas import DIMENSIONS
from viewmill.sources.buckets import bucketed_folders
from viewmill.sources.store import StarStore


@pytest.fixture
def joins_shuffle(spark):
    """No table is small enough to be broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def cut(store, load_id="merged"):
    """The tables of which a load lies in buckets."""
    return {n for n in (*DIMENSIONS, "view_ids") if bucketed_folders(store.folders, f"{store.path(n)}/load_id={load_id}")}


@pytest.fixture
def merged(store):
    """A star whose two loads were merged, with everything in buckets, and what it holds."""
    load(store, "a", *[view(i, product_id=f"p{i}") for i in range(0, 60, 2)])
    load(store, "b", *[view(i, 6, product_id=f"p{i}") for i in range(1, 60, 2)])
    refresh_marts(store)
    before = seen(store)
    assert merge_loads(store, bucket_rows=20) == ["a", "b"]
    assert seen(store) == before
    return store


def test_stored_side_is_not_shuffled(spark, merged, joins_shuffle):
    assert {"dim_product", "view_ids"} <= cut(merged)
    for name in cut(merged):
        key = DIMENSIONS[name].key if name in DIMENSIONS else ("view_id",)
        dealt, rest = merged.read_parts(name)
        source = merged.spark.createDataFrame(dealt.limit(1).collect(), dealt.schema)
        assert exchanges(absent_rows(source, dealt, key)) == 1
        assert exchanges(absent_rows(source, merged.table(name), key)) == 2
        # What is written after the merge is shuffled, and what is new is not shuffled once more for it.
        assert exchanges(absent_rows(absent_rows(source, dealt, key), rest, key)) == 2
        assert absent_rows(source, dealt, key).isEmpty()
        assert dealt.count() + rest.count() == merged.table(name).count()


@pytest.mark.parametrize("most", [0, 500_000])
def test_loads_go_on_upon_buckets(spark, merged, joins_shuffle, monkeypatch, most):
    monkeypatch.setattr(star, "BROADCAST_VIEW_IDS", most)
    again = [view(i, product_id=f"p{i}") for i in range(62)]
    done = load(merged, "c", *again)
    assert (done[FACT], done["dim_product"]) == (2, 2)
    done = load(merged, "d", *again)
    assert (done[FACT], done["dim_product"]) == (0, 0)
    assert rows(merged.table("dim_product"), "product_id") == sorted((f"p{i}",) for i in range(62))
    # Merged once more: the old buckets go, and a session that has never seen the new ones reads them.
    refresh_marts(merged)
    before = seen(merged)
    assert merge_loads(merged, bucket_rows=20) == ["c", "d", "merged"]
    assert sweep_replaced(merged) == ["a", "b", "c", "d", "merged"]
    assert seen(merged) == before and not cut(merged) and "dim_product" in cut(merged, "merged+1")
    other = StarStore(spark.newSession(), merged.root)
    for table in spark.catalog.listTables():
        if table.name.startswith("viewmill_buckets_"):
            spark.sql(f"DROP TABLE {table.name}")
    assert sum(part.count() for part in other.read_parts("dim_product")) == 62
    assert load(merged, "e", *again, view(99))[FACT] == 1


def test_open_and_unfinished_loads_are_no_part(spark, merged):
    products = merged.table("dim_product")
    name = merged.begin_load("half")
    merged.add_buckets("dim_product", products.limit(0), name, 4)
    assert len(merged.read_parts("dim_product")) == 2
    assert merged.begin_load("half") == name and "dim_product" not in cut(merged, "half")


def test_how_many_buckets_and_which_ids():
    assert [bucket_count(n, 10) for n in (0, 1, 10, 11, 20, 21, 40, 41, 100)] == [1, 1, 1, 2, 2, 4, 4, 8, 16]
    assert not without_order([("a1", "a9"), ("c1", "c9"), ("b1", "b9")])
    assert not without_order([("a1", "a9"), ("a9", "b9"), ("b95", "c9"), ("c91", "d")])
    assert without_order([("a", "y"), ("b", "z"), ("a1", "x")]) and not without_order([])
