from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import INTERNAL, home, ranges, rows, views
from viewmill.operators.enrich import enrich
from viewmill.operators.quality import orphans
from viewmill.operators.stored_ids import ID_LAYOUT, id_span, in_order
from viewmill.plans import star
from viewmill.plans.star import LoadOptions, compact_into, dimension, fact_views, load_star
from viewmill.plans.checks import check_star
from viewmill.plans.marts import run_daily
from viewmill.schemas import DIMENSIONS, FACT_KEYS
from viewmill.sources.store import StarStore

FACT = "fact_product_views"


def load(store, load_id, *changes, **options):
    spark = store.spark
    return load_star(store, views(spark, *changes), load_id, home(spark), INTERNAL, LoadOptions(**options))


def content(store):
    found = {name: rows(store.table(name)) for name in DIMENSIONS}
    return found | {FACT: rows(store.table(FACT), *FACT_KEYS)}


@pytest.mark.parametrize("staged", [False, True])
def test_load_fills_all_tables(store, staged):
    done = load(store, "a", {}, {"id": "v2", "product_id": "p2"}, {"id": "v3", "ip": "9.9.9.9"}, staged=staged)
    assert done == {
        "views": 3,
        "rejected_views": 0,
        "dim_product": 2,
        "dim_store": 1,
        "dim_location": 2,
        "dim_device": 1,
        "dim_traffic_source": 1,
        "dim_date": 1,
        "dim_time": 1,
        FACT: 3,
    }
    for name, table in DIMENSIONS.items():
        assert orphans(store.table(FACT), store.table(name), table.key[0]).count() == 0
    assert store.table(FACT).filter("inserted_at is null").count() == 0


def test_repeated_load_changes_nothing(store):
    changes = [{}, {"id": "v2", "local_time": "2024-01-06 00:00:00"}]
    load(store, "a", *changes)
    before = content(store)
    load(store, "a", *changes)
    assert content(store) == before
    done = load(store, "b", *changes)
    assert sum(v for k, v in done.items() if k != "views") == 0
    assert content(store) == before


def test_same_view_twice(store):
    """Within a load the earliest wins, between loads the stored one."""
    load(store, "a", {"product_id": "late", "local_time": "2024-01-05 11:00:00"}, {"product_id": "early"})
    joined = store.table(FACT).join(store.table("dim_product"), "sk_product")
    assert rows(joined, "view_id", "product_id") == [("v1", "early")]
    load(store, "b", {"product_id": "other", "local_time": "2024-01-05 01:00:00"}, {"id": "v2"})
    joined = store.table(FACT).join(store.table("dim_product"), "sk_product")
    assert rows(joined, "view_id", "product_id") == [("v1", "early"), ("v2", "p1")]


@pytest.mark.parametrize("most", [0, 500_000])
def test_both_ways_to_find_stored_ids(store, monkeypatch, most):
    monkeypatch.setattr(star, "BROADCAST_VIEW_IDS", most)
    load(store, "a", {}, {"id": "v2"})
    assert load(store, "b", {}, {"id": "v3"})[FACT] == 1
    assert rows(store.table(FACT), "view_id") == [("v1",), ("v2",), ("v3",)]


def test_stored_ids_are_not_broadcast_for_many_views(store, monkeypatch):
    """How small the files of ids are says little of their number."""
    monkeypatch.setattr(star, "BROADCAST_VIEW_IDS", 0)
    plans, add = [], StarStore.add_rows

    def noted(self, name, rows, load_id):
        if name == FACT:
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
        add(self, name, rows, load_id)

    monkeypatch.setattr(StarStore, "add_rows", noted)
    load(store, "a", {}, {"id": "v2"})
    assert load(store, "b", {}, {"id": "v3"})[FACT] == 1
    joins = [line for line in plans[1].splitlines() if "LeftAnti" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_views_of_one_partition_are_dealt_out(store, spark, monkeypatch):
    """A load runs on all cores whatever partitions its views come in; few views stay together."""
    parts, stage = [], star._stage

    def counted(*args):
        kept, release = stage(*args)
        kept.count()
        parts.append(kept.rdd.getNumPartitions())
        return kept, release

    monkeypatch.setattr(star, "_stage", counted)
    ids = spark.range(0, 60_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("view_id"))
    many = views(spark, {}).drop("view_id").crossJoin(ids).coalesce(1)
    assert load_star(store, many, "a", home(spark), INTERNAL)[FACT] == 60_000
    load(store, "b", {})
    assert parts[0] > 1 and parts[1] == 1


def test_compaction(store, spark, tmp_path):
    load(store, "a", {})
    assert load(store, "b", {}, {"id": "v2", "local_time": "2024-01-06 10:00:00"})[FACT] == 1
    assert load(store, "c", {"local_time": "2024-01-07 10:00:00"})[FACT] == 0
    target = StarStore(spark, str(tmp_path / "compact"))
    done = compact_into(store, target)
    assert (done[FACT], done["dim_date"]) == (2, 3)
    assert rows(target.table(FACT), "view_id", "sk_date") == [("v1", 20240105), ("v2", 20240106)]
    assert rows(target.read(FACT).select("load_id").distinct()) == [("compacted",)]


@pytest.mark.parametrize(
    "again",
    [
        [{}],
        [{}, {"id": "v2", "local_time": "2024-01-06 00:00:00", "product_id": "p2"}, {"id": "v3", "product_id": "p3"}],
        [{"id": "v4", "product_id": "p4", "ip": "9.9.9.9"}],
        [],
    ],
)
def test_repeated_load_only_adds(store, spark, again):
    """Delivered again with fewer, more, other or no views: nothing stored goes, and no fact points to nothing."""
    load(store, "a", {}, {"id": "v2", "local_time": "2024-01-06 00:00:00", "product_id": "p2"}, {"id": None})
    before = content(store)
    if again:
        load(store, "a", *again)
    else:
        load_star(store, views(spark, {}).filter("false"), "a", home(spark), INTERNAL)
    after = content(store)
    assert all(set(before[name]) <= set(after[name]) for name in before)
    assert store.table("rejected_views").count() == 0
    assert not any(r["violations"] for r in check_star(store).collect())


INVALID = [
    ({"id": None}, "view_id is null"),
    ({"product_id": None}, "product_id is null"),
    ({"store_id": None}, "store_id is null"),
    ({"local_time": "bad"}, "sk_date is null"),
    ({"resolution": "x" * 51}, "resolution exceeds 50"),
    ({"referrer_url": "http://" + "r" * 501}, "referrer_domain exceeds 500"),
]


def test_invalid_views_are_kept_aside(store):
    done = load(store, "a", {}, *[change for change, _ in INVALID])
    assert (done["views"], done["rejected_views"], done[FACT]) == (7, 6, 1)
    assert sorted(r for (r,) in rows(store.table("rejected_views"), "reason")) == sorted(r for _, r in INVALID)
    load(store, "a", {}, *[change for change, _ in INVALID])
    assert store.table("rejected_views").count() == 6
    assert rows(store.table("rejected_views"), "ip", "collection") == [("10.0.0.1", "view_product_detail")] * 6


def test_too_long_country_code(store, spark):
    long = ranges(spark, ("10.0.0.0", "10.0.255.255", "ELEVENCHARS"))
    load_star(store, views(spark, {}), "a", long, INTERNAL)
    assert rows(store.table("rejected_views"), "reason") == [("country_code exceeds 10",)]


def test_strict_load_stores_nothing(store):
    with pytest.raises(ValueError, match="1 of 2 views are invalid"):
        load(store, "a", {}, {"id": None}, strict=True)
    assert all(not found for found in content(store).values())


def test_empty_load(store, spark):
    done = load_star(store, views(spark, {}).filter("false"), "a", home(spark), INTERNAL)
    assert done == {"views": 0, "rejected_views": 0}


def test_failure_between_dimensions_and_facts(store, monkeypatch):
    def broken(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(star, "_load_fact", broken)
        with pytest.raises(OSError):
            load(store, "a", {}, {"id": "v2"})
    assert all(not found for found in content(store).values())
    load(store, "a", {}, {"id": "v2"})
    assert (store.table(FACT).count(), store.table("dim_product").count()) == (2, 1)


def test_given_insertion_time(store, spark):
    load_star(store, views(spark, {}), "a", home(spark), INTERNAL, inserted_at=datetime(2024, 2, 1))
    assert rows(store.table(FACT).selectExpr("cast(inserted_at as string)")) == [("2024-02-01 00:00:00",)]


def test_one_location_key_with_two_country_names(spark):
    """The key does not cover the country name; the smaller one is picked whatever the order."""
    table = ranges(
        spark, (1, 1, "CC", "Zeta", "r", "c"), (2, 2, "CC", "Alpha", "r", "c")
    )
    for ips in (("0.0.0.1", "0.0.0.2"), ("0.0.0.2", "0.0.0.1")):
        found = enrich(views(spark, *[{"ip": ip} for ip in ips]), table, INTERNAL)
        assert rows(dimension(found, "dim_location"), "country_name") == [("Alpha",)]


def test_hot_view_is_one_fact(spark):
    many = views(spark, {}).crossJoin(spark.range(5000)).drop("id")
    found = fact_views(enrich(many, home(spark), INTERNAL))
    assert found.count() == 1
    assert found.filter(F.col("view_id") == "v1").count() == 1


# --- commits ----------------------------------------------------------------------------------


@pytest.mark.parametrize("step", ["_load_fact", "_describe_load", "_number_products"])
def test_readers_see_nothing_of_a_load_that_failed(store, spark, monkeypatch, step):
    def broken(*_):
        raise OSError("disk full")

    load(store, "a", {})
    before, marts = content(store), run_daily(store, "2024-01-05")
    changes = [{}, {"id": "v2", "product_id": "p2"}, {"id": "v3", "local_time": "2024-01-06 00:00:00"}]
    with monkeypatch.context() as patch:
        patch.setattr(star, step, broken)
        with pytest.raises(OSError):
            load(store, "b", *changes)
        assert content(store) == before
        assert run_daily(store, "2024-01-05") == marts
        assert store.fact_for_day(20240106).count() == 0
        # A load that does not know of the one that failed stores the same dimension rows itself.
        with pytest.raises(OSError):
            load(store, "c", *changes[1:])
    assert load(store, "d", *changes[1:2])["dim_product"] == 1
    done = load(store, "b", *changes)
    assert (done[FACT], done["dim_product"], done["dim_date"]) == (1, 0, 1)
    assert rows(store.table(FACT), "view_id") == [("v1",), ("v2",), ("v3",)]
    assert not any(r["violations"] for r in check_star(store).collect())
    assert store.loads.open_in(store.loads.state()) == ["c"]


def test_a_table_read_before_a_load_stays_as_it_was(store):
    load(store, "a", {})
    facts = store.table(FACT)
    name = store.begin_load("b")
    store.add_rows(FACT, store.table(FACT).withColumn("view_id", F.lit("hidden")), name)
    assert rows(facts, "view_id") == rows(store.table(FACT), "view_id") == [("v1",)]
    store.commit_load(name)
    assert rows(store.table(FACT), "view_id") == [("hidden",), ("v1",)]


def test_load_that_ends_while_files_are_listed(store):
    """What a reader listed before the load's last file does not count."""
    load(store, "a", {})
    begun = []

    class Late:
        """The markers as a reader sees them: a whole load begins and ends after its first look."""

        def __getattr__(self, name):
            return getattr(loads, name)

        def state(self):
            found = loads.state()
            if not begun:
                begun.append("b=1")
                other = StarStore(store.spark, store.root)
                name = other.begin_load("b=1")
                other.add_rows(FACT, other.read_loads(FACT, ["a"]).withColumn("view_id", F.lit("late")), name)
                other.commit_load(name)
                begun.append(name)
            return found

    loads, store.loads = store.loads, Late()
    assert rows(store.table(FACT), "view_id") == [("late",), ("v1",)]
    assert begun == ["b=1", "b=1"]


def test_what_a_load_leaves_behind(store, spark):
    at = datetime(2024, 2, 1)
    changes = [{"id": f"v{i}", "product_id": f"p{i % 3}", "local_time": f"2024-01-0{5 + i % 2} 10:00:00"} for i in range(10)]
    load_star(store, views(spark, *changes, {"id": None}), "a", home(spark), INTERNAL, inserted_at=at)
    load_star(store, views(spark, *changes, {"id": "w", "product_id": "p9"}), "b", home(spark), INTERNAL, inserted_at=at)
    found = rows(store.table("loads").drop("last_inserted_at"))
    assert found == [("a", 11, 10, [20240105, 20240106], "v0", "v9"), ("b", 11, 1, [20240105], "w", "w")]
    assert rows(store.table("view_ids")) == [(f"v{i}",) for i in range(10)] + [("w",)]
    numbers = rows(store.table("product_numbers"))
    assert len(numbers) == 4 and len({n for _, n in numbers}) == 4


def test_loads_that_are_delivered_again_have_names_of_their_own(store):
    load(store, "a", {})
    load(store, "a", {"id": "v2"})
    load(store, "a", {"id": "v3"})
    assert sorted(r[0] for r in rows(store.table("loads"), "load_id")) == ["a", "a+1", "a+2"]
    assert store.table(FACT).count() == 3


# --- stored ids -------------------------------------------------------------------------------


def scanned_rows(df) -> int:
    """Rows that scans of files had to give out to compute ``df``."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(
        leaves.apply(i).metrics().apply("numOutputRows").value()
        for i in range(leaves.size())
        if leaves.apply(i).getClass().getSimpleName() == "FileSourceScanExec"
    )


def ids_of(store, spark, ids, load_id):
    """Store ids as a load of that name does."""
    name = store.begin_load(load_id)
    table = spark.createDataFrame([(i,) for i in ids], "view_id string")
    store.add_as_is("view_ids", in_order(table, "view_id"), name, ID_LAYOUT)
    described = [(name, len(ids), len(ids), datetime(2024, 1, 1), [], min(ids), max(ids))]
    store.add_as_is("loads", spark.createDataFrame(described, star.LOADS.schema), name)
    store.commit_load(name)


def looked_up(store, spark, ids):
    table = spark.createDataFrame([(i,) for i in ids], "view_id string")
    span = id_span(table, "view_id", len(ids), min(ids), max(ids))
    found = star.stored_matches(store, span)
    return found.join(table, "view_id", "left_semi"), found


def test_a_batch_reads_the_same_from_few_and_from_many_loads(store, spark):
    """Ids that grow: what is read does not grow with history, and late ids cost their own load only."""
    size, read = 300, {}
    for n in range(40):
        ids_of(store, spark, [f"{n * size + i:012d}" for i in range(size)], f"l{n:03d}")
        if n in (9, 39):
            fresh = [f"{(n + 1) * size + i:012d}" for i in range(size)]
            again, found = looked_up(store, spark, [*fresh, f"{(n - 1) * size + 7:012d}", f"{3:012d}"])
            assert rows(again) == [(f"{3:012d}",), (f"{(n - 1) * size + 7:012d}",)]
            read[n] = scanned_rows(found)
    assert 0 < read[9] == read[39] <= 2 * size


def test_few_ids_without_order_are_met_by_bloom_filters(store, spark):
    import hashlib

    def scattered(n):
        return [hashlib.md5(f"{n}-{i}".encode()).hexdigest() for i in range(1000)]

    read = {}
    for n in range(12):
        ids_of(store, spark, scattered(n), f"l{n:03d}")
        if n in (3, 11):
            again, found = looked_up(store, spark, scattered(99)[:100])
            assert rows(again) == []
            read[n] = scanned_rows(found)
            again, _ = looked_up(store, spark, [*scattered(99)[:100], scattered(2)[500]])
            assert rows(again) == [(scattered(2)[500],)]
    assert read[11] <= 1000


def test_spans_hold_every_id_of_their_batch(spark):
    import random

    rng = random.Random(4)
    for _ in range(12):
        pool = rng.choice([["a", "aé", "b", "𝄞", ""], ["id-1", "id-11", "id-2", "id-", "x"], ["7"]])
        ids = sorted({rng.choice(pool) + str(rng.randrange(10 ** rng.randint(1, 12))) for _ in range(400)})
        table = spark.createDataFrame([(i,) for i in ids], "view_id string")
        low, high = table.agg(F.min("view_id"), F.max("view_id")).first()
        span = id_span(table, "view_id", len(ids) + 1000, low, high)
        assert table.filter(span.may_hold("view_id")).count() == len(ids)
        middle = spark.createDataFrame([(a, b) for a, b in span.gaps], "a string, b string")
        assert middle.withColumn("x", F.concat("a", F.lit("\x01"))).filter("x < b").filter(span.may_hold("x")).count() == 0


def test_large_batch_of_long_ids_is_not_broadcast(store, monkeypatch):
    monkeypatch.setattr(star, "BROADCAST_ID_BYTES", 5)
    load(store, "a", {}, {"id": "v2"})
    assert load(store, "b", {}, {"id": "v3"})[FACT] == 1
