"""The physical plans the engine counts on."""

from __future__ import annotations

import pytest

from tests.helpers import INTERNAL, home, views
from viewmill.catalog.queries import QUERIES
from viewmill.operators.enrich import enrich
from viewmill.operators.geo import geo_lookup
from viewmill.operators.merge import insert_if_absent
from viewmill.plans.star import dimension, fact_views, load_star

STREAMS = {"stream_star_load", "stream_replay", "stream_remembering"}


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_nested_loops_and_no_python_workers(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text


def test_enrichment_does_not_shuffle(spark, sf_dir):
    text = plan(QUERIES["enriched_views"](spark, sf_dir))
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text


def test_top_products_are_limited_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["daily_top_products"](spark, sf_dir))
    assert text.count("WindowGroupLimit") >= 2


def test_day_filter_prunes_folders_and_columns(spark, store):
    load_star(store, views(spark, {}, {"id": "v2", "local_time": "2024-01-06 00:00:00"}), "a", home(spark), INTERNAL)
    text = plan(store.read("fact_product_views").filter("sk_date = 20240106").select("sk_product"))
    assert "PartitionFilters: [isnotnull(sk_date" in text
    assert "ReadSchema: struct<sk_product:string>" in text
    day = store.fact_for_day(20240106)
    assert all("sk_date=20240106" in file for file in day.inputFiles())


def test_dimension_is_folded_by_hash_before_the_shuffle(spark):
    found = dimension(enrich(views(spark, {}), home(spark), INTERNAL), "dim_store")
    text = plan(found)
    assert text.count("HashAggregate") >= 2
    assert "SortAggregate" not in text
    assert "WindowGroupLimit" in text
    assert "LeftAnti" in plan(insert_if_absent(found, found, ["sk_store"]))


def test_fact_is_shuffled_once_by_view(spark):
    text = plan(fact_views(enrich(views(spark, {}), home(spark), INTERNAL)))
    assert text.count("Arguments: hashpartitioning") == 1


def test_merged_lookup_shuffles_views_once(spark):
    text = plan(geo_lookup(views(spark, {}), home(spark), broadcast=False))
    views_side = [line for line in text.splitlines() if "hashpartitioning(_range" in line and "_part" in line]
    assert len(views_side) == 1
    assert "SortMergeJoin" not in text and "Generate" in text
