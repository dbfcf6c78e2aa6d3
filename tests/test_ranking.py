from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tests.helpers import rows
from viewmill.operators.ranking import rank_in_group, top_n_per_group


@pytest.fixture(scope="module")
def counts(spark):
    rng = random.Random(7)
    letters = "abÄz€"
    items = {(rng.randrange(3), "".join(rng.choice(letters) for _ in range(rng.randint(0, 6)))) for _ in range(800)}
    data = [(d, i, rng.choice([1, 1, 1, 2, 3, 50])) for d, i in items] + [(0, None, 1), (1, None, 50)]
    return spark.createDataFrame(data, "day int, item string, n long")


def plain(counts):
    order = W.partitionBy("day").orderBy(F.desc("n"), F.asc("item"))
    return counts.withColumn("rank", F.row_number().over(order))


def test_rank_equals_row_number(counts):
    assert rows(rank_in_group(counts, "day", "n", "item")) == rows(plain(counts))


def test_rank_keeps_null_groups_and_counts(spark):
    df = spark.createDataFrame(
        [(None, "a", 2), (None, "b", 3), (1, "c", None), (1, None, None), (1, "d", 1)], "day int, item string, n long"
    )
    assert rows(rank_in_group(df, "day", "n", "item")) == rows(plain(df))


def test_rank_spreads_equal_counts(spark):
    """A long tail of items with one count and one prefix is numbered by several tasks."""
    df = spark.range(50_000).select(
        F.lit(1).alias("day"), F.format_string("SKU-%06d", "id").alias("item"), F.lit(1).cast("long").alias("n")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = rank_in_group(df.repartition(4), "day", "n", "item")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(ranked.inputFiles()) > 1
    assert ranked.where(F.col("rank") != F.substring("item", 5, 6).cast("int") + 1).isEmpty()


def test_top_n(counts):
    assert rows(top_n_per_group(counts, "day", "n", "item", 4)) == rows(plain(counts).filter("rank <= 4"))


def test_ties_go_by_item(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 3)], "day int, item string, n long")
    assert rows(top_n_per_group(df, "day", "n", "item", 2), "item", "rank") == [("a", 2), ("c", 1)]
