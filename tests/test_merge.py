from __future__ import annotations

import random

from tests.helpers import rows
from viewmill.operators.merge import add_column_if_missing, distinct_per_key, first_per_key, insert_if_absent, upsert


def test_first_per_key_takes_the_smallest(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q"), ("b", 1, "p")], "k string, n int, v string"
    )
    assert rows(first_per_key(df, ["k"], ["n"])) == [("a", 1, "y"), ("b", None, "q")]
    assert rows(first_per_key(df, ["k"], ["v"])) == [("a", 2, "x"), ("b", 1, "p")]
    assert rows(first_per_key(df.select("k"), ["k"])) == [("a",), ("b",)]


def test_distinct_per_key_gives_the_same(spark):
    data = [("a", None, "x"), ("a", 1, "x"), ("a", None, "y"), ("b", 1, None), ("b", 1, None), ("b", 0, "z")]
    df = spark.createDataFrame(data * 20, "k string, n int, v string")
    assert rows(distinct_per_key(df, ["k"])) == rows(first_per_key(df, ["k"]))
    assert rows(distinct_per_key(df.select("k"), ["k"])) == [("a",), ("b",)]


def test_first_per_key_does_not_depend_on_layout(spark):
    data = [(i % 7, random.Random(i).randrange(50), i) for i in range(300)]
    expected = None
    for parts in (1, 5):
        random.Random(parts).shuffle(data)
        df = spark.createDataFrame(data, "k int, n int, v int").repartition(parts)
        found = rows(first_per_key(df, ["k"], ["n"]))
        assert expected in (None, found)
        expected = found


def test_insert_if_absent_keeps_stored_rows(spark):
    target = spark.createDataFrame([("a", "old")], "k string, v string")
    source = spark.createDataFrame([("a", "new"), ("b", "2"), ("b", "1")], "k string, v string")
    assert rows(insert_if_absent(target, source, ["k"])) == [("a", "old"), ("b", "1")]
    assert rows(insert_if_absent(target.filter("false"), source, ["k"])) == [("a", "new"), ("b", "1")]


def test_upsert_overwrites_and_adds(spark):
    schema = "d int, k string, n int, note string"
    target = spark.createDataFrame([(1, "a", 1, "x"), (1, "b", 2, "y")], schema)
    source = spark.createDataFrame([(1, "b", 20, "new"), (2, "b", 30, "new")], schema)
    assert rows(upsert(target, source, ["d", "k"])) == [(1, "a", 1, "x"), (1, "b", 20, "new"), (2, "b", 30, "new")]
    partly = upsert(target, source, ["d", "k"], ["n"])
    assert rows(partly) == [(1, "a", 1, "x"), (1, "b", 20, "y"), (2, "b", 30, "new")]


def test_upsert_keeps_a_stored_null(spark):
    target = spark.createDataFrame([("a", 1, None)], "k string, n int, note string")
    source = spark.createDataFrame([("a", 2, "new")], "k string, n int, note string")
    assert rows(upsert(target, source, ["k"], ["n"])) == [("a", 2, None)]


def test_add_column_if_missing(spark):
    df = spark.createDataFrame([("a", None), ("b", 5)], "k string, n int")
    assert rows(add_column_if_missing(df, "n", 9, "int")) == [("a", 9), ("b", 5)]
    assert rows(add_column_if_missing(df.select("k"), "n", 9, "int")) == [("a", 9), ("b", 9)]
