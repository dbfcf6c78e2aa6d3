"""Insert-if-absent and upsert as joins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by all other columns.

    A minimum over a struct is combined before the shuffle, so a key with many copies crosses the
    network once per task, and the pick does not depend on row order.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *[c for c in rest if c not in order]]
    if not ranked:
        return df.distinct()
    smallest = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    return smallest.select(*[c if c in keys else F.col(f"_first.{c}") for c in df.columns])


def distinct_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The result of :func:`first_per_key` for a source with few distinct rows.

    Equal rows are folded by a hash aggregate in every task; only what is left is shuffled and
    sorted. (A minimum on top of ``distinct`` would not do: Spark then drops the ``distinct`` as
    redundant and sorts all rows.)
    """
    rest = [c for c in df.columns if c not in keys]
    order = W.partitionBy(*keys).orderBy(*(rest or keys))
    return df.distinct().withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def absent_rows(source: DataFrame, stored_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key is not stored. Keys must not be NULL (see ``split_valid``)."""
    return source.join(stored_keys.select(*keys), list(keys), "left_anti")


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """``target`` plus the first source row of each key that ``target`` lacks."""
    new = absent_rows(first_per_key(source, keys, order), target, keys)
    return target.unionByName(new)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Iterable[str] | None = None,
) -> DataFrame:
    """``target`` with the rows of ``source`` inserted, or written over ``update_cols`` on a key match.

    ``source`` must hold a key once (see ``assert_unique``). By default all other columns are
    overwritten; columns left out keep the stored value.
    """
    values = [c for c in target.columns if c not in keys]
    updated = set(values if update_cols is None else update_cols)
    kept = [c for c in values if c not in updated]
    fresh = source.select(*target.columns)
    if kept:
        old = target.select(*keys, F.struct(*kept).alias("_old"))
        fresh = fresh.join(old, list(keys), "left").select(
            *[
                F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(F.col(c)).alias(c)
                if c in kept
                else c
                for c in target.columns
            ]
        )
    return fresh.unionByName(target.join(source.select(*keys), list(keys), "left_anti"))


def add_column_if_missing(df: DataFrame, name: str, default, data_type: T.DataType | str) -> DataFrame:
    """``df`` with a required column ``name``; rows without a value get ``default``."""
    value = F.lit(default).cast(data_type)
    if name in df.columns:
        value = F.coalesce(F.col(name), value)
    return df.withColumn(name, value)
