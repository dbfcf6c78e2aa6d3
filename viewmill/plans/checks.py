"""All declared constraints of a star, checked together."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewmill.operators.quality import duplicate_keys
from viewmill.schemas import DIMENSIONS, FACT, REJECTED, TABLES
from viewmill.sources.store import StarStore


def _counted(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: how many rows of ``df`` break it, from one pass."""
    names = list(rules)
    sums = df.agg(*[F.count(F.when(rules[name], 1)).alias(f"n{i}") for i, name in enumerate(names)])
    found = [F.struct(F.lit(n).alias("rule"), F.col(f"n{i}").alias("violations")) for i, n in enumerate(names)]
    return sums.select(F.lit(table).alias("table_name"), F.explode(F.array(*found)).alias("f")).select(
        "table_name", "f.*"
    )


def _column_rules(df: DataFrame, name: str) -> DataFrame:
    table = TABLES[name]
    rules = {f"{c} is null": F.col(c).isNull() for c in table.required if c in df.columns}
    rules |= {f"{c} exceeds {n}": F.char_length(c) > n for c, n in table.max_length.items() if c in df.columns}
    return _counted(df, name, rules)


def _unique(df: DataFrame, name: str) -> DataFrame:
    return _counted(duplicate_keys(df, TABLES[name].key), name, {"key is not unique": F.lit(True)})


def _foreign_keys(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Facts that point to nothing, per key. The facts are read once and counted per key before the join, so a key
    that most facts share is a row per task there."""
    keys = {DIMENSIONS[name].key[0]: dim for name, dim in dims.items()}
    pointers = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])
    used = (
        fact.select(F.explode(pointers).alias("p"))
        .select("p.*")
        .where(F.col("value").isNotNull())
        .groupBy("key", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = reduce(
        DataFrame.unionAll,
        [d.select(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k, d in keys.items()],
    )
    lost = used.join(known, ["key", "value"], "left_anti")
    lost = lost.agg(*[F.coalesce(F.sum(F.when(F.col("key") == k, F.col("n"))), F.lit(0)).alias(k) for k in keys])
    found = [F.struct(F.lit(f"{k} points to nothing").alias("rule"), F.col(k).alias("violations")) for k in keys]
    return lost.select(F.lit(FACT.name).alias("table_name"), F.explode(F.array(*found)).alias("f")).select(
        "table_name", "f.*"
    )


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name``, ``rule``, ``violations`` for every declared constraint of the given tables, broken or not:
    NOT NULL and length of each column (rows), keys (values held more than once), foreign keys of the fact (rows)."""
    parts = [_column_rules(df, name) for name, df in tables.items()]
    parts += [_unique(df, name) for name, df in tables.items()]
    if FACT.name in tables:
        parts.append(_foreign_keys(tables[FACT.name], {n: tables[n] for n in DIMENSIONS if n in tables}))
    return reduce(DataFrame.unionByName, parts)


def check_star(store: StarStore) -> DataFrame:
    """:func:`check_tables` of a whole stored star; rejected views have no constraints."""
    return check_tables({name: store.table(name) for name in TABLES if name != REJECTED.name})
