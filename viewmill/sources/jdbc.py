"""Star tables and marts in a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of the JDBC connector; ``extra`` takes ``user``, ``password``, ``driver`` and the like."""
    return {"url": url, "dbtable": table, **(extra or {})}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    extra: Mapping[str, str] | None = None,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """A database table. With ``split_column`` (such as ``sk_date``) it is read by ``parts`` tasks."""
    options = jdbc_options(url, table, extra)
    if split_column and bounds and parts:
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(parts),
        }
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    extra: Mapping[str, str] | None = None,
    mode: str = "append",
    connections: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Write ``df`` in batches over at most ``connections`` database connections.

    Databases offer no insert-if-absent through JDBC: write what ``insert_if_absent`` or ``upsert``
    left over, or write a staging table and merge it there.
    """
    options = jdbc_options(url, table, extra) | {
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
    }
    df.write.format("jdbc").options(**options).mode(mode).save()
