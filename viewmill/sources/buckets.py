"""Folders of parquet whose files are dealt by a hash of their key, so that a join on it reads them without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from viewmill.sources.commits import Folders

# Written last, beside the files: under which name the catalog knows the folder, and how many buckets it has. A session
# that finds no such table declares it anew, so nothing depends on a catalog that outlives a session.
_NOTE = "_buckets"


def _table(token: str) -> str:
    return f"spark_catalog.default.viewmill_buckets_{token}"


def write_buckets(
    folders: Folders, rows: DataFrame, folder: str, keys: Sequence[str], count: int, layout: Mapping[str, str] | None = None
) -> None:
    """Write ``rows`` to a folder that does not exist yet, as one sorted file per bucket, with writer options ``layout``."""
    token = uuid.uuid4().hex
    dealt = rows.repartition(count, *keys).write.format("parquet").options(**(layout or {}))
    dealt.bucketBy(count, *keys).sortBy(*keys).option("path", folder).saveAsTable(_table(token))
    folders.write(f"{folder}/{_NOTE}", f"{token} {count}")


def bucketed_folders(folders: Folders, pattern: str) -> list[str]:
    """Those of the matching folders that :func:`write_buckets` has finished."""
    return [note[: -len(_NOTE) - 1] for note in folders.matching(f"{pattern}/{_NOTE}")]


def read_buckets(
    spark: SparkSession, folders: Folders, folder: str, keys: Sequence[str], schema: T.StructType
) -> DataFrame:
    """The rows of a folder, which Spark knows to be dealt by ``keys``."""
    token, count = folders.text(f"{folder}/{_NOTE}").split()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_table(token)} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(count)} BUCKETS LOCATION '{place}'"
    )
    return spark.table(_table(token))


def forget_buckets(spark: SparkSession, folders: Folders, folder: str) -> None:
    """Take a folder that is about to be deleted out of the catalog."""
    if folders.exists(f"{folder}/{_NOTE}"):
        spark.sql(f"DROP TABLE IF EXISTS {_table(folders.text(f'{folder}/{_NOTE}').split()[0])}")
