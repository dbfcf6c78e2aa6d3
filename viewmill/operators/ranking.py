"""Row numbers within a group, for few or for all rows of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from viewmill.session import scratch_dir


def top_n_per_group(df: DataFrame, group: str, count: str, item: str, n: int) -> DataFrame:
    """The ``n`` rows of each ``group`` with the highest ``count``, ties by ``item``, with ``rank``.

    Spark limits each task to its own best ``n`` before the shuffle, so a group arrives as ``n`` rows
    per task and never whole.
    """
    order = W.partitionBy(group).orderBy(F.desc(count), F.asc(item))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def rank_in_group(df: DataFrame, group: str, count: str, item: str) -> DataFrame:
    """Row number of every row in its ``group`` by ``count`` descending, then ``item``; NULLs as in ``row_number``.

    One window per group would sort a whole group in one task. Here rows are dealt out by ranges of (group, count,
    item) and written with the number of their range, so that a task that is repeated finds the same ranges. A row's
    number is its place within its range plus the rows of its group in earlier ranges, of which there is one count each.
    """
    order = [F.asc(group), F.desc(count), F.asc(item)]
    path = scratch_dir(df.sparkSession, "ranked")
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(path)
    earlier = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(group, "_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(F.col(group).alias("_group"), F.col("_range").alias("_of"), F.sum("_size").over(earlier).alias("_offset"))
    )
    inside = F.row_number().over(W.partitionBy(group, "_range").orderBy(*order[1:]))
    return (
        ranged.withColumn("_inside", inside)
        .join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
        .select(*df.columns, (F.coalesce("_offset", F.lit(0)) + F.col("_inside")).cast("int").alias("rank"))
    )
