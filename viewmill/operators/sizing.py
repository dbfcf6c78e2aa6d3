"""Checks that must precede a broadcast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BroadcastLimit:
    """What an executor is expected to hold in memory without trouble."""

    rows: int = 2_000_000
    bytes: int = 256 * 1024 * 1024


DEFAULT_LIMIT = BroadcastLimit()


def fits_broadcast(df: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> bool:
    """Measure ``df`` (one distributed aggregate over its columns) against ``limit``."""
    width = sum(
        (
            F.coalesce(F.octet_length(F.col(name)), F.lit(0)) + 16 if kind == "string" else F.lit(8)
            for name, kind in df.dtypes
        ),
        F.lit(0),
    )
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width.cast("bigint")).alias("bytes")).first()
    return size.rows <= limit.rows and (size.bytes or 0) <= limit.bytes


def broadcast_if_small(df: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """``df`` with a broadcast hint when its measured size allows it, else unchanged."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df
