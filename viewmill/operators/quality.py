"""Constraints and freshness as DataFrame operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reject_reason(required: Sequence[str] = (), max_length: Mapping[str, int] | None = None) -> Column:
    """All broken rules of a row joined with ``; ``, NULL for a valid row."""
    broken = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required]
    broken += [
        F.when(F.char_length(c) > limit, F.lit(f"{c} exceeds {limit}"))
        for c, limit in (max_length or {}).items()
    ]
    return F.nullif(F.concat_ws("; ", *broken), F.lit(""))


def split_valid(
    df: DataFrame, required: Sequence[str] = (), max_length: Mapping[str, int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reason``); together they are all of ``df``."""
    judged = df.withColumn("reason", reject_reason(required, max_length))
    rejected = F.col("reason").isNotNull()
    return judged.filter(~rejected).drop("reason"), judged.filter(rejected)


def overlong_values(df: DataFrame, keys: Sequence[str], max_length: Mapping[str, int]) -> DataFrame:
    """One row per value longer than its limit: keys, ``column_name``, ``length``, ``max_length``."""
    findings = F.array(
        *[
            F.when(
                F.char_length(c) > limit,
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.char_length(c).alias("length"),
                    F.lit(limit).alias("max_length"),
                ),
            )
            for c, limit in max_length.items()
        ]
    )
    return (
        df.select(*keys, F.explode(findings).alias("_found"))
        .filter(F.col("_found").isNotNull())
        .select(*keys, "_found.*")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows as ``copies``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise ``ValueError`` naming one offending key of ``what``."""
    found = duplicate_keys(df, keys).take(1)
    if found:
        raise ValueError(f"{what}: duplicate key {found[0].asDict()}")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose ``key`` is set but missing in ``dim``; NULL references nothing and passes."""
    return fact.filter(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")


def _micros(df: DataFrame, column: str) -> Column:
    """Microseconds since the epoch; a time without zone counts as UTC."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{column}`)")
    return F.unix_micros(column)


def freshness(
    df: DataFrame,
    ts_col: str = "inserted_at",
    now: datetime | None = None,
    threshold_minutes: int = 10,
    count_col: str | None = None,
) -> DataFrame:
    """One row: ``last_seen``, ``total``, ``lag_seconds`` and ``status``.

    ``EMPTY`` without rows, ``STALE`` when the lag exceeds the threshold, else ``OK``. ``now`` defaults
    to the current time; without a zone it counts as UTC. With ``count_col`` a row of ``df`` stands for so many, as in
    a log of loads.
    """
    if now is None:
        now_micros = F.unix_micros(F.current_timestamp())
    else:
        aware = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
        since = aware - datetime(1970, 1, 1, tzinfo=timezone.utc)
        now_micros = F.lit((since.days * 86400 + since.seconds) * 1_000_000 + since.microseconds)
    total = F.count(F.lit(1)) if count_col is None else F.coalesce(F.sum(count_col), F.lit(0))
    seen = df.select(_micros(df, ts_col).alias("_micros"), *([count_col] if count_col else [])).agg(
        F.max("_micros").alias("_last"), total.alias("total")
    )
    lag = now_micros - F.col("_last")
    return seen.select(
        F.timestamp_micros("_last").alias("last_seen"),
        "total",
        F.floor(lag / 1_000_000).cast("bigint").alias("lag_seconds"),
        F.when(F.col("_last").isNull(), "EMPTY")
        .when(lag > threshold_minutes * 60_000_000, "STALE")
        .otherwise("OK")
        .alias("status"),
    )


def assert_fresh(
    df: DataFrame,
    ts_col: str = "inserted_at",
    now: datetime | None = None,
    threshold_minutes: int = 10,
    count_col: str | None = None,
) -> dict:
    """The :func:`freshness` row as a dict; ``RuntimeError`` unless its status is ``OK``."""
    found = freshness(df, ts_col, now, threshold_minutes, count_col).first().asDict()
    if found["status"] == "EMPTY":
        raise RuntimeError("no rows have been loaded yet")
    if found["status"] == "STALE":
        raise RuntimeError(
            f"no new rows for {found['lag_seconds'] / 60:.1f} minutes (limit {threshold_minutes})"
        )
    return found
