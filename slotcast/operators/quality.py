"""Data tests. Each is one aggregate over the table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from slotcast.functions.slots import MICROS, ntz, to_event_time


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null count per column, in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in cols))
    rows = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in cols)
    )
    return counts.select(F.inline(rows))


def accepted_range(df: DataFrame, column: str, lo: float) -> DataFrame:
    """How many values lie below ``lo``; nulls are not counted."""
    return df.agg(F.count_if(F.col(column) < lo).alias("failures"))


def freshness(
    df: DataFrame, column: str, as_of: datetime | str | DataFrame, max_age: timedelta = timedelta(minutes=30)
) -> DataFrame:
    """The newest value, its age in seconds at ``as_of`` and whether it is stale."""
    at = as_of.scalar() if isinstance(as_of, DataFrame) else ntz(as_of)
    age = F.unix_micros(to_event_time(at)) - F.unix_micros(to_event_time("newest"))
    limit = max_age // timedelta(microseconds=1)
    return df.agg(F.max(column).alias("newest")).select(
        "newest",
        (age / MICROS).cast("bigint").alias("age_seconds"),
        F.when(age > limit, "warn").otherwise("pass").alias("status"),
    )


def row_count_invariant(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in, rows out, and whether they agree."""
    rows_out = after.agg(F.count(F.lit(1))).scalar()
    return before.agg(F.count(F.lit(1)).alias("rows_in")).select(
        "rows_in", rows_out.alias("rows_out"), (F.col("rows_in") == rows_out).alias("holds")
    )
