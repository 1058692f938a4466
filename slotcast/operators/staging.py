"""Typed logs with their calendar columns. Projections only: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slotcast.constants import MINUTES_PER_SLOT
from slotcast.functions.slots import floor_to_slot


def _at() -> Column:
    return F.col("created_at").cast("timestamp_ntz")


def stage_sales(df: DataFrame) -> DataFrame:
    at = _at()
    return df.select(
        "store_id",
        "item_id",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("price").cast("double").alias("price"),
        at.alias("created_at"),
        F.to_date(at).alias("sale_date"),
        F.hour(at).alias("sale_hour"),
        F.weekday(at).alias("day_of_week"),
        floor_to_slot(at).alias("sale_15min"),
        (F.floor(F.minute(at) / MINUTES_PER_SLOT) * MINUTES_PER_SLOT).cast("int").alias("sale_minute"),
    )


def stage_waste(df: DataFrame) -> DataFrame:
    at = _at()
    return df.select(
        "store_id",
        "item_id",
        F.col("quantity").cast("int").alias("quantity"),
        at.alias("created_at"),
        F.to_date(at).alias("waste_date"),
        F.hour(at).alias("waste_hour"),
        F.weekday(at).alias("day_of_week"),
    )


def stage_stockouts(df: DataFrame) -> DataFrame:
    at = _at()
    return df.select(
        "store_id",
        "item_id",
        F.col("quantity_requested").cast("int").alias("quantity_requested"),
        at.alias("created_at"),
        F.to_date(at).alias("stockout_date"),
        F.hour(at).alias("stockout_hour"),
        F.weekday(at).alias("day_of_week"),
    )
