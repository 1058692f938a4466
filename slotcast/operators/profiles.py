"""Slot-grain demand and the historical profiles built on it.

The sales log is read once: it is summed to (store, item, date, slot) with map-side combine, and
all profiles work on that grain. A store-item has at most 96 such rows a day however many events
it had, so a hot item is only hot before the first partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotcast.constants import SLOTS_PER_DAY, SLOTS_PER_HOUR
from slotcast.functions.slots import (
    date_of_running_slot,
    day_of_slot,
    has_all,
    hour_of_slot,
    ring_slot_of_running,
    running_slot,
)

ITEM = ["store_id", "item_id"]


def _slot_of_staged() -> Column:
    return (
        F.col("day_of_week") * SLOTS_PER_DAY
        + F.col("sale_hour") * SLOTS_PER_HOUR
        + F.floor(F.col("sale_minute") / 15)
    ).cast("int")


def slot_sales(sales: DataFrame) -> DataFrame:
    """Units per store, item, date and slot, from staged sales."""
    # Hour and weekday follow from the slot, so they need not be grouping keys.
    return (
        sales.groupBy(*ITEM, "sale_date", _slot_of_staged().alias("slot_index"))
        .agg(F.sum("quantity").alias("slot_quantity"))
        .select(
            *ITEM,
            "sale_date",
            hour_of_slot("slot_index").alias("sale_hour"),
            "slot_index",
            day_of_slot("slot_index").alias("day_of_week"),
            "slot_quantity",
        )
    )


def shared_slot_sales(sales: DataFrame) -> DataFrame:
    """:func:`slot_sales` for plans that use it several times, without rows that fail the log's
    not-null tests.

    Stating the test here gives all consumers the same filters and columns up to the shuffle:
    none prunes the sum, and no join adds a filter of its own. Spark then scans the log once and
    reuses that shuffle.
    """
    return slot_sales(sales).filter(
        has_all(*ITEM, "sale_date", "slot_index", "day_of_week", "sale_hour", "slot_quantity")
    )


def store_dow_dates(sales: DataFrame) -> DataFrame:
    """How many dates each store traded, per weekday. Takes staged sales or slot sales."""
    return sales.groupBy("store_id", "day_of_week").agg(
        F.count_distinct("sale_date").alias("total_dates")
    )


def item_days_observed(sales: DataFrame) -> DataFrame:
    """How many dates each store sold each item. Takes staged sales or slot sales."""
    return sales.groupBy(*ITEM).agg(F.count_distinct("sale_date").alias("days_observed"))


def profile_of_slots(slots: DataFrame) -> DataFrame:
    """Mean units per weekly slot, over all dates on which the store traded that weekday."""
    totals = slots.groupBy(*ITEM, "slot_index").agg(
        F.sum("slot_quantity").alias("units"), F.count(F.lit(1)).alias("sample_size")
    )
    return (
        totals.withColumn("day_of_week", day_of_slot("slot_index"))
        .join(store_dow_dates(slots), ["store_id", "day_of_week"])
        .join(item_days_observed(slots), ITEM)
        .select(
            *ITEM,
            "day_of_week",
            hour_of_slot("slot_index").alias("sale_hour"),
            "slot_index",
            (F.col("units") / F.col("total_dates")).alias("avg_slot_quantity"),
            "sample_size",
            "days_observed",
        )
    )


def time_of_day_profile(sales: DataFrame) -> DataFrame:
    """:func:`profile_of_slots` straight from staged sales, with one scan."""
    return profile_of_slots(shared_slot_sales(sales))


def cold_start_profile(profile: DataFrame, menu: DataFrame) -> DataFrame:
    """Mean profile of a category per slot, over stores and items alike; unknown items drop out."""
    categories = menu.select("item_id", "category").dropna(subset=["category"])
    return (
        profile.join(categories, "item_id")
        .groupBy("category", "day_of_week", "sale_hour", "slot_index")
        .agg(F.avg("avg_slot_quantity").alias("avg_slot_quantity"))
    )


def store_traffic_ratio(sales: DataFrame) -> DataFrame:
    """Units per trading day of each store, relative to the mean over stores.

    Takes staged sales or slot sales. The mean is a scalar subquery over the per-store rows, whose
    shuffle both sides share, instead of a window without partitions.
    """
    units = "slot_quantity" if "slot_quantity" in sales.columns else "quantity"
    daily = sales.groupBy("store_id", "sale_date").agg(F.sum(units).alias("units"))
    totals = daily.groupBy("store_id").agg(
        (F.sum("units") / F.count(F.lit(1))).alias("avg_daily_units")
    )
    mean = totals.agg(F.avg("avg_daily_units")).scalar()
    return totals.withColumn("traffic_ratio", F.col("avg_daily_units") / mean)


def store_dates(sales: DataFrame) -> DataFrame:
    """The dates on which each store traded. Takes staged sales or slot sales."""
    return sales.select("store_id", "sale_date", "day_of_week").distinct()


def latest_slot_per_item(slots: DataFrame, profile: DataFrame) -> DataFrame:
    """The newest slot with sales of each store and item, with its profile.

    An aggregate with map-side combine instead of a sort over each item's history; the profile
    joins the one row that is left.
    """
    at = running_slot("sale_date", "slot_index")
    newest = slots.groupBy(*ITEM).agg(
        F.max(at).alias("at"), F.max_by("slot_quantity", at).alias("slot_quantity")
    )
    return (
        newest.select(
            *ITEM,
            date_of_running_slot("at").alias("sale_date"),
            ring_slot_of_running("at").alias("slot_index"),
            "slot_quantity",
        )
        .join(
            profile.select(*ITEM, "slot_index", "avg_slot_quantity", "sample_size"),
            [*ITEM, "slot_index"],
            "left",
        )
        .select(
            *ITEM,
            "sale_date",
            hour_of_slot("slot_index").alias("sale_hour"),
            "slot_index",
            day_of_slot("slot_index").alias("day_of_week"),
            "slot_quantity",
            "avg_slot_quantity",
            "sample_size",
        )
    )


def rolling_slot_demand(slots: DataFrame, widths: tuple[int, ...] = (4, 8)) -> DataFrame:
    """Units of the last 4 and 8 slots up to each slot with sales.

    Slots are sparse, so the window is a range of slot numbers, not of rows. A window group has at
    most 96 rows a day.
    """
    over_time = Window.partitionBy(*ITEM).orderBy(running_slot("sale_date", "slot_index"))
    return slots.select(
        *ITEM,
        "sale_date",
        "slot_index",
        "slot_quantity",
        *(
            F.sum("slot_quantity").over(over_time.rangeBetween(1 - w, 0)).alias(f"units_last_{w}")
            for w in widths
        ),
    )
