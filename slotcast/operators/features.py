"""Training features: every slot an item has ever sold in, on every date its store traded."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotcast.constants import FEATURE_COLUMNS
from slotcast.functions.slots import minute_of_slot
from slotcast.operators.plan import with_weekend
from slotcast.operators.profiles import store_dates
from slotcast.session import shuffle_partitions

SLOT = ["store_id", "item_id", "slot_index"]


def training_features(
    slots: DataFrame, profile: DataFrame, stores: DataFrame, weather: DataFrame
) -> DataFrame:
    """Profile slots x the store's dates of that weekday, with units sold (0 if none) and weather.

    ``slots`` are slot sales. The result is several times larger than its inputs, so it is never
    shuffled: the sold dates of each weekly slot are gathered at profile grain, and dates without
    a sale are filled in row by row. Both arrays hold at most one entry per week of history. The
    number of partitions is fixed: sized by their bytes, they would be too few for the rows that
    come out.
    """
    partitions = shuffle_partitions(slots.sparkSession)
    sold = slots.repartition(partitions, *SLOT).groupBy(*SLOT).agg(
        F.collect_list(F.struct("sale_date", "slot_quantity")).alias("sold")
    )
    dates = (
        store_dates(slots)
        .groupBy("store_id", "day_of_week")
        .agg(F.collect_list("sale_date").alias("dates"))
    )
    observation = "array<struct<sale_date: date, slot_quantity: bigint>>"
    sold_or_none = F.coalesce("sold", F.array().cast(observation))
    unsold = F.transform(
        F.array_except("dates", F.transform("sold_or_none", lambda s: s["sale_date"])),
        lambda d: F.struct(d.alias("sale_date"), F.lit(0).cast("bigint").alias("slot_quantity")),
    )
    return (
        profile.select(
            *SLOT, "day_of_week", "sale_hour", "avg_slot_quantity", "sample_size"
        )
        .repartition(partitions, *SLOT)
        .join(sold, SLOT, "left")
        .join(dates, ["store_id", "day_of_week"])
        .join(stores.select("store_id", "region"), "store_id")
        .withColumn("sold_or_none", sold_or_none)
        .select(
            *SLOT,
            "region",
            "day_of_week",
            "sale_hour",
            "avg_slot_quantity",
            "sample_size",
            F.inline(F.concat("sold_or_none", unsold)),
        )
        .join(weather, ["region", "sale_date"], "left")
        .select(
            "store_id",
            "item_id",
            "sale_date",
            "sale_hour",
            minute_of_slot("slot_index").alias("sale_minute"),
            "slot_index",
            "day_of_week",
            F.coalesce("slot_quantity", F.lit(0)).alias("slot_quantity"),
            "avg_slot_quantity",
            "sample_size",
            "temp_f",
            "precip",
        )
    )


def model_features(df: DataFrame) -> DataFrame:
    """The model's columns, with the date and the target. Null weather stays null."""
    return with_weekend(df).select(
        "sale_date",
        *FEATURE_COLUMNS[:-1],
        F.col("precip").cast("int").alias("precip"),
        "slot_quantity",
    )
