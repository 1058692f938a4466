"""The store x item x slot grid, its routing and the production plan."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from itertools import chain

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from slotcast.constants import (
    AVAILABLE_HOURS,
    BROADCAST_ROWS,
    ESTABLISHED_DAYS,
    HOURS_PER_DAY,
    LIMITED_CLOSE_HOUR,
    LIMITED_HOURS,
    LIMITED_OPEN_HOUR,
    NEUTRAL_PRECIP,
    NEUTRAL_TEMP_F,
    RUSH_CURVE,
    RUSH_THRESHOLD,
    SLOTS_PER_DAY,
    SLOTS_PER_HOUR,
    SLOTS_PER_WEEK,
    SUM_DIGITS,
)
from slotcast.functions.scoring import effective_price as price_on_day
from slotcast.functions.slots import day_of_slot, hour_of_slot, minute_of_slot, slot_of
from slotcast.operators.live import Now, with_now
from slotcast.session import shuffle_partitions, stage

ITEM = ["store_id", "item_id"]
SLOT = [*ITEM, "slot_index"]


def _hours_of(time_of_day: Column) -> Column:
    """The hours of the day in which an item may be made; null for an unknown label."""
    start_end = F.create_map(
        *chain.from_iterable(
            (F.lit(label), F.array(F.lit(start), F.lit(end)))
            for label, (start, end) in AVAILABLE_HOURS.items()
        )
    )
    return F.try_element_at(start_end, time_of_day)


def _sellable(menu: DataFrame, as_of: date | Column) -> DataFrame:
    day = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    return menu.filter(F.col("active") & (F.col("added") <= day))


def available_items(menu: DataFrame, day: date | Column, hour: int | Column) -> DataFrame:
    """Active items that are on the menu by ``day`` and may be made at ``hour``."""
    window = _hours_of(F.col("time_of_day"))
    hour = hour if isinstance(hour, Column) else F.lit(hour)
    return _sellable(menu, day).filter((hour >= window[0]) & (hour < window[1]))


def open_hours_filter(df: DataFrame, stores: DataFrame, hour: str = "hour") -> DataFrame:
    """Drop rows whose hour lies outside their store's opening hours; unknown stores are open."""
    closed = (F.col("hours") == LIMITED_HOURS) & (
        (F.col(hour) < LIMITED_OPEN_HOUR) | (F.col(hour) >= LIMITED_CLOSE_HOUR)
    )
    return (
        df.join(stores.select("store_id", "hours"), "store_id", "left")
        .filter(~F.coalesce(closed, F.lit(False)))
        .drop("hours")
    )


def effective_price(menu: DataFrame, day_of_week: int | Column) -> DataFrame:
    """The menu with the price that holds on a weekday."""
    day = day_of_week if isinstance(day_of_week, Column) else F.lit(day_of_week)
    price = price_on_day("price", "sale_price", "sale_days", day)
    return menu.withColumn("effective_price", price)


def store_item_slot_grid(stores: DataFrame, menu: DataFrame, as_of: date | Column) -> DataFrame:
    """All store, item and slot combinations in which the item may be made."""
    return _store_item_hours(stores, menu, as_of).select(
        *ITEM, "category", F.explode(_slots_of_hour(F.col("sale_hour"))).alias("slot_index")
    )


def _store_item_hours(stores: DataFrame, menu: DataFrame, as_of: date | Column) -> DataFrame:
    """Every store with the items it may make, per hour of the day.

    Stores spread over the shuffle partitions before they are expanded, so the grid is born
    distributed. Each store needs all items of each hour, so this is a product by its nature; items x
    hours is the small side, which is broadcast after its rows are counted (runs a job). A menu too
    large for that meets the stores by a shuffle on hour and store group.
    """
    window = _hours_of(F.col("time_of_day"))
    item_hours = _sellable(menu, as_of).select(
        "item_id", "category", F.explode(F.sequence(window[0], window[1] - 1)).alias("sale_hour")
    )
    parts = shuffle_partitions(stores.sparkSession)
    hours = F.explode(F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1)))
    open_hours = (
        stores.select("store_id").repartition(parts, "store_id").distinct().select("store_id", hours.alias("sale_hour"))
    )
    if is_small(item_hours):
        return open_hours.join(F.broadcast(item_hours), "sale_hour")
    groups = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("store_group")
    grouped = open_hours.withColumn("store_group", F.pmod(F.hash("store_id"), F.lit(parts)))
    return grouped.join(item_hours.select("*", groups), ["sale_hour", "store_group"]).drop("store_group")


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame of a few narrow columns may be broadcast (runs a job that stops at the bound)."""
    return df.limit(rows + 1).count() <= rows


def _slots_of_hour(hour: Column) -> Column:
    """The 28 weekly slots of an hour of the day."""
    day_starts = F.sequence(F.lit(0), F.lit(SLOTS_PER_WEEK - 1), F.lit(SLOTS_PER_DAY))
    first = hour * SLOTS_PER_HOUR
    return F.flatten(
        F.transform(
            day_starts, lambda d: F.sequence(d + first, d + first + F.lit(SLOTS_PER_HOUR - 1))
        )
    )


def complete_features(grid: DataFrame, profile: DataFrame) -> DataFrame:
    """The grid with its profile; slots without one get zeros and the item's days observed.

    The item's days come from a window over its 672 slots at most.
    """
    per_item = Window.partitionBy(*ITEM)
    known = profile.select(*SLOT, "avg_slot_quantity", "sample_size", "days_observed")
    return grid.join(known, SLOT, "left").select(
        *ITEM,
        "category",
        "slot_index",
        day_of_slot("slot_index").alias("day_of_week"),
        hour_of_slot("slot_index").alias("sale_hour"),
        minute_of_slot("slot_index").alias("sale_minute"),
        F.coalesce("avg_slot_quantity", F.lit(0.0)).alias("avg_slot_quantity"),
        F.coalesce("sample_size", F.lit(0)).alias("sample_size"),
        F.coalesce(F.max("days_observed").over(per_item), F.lit(0)).alias("days_observed"),
    )


def grid_features(
    stores: DataFrame, menu: DataFrame, profile: DataFrame, as_of: date | Column
) -> DataFrame:
    """:func:`complete_features` of the whole grid, with one shuffle of the grid instead of two.

    The days observed are found per hour of the day, at a 28th of the grid's rows, before hours
    are expanded to slots. That frame has a fixed number of partitions: sized by its bytes, it
    would have too few for the rows that come out.
    """
    per_item = Window.partitionBy(*ITEM)
    hour = [*ITEM, "sale_hour"]
    days = profile.groupBy(*hour).agg(F.max("days_observed").alias("days"))
    hours = (
        _store_item_hours(stores, menu, as_of)
        .repartition(shuffle_partitions(stores.sparkSession), *ITEM)
        .join(days, hour, "left")
        .withColumn("days_observed", F.coalesce(F.max("days").over(per_item), F.lit(0)))
    )
    known = profile.select(*SLOT, "avg_slot_quantity", "sample_size")
    return (
        hours.select(
            *ITEM,
            "category",
            "days_observed",
            F.explode(_slots_of_hour(F.col("sale_hour"))).alias("slot_index"),
        )
        .join(known, SLOT, "left")
        .select(
            *ITEM,
            "category",
            "slot_index",
            day_of_slot("slot_index").alias("day_of_week"),
            hour_of_slot("slot_index").alias("sale_hour"),
            minute_of_slot("slot_index").alias("sale_minute"),
            F.coalesce("avg_slot_quantity", F.lit(0.0)).alias("avg_slot_quantity"),
            F.coalesce("sample_size", F.lit(0)).alias("sample_size"),
            "days_observed",
        )
    )


def route_rows(df: DataFrame, vocab: DataFrame | None = None, min_days: int = ESTABLISHED_DAYS) -> DataFrame:
    """Add ``route``: warm (use the model), zero (never sells then) or cold (use the category).

    ``vocab`` holds the item ids the model was trained on; without it all items count as known.
    """
    if vocab is None:
        known, marked = F.lit(True), df
    else:
        items = vocab.select("item_id").distinct().withColumn("in_vocab", F.lit(True))
        known, marked = F.col("in_vocab").isNotNull(), df.join(items, "item_id", "left")
    established = F.col("days_observed") >= min_days
    sells = F.col("sample_size") > 0
    route = (
        F.when(established & sells & known, "warm").when(established & ~sells, "zero").otherwise("cold")
    )
    return marked.withColumn("route", route).select(*df.columns, "route")


def cold_prediction(df: DataFrame, cold_profile: DataFrame, ratio: DataFrame) -> DataFrame:
    """Category mean times the store's traffic ratio, as ``predicted_units``.

    A slot without a category profile gets 0. The profile has 672 rows per category; it is broadcast
    after a count of its rows (runs a job), so that the grid is not shuffled by category.
    """
    category = cold_profile.select(
        "category", "slot_index", F.col("avg_slot_quantity").alias("category_avg")
    )
    return (
        df.join(F.broadcast(category) if is_small(category) else category, ["category", "slot_index"], "left")
        .join(ratio.select("store_id", "traffic_ratio"), "store_id", "left")
        .withColumn(
            "predicted_units", F.coalesce("category_avg", F.lit(0.0)) * F.col("traffic_ratio")
        )
        .select(*df.columns, "predicted_units")
    )


def zero_prediction(df: DataFrame) -> DataFrame:
    return df.withColumn("predicted_units", F.lit(0.0))


def attach_weather(
    df: DataFrame, stores: DataFrame | None = None, weather_by_region: DataFrame | None = None
) -> DataFrame:
    """``temp_f`` and ``precip`` of each store's region, or a neutral day for all."""
    if weather_by_region is None:
        return df.withColumn("temp_f", F.lit(NEUTRAL_TEMP_F)).withColumn(
            "precip", F.lit(NEUTRAL_PRECIP)
        )
    weather = weather_by_region.select("region", "temp_f", F.col("precip").cast("int"))
    of_store = stores.select("store_id", "region").join(weather, "region", "left").drop("region")
    return df.join(of_store, "store_id", "left")


def with_weekend(df: DataFrame) -> DataFrame:
    return df.withColumn("is_weekend", F.col("day_of_week").isin(5, 6).cast("int"))


def profile_model(df: DataFrame) -> DataFrame:
    """The baseline forecast: the profile mean itself."""
    return df.withColumn("predicted_units", F.col("avg_slot_quantity"))


def production_plan(
    stores: DataFrame,
    menu: DataFrame,
    profile: DataFrame,
    cold: DataFrame,
    ratio: DataFrame,
    as_of: date | Column,
    model: Callable[[DataFrame], DataFrame] = profile_model,
    vocab: DataFrame | None = None,
    weather_by_region: DataFrame | None = None,
    grid_rows: Observation | None = None,
) -> DataFrame:
    """Predicted units for each row of the grid.

    ``model`` adds ``predicted_units`` to its input, which are the warm rows alone. The profile mean is a column
    that every row has, so its plan is one pass. For any other model the grid is routed once and written
    (runs a job), since the warm rows and the others are read apart; ``grid_rows`` is then told how many rows
    were written, as ``n``.
    """
    routed = route_rows(grid_features(stores, menu, profile, as_of), vocab)
    if model is profile_model:
        chosen = (
            F.when(F.col("route") == "warm", F.col("avg_slot_quantity"))
            .when(F.col("route") == "zero", F.lit(0.0))
            .otherwise(F.col("predicted_units"))
        )
        return cold_prediction(routed, cold, ratio).select(*ITEM, chosen.alias("predicted_units"), "slot_index")
    if grid_rows is not None:
        routed = routed.observe(grid_rows, F.count(F.lit(1)).alias("n"))
    routed = stage(routed, "routed-grid")
    is_warm = F.col("route") == "warm"
    warm = model(with_weekend(attach_weather(routed.filter(is_warm), stores, weather_by_region)))
    others = cold_prediction(routed.filter(~is_warm), cold, ratio)
    chosen = F.when(F.col("route") == "zero", F.lit(0.0)).otherwise(F.col("predicted_units"))
    return warm.select(*ITEM, "predicted_units", "slot_index").unionByName(
        others.select(*ITEM, chosen.alias("predicted_units"), "slot_index")
    )


def plan_summary(plan: DataFrame) -> DataFrame:
    """Rows, stores, items and slots covered, mean and largest prediction, as one row.

    One scan: partial aggregation shrinks the expanded rows of the three distinct counts to the
    distinct ids before the shuffle.
    """
    return plan.agg(
        F.count(F.lit(1)).alias("predictions"),
        F.count_distinct("store_id").alias("stores"),
        F.count_distinct("item_id").alias("items"),
        F.count_distinct("slot_index").alias("slots"),
        F.avg("predicted_units").alias("avg_units"),
        F.max("predicted_units").alias("max_units"),
    )


def top_items(plan: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` items with the highest mean prediction; ties by item id."""
    return (
        plan.groupBy("item_id")
        .agg(F.avg("predicted_units").alias("avg_units"))
        .orderBy(F.desc("avg_units"), "item_id")
        .limit(k)
    )


def day_demand_totals(targets: DataFrame, menu: DataFrame, day_of_week: int) -> DataFrame:
    """Sum of an arm's targets over the 96 slots of a weekday, for active items."""
    first = day_of_week * SLOTS_PER_DAY
    return (
        targets.filter(F.col("slot_index").between(first, first + SLOTS_PER_DAY - 1))
        .join(menu.filter("active").select("item_id"), "item_id", "left_semi")
        .groupBy("arm")
        .agg(F.sum("target").alias("day_demand"))
    )


def replenishment(lookahead: DataFrame, on_hand: DataFrame, now: Now) -> DataFrame:
    """Units to cook: the demand ahead that shelf and kitchen do not cover.

    A gap of at most 1 cooks nothing. Orders fire in rush hours and on the full hour.
    """
    curve = F.array(*(F.lit(v) for v in RUSH_CURVE))
    rush = curve[F.hour("now")] >= RUSH_THRESHOLD
    fires = rush | (slot_of("now") % SLOTS_PER_HOUR == 0)
    committed = F.coalesce("on_shelf", F.lit(0)) + F.coalesce("in_progress", F.lit(0))
    return (
        with_now(lookahead, now)
        .join(on_hand.select(*ITEM, "on_shelf", "in_progress"), ITEM, "left")
        .withColumn("gap", F.round(F.col("predicted_units") - committed, SUM_DIGITS))
        .select(
            *ITEM,
            F.col("predicted_units").alias("demand"),
            committed.alias("committed"),
            F.when(fires & (F.col("gap") > 1), F.ceil("gap")).otherwise(0).cast("int").alias("cook_qty"),
        )
    )
