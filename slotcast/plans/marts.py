"""The warehouse models end to end, and the nightly run that stores them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from slotcast.operators import profiles, staging, waste as waste_ops
from slotcast.operators.features import training_features
from slotcast.sources.tables import materialize


@dataclass(frozen=True)
class Logs:
    sales: DataFrame
    waste: DataFrame
    stockouts: DataFrame


@dataclass(frozen=True)
class Dims:
    stores: DataFrame
    menu: DataFrame
    weather: DataFrame


def build_marts(spark: SparkSession, logs: Logs, dims: Dims) -> dict[str, DataFrame]:
    """Compute and store every mart (runs jobs).

    Slot sales are stored first, although they are an intermediate model: every later model but
    the waste and stockout marts reads this small table instead of the sales log.
    """
    sales = materialize(spark, staging.stage_sales(logs.sales), "staging", "stg_sales_events")
    waste = materialize(spark, staging.stage_waste(logs.waste), "staging", "stg_waste_log")
    stockouts = materialize(
        spark, staging.stage_stockouts(logs.stockouts), "staging", "stg_stockout_events"
    )
    slots = materialize(spark, profiles.slot_sales(sales), "marts", "slot_sales")
    profile = materialize(spark, profiles.profile_of_slots(slots), "marts", "baseline_profile")
    models = {
        "cold_start_profile": profiles.cold_start_profile(profile, dims.menu),
        "traffic_ratio": profiles.store_traffic_ratio(slots),
        "store_sales_15min": profiles.latest_slot_per_item(slots, profile),
        "waste_percentage": waste_ops.waste_percentage(waste, sales, dims.menu),
        "stockout_summary": waste_ops.stockout_summary(stockouts),
        "ml_training_features": training_features(slots, profile, dims.stores, dims.weather),
    }
    marts = {name: materialize(spark, df, "marts", name) for name, df in models.items()}
    return {"slot_sales": slots, "baseline_profile": profile} | marts
