"""A/B scoring of two forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slotcast.constants import ARM_METRICS, ARMS
from slotcast.functions.scoring import classify_weather, service_level, waste_pct


def flatten_results(results: DataFrame) -> DataFrame:
    """The nested results document as one row per date and arm."""
    arms = F.array(
        *(
            F.struct(
                F.to_date("day.date").alias("date"),
                F.lit(arm).alias("arm"),
                *(F.col(f"day.{arm}.{m}").alias(m) for m in ARM_METRICS),
            )
            for arm in ARMS
        )
    )
    return results.select(F.explode("daily").alias("day")).select(F.inline(arms))


def nest_results(daily: DataFrame) -> DataFrame:
    """The results document of a frame with one row per date and arm: one row per date."""
    of_arm = {
        arm: F.first(
            F.when(F.col("arm") == arm, F.struct(*ARM_METRICS)), ignorenulls=True
        ).alias(arm)
        for arm in ARMS
    }
    return daily.groupBy(F.col("date").cast("string").alias("date")).agg(*of_arm.values())


def arm_totals(store_days: DataFrame) -> DataFrame:
    """The five metrics per date and arm, over stores."""
    return store_days.groupBy("date", "arm").agg(*(F.sum(m).alias(m) for m in ARM_METRICS))


def cumulative(daily: DataFrame) -> DataFrame:
    """Days run, and the mean over days of each arm's daily ratios, rounded half-even to 2."""
    waste = F.col("waste_cost") / F.nullif("sales_revenue", F.lit(0.0)) * 100
    requested = F.col("units_sold") + F.col("stockouts")
    service = F.col("units_sold") / F.nullif(requested, F.lit(0)) * 100

    def mean(arm: str, ratio: Column) -> Column:
        return F.bround(F.avg(F.when(F.col("arm") == arm, ratio)), 2)

    return daily.agg(
        F.count_distinct("date").alias("days_run"),
        mean("ml", waste).alias("ml_avg_waste_pct"),
        mean("baseline", waste).alias("baseline_avg_waste_pct"),
        mean("ml", service).alias("ml_avg_service_level"),
        mean("baseline", service).alias("base_avg_service_level"),
    )


def weather_impact(store_days: DataFrame, stores: DataFrame, weather: DataFrame) -> DataFrame:
    """Ratios of sums per weather bucket and arm; buckets without store-days do not appear.

    ``store_days`` has one row per date, store and arm.
    """
    by_region = weather.select("region", F.col("sale_date").alias("date"), "temp_f", "precip")

    def total(arm: str, metric: str) -> Column:
        return F.sum(F.when(F.col("arm") == arm, F.col(metric)).otherwise(0))

    totals = (
        store_days.join(stores.select("store_id", "region"), "store_id")
        .join(by_region, ["region", "date"])
        .withColumn("bucket", classify_weather("temp_f", "precip"))
        .groupBy("bucket")
        .agg(
            F.count_if(F.col("arm") == ARMS[0]).alias("store_days"),
            *(total(arm, m).alias(f"{arm}_{m}") for arm in ARMS for m in ARM_METRICS),
        )
    )
    level = {a: service_level(f"{a}_units_sold", f"{a}_stockouts") for a in ARMS}
    waste = {a: waste_pct(f"{a}_waste_cost", f"{a}_sales_revenue") for a in ARMS}
    return totals.select(
        "bucket",
        "store_days",
        F.bround(level["ml"], 2).alias("ml_service_level"),
        F.bround(level["baseline"], 2).alias("baseline_service_level"),
        F.bround(level["ml"] - level["baseline"], 2).alias("service_level_gap_pp"),
        F.bround(waste["ml"], 2).alias("ml_waste_pct"),
        F.bround(waste["baseline"], 2).alias("baseline_waste_pct"),
    )
