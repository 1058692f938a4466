"""Daily sales, waste and stockout summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def daily_item_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("store_id", "item_id", "sale_date").agg(
        F.sum("quantity").alias("sale_quantity")
    )


def daily_item_waste(waste: DataFrame) -> DataFrame:
    return waste.groupBy("store_id", "item_id", "waste_date").agg(
        F.sum("quantity").alias("waste_quantity")
    )


def waste_percentage(waste: DataFrame, sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Waste cost in percent of revenue at menu price, for item-days that have both.

    Both logs are summed on the join keys first, so the join adds no shuffle.
    """
    sold = daily_item_sales(sales).withColumnRenamed("sale_date", "waste_date")
    dims = menu.select("item_id", "category", "price", "cost")
    cost = F.col("waste_quantity") * F.col("cost")
    revenue = F.col("sale_quantity") * F.col("price")
    return (
        daily_item_waste(waste)
        .join(sold, ["store_id", "item_id", "waste_date"])
        .join(dims, "item_id")
        .select(
            "store_id",
            "item_id",
            "category",
            cost.alias("waste_cost"),
            revenue.alias("sale_revenue"),
            "waste_date",
            "sale_quantity",
            (cost / F.nullif(revenue, F.lit(0.0)) * 100).alias("waste_percentage"),
        )
    )


def stockout_summary(stockouts: DataFrame) -> DataFrame:
    return stockouts.groupBy(
        "store_id", "item_id", "stockout_date", "stockout_hour", "day_of_week"
    ).agg(
        F.sum("quantity_requested").alias("total_missed_units"),
        F.count(F.lit(1)).alias("event_count"),
    )
