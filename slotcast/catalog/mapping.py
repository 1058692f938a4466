"""The retail logs and dimensions as they are read from the driver's ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from slotcast.operators import staging
from slotcast.plans.marts import Dims, Logs
from slotcast.schemas import LOGS

SALE_TYPES = ("purchase", "click", "view")
WASTE_TYPE = "signup"
STOCKOUT_TYPE = "error"
CATEGORIES = ("sandwich", "side", "roller_grill", "chicken", "appetizer")
TIMES_OF_DAY = ("breakfast", "lunch", "all_day", "chicken")
LAUNCH = "2024-01-19"
_TYPES = {"store_id": IntegerType(), "item_id": IntegerType(), "price": DoubleType()}



#: The logs' schemas with the ids and prices of the test tables.
SCHEMAS = {
    kind: StructType([StructField(f.name, _TYPES.get(f.name, f.dataType)) for f in schema])
    for kind, schema in LOGS.items()
}


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def as_log(events: DataFrame) -> DataFrame:
    """One log of all kinds, with the kind and the event's id and A/B arm."""
    quantity = (1 + F.col("event_id") % 3).cast("int")
    return events.select(
        F.when(F.col("event_type").isin(*SALE_TYPES), "sales")
        .when(F.col("event_type") == WASTE_TYPE, "waste")
        .when(F.col("event_type") == STOCKOUT_TYPE, "stockouts")
        .alias("kind"),
        F.col("event_id").alias("id"),
        (F.col("user_id") % 12).cast("int").alias("store_id"),
        (F.col("event_id") % 10).cast("int").alias("item_id"),
        quantity.alias("quantity"),
        quantity.alias("quantity_requested"),
        F.col("value").alias("price"),
        F.col("ts").alias("created_at"),
        F.when(F.floor(F.col("user_id") / 12) % 2 == 0, "ml").otherwise("baseline").alias("arm"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_log(_read(spark, sf_dir))


def of_kind(spark: SparkSession, sf_dir: str, types: tuple[str, ...]) -> DataFrame:
    # Filters on the stored column, so that it reaches the scan.
    return as_log(_read(spark, sf_dir).filter(F.col("event_type").isin(*types)))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return of_kind(spark, sf_dir, SALE_TYPES)


def raw_waste(spark: SparkSession, sf_dir: str) -> DataFrame:
    return of_kind(spark, sf_dir, (WASTE_TYPE,))


def raw_stockouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return of_kind(spark, sf_dir, (STOCKOUT_TYPE,))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_sales(raw_sales(spark, sf_dir))


def waste(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_waste(raw_waste(spark, sf_dir))


def stockouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_stockouts(raw_stockouts(spark, sf_dir))


def launch_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales in which item 9 is new on 19 January; before that, its rows are sales of item 4."""
    before = (F.col("item_id") == 9) & (F.col("sale_date") < F.lit(LAUNCH).cast("date"))
    return sales(spark, sf_dir).withColumn("item_id", F.when(before, 4).otherwise(F.col("item_id")))


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.array(*(F.lit(v) for v in values))[(index % len(values)).cast("int")]


def menu(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    launched = F.when(i == 7, F.lit("2024-02-15")).otherwise(F.lit("2023-12-01")).cast("date")
    return spark.range(10).select(
        i.cast("int").alias("item_id"),
        F.concat(F.lit("item_"), i).alias("name"),
        (2.0 + i).alias("price"),
        F.when(i % 5 != 4, 1.0 + i).alias("sale_price"),
        F.array((i % 7).cast("int"), ((i + 3) % 7).cast("int")).alias("sale_days"),
        (0.5 + 0.25 * i).alias("cost"),
        _pick(TIMES_OF_DAY, i).alias("time_of_day"),
        _pick(CATEGORIES, i).alias("category"),
        (1.5 + 0.5 * (i % 6)).alias("hold_time"),
        (5 * (1 + i % 3)).cast("int").alias("cook_time"),
        (1 + i % 5).cast("int").alias("popularity"),
        (i != 8).alias("active"),
        launched.alias("added"),
    )


def stores(spark: SparkSession) -> DataFrame:
    s = F.col("id")
    return spark.range(12).select(
        s.cast("int").alias("store_id"),
        F.concat(F.lit("Store "), s).alias("name"),
        (s % 4).cast("int").alias("region"),
        (1 + s % 4).cast("int").alias("level"),
        F.when(s % 2 == 0, "24/7").otherwise("5am-11pm").alias("hours"),
        F.lit(True).alias("active"),
    )


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store for each supplier, so that the chain grows with the given tables."""
    s = F.col("s_suppkey")
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        s.cast("int").alias("store_id"), F.when(s % 2 == 0, "24/7").otherwise("5am-11pm").alias("hours")
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather of each region on every day from the first event to the last."""
    ends = _read(spark, sf_dir).agg(F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last"))
    day = F.explode(F.sequence("first", "last"))
    r, d = F.col("region"), F.dayofmonth("sale_date")
    return (
        ends.select(F.explode(F.lit(list(range(4)))).alias("region"), "first", "last")
        .select("region", day.alias("sale_date"))
        .select(
            "region",
            "sale_date",
            (10.0 + (d * 37 + r * 23) % 91).alias("temp_f"),
            ((d + r) % 3 == 0).alias("precip"),
        )
    )


def logs(spark: SparkSession, sf_dir: str) -> Logs:
    return Logs(raw_sales(spark, sf_dir), raw_waste(spark, sf_dir), raw_stockouts(spark, sf_dir))


def dims(spark: SparkSession, sf_dir: str) -> Dims:
    return Dims(stores(spark), menu(spark), weather(spark, sf_dir))


def store_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five metrics of each date, store and arm, in one pass over all events."""
    dims = menu(spark).select("item_id", "cost", F.col("price").alias("menu_price"))
    units = F.col("quantity")

    def total(kind: str, value: Column) -> Column:
        return F.sum(F.when(F.col("kind") == kind, value).otherwise(0))

    return (
        log(spark, sf_dir)
        .join(dims, "item_id")
        .groupBy(F.to_date("created_at").alias("date"), "store_id", "arm")
        .agg(
            total("sales", units).alias("units_sold"),
            total("stockouts", units).alias("stockouts"),
            total("waste", units).alias("units_wasted"),
            total("waste", units * F.col("cost")).alias("waste_cost"),
            total("sales", units * F.col("menu_price")).alias("sales_revenue"),
        )
    )
