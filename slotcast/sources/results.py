"""A/B results: the nested document, the daily table and the bucket summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotcast.constants import ARM_METRICS
from slotcast.operators.scoring import cumulative, nest_results
from slotcast.schemas import DAILY_RESULTS, RESULTS


def read_results_json(spark: SparkSession, path: str) -> DataFrame:
    """The nested document: totals and an array of days with both arms."""
    return spark.read.schema(RESULTS).option("multiLine", True).json(path)


def append_daily_result(df: DataFrame, path: str) -> None:
    """Add the arms of a day to the daily table; running a day again replaces it.

    Totals over days are made from all of them when the document is written
    (:func:`write_results_document`), so a day that is run again cannot be counted twice.
    """
    (
        df.select("arm", *ARM_METRICS, "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def read_daily_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DAILY_RESULTS).parquet(path)


def write_results_document(daily: DataFrame, path: str) -> None:
    """Write the nested document of a daily table: its days in order, and the totals over them (runs a job).

    One entry per day of the calendar is gathered. Without days there is a document with an empty list.
    """
    days = nest_results(daily).agg(F.sort_array(F.collect_list(F.struct("date", "ml", "baseline"))).alias("daily"))
    totals = cumulative(daily)
    write_results_json(totals.select(F.struct(*totals.columns).alias("cumulative"), days.scalar().alias("daily")), path)


def write_results_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
