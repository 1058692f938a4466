"""The batch summaries on streams of events.

Event times are TIMESTAMP_NTZ in the logs. Watermarks need TIMESTAMP, so they run on the wall
clock read as UTC and results are turned back; the session time zone plays no part.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from slotcast.functions.slots import from_event_time, slot_of, to_event_time
from slotcast.schemas import LOGS
from slotcast.session import exists, folders, remove
from slotcast.sources.events import Schemas, append_events

FLUSH_INTERVAL = "5 minutes"
EPOCH, BASE, TAIL = "epoch", "base", "tail"


def _windowed(sdf: DataFrame, delay: str, width: str, sums: dict) -> DataFrame:
    return (
        sdf.withColumn("at", to_event_time("created_at"))
        .withWatermark("at", delay)
        .groupBy(F.window("at", width).alias("span"), "store_id", "item_id")
        .agg(*(F.sum(c).alias(name) for name, c in sums.items()), F.count(F.lit(1)).alias("n_events"))
        .withColumn("starts_at", from_event_time("span.start"))
    )


def stream_slot_sales(sdf: DataFrame, delay: str = "15 minutes") -> DataFrame:
    """Units per store, item and 15 minutes."""
    sums = _windowed(sdf, delay, "15 minutes", {"slot_quantity": F.col("quantity")})
    return sums.select(
        "store_id",
        "item_id",
        F.col("starts_at").alias("sale_15min"),
        slot_of("starts_at").alias("slot_index"),
        "slot_quantity",
    )


def stream_stockouts(sdf: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Missed units and events per store, item and hour."""
    sums = _windowed(sdf, delay, "1 hour", {"total_missed_units": F.col("quantity_requested")})
    return sums.select(
        "store_id",
        "item_id",
        F.to_date("starts_at").alias("stockout_date"),
        F.hour("starts_at").alias("stockout_hour"),
        "total_missed_units",
        F.col("n_events").alias("event_count"),
    )


def stream_waste_today(sdf: DataFrame, menu: DataFrame, delay: str = "1 day") -> DataFrame:
    """Running sales, revenue and waste per store, item and day, with the waste's cost.

    ``sdf`` holds sales and waste with their ``kind``; ``menu`` is a static table. In update mode
    (:func:`upsert_sink`) the current day is given out as it grows.
    """
    sold, wasted = F.col("kind") == "sales", F.col("kind") == "waste"
    sums = _windowed(
        sdf,
        delay,
        "1 day",
        {
            "sales_quantity": F.when(sold, F.col("quantity")).otherwise(0),
            "sales_revenue": F.when(sold, F.col("quantity") * F.col("price")).otherwise(0),
            "waste_quantity": F.when(wasted, F.col("quantity")).otherwise(0),
        },
    )
    return sums.join(menu.select("item_id", "category", "cost"), "item_id", "left").select(
        "store_id",
        "item_id",
        F.to_date("starts_at").alias("waste_date"),
        "sales_quantity",
        "sales_revenue",
        "waste_quantity",
        "category",
        (F.col("waste_quantity") * F.col("cost")).alias("waste_cost"),
    )


def file_sink(
    sdf: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    return (
        sdf.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def upsert_sink(sdf: DataFrame, path: str, checkpoint: str, keys: list[str], tail: int = 10) -> DataStreamWriter:
    """Give out every group that changed, open windows too, one folder per trigger.

    A trigger that is retried overwrites its folder, so nothing is doubled. :func:`read_upserts` reads the
    newest row of each group: from a base, which has one row per group, and the folders after it.
    As soon as ``tail`` folders have gathered they are folded into a new base, so what readers read
    follows the number of groups, not of triggers.
    """

    def write(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(path, TAIL, f"{EPOCH}={epoch}"))
        _, after = _parts(df.sparkSession, path)
        if len(after) >= tail:
            fold_upserts(df.sparkSession, path, df.schema, keys)

    return sdf.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)


def _parts(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """The epoch of the newest complete base, and the epochs of the tail after it."""

    def epochs(part: str) -> list[int]:
        names = (n for n in folders(spark, os.path.join(path, part)) if n.startswith(f"{EPOCH}="))
        return sorted(int(n.split("=")[1]) for n in names)

    whole = [e for e in epochs(BASE) if exists(spark, os.path.join(path, BASE, f"{EPOCH}={e}", "_SUCCESS"))]
    base = max(whole, default=None)
    return base, [e for e in epochs(TAIL) if base is None or e > base]


def fold_upserts(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> None:
    """Write a base of all groups, and delete what only the base before the last one needed (runs a job).

    The folders of the last base and its tail stay for readers that have planned with them. Every step
    may be repeated.
    """
    base, after = _parts(spark, path)
    if not after:
        return
    newest = read_upserts(spark, path, schema, keys)
    newest.write.mode("overwrite").parquet(os.path.join(path, BASE, f"{EPOCH}={after[-1]}"))
    if base is not None:
        for part, spare in ((BASE, base - 1), (TAIL, base)):
            names = folders(spark, os.path.join(path, part))
            remove(spark, *(os.path.join(path, part, n) for n in names if int(n.split("=")[1]) <= spare))


def read_upserts(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The newest row of each group that :func:`upsert_sink` wrote."""
    base, after = _parts(spark, path)
    named = [(BASE, [] if base is None else [base]), (TAIL, after)]
    parts = [
        spark.read.schema(schema).parquet(os.path.join(path, part, f"{EPOCH}={e}")).withColumn(EPOCH, F.lit(e))
        for part, some in named
        for e in some
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    rows = reduce(DataFrame.unionByName, parts)
    values = F.struct(*(f.name for f in schema if f.name not in keys))
    newest = rows.groupBy(*keys).agg(F.max_by(values, EPOCH).alias("newest"))
    return newest.select(*keys, "newest.*").select(*schema.names)


def stream_append_logs(
    sdf: DataFrame,
    path: str,
    checkpoint: str,
    every: str = FLUSH_INTERVAL,
    once: bool = False,
    schemas: Schemas = LOGS,
) -> StreamingQuery:
    """Append events with their ``kind`` to the three logs, one flush per trigger, exactly once.

    A log belongs to one checkpoint: a trigger's number is the epoch of its flush.
    """
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return (
        sdf.writeStream.foreachBatch(lambda df, epoch: append_events(df, epoch, path, schemas))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_append(
    sdf: DataFrame, path: str, checkpoint: str, every: str = FLUSH_INTERVAL, once: bool = False
) -> StreamingQuery:
    """Append events to a log by date, one flush per trigger, each event exactly once.

    The checkpoint remembers what was read, so a restart resumes where the last flush ended.
    With ``once``, takes what there is and stops.
    """
    dated = sdf.withColumn("event_date", F.to_date("created_at"))
    sink = file_sink(dated, path, checkpoint).partitionBy("event_date")
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return sink.trigger(**trigger).start()
