"""The profile marts kept up to date from the days that changed.

What the profiles need adds up over days, since every day counts once: units and days of each store, item
and slot, days of each store and item, units and days of each store and weekday. A refresh reads from the
log only the days that commits after the last refresh name, takes what these days gave before from
the sums and adds what they give now. So late events and deleted ones are right too, and a night's
work follows the new days and the number of groups, not the history.

Below ``path``, ``days`` has the slot sales of every day as of the refresh that last read it, ``sums``
the sums after each refresh. The folder of a refresh in ``done`` is written last and makes it count: it names
the commit it goes up to and the refresh that each day is from. A refresh that failed is run again
from the one before it.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slotcast.functions.slots import day_of_slot, hour_of_slot
from slotcast.operators import profiles, staging
from slotcast.schemas import LOGS
from slotcast.session import folders, remove
from slotcast.sources import commits
from slotcast.sources.events import Schemas, read_events

ITEM = profiles.ITEM
#: Keys and sums of the additive state.
STATE = {
    "item_slots": ([*ITEM, "slot_index"], ["units", "days"]),
    "items": (ITEM, ["days"]),
    "store_weekdays": (["store_id", "day_of_week"], ["units", "days"]),
}


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in folders(spark, folder) if n.startswith("refresh="))


def _at(path: str, part: str, refresh: int) -> str:
    return os.path.join(path, part, f"refresh={refresh}")


def refresh_profiles(spark: SparkSession, log: str, path: str, schemas: Schemas = LOGS) -> int:
    """Bring the state at ``path`` up to the log's newest commit (runs jobs); returns the days read.

    A compaction changes no rows and costs nothing, unless it removed commits that were not yet refreshed
    from: then all days are read.
    """
    done = _numbers(spark, os.path.join(path, "done"))
    last = done[-1] if done else None
    upto = max(commits.versions(spark, log), default=-1)
    before = {} if last is None else {r["sale_date"]: r["refresh"] for r in _done(spark, path, last)}
    seen = -1 if last is None else _seen(spark, path, last)
    days = commits.changed_days(spark, log, seen) - {None}
    if last is not None and not days:
        return 0
    refresh = 0 if last is None else last + 1
    sales = staging.stage_sales(read_events(spark, log, "sales", dates=days, schemas=schemas))
    fresh = profiles.shared_slot_sales(sales).select(*ITEM, "sale_date", "slot_index", "slot_quantity")
    fresh.write.mode("overwrite").partitionBy("sale_date").parquet(_at(path, "days", refresh))
    fresh = _read_days(spark, path, {d: refresh for d in days}, fresh)
    stale = _read_days(spark, path, {d: before[d] for d in days if d in before}, fresh)
    for part, changes in _changes(fresh, stale).items():
        keys, sums = STATE[part]
        if last is not None:
            changes = changes.unionByName(read_state(spark, path, part, last))
        total = changes.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums)).filter("days > 0")
        total.write.mode("overwrite").parquet(_at(path, os.path.join("sums", part), refresh))
    now = [(d, r, upto) for d, r in {**before, **{d: refresh for d in days}}.items()] or [(None, refresh, upto)]
    rows = spark.createDataFrame(now, "sale_date date, refresh long, upto long")
    rows.coalesce(1).write.mode("overwrite").parquet(_at(path, "done", refresh))
    if last is not None:  # the sums before the last ones, which no reader starts from any more
        old = [_at(path, os.path.join("sums", part), n) for part in STATE for n in done[:-1]]
        remove(spark, *old, *(_at(path, "done", n) for n in done[:-1]))
    return len(days)


def _done(spark: SparkSession, path: str, refresh: int) -> list:
    """The days with the refresh that each is from: one row per day of the calendar."""
    return spark.read.parquet(_at(path, "done", refresh)).collect()


def _seen(spark: SparkSession, path: str, refresh: int) -> int:
    return _done(spark, path, refresh)[0]["upto"]


def _read_days(spark: SparkSession, path: str, days: dict, like: DataFrame) -> DataFrame:
    """Slot sales of some days, each from the refresh named with it."""
    parts = []
    for refresh in sorted(set(days.values())):
        some = [d for d, r in days.items() if r == refresh and d is not None]
        stored = spark.read.schema(like.schema).parquet(_at(path, "days", refresh))
        parts.append(stored.filter(F.col("sale_date").isin(some)).select(*like.columns))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], like.schema)


def _changes(fresh: DataFrame, stale: DataFrame) -> dict[str, DataFrame]:
    """What the days add to each sum now, less what they added before."""
    sign = F.col("sign")
    rows = fresh.withColumn("sign", F.lit(1)).unionByName(stale.withColumn("sign", F.lit(-1)))
    units = (sign * F.col("slot_quantity")).alias("units")
    weekday = day_of_slot("slot_index").alias("day_of_week")
    one = sign.cast("long").alias("days")
    store_days = rows.groupBy("store_id", "sale_date", weekday, "sign").agg(F.sum("slot_quantity").alias("units"))
    return {
        "item_slots": rows.select(*ITEM, "slot_index", units, one),
        "items": rows.select(*ITEM, "sale_date", "sign").distinct().select(*ITEM, one),
        "store_weekdays": store_days.select("store_id", "day_of_week", (sign * F.col("units")).alias("units"), one),
    }


def read_state(spark: SparkSession, path: str, part: str, refresh: int | None = None) -> DataFrame:
    """One of the sums, after the newest refresh or a given one."""
    refresh = _numbers(spark, os.path.join(path, "done"))[-1] if refresh is None else refresh
    return spark.read.parquet(_at(path, os.path.join("sums", part), refresh))


def refreshed_profile(spark: SparkSession, path: str) -> DataFrame:
    """:func:`profiles.profile_of_slots` from the sums."""
    dates = read_state(spark, path, "store_weekdays").select("store_id", "day_of_week", F.col("days").alias("total_dates"))
    observed = read_state(spark, path, "items").withColumnRenamed("days", "days_observed")
    return (
        read_state(spark, path, "item_slots")
        .withColumn("day_of_week", day_of_slot("slot_index"))
        .join(dates, ["store_id", "day_of_week"])
        .join(observed, ITEM)
        .select(
            *ITEM,
            "day_of_week",
            hour_of_slot("slot_index").alias("sale_hour"),
            "slot_index",
            (F.col("units") / F.col("total_dates")).alias("avg_slot_quantity"),
            F.col("days").alias("sample_size"),
            "days_observed",
        )
    )


def refreshed_traffic_ratio(spark: SparkSession, path: str) -> DataFrame:
    """:func:`profiles.store_traffic_ratio` from the sums."""
    daily: Column = (F.sum("units") / F.sum("days")).alias("avg_daily_units")
    totals = read_state(spark, path, "store_weekdays").groupBy("store_id").agg(daily)
    mean = totals.agg(F.avg("avg_daily_units")).scalar()
    return totals.withColumn("traffic_ratio", F.col("avg_daily_units") / mean)
