"""Read-outs against the data's own clock.

``now`` is a literal time, a one-row frame ``(now)``, or a frame of store clocks
``(store_id, now)``. In every form the scan gets a lower bound on ``created_at`` that reaches
Parquet, and the log is summed before it meets a clock, so that no raw event is joined.
"""

from __future__ import annotations

from datetime import datetime
from itertools import chain

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotcast.constants import KPI_GROUPS, QUEUES, SLOTS_PER_HOUR, SLOTS_PER_WEEK, SUM_DIGITS
from slotcast.functions.slots import midnight, ntz, slot_of, slots_ahead

Now = datetime | str | DataFrame
ITEM = ["store_id", "item_id"]


def sim_now(sales: DataFrame, store_id: str | int | None = None) -> DataFrame:
    """The time of the newest sale, of one store or of all, as one row."""
    if store_id is not None:
        sales = sales.filter(F.col("store_id") == F.lit(store_id))
    return sales.agg(F.max("created_at").alias("now"))


def store_clocks(sales: DataFrame) -> DataFrame:
    """The time of the newest sale of each store."""
    # Stated here, the filter that joins on the store would add; all uses share one scan.
    sales = sales.filter(F.col("store_id").isNotNull())
    return sales.groupBy("store_id").agg(F.max("created_at").alias("now"))


def _has_store_clocks(now: Now) -> bool:
    return isinstance(now, DataFrame) and "store_id" in now.columns


def _one_time(now: Now) -> Column:
    return now.select("now").scalar() if isinstance(now, DataFrame) else ntz(now)


def with_now(df: DataFrame, now: Now) -> DataFrame:
    """Add the column ``now``."""
    if _has_store_clocks(now):
        return df.join(now.select("store_id", "now"), "store_id")
    return df.withColumn("now", _one_time(now))


def today_totals(events: DataFrame, now: Now, sums: dict[str, Column]) -> DataFrame:
    """Sums per store and item since midnight of ``now``, without an upper bound."""
    if not _has_store_clocks(now):
        today = events.filter(F.col("created_at") >= midnight(_one_time(now)))
        return today.groupBy("store_id", "item_id").agg(
            *(F.sum(c).alias(name) for name, c in sums.items())
        )
    earliest = now.agg(F.min(midnight("now"))).scalar()
    per_day = (
        events.filter(F.col("created_at") >= earliest)
        .groupBy("store_id", "item_id", F.to_date("created_at").alias("day"))
        .agg(*(F.sum(c).alias(name) for name, c in sums.items()))
    )
    return (
        with_now(per_day, now)
        .filter(F.col("day") >= F.to_date("now"))
        .groupBy("store_id", "item_id")
        .agg(*(F.sum(name).alias(name) for name in sums))
    )


def missed_units_today(stockouts: DataFrame, now: Now) -> DataFrame:
    return today_totals(stockouts, now, {"missed_units": F.col("quantity_requested")})


def waste_summary_today(sales: DataFrame, waste: DataFrame, menu: DataFrame, now: Now) -> DataFrame:
    """Today's sales at the price paid, and today's waste, for items that have either."""
    sold = today_totals(
        sales,
        now,
        {
            "sale_quantity": F.col("quantity"),
            "sale_revenue": F.col("quantity") * F.col("price").cast("double"),
        },
    )
    wasted = today_totals(waste, now, {"waste_quantity": F.col("quantity")})
    none = F.lit(0)
    return (
        sold.join(wasted, ["store_id", "item_id"], "full_outer")
        .join(menu.select("item_id", "category", "cost"), "item_id", "left")
        .select(
            "store_id",
            "item_id",
            F.coalesce("sale_quantity", none).alias("sale_quantity"),
            F.coalesce("sale_revenue", F.lit(0.0)).alias("sale_revenue"),
            F.coalesce("waste_quantity", none).alias("waste_quantity"),
            "category",
            "cost",
            (F.coalesce("waste_quantity", none) * F.col("cost")).alias("waste_cost"),
        )
    )


def category_group_kpis(waste_summary: DataFrame) -> DataFrame:
    """Units, revenue and waste percent of the three category groups of each store.

    A group without revenue has 0 units, and null for revenue and waste.
    """
    sums = ("sale_quantity", "sale_revenue", "waste_cost")
    per_store = waste_summary.groupBy("store_id").agg(
        *(
            F.sum(F.when(F.col("category").isin(*categories), F.col(c))).alias(f"{group}_{c}")
            for group, categories in KPI_GROUPS.items()
            for c in sums
        )
    )

    def row(group: str) -> Column:
        units, revenue, cost = (F.col(f"{group}_{c}") for c in sums)
        sold = F.coalesce(revenue, F.lit(0.0)) != 0
        return F.struct(
            F.lit(group).alias("category_group"),
            F.when(sold, units).otherwise(F.lit(0)).alias("units"),
            F.when(sold, revenue).alias("revenue"),
            F.when(sold, F.coalesce(cost, F.lit(0.0)) / revenue * 100).alias("waste_pct"),
        )

    return per_store.select("store_id", F.inline(F.array(*(row(g) for g in KPI_GROUPS))))


def lookahead_demand(pred: DataFrame, menu: DataFrame, now: Now) -> DataFrame:
    """Predicted units of each item over its hold time from the slot of ``now`` on.

    The ring wraps from 671 to 0. A prediction counts if its slot is fewer than
    ``int(hold_time * 4)`` slots ahead; that is arithmetic on the row, so no window is exploded.
    """
    window = F.floor(F.col("hold_time") * SLOTS_PER_HOUR).cast("int")
    ahead = slots_ahead("slot_index", slot_of("now"))
    # Times the slot falls in the window: once, unless the hold time is longer than a week.
    times = F.ceil((F.col("window") - F.col("ahead")) / SLOTS_PER_WEEK)
    return (
        with_now(pred.select("store_id", "item_id", "slot_index", "predicted_units"), now)
        .join(menu.select("item_id", window.alias("window")), "item_id")
        .withColumn("ahead", ahead)
        .filter(F.col("ahead") < F.col("window"))
        .groupBy("store_id", "item_id")
        .agg(F.sum(F.col("predicted_units") * times).alias("predicted_units"))
    )


def lookahead_index(pred: DataFrame) -> DataFrame:
    """Running sums of the predictions around the ring, made when a plan is published.

    A row for each store, item and slot 0..671: units and predictions up to and with the slot, and those of
    the whole week. Stored in the order of slots, a window needs two of an item's 672 rows.
    """
    units = pred.select(*ITEM, "slot_index", "predicted_units", F.lit(1).alias("n"))
    every = F.explode(F.sequence(F.lit(0), F.lit(SLOTS_PER_WEEK - 1))).alias("slot_index")
    empty = units.select(*ITEM).distinct().select(*ITEM, every, F.lit(0.0).alias("predicted_units"), F.lit(0).alias("n"))
    slots = units.unionByName(empty).groupBy(*ITEM, "slot_index").agg(
        F.sum("predicted_units").alias("units"), F.sum("n").alias("n")
    )
    week = Window.partitionBy(*ITEM)
    so_far = week.orderBy("slot_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return slots.select(
        *ITEM,
        "slot_index",
        F.sum("units").over(so_far).alias("units_through"),
        F.sum("n").over(so_far).alias("n_through"),
        F.sum("units").over(week).alias("week_units"),
        F.sum("n").over(week).alias("week_n"),
    )


def publish_lookahead(pred: DataFrame, path: str) -> None:
    """Store :func:`lookahead_index` by ranges of slots (runs jobs), so that a few slots are few row groups."""
    order = ["slot_index", *ITEM]
    index = lookahead_index(pred).repartitionByRange(*order).sortWithinPartitions(*order)
    index.write.mode("overwrite").option("parquet.block.size", 8 << 20).parquet(path)


def lookahead_of_index(index: DataFrame, menu: DataFrame, now: DataFrame) -> DataFrame:
    """:func:`lookahead_demand` from two rows of the stored index for each item (runs two small jobs).

    ``now`` has store clocks. The slots that any store and hold time need are at most 672 numbers; they become
    a filter of the scan. The sum over a window is the difference of its ends, and a week's units for each
    time it comes round.
    """
    window = F.floor(F.col("hold_time") * SLOTS_PER_HOUR).cast("int")
    before = F.pmod(slot_of("now") - 1, F.lit(SLOTS_PER_WEEK)).alias("before")
    clocks, items = now.select("store_id", before), menu.select("item_id", window.alias("window"))
    rest = F.col("window") % SLOTS_PER_WEEK
    last = (F.col("before") + rest) % SLOTS_PER_WEEK
    starts = [r[0] for r in clocks.dropna().select("before").distinct().collect()]  # at most 672 each
    spans = [r[0] for r in items.dropna().select(rest).distinct().collect()]
    needed = sorted({*starts, *((a + n) % SLOTS_PER_WEEK for a in starts for n in spans)})
    weeks = F.floor(F.col("window") / SLOTS_PER_WEEK) + (F.col("before") + rest >= SLOTS_PER_WEEK).cast("int")

    def inside(name: str, week: str) -> Column:
        to, frm = (F.max(F.when(F.col("slot_index") == end, F.col(name))) for end in (last, F.col("before")))
        return to - frm + F.max(weeks * F.col(week))

    return (
        index.filter(F.col("slot_index").isin(needed))
        .join(clocks, "store_id")
        .join(items, "item_id")
        .filter((F.col("slot_index") == F.col("before")) | (F.col("slot_index") == last))
        .groupBy(*ITEM)
        .agg(inside("units_through", "week_units").alias("predicted_units"), inside("n_through", "week_n").alias("n"))
        .filter("n > 0")
        .drop("n")
    )


def production_queue(pred: DataFrame, stockouts: DataFrame, menu: DataFrame, now: Now) -> DataFrame:
    """Look-ahead demand in whole units, units missed today, and the kitchen queue of the item."""
    return queue_of(lookahead_demand(pred, menu, now), stockouts, menu, now)


def queue_of(ahead: DataFrame, stockouts: DataFrame, menu: DataFrame, now: Now) -> DataFrame:
    """:func:`production_queue` of a look-ahead that is known."""
    queue_of = F.create_map(
        *chain.from_iterable(
            (F.lit(category), F.lit(queue))
            for queue, categories in QUEUES.items()
            for category in categories
        )
    )
    return (
        ahead.join(missed_units_today(stockouts, now), ["store_id", "item_id"], "left")
        .join(menu.select("item_id", "category"), "item_id", "left")
        .select(
            "store_id",
            "item_id",
            F.bround(F.round("predicted_units", SUM_DIGITS)).cast("int").alias("predicted_units"),
            F.coalesce("missed_units", F.lit(0)).alias("missed_units"),
            "category",
            F.try_element_at(queue_of, F.col("category")).alias("queue"),
        )
    )


def open_items(queue: DataFrame, done: DataFrame) -> DataFrame:
    """The queue without acknowledged items."""
    return queue.join(done, ["store_id", "item_id"], "left_anti")


def completed_items(queue: DataFrame, done: DataFrame) -> DataFrame:
    return queue.join(done, ["store_id", "item_id"], "left_semi")
