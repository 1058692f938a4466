"""Which supply met which demand, and what was sold, missed and wasted."""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from slotcast.constants import LIMITED_CLOSE_HOUR, LIMITED_HOURS, LIMITED_OPEN_HOUR
from slotcast.functions.prefix import units_before
from slotcast.functions.slots import floor_to_slot, midnight
from slotcast.session import shuffle_partitions

ITEM = ["store_id", "item_id"]
TICK = [*ITEM, "tick"]
UNITS_PER_BUCKET = 1024
MINUTES_PER_HOUR = 60


def _unit_ranges(side: DataFrame, id_name: str) -> DataFrame:
    """Number the units of each store and item in time order: [start, end) per row."""
    timed = (
        side.select(*ITEM, F.col("id").alias(id_name), F.col("at"), F.col("quantity").cast("bigint"))
        .filter(F.col("quantity") > 0)
        .withColumn("day", F.to_date("at"))
        .withColumn("quarter", floor_to_slot("at"))
    )
    return units_before(
        timed, ITEM, ["at", id_name], "quantity", ["day", "quarter"], "start"
    ).select(*ITEM, id_name, "start", (F.col("start") + F.col("quantity")).alias("end"))


def _clip(ranges: DataFrame, id_name: str, width: int) -> DataFrame:
    """Cut unit ranges at bucket borders: one row per range and bucket it touches."""
    first, last = F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width)
    low, high = F.col("bucket") * width, (F.col("bucket") + 1) * width
    return (
        ranges.withColumn("bucket", F.explode(F.sequence(first, last)))
        .withColumn("start", F.greatest("start", low))
        .withColumn("end", F.least("end", high))
        .select(*ITEM, "bucket", "start", "end", id_name)
    )


def fifo_allocate(
    supply: DataFrame, demand: DataFrame, units_per_bucket: int = UNITS_PER_BUCKET
) -> DataFrame:
    """Units of each supply row that each demand row takes, oldest first, without expiry.

    Both sides have (store_id, item_id, id, at, quantity). Numbering the units on each side turns
    FIFO into an overlap of ranges. Ranges are cut into buckets of units; inside a bucket, range
    ends of both sides are sorted together, and each stretch between two ends belongs to the next
    end of either side. Rows per bucket are bounded by its units, however many an item has in
    all, and no pairs are tried.
    """
    s = _clip(_unit_ranges(supply, "supply_id"), "supply_id", units_per_bucket)
    d = _clip(_unit_ranges(demand, "demand_id"), "demand_id", units_per_bucket)
    ends = s.drop("start").unionByName(d.drop("start"), allowMissingColumns=True)
    bucket = [*ITEM, "bucket"]
    merged = ends.groupBy(*bucket, "end").agg(
        F.max("supply_id").alias("supply_id"), F.max("demand_id").alias("demand_id")
    )
    # Downwards, the last end seen of either side is the one that a stretch belongs to.
    downwards = Window.partitionBy(*bucket).orderBy(F.desc("end"))
    so_far = downwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = F.coalesce(F.lead("end").over(downwards), F.col("bucket") * units_per_bucket)
    return (
        merged.select(
            *ITEM,
            (F.col("end") - below).alias("units"),
            F.last("supply_id", ignorenulls=True).over(so_far).alias("supply_id"),
            F.last("demand_id", ignorenulls=True).over(so_far).alias("demand_id"),
        )
        .dropna(subset=["supply_id", "demand_id"])
        .groupBy(*ITEM, "supply_id", "demand_id")
        .agg(F.sum("units").alias("units"))
    )


REPLAY_INPUT = [
    "store_id", "day", "item_id", "minute", "requested", "cooked", "opening",
    "cook_time", "hold_time", "hours",
]
COUNTS = ["requested", "cooked", "on_hand", "sold", "wasted", "left_over", "in_progress"]


class Shelf:
    """The batches of one item in one store; times are minutes on any fixed clock.

    Batches of an item are ready and expire in the order they were started, so both queues are
    read from the front.
    """

    def __init__(self, cook_minutes: float, hold_minutes: float, batches=(), cooking=()):
        self.cook_minutes, self.hold_minutes = cook_minutes, hold_minutes
        self.batches = deque([q, expires] for q, expires in batches)
        self.cooking = deque(tuple(batch) for batch in cooking)  # (quantity, ready, expires)
        self.on_hand = sum(q for q, _ in self.batches)
        self.in_progress = sum(batch[0] for batch in self.cooking)

    def holds_food(self) -> bool:
        return bool(self.on_hand or self.in_progress)

    def step(self, minute: int, requested: int, cooked: int) -> tuple | None:
        """One tick: promote, cook, sell, expire. Nothing to report without stock or events."""
        while self.cooking and self.cooking[0][1] <= minute:
            quantity, _, expires = self.cooking.popleft()
            self.batches.append([quantity, expires])
            self.in_progress -= quantity
            self.on_hand += quantity
        if cooked > 0:
            ready = minute + self.cook_minutes
            self.cooking.append((cooked, ready, ready + self.hold_minutes))
            self.in_progress += cooked
        before = self.on_hand
        if not (requested or cooked or before):
            return None
        wanted = sold = min(requested, before)
        while wanted > 0:
            taken = min(wanted, self.batches[0][0])
            self.batches[0][0] -= taken
            wanted -= taken
            if self.batches[0][0] == 0:
                self.batches.popleft()
        wasted = 0
        while self.batches and self.batches[0][1] <= minute:
            wasted += self.batches.popleft()[0]
        self.on_hand = before - sold - wasted
        return minute, requested, cooked, before, sold, wasted, self.on_hand, self.in_progress


def is_open(hours: str, minute_of_day: int) -> bool:
    hour = minute_of_day // MINUTES_PER_HOUR
    return hours != LIMITED_HOURS or LIMITED_OPEN_HOUR <= hour < LIMITED_CLOSE_HOUR


def _replay_store_days(rows: pd.DataFrame) -> pd.DataFrame:
    """All items of some whole store-days."""
    events, facts = defaultdict(dict), {}
    for store, day, item, minute, requested, cooked, opening, cook, hold, hours in zip(
        *(rows[c].tolist() for c in REPLAY_INPUT)
    ):
        key = store, day, item
        events[key][minute] = requested, cooked
        facts[key] = opening, cook, hold * MINUTES_PER_HOUR, hours
    open_ticks = {
        hours: [t for t in range(0, 24 * MINUTES_PER_HOUR, 15) if is_open(hours, t)]
        for hours in {fact[3] for fact in facts.values()}
    }
    out = []
    for key, (opening, cook, hold, hours) in facts.items():
        shelf = Shelf(cook, hold, [(opening, hold)] if opening > 0 else [])
        of_item = events[key]
        for tick in open_ticks[hours]:
            if tick in of_item or shelf.holds_food():
                counts = shelf.step(tick, *of_item.get(tick, (0, 0)))
                if counts is not None:
                    out.append((*key, *counts))
    return pd.DataFrame(out, columns=["store_id", "day", "item_id", "minute", *COUNTS])


def _replay_partition(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches sorted by store and day; the last store-day of a batch waits for the next batch."""
    waiting = None
    for rows in batches:
        if waiting is not None:
            rows = pd.concat([waiting, rows], ignore_index=True)
        last = rows.iloc[-1]
        open_day = (rows["store_id"] == last["store_id"]) & (rows["day"] == last["day"])
        waiting = rows[open_day]
        if not open_day.all():
            yield _replay_store_days(rows[~open_day])
    if waiting is not None:
        yield _replay_store_days(waiting)


def replay_ticks(
    demand: DataFrame,
    cook_orders: DataFrame,
    items: DataFrame,
    stores: DataFrame,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Stock of every store, item and day, tick by tick; each day starts from ``opening``.

    ``demand`` and ``cook_orders`` have (store_id, item_id, at, quantity), ``opening`` has
    (store_id, item_id, day, quantity) with food made at midnight. What is sold in a tick depends
    on the units requested, not on the single requests, so both logs are summed to ticks before
    they are spread by store and day: a store-day holds at most 96 rows per item. Food that is neither sold nor
    expired by the last tick stays in ``left_over`` or ``in_progress``. Ticks outside opening
    hours do not run; requests in them are neither sold nor missed.
    """
    key = [*ITEM, "day", "tick"]

    def per_tick(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(
            *ITEM, F.to_date("at").alias("day"), floor_to_slot("at").alias("tick")
        ).agg(F.sum("quantity").cast("bigint").alias(name))

    both = per_tick(demand, "requested").join(per_tick(cook_orders, "cooked"), key, "full_outer")
    if opening is None:
        seeded = both.withColumn("opening", F.lit(0).cast("bigint"))
    else:
        seeds = opening.groupBy(*ITEM, "day").agg(F.sum("quantity").cast("bigint").alias("opening"))
        seeded = both.join(seeds, [*ITEM, "day"], "full_outer").withColumn(
            "tick", F.coalesce("tick", midnight("day"))
        )
    ticks = (
        seeded.fillna(0, ["requested", "cooked", "opening"])
        .join(items.select("item_id", "cook_time", "hold_time"), "item_id")
        .join(stores.select("store_id", "hours"), "store_id")
        .withColumn("minute", F.hour("tick") * MINUTES_PER_HOUR + F.minute("tick"))
        .select(*REPLAY_INPUT)
    )
    kind = {f.name: f.dataType.simpleString() for f in ticks.schema}
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    replayed = (
        # A number of partitions of its own: the work per byte is too high to merge small ones.
        ticks.repartition(shuffle_partitions(ticks.sparkSession), "store_id", "day")
        .sortWithinPartitions("store_id", "day")
        .mapInPandas(
            _replay_partition,
            f"store_id {kind['store_id']}, day date, item_id {kind['item_id']}, minute int, {counts}",
        )
    )
    into_day = F.make_dt_interval(F.lit(0), F.lit(0), F.col("minute"))
    return replayed.select(*ITEM, "day", (midnight("day") + into_day).alias("tick"), *COUNTS)


def _queued(demand: DataFrame) -> DataFrame:
    """Requests with their tick and the units requested before them in that tick."""
    timed = (
        demand.select(*ITEM, "id", "at", F.col("quantity").cast("bigint"))
        .filter(F.col("quantity") > 0)
        .withColumn("tick", floor_to_slot("at"))
        .withColumn("second", F.minute("at") * 60 + F.second("at"))
    )
    return units_before(timed, TICK, ["at", "id"], "quantity", ["second"], "before")


def missed_requests(demand: DataFrame, ticks: DataFrame) -> DataFrame:
    """Requests that found nothing on the shelf: (store_id, item_id, id, tick, quantity).

    A request that is filled in part counts as sold, and its rest is not missed. A request is
    missed if the earlier requests of its tick already took all that was on hand.
    """
    return (
        _queued(demand)
        .join(ticks.select(*TICK, "on_hand"), TICK)
        .filter(F.col("before") >= F.col("on_hand"))
        .select(*ITEM, "id", "tick", "quantity")
    )


def inventory_replay(
    demand: DataFrame,
    cook_orders: DataFrame,
    items: DataFrame,
    stores: DataFrame,
    opening: DataFrame | None = None,
) -> DataFrame:
    """:func:`replay_ticks` with the units of missed requests per tick.

    Requests meet their tick once and are summed where they meet, so the replay runs once.
    """
    ticks = replay_ticks(demand, cook_orders, items, stores, opening)
    missed = F.when(F.col("before") >= F.col("on_hand"), F.col("_quantity")).otherwise(0)
    queued = _queued(demand).select(*TICK, "before", F.col("quantity").alias("_quantity"))
    return (
        ticks.join(queued, TICK, "left")
        .groupBy(*ticks.columns)
        .agg(F.sum(missed).alias("stockouts"))
    )
