"""Stock of every store and item, kept while requests and cook orders stream in."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from slotcast.functions.slots import from_event_time, to_event_time
from slotcast.operators.inventory import COUNTS, MINUTES_PER_HOUR, Shelf, is_open

ITEM = ["store_id", "item_id"]
TICK = 15
DAY = 24 * MINUTES_PER_HOUR
MS_PER_MINUTE = 60_000


def _next_tick(memory: dict, shelf: Shelf) -> int | None:
    """The next tick with anything to do: an event, or any tick while there is food."""
    waiting = [int(t) for t in memory["events"]]
    if shelf.holds_food():
        waiting.append(memory["done"] + TICK)
    return min(waiting, default=None)


def _combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sum events to ticks before they are shuffled, so that a hot item sends few rows."""
    for rows in frames:
        yield rows.groupby([*ITEM, "minute"], as_index=False).agg(
            {"newest": "max", "requested": "sum", "cooked": "sum"}
        )[list(rows.columns)]


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Take in new events, and run the ticks that the watermark has closed, in order.

    The state holds the batches, and per tick the units of events that wait for the watermark.
    """
    memory = json.loads(state.get[0]) if state.exists else {
        "done": None, "events": {}, "batches": [], "cooking": [], "facts": None,
    }
    closed = state.getCurrentWatermarkMs() // MS_PER_MINUTE
    for rows in frames:
        for tick, requested, cooked, *facts in zip(
            *(rows[c].tolist() for c in ("minute", "requested", "cooked", "cook_time", "hold_time", "hours"))
        ):
            memory["facts"] = facts
            if memory["done"] is None or tick > memory["done"]:
                units = memory["events"].setdefault(str(tick), [0, 0])
                units[0] += requested
                units[1] += cooked
    cook, hold, hours = memory["facts"]
    shelf = Shelf(cook, hold * MINUTES_PER_HOUR, memory["batches"], memory["cooking"])
    out = []
    tick = _next_tick(memory, shelf)
    while tick is not None and tick + TICK <= closed:
        units = memory["events"].pop(str(tick), (0, 0))
        if is_open(hours, tick % DAY):
            counts = shelf.step(tick, *units)
            if counts is not None:
                out.append((*key, *counts))
        memory["done"] = tick
        tick = _next_tick(memory, shelf)
    if tick is None:
        state.remove()
    else:
        memory["batches"], memory["cooking"] = list(shelf.batches), list(shelf.cooking)
        state.update((json.dumps(memory),))
        state.setTimeoutTimestamp((tick + TICK) * MS_PER_MINUTE)
    yield pd.DataFrame(out, columns=[*ITEM, "minute", *COUNTS])


def stream_inventory(
    events: DataFrame, items: DataFrame, stores: DataFrame, delay: str = "15 minutes"
) -> DataFrame:
    """Ticks of every store and item, without daily resets, as the watermark closes them.

    ``events`` has (store_id, item_id, kind, at, quantity) with kind ``demand`` or ``cook``. The
    order inside a tick is that of the batch replay. Events are summed to ticks before the shuffle,
    and a key's state is its food and the sums of the ticks still open, whatever the number of
    events.
    """
    units = F.col("quantity").cast("bigint")
    micros = F.unix_micros(to_event_time("at"))
    clocked = events.select(
        *ITEM,
        micros.alias("newest"),
        (F.floor(micros / (MS_PER_MINUTE * 1000 * TICK)) * TICK).alias("minute"),
        F.when(F.col("kind") == "demand", units).otherwise(0).alias("requested"),
        F.when(F.col("kind") == "cook", units).otherwise(0).alias("cooked"),
    )
    prepared = (
        clocked.mapInPandas(_combine, clocked.schema)
        .withColumn("event_time", F.timestamp_micros("newest"))
        .withWatermark("event_time", delay)
        .join(items.select("item_id", "cook_time", F.col("hold_time").cast("double")), "item_id")
        .join(stores.select("store_id", "hours"), "store_id")
    )
    ids = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prepared.select(*ITEM).schema)
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    ticks = prepared.groupBy(*ITEM).applyInPandasWithState(
        _advance,
        f"{ids}, minute bigint, {counts}",
        "memory string",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    tick = from_event_time(F.timestamp_seconds(F.col("minute") * 60))
    return ticks.select(*ITEM, tick.alias("tick"), *COUNTS)
