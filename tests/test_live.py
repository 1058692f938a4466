import random
import re
from datetime import datetime

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from slotcast.operators import live

MENU = "item_id string, category string, cost double, hold_time double"
PRED = "store_id string, item_id string, slot_index int, predicted_units double"
SALES = "store_id string, item_id string, quantity int, price double, created_at timestamp_ntz"
WASTE = "store_id string, item_id string, quantity int, created_at timestamp_ntz"
STOCKOUTS = "store_id string, item_id string, quantity_requested int, created_at timestamp_ntz"


def clocks_of(make, kind):
    # A Sunday, slot 670.
    if kind == "literal":
        return datetime(2024, 1, 7, 23, 31)
    if kind == "one row":
        return make([("2024-01-07 23:31:00",)], "now timestamp_ntz")
    return make([("s", "2024-01-07 23:31:00")], "store_id string, now timestamp_ntz")


@pytest.fixture(params=["literal", "one row", "stores"])
def now(request, make):
    return clocks_of(make, request.param)


def test_look_ahead_wraps_the_ring(make, now):
    pred = make([("s", "a", i, float(10**k)) for k, i in enumerate((669, 670, 671, 0, 1, 2, 3, 4))], PRED)
    menu = make([("a", "side", 1.0, 1.5)], MENU)
    rows = as_dicts(live.lookahead_demand(pred, menu, now))
    assert rows[0]["predicted_units"] == 1111110.0


def test_look_ahead_longer_than_a_week_counts_slots_again(make):
    pred = make([("s", "a", 670, 1.0), ("s", "a", 0, 10.0)], PRED)
    menu = make([("a", "side", 1.0, 168.25)], MENU)  # 673 slots
    rows = as_dicts(live.lookahead_demand(pred, menu, clocks_of(make, "stores")))
    assert rows[0]["predicted_units"] == 12.0


def test_queue_rounds_half_to_even(make, now):
    pred = make([("s", "a", 670, 2.5), ("s", "b", 670, 3.5), ("s", "c", 670, 1.2)], PRED)
    menu = make([("a", "side", 1.0, 2.0), ("b", "chicken", 1.0, 2.0), ("c", "other", 1.0, 2.0)], MENU)
    stockouts = make(
        [("s", "a", 2, "2024-01-07 00:00:00"), ("s", "a", 3, "2024-01-08 01:00:00"),
         ("s", "a", 9, "2024-01-06 23:59:59")],
        STOCKOUTS,
    )
    rows = as_dicts(live.production_queue(pred, stockouts, menu, now), "item_id")
    assert [(r["predicted_units"], r["missed_units"], r["queue"]) for r in rows] == [
        (2, 5, "Kitchen"), (4, 0, "Chicken"), (1, 0, None),
    ]


def test_waste_today_keeps_either_side(make, now):
    sales = make(
        [("s", "a", 2, 3.0, "2024-01-07 08:00:00"), ("s", "a", 1, 2.0, "2024-01-07 09:00:00"),
         ("s", "a", 5, 3.0, "2024-01-06 08:00:00")],
        SALES,
    )
    wasted = make([("s", "b", 4, "2024-01-07 08:00:00"), ("s", "?", 1, "2024-01-07 08:00:00")], WASTE)
    menu = make([("a", "side", 0.5, 2.0), ("b", "chicken", 0.25, 2.0)], MENU)
    summary = live.waste_summary_today(sales, wasted, menu, now)
    rows = {r["item_id"]: r for r in as_dicts(summary)}
    assert (rows["a"]["sale_quantity"], rows["a"]["sale_revenue"], rows["a"]["waste_cost"]) == (3, 8.0, 0.0)
    assert (rows["b"]["sale_quantity"], rows["b"]["waste_cost"]) == (0, 1.0)
    assert rows["?"]["waste_cost"] is None
    kpis = {r["category_group"]: r for r in as_dicts(live.category_group_kpis(summary))}
    assert kpis["hot_foods"] == {
        "store_id": "s", "category_group": "hot_foods", "units": 3, "revenue": 8.0, "waste_pct": 0.0,
    }
    for group in ("chicken", "roller_grill"):
        assert (kpis[group]["units"], kpis[group]["revenue"], kpis[group]["waste_pct"]) == (0, None, None)


def test_each_store_has_its_own_day(make):
    stockouts = make([(s, "a", 1, "2024-01-06 12:00:00") for s in "xy"], STOCKOUTS)
    clocks = make(
        [("x", "2024-01-06 13:00:00"), ("y", "2024-01-07 01:00:00")], "store_id string, now timestamp_ntz"
    )
    rows = as_dicts(live.missed_units_today(stockouts, clocks))
    assert rows == [{"store_id": "x", "item_id": "a", "missed_units": 1}]


def test_acknowledged_items(make):
    queue = make([("s", "a"), ("s", "b")], "store_id string, item_id string")
    done = make([("s", "b"), ("t", "a")], "store_id string, item_id string")
    assert [r.item_id for r in live.open_items(queue, done).collect()] == ["a"]
    assert [r.item_id for r in live.completed_items(queue, done).collect()] == ["b"]


def test_sim_now_of_a_store(make):
    sales = make([(s, "a", 1, 1.0, f"2024-01-0{d} 00:00:00") for d, s in ((1, "x"), (2, "y"))], SALES)
    assert str(live.sim_now(sales, "x").first().now) == "2024-01-01 00:00:00"
    assert str(live.sim_now(sales).first().now) == "2024-01-02 00:00:00"


@pytest.mark.parametrize("seed", range(3))
def test_lookahead_from_running_sums(spark, make, tmp_path, seed):
    draw = random.Random(seed)
    pred = make(
        [(f"s{s}", f"i{i}", k, draw.random()) for s in range(3) for i in range(5) for k in range(672) if draw.random() < 0.1]
        + [("s0", "lone", 671, 2.0), ("s0", "none", 300, 1.0), ("gone", "i0", 3, 1.0)],
        "store_id string, item_id string, slot_index int, predicted_units double",
    )
    # From nothing to more than two weeks.
    hold = {"i0": 0.2, "i1": 1.5, "i2": 100.0, "i3": 168.0, "i4": 400.25, "lone": 4.0, "none": 1.0}
    menu = make(list(hold.items()), "item_id string, hold_time double")
    now = make(
        [("s0", "2024-01-07 23:50:00"), ("s1", "2024-01-08 00:00:00"), ("s2", "2024-01-10 13:20:00")],
        "store_id string, now timestamp_ntz",
    )
    live.publish_lookahead(pred, str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    found = {(r.store_id, r.item_id): r.predicted_units for r in live.lookahead_of_index(index, menu, now).collect()}
    want = {(r.store_id, r.item_id): r.predicted_units for r in live.lookahead_demand(pred, menu, now).collect()}
    assert found.keys() == want.keys() and len(want) > 10
    assert all(abs(found[k] - want[k]) < 1e-9 for k in want)
    # Where all stores have one clock, an item has two rows of the scan, or one if its window is empty.
    one = now.withColumn("now", F.lit("2024-01-08 10:00:00").cast("timestamp_ntz"))
    used = menu.filter("item_id IN ('i1')")
    df = live.lookahead_of_index(index, used, one)
    scanned = re.search(r"PushedFilters: \[.*?In\(slot_index, \[([\d,]+)\]", df._jdf.queryExecution().toString())
    assert len(scanned[1].split(",")) == 2
    assert index.filter(f"slot_index IN ({scanned[1]})").count() == 2 * pred.select("store_id", "item_id").distinct().count()
