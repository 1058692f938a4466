from datetime import date, datetime

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from slotcast.operators import plan, quality

MENU = "item_id string, category string, time_of_day string, active boolean, added date"
PROFILE = (
    "store_id string, item_id string, slot_index int, sale_hour int, avg_slot_quantity double, "
    "sample_size bigint, days_observed bigint"
)
FEATURES = "store_id string, item_id string, category string, slot_index int, days_observed bigint, sample_size bigint"


@pytest.fixture(scope="module")
def stores(make):
    return make(
        [("s", "north", "24/7"), ("t", "south", "5am-11pm")], "store_id string, region string, hours string"
    )


@pytest.fixture(scope="module")
def menu(make):
    return make(
        [
            ("early", "side", "breakfast", True, "2024-01-01"),
            ("any", "side", "all_day", True, "2024-01-01"),
            ("gone", "side", "all_day", False, "2024-01-01"),
            ("later", "side", "all_day", True, "2024-03-01"),
        ],
        MENU,
    )


def test_grid(stores, menu):
    grid = plan.store_item_slot_grid(stores, menu, date(2024, 2, 1))
    counts = {tuple(r)[:2]: r["count"] for r in grid.groupBy("store_id", "item_id").count().collect()}
    assert counts == {("s", "early"): 224, ("t", "early"): 224, ("s", "any"): 672, ("t", "any"): 672}
    hours = grid.filter("item_id = 'early'").agg(
        F.min((F.col("slot_index") % 96) / 4), F.max(F.floor((F.col("slot_index") % 96) / 4))
    )
    assert tuple(hours.first()) == (4.0, 11)


def test_item_added_on_the_day_counts(stores, menu):
    items = plan.store_item_slot_grid(stores, menu, date(2024, 3, 1)).select("item_id").distinct()
    assert {r.item_id for r in items.collect()} == {"early", "any", "later"}


def test_routes(make):
    rows = [
        ("s", "a", "side", 0, 13, 5), ("s", "a", "side", 1, 14, 5), ("s", "a", "side", 2, 15, 5),
        ("s", "a", "side", 3, 14, 0), ("s", "a", "side", 4, 13, 0),
        ("s", "new", "side", 5, 20, 5), ("s", "new", "side", 6, 20, 0),
    ]
    vocab = make([("a",), ("a",)], "item_id string")
    routed = as_dicts(plan.route_rows(make(rows, FEATURES), vocab), "slot_index")
    assert [r["route"] for r in routed] == ["cold", "warm", "warm", "zero", "cold", "cold", "zero"]


def test_plan_keeps_every_row(make, stores, menu):
    profile = make(
        [("s", "any", 40, 10, 2.5, 3, 20), ("t", "any", 41, 10, 1.0, 1, 5), ("s", "early", 41, 10, 7.0, 9, 30)],
        PROFILE,
    )
    cold = make([("side", 41, 4.0)], "category string, slot_index int, avg_slot_quantity double")
    ratio = make([("s", 0.5), ("t", 1.5)], "store_id string, traffic_ratio double")
    grid = plan.store_item_slot_grid(stores, menu, date(2024, 2, 1))
    made = plan.production_plan(stores, menu, profile, cold, ratio, date(2024, 2, 1))
    assert quality.row_count_invariant(grid, made).first().holds
    units = {
        (r.store_id, r.item_id, r.slot_index): r.predicted_units
        for r in made.filter("predicted_units > 0").collect()
    }
    # s/any is established; t/any and t/early are not; s/early sells at that slot only.
    assert units == {
        ("s", "any", 40): 2.5, ("s", "early", 41): 7.0, ("t", "any", 41): 6.0, ("t", "early", 41): 6.0,
    }


def test_both_ways_to_complete_the_grid(make, stores, menu):
    # early sold at 13:00, outside its window: neither the slot nor its days count.
    profile = make(
        [("s", "any", 40, 10, 2.5, 3, 20), ("s", "early", 52, 13, 7.0, 9, 30), ("t", "early", 16, 4, 1.0, 2, 9),
         ("t", "early", 52, 13, 7.0, 9, 30), ("u", "any", 40, 10, 1.0, 1, 1)],
        PROFILE,
    )
    day = date(2024, 2, 1)
    two_steps = plan.complete_features(plan.store_item_slot_grid(stores, menu, day), profile)
    one_step = plan.grid_features(stores, menu, profile, day).select(*two_steps.columns)
    rows = sorted(map(tuple, one_step.collect()))
    assert rows == sorted(map(tuple, two_steps.collect()))
    assert {r[:2]: r[-1] for r in rows} == {
        ("s", "any"): 20, ("t", "any"): 0, ("s", "early"): 0, ("t", "early"): 9,
    }


def test_plan_with_weather_reaches_the_model(make, stores, menu):
    profile = make(
        [("s", "any", 40, 10, 2.5, 3, 20), ("t", "any", 40, 10, 2.5, 3, 20)], PROFILE
    )
    cold = make([("side", 41, 4.0)], "category string, slot_index int, avg_slot_quantity double")
    ratio = make([("s", 1.0), ("t", 1.0)], "store_id string, traffic_ratio double")
    weather = make([("north", 90.0, False), ("south", 30.0, True)], "region string, temp_f double, precip boolean")
    made = plan.production_plan(
        stores, menu, profile, cold, ratio, date(2024, 2, 1),
        model=lambda df: df.withColumn("predicted_units", F.col("temp_f") + F.col("precip")),
        weather_by_region=weather,
    )
    units = {r.store_id: r.predicted_units for r in made.filter("item_id = 'any' and slot_index = 40").collect()}
    assert units == {"s": 90.0, "t": 31.0}


def test_neutral_weather(make, stores):
    row = plan.attach_weather(stores).first()
    assert (row.temp_f, row.precip) == (62.5, 0)


def test_replenishment(make):
    ahead = make(
        [("s", i, 3.0) for i in "abc"] + [("s", "d", 3.01)],
        "store_id string, item_id string, predicted_units double",
    )
    on_hand = make(
        [("s", "a", 1, 1), ("s", "b", 1, 0), ("s", "d", 2, 0)],
        "store_id string, item_id string, on_shelf int, in_progress int",
    )

    def cooked(now):
        return [r["cook_qty"] for r in as_dicts(plan.replenishment(ahead, on_hand, now), "item_id")]

    # A gap of exactly 1 cooks nothing, 1.01 cooks two.
    assert cooked(datetime(2024, 1, 1, 12, 30)) == [0, 2, 3, 2]
    assert cooked(datetime(2024, 1, 1, 3, 0)) == [0, 2, 3, 2]
    assert cooked(datetime(2024, 1, 1, 3, 15)) == [0, 0, 0, 0]


def test_availability_and_open_hours(make, stores, menu):
    def at(hour):
        return {r.item_id for r in plan.available_items(menu, date(2024, 2, 1), hour).collect()}

    assert at(3) == {"any"} and at(4) == {"any", "early"} and at(12) == {"any"}
    hours = make([(s, h) for s in "st" for h in (0, 4, 5, 22, 23)], "store_id string, hour int")
    kept = {tuple(r) for r in plan.open_hours_filter(hours, stores).collect()}
    assert kept == {("s", h) for h in (0, 4, 5, 22, 23)} | {("t", 5), ("t", 22)}
    unknown = make([("unknown", 3)], "store_id string, hour int")
    assert plan.open_hours_filter(unknown, stores).count() == 1


def test_effective_price(make):
    menu = make(
        [("a", 3.0, 2.0, [2, 5]), ("b", 3.0, None, [2]), ("c", 3.0, 2.0, None)],
        "item_id string, price double, sale_price double, sale_days array<int>",
    )
    for day, expected in ((2, [2.0, 3.0, 3.0]), (3, [3.0, 3.0, 3.0])):
        rows = as_dicts(plan.effective_price(menu, day), "item_id")
        assert [r["effective_price"] for r in rows] == expected


def test_summary_and_top(make):
    made = make(
        [("s", "a", 0, 1.0), ("s", "b", 0, 4.0), ("t", "b", 1, 0.0), ("t", "c", 1, 2.0)],
        "store_id string, item_id string, slot_index int, predicted_units double",
    )
    assert tuple(plan.plan_summary(made).first()) == (4, 2, 3, 2, 1.75, 4.0)
    # b and c tie at 2.0.
    assert [r.item_id for r in plan.top_items(made, 2).collect()] == ["b", "c"]
