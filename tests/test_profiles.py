import pytest
from conftest import as_dicts

from slotcast.operators import profiles, staging, waste

SALES = "store_id string, item_id string, quantity int, price double, created_at timestamp_ntz"


def staged(make, rows):
    return staging.stage_sales(make(rows, SALES))


def test_staging_calendar(make):
    # 2024-01-07 is a Sunday.
    row = as_dicts(staged(make, [("s", "a", 1, 2.5, "2024-01-07 23:59:59.999")]))[0]
    assert (row["day_of_week"], row["sale_hour"], row["sale_minute"]) == (6, 23, 45)
    assert str(row["sale_15min"]) == "2024-01-07 23:45:00"


@pytest.mark.parametrize("zone", ["America/Chicago", "Asia/Kathmandu"])
def test_session_zone_does_not_shift_slots(spark, make, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # This hour does not exist in Chicago on that day.
        row = as_dicts(staged(make, [("s", "a", 1, 2.5, "2024-03-10 02:31:00")]))[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row["sale_hour"], row["sale_minute"], str(row["sale_15min"])) == (
        2, 30, "2024-03-10 02:30:00",
    )


def test_unsold_dates_count_in_the_mean(make):
    # Three Mondays of trade; item a sold on two of them, twice in one slot of the first.
    sales = staged(
        make,
        [
            ("s", "a", 2, 1.0, "2024-01-01 08:01:00"),
            ("s", "a", 1, 1.0, "2024-01-01 08:14:00"),
            ("s", "a", 3, 1.0, "2024-01-08 08:00:00"),
            ("s", "b", 1, 1.0, "2024-01-15 12:00:00"),
        ],
    )
    rows = as_dicts(profiles.time_of_day_profile(sales), "item_id")
    assert rows[0]["avg_slot_quantity"] == pytest.approx(2.0)
    assert (rows[0]["slot_index"], rows[0]["sample_size"], rows[0]["days_observed"]) == (32, 2, 2)
    assert rows[1]["avg_slot_quantity"] == pytest.approx(1 / 3)


def test_profile_from_stored_slots_is_the_same(make):
    sales = staged(
        make, [("s", i, q, 1.0, f"2024-01-{d:02d} 10:{q}0:00") for i in "ab" for q in (1, 2) for d in range(1, 16)]
    )
    direct = profiles.time_of_day_profile(sales)
    stored = profiles.profile_of_slots(profiles.slot_sales(sales))
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, stored.collect()))


def test_traffic_ratio(make):
    sales = staged(
        make, [("a", "x", 1, 1.0, "2024-01-01 08:00:00"), ("b", "x", 3, 1.0, "2024-01-01 08:00:00")]
    )
    for source in (sales, profiles.slot_sales(sales)):
        ratios = {r.store_id: r.traffic_ratio for r in profiles.store_traffic_ratio(source).collect()}
        assert ratios == {"a": 0.5, "b": 1.5}


def test_cold_start_drops_unknown_items(make):
    sales = staged(
        make,
        [(s, i, q, 1.0, "2024-01-01 08:00:00") for s, i, q in (("a", "x", 1), ("b", "x", 3), ("a", "?", 9))],
    )
    menu = make([("x", "side")], "item_id string, category string")
    rows = as_dicts(profiles.cold_start_profile(profiles.time_of_day_profile(sales), menu))
    assert [(r["category"], r["avg_slot_quantity"]) for r in rows] == [("side", 2.0)]


def test_latest_slot_and_rolling_windows(make):
    # Across midnight: slots 95 and 96 are neighbours, and so are 671 and 0.
    sales = staged(
        make,
        [
            ("s", "a", 1, 1.0, "2024-01-07 23:50:00"),
            ("s", "a", 2, 1.0, "2024-01-08 00:05:00"),
            ("s", "a", 4, 1.0, "2024-01-08 01:20:00"),
        ],
    )
    slots = profiles.slot_sales(sales)
    newest = as_dicts(profiles.latest_slot_per_item(slots, profiles.profile_of_slots(slots)))[0]
    assert (newest["slot_index"], newest["slot_quantity"], newest["day_of_week"]) == (5, 4, 0)
    assert newest["sample_size"] == 1
    rolling = as_dicts(profiles.rolling_slot_demand(slots), "sale_date", "slot_index")
    assert [(r["units_last_4"], r["units_last_8"]) for r in rolling] == [(1, 1), (3, 3), (4, 7)]


def test_waste_percentage_edges(make):
    sales = staged(
        make, [("s", "a", 4, 9.0, "2024-01-01 08:00:00"), ("s", "free", 1, 0.0, "2024-01-01 08:00:00")]
    )
    wasted = staging.stage_waste(
        make(
            [("s", i, 2, "2024-01-01 09:00:00") for i in ("a", "free", "unsold")],
            "store_id string, item_id string, quantity int, created_at timestamp_ntz",
        )
    )
    menu = make(
        [("a", "side", 5.0, 1.0), ("free", "side", 0.0, 1.0), ("unsold", "side", 5.0, 1.0)],
        "item_id string, category string, price double, cost double",
    )
    rows = {r["item_id"]: r for r in as_dicts(waste.waste_percentage(wasted, sales, menu))}
    assert set(rows) == {"a", "free"}
    assert rows["a"]["waste_percentage"] == pytest.approx(10.0)  # menu price, not the price paid
    assert rows["free"]["waste_percentage"] is None
