"""What the plans must look like to hold at scale."""

import re

import pytest

from slotcast.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def physical(spark):
    """The physical plan of a query as text, without adaptive changes and broadcasts."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield lambda name: QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(
    "name, scans",
    [
        ("time_of_day_profile", 1),
        ("cold_start_profile", 1),
        ("store_traffic_ratio", 1),
        ("latest_slot_per_item", 1),
        ("rolling_slot_demand", 1),
        ("training_features", 1),
        ("weather_impact", 1),
        ("waste_percentage", 2),  # sales and waste
        ("fifo_allocate", 2),  # supply and demand
        ("production_plan", 2),  # sales, and the clock
    ],
)
def test_each_log_is_scanned_once(physical, name, scans):
    assert physical(name).count("FileScan parquet") == scans


def test_no_query_multiplies_rows_in_a_cross_join(physical):
    for name in ("production_plan", "training_features", "fifo_allocate", "lookahead_demand", "waste_summary_today"):
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", physical(name)), name


def test_filters_and_columns_reach_the_scan(physical):
    plan = physical("store_clocks")
    assert "PushedFilters: [" in plan and "In(event_type" in plan
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>", plan)


def test_todays_bound_reaches_the_scan(physical):
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(created_at,", physical("missed_units_today"))


@pytest.mark.parametrize("name", ["production_queue", "waste_summary_today", "replenishment", "open_items"])
def test_read_outs_of_today_read_no_other_day(spark, name):
    files = QUERIES[name](spark, SF).inputFiles()
    assert files and not any("events.parquet" in f for f in files)  # no look at the whole sales log
    clocks = {str(r.now.date()) for r in QUERIES["committed_clocks"](spark, SF).collect()}
    of_log = {(f.split("/event_date=")[0].split("/")[-1], f.split("event_date=")[1][:10]) for f in files if "event_date=" in f}
    assert of_log and all(day in clocks if kind == "sales" else day >= min(clocks) for kind, day in of_log)


def test_sums_are_combined_before_the_shuffle(physical):
    for name in ("slot_sales", "stockout_summary", "latest_slot_per_item", "waste_percentage"):
        first = physical(name).split("FileScan parquet")[0]
        assert "partial_" in first, name
        assert "SortAggregate" not in first, name


def test_the_plan_that_runs_shuffles_the_grid_by_store_and_item(spark):
    out = QUERIES["production_plan"](spark, SF)
    out.collect()  # the adaptive plan is final once it has run
    final = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", final)
    for keys in re.findall(r"hashpartitioning\(([^)]*)\)", final):
        names = {re.sub(r"#.*", "", k.strip()) for k in keys.split(",")[:-1]}
        assert names not in ({"sale_hour"}, {"category", "slot_index"}), keys
