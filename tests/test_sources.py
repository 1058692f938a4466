import uuid
from datetime import date, datetime

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from slotcast.catalog import mapping as m
from slotcast.operators import scoring
from slotcast.plans import forecast
from slotcast.plans.marts import build_marts
from slotcast.schemas import MENU, SALES
from slotcast.sources import dims, events, results, tables

SF = "/root/testdata/sf0.001"
LOG = (
    "kind string, store_id string, item_id string, quantity int, quantity_requested int, "
    "price double, created_at timestamp_ntz"
)


@pytest.fixture
def schema(spark, tmp_path):
    name = "t_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{tmp_path}/{name}'")
    return name


@pytest.fixture
def log(make):
    return make(
        [("sales", "s", "a", 1, None, 2.5, "2024-01-01 10:00:00"),
         ("sales", "s", "a", 2, None, 2.5, "2024-01-02 10:00:00"),
         ("sales", "s", "a", 4, None, 2.5, "2024-01-02 11:00:00"),
         ("sales", "s", "a", 8, None, 2.5, "2024-01-03 09:00:00"),
         ("waste", "s", "a", 3, None, None, "2024-01-02 12:00:00"),
         ("stockouts", "s", "a", None, 5, None, "2024-01-03 10:00:00")],
        LOG,
    )


def test_flushes_are_repeatable(spark, log, tmp_path):
    path = str(tmp_path / "log")
    for epoch in (0, 1, 1):
        events.append_events(log, epoch, path)
    sales = events.read_events(spark, path, "sales")
    assert sales.schema.fieldNames() == SALES.fieldNames()
    assert sales.agg(F.sum("quantity")).first()[0] == 30
    recent = events.read_events(spark, path, "sales", since=datetime(2024, 1, 2, 11))
    assert sorted(r.quantity for r in recent.collect()) == [4, 4, 8, 8]
    assert "PartitionFilters: [isnotnull(event_date" in recent._jdf.queryExecution().toString()
    assert events.read_events(spark, path, "waste").first().reason is None
    assert events.read_events(spark, path, "stockouts").first().quantity_requested == 5
    # All flushes of a day share its folder.
    assert sorted(p.name for p in (tmp_path / "log" / "sales").glob("event_date=*")) == [
        f"event_date=2024-01-0{d}" for d in (1, 2, 3)
    ]


def test_a_flush_without_commit_is_not_read(spark, log, make, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    events.append_events(log, 0, path)

    def fail(*args):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as patched:
        patched.setattr(events.commits, "commit", fail)
        with pytest.raises(RuntimeError):
            events.append_events(log, 1, path)
    assert events.read_events(spark, path, "sales").count() == 4
    events.append_events(log, 1, path)  # the retry
    assert events.read_events(spark, path, "sales").agg(F.sum("quantity")).first()[0] == 30
    later = make([("sales", "t", "a", 16, None, 2.5, "2024-01-04 08:00:00"), ("sales", "t", "a", 1, None, 1.0, None)], LOG)
    events.append_events(later, 2, path)
    assert events.read_events(spark, path, "sales").agg(F.sum("quantity")).first()[0] == 47
    assert as_dicts(events.read_clocks(spark, path), "store_id") == [
        {"store_id": "s", "now": datetime(2024, 1, 3, 9)}, {"store_id": "t", "now": datetime(2024, 1, 4, 8)},
    ]


def test_compaction_keeps_rows_clocks_and_epochs(spark, log, tmp_path):
    path = str(tmp_path / "log")
    assert events.read_events(spark, path, "sales").count() == 0
    for epoch in range(4):
        events.append_events(log, epoch, path)

    def state():
        sales = events.read_events(spark, path, "sales")
        rows = sorted((r.created_at, r.quantity) for r in sales.collect())
        return rows, len(sales.inputFiles()), as_dicts(events.read_clocks(spark, path), "store_id")

    rows, n_files, clocks = state()
    planned = events.read_events(spark, path, "sales")
    events.compact_events(spark, path, date(2024, 1, 3))
    assert planned.count() == 16  # its files are still there
    compacted = state()
    assert compacted[0] == rows and compacted[2] == clocks and (n_files, compacted[1]) == (12, 6)
    events.remove_replaced(spark, path)
    events.append_events(log, 3, path)  # a repeat is known after the compaction too
    assert state() == compacted
    events.append_events(log, 4, path)
    assert events.read_events(spark, path, "waste").count() == 5
    events.compact_events(spark, path, date(2024, 1, 5))
    assert state()[1] == 3 and len(state()[0]) == 20


@pytest.mark.parametrize(
    "cutoff, left",
    [("2024-01-02 11:00:00", {1, 2}), ("2024-01-02", {1}), ("2024-01-02 10:00:00", {1}),
     ("2024-01-02 00:00:00", {1}), ("2027-01-01", {1, 2, 4, 8}), ("2023-01-01", set())],
)
def test_delete_from_cutoff(spark, schema, log, cutoff, left):
    events.ensure_tables(spark, schema)
    events.ensure_tables(spark, schema)
    names = [f"{schema}.sales_events", f"{schema}.waste_log"]
    for kind, name in zip(("sales", "waste"), names):
        events.insert_events(log.filter(F.col("kind") == kind), kind, name)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for _ in range(2):  # a repeated run changes nothing
        events.delete_from_cutoff(spark, names, cutoff)
        assert {r.quantity for r in spark.table(names[0]).collect()} == left
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_union_stores(make):
    a = make([("x", 1)], "item_id string, quantity int")
    b = make([(2, "y", 0.5)], "quantity int, item_id string, price double")
    rows = as_dicts(events.union_stores({"s": a, "t": b}), "store_id")
    assert [(r["store_id"], r["item_id"], r["quantity"], r["price"]) for r in rows] == [
        ("s", "x", 1, None), ("t", "y", 2, 0.5),
    ]


def test_dimension_files(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("store_id,name,region,level,hours,active\ns,S,north,2,24/7,True\n")
    (tmp_path / "menu_items.csv").write_text(
        "item_id,name,price,sale_price,sale_days,cost,time_of_day,category,hold_time,popularity,active,added\n"
        'A,Item A,2.99,1.99,"[2, 5]",1.20,all_day,sandwich,2,5,True,2024-01-01\n'
        "B,Item B,3.29,,,1.30,breakfast,sandwich,2.5,5,False,2024-01-01\n"
    )
    (tmp_path / "weather_daily.csv").write_text("region,sale_date,temp_f,precip\nnorth,2026-05-20,30.5,True\n")
    read = dims.read_dims_csv(spark, str(tmp_path))
    menu = as_dicts(read["menu_items"], "item_id")
    assert menu[0]["sale_days"] == [2, 5] and menu[1]["sale_days"] is None
    assert menu[0]["active"] and not menu[1]["active"] and menu[1]["sale_price"] is None
    assert read["weather_daily"].first().precip and read["stores"].first().level == 2


def test_dimension_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("name,store_id,hours,extra,region,level,active\nS,s,24/7,x,north,2,True\n")
    (tmp_path / "menu_items.csv").write_text("name,item_id\nItem,A\n")
    (tmp_path / "weather_daily.csv").write_text("sale_date,precip,region,temp_f\n2026-05-20,True,north,30.5\n")
    with pytest.raises(ValueError, match="menu_items.csv has no column"):
        dims.read_dims_csv(spark, str(tmp_path))
    (tmp_path / "menu_items.csv").write_text(
        "name,item_id,added,active,popularity,hold_time,category,time_of_day,cost,sale_days,sale_price,price\n"
        'Item,A,2024-01-01,True,5,2,side,all_day,1.20,"[2, 5]",,2.99\n'
    )
    read = dims.read_dims_csv(spark, str(tmp_path))
    assert read["stores"].first().store_id == "s" and read["stores"].first().level == 2
    assert read["weather_daily"].first().region == "north" and read["weather_daily"].first().temp_f == 30.5
    assert read["menu_items"].first().price == 2.99 and read["menu_items"].first().sale_days == [2, 5]


def test_delete_keeps_events_without_a_time(spark, schema, make):
    events.ensure_tables(spark, schema)
    rows = [("sales", "s", "a", 1, None, 2.5, "2024-01-01 10:00:00"), ("sales", "s", "a", 2, None, 2.5, None),
            ("sales", "s", "a", 4, None, 2.5, "2024-01-03 10:00:00")]
    events.insert_events(make(rows, LOG), "sales", f"{schema}.sales_events")
    events.delete_from_cutoff(spark, [f"{schema}.sales_events", f"{schema}.waste_log"], "2024-01-02")
    assert {r.quantity for r in spark.table(f"{schema}.sales_events").collect()} == {1, 2}


def test_store_folders_are_read_as_they_are(spark, make, tmp_path):
    path = str(tmp_path / "stores")
    make([("x", 1)], "item_id string, quantity int").write.parquet(f"{path}/store_id=s")
    make([("y", 2, 0.5)], "item_id string, quantity int, price double").write.parquet(f"{path}/store_id=t9")
    rows = as_dicts(events.read_store_folders(spark, path), "store_id")
    assert [(r["store_id"], r["item_id"], r["price"]) for r in rows] == [("s", "x", None), ("t9", "y", 0.5)]


def test_dimension_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "menu.yaml").write_text(
        "items:\n  - id: A\n    name: Item A\n    price: 3\n    sale_price: 1.99\n    sale_days: [2, 5]\n"
        "    cost: 1.2\n    time_of_day: all_day\n    category: side\n    hold_time: 2\n    cook_time: 10\n"
        "    popularity: 5\n    batch: 4\n    active: true\n    added: 2024-01-01\n"
        "  - id: B\n    price: 3.5\n    active: false\n    added: '2024-02-01'\n"
    )
    (tmp_path / "stores.yaml").write_text(
        "stores:\n  - id: s\n    name: S\n    region: north\n    level: 4\n    hours: 5am-11pm\n    active: true\n"
    )
    read = dims.read_dims_yaml(spark, str(tmp_path))
    assert read["menu"].schema == MENU
    a, b = read["menu"].orderBy("item_id").collect()
    assert (a.price, a.hold_time, a.sale_days, str(a.added)) == (3.0, 2.0, [2, 5], "2024-01-01")
    assert (b.category, str(b.added)) == (None, "2024-02-01")
    assert read["stores"].first().store_id == "s"


def test_daily_results_replace_a_repeated_day(spark, make, tmp_path):
    def day(date, sold):
        return make(
            [(date, arm, sold, 1, 1, 1.0, 10.0) for arm in ("ml", "baseline")],
            "date date, arm string, units_sold bigint, stockouts bigint, units_wasted bigint, "
            "waste_cost double, sales_revenue double",
        )

    path = str(tmp_path / "daily")
    for frame in (day("2024-01-01", 9), day("2024-01-02", 5), day("2024-01-02", 19)):
        results.append_daily_result(frame, path)
    totals = scoring.cumulative(results.read_daily_results(spark, path)).first()
    assert (totals.days_run, totals.ml_avg_service_level) == (2, 92.5)


def test_csv_sink(spark, make, tmp_path):
    weather = make([("north", "2024-01-01", 30.5, True)], "region string, sale_date date, temp_f double, precip boolean")
    dims.write_csv(weather, str(tmp_path / "w"))
    assert spark.read.csv(str(tmp_path / "w"), header=True, schema=weather.schema).first() == weather.first()


def test_layers(spark, make, tmp_path):
    df = make([(1,)], "x int")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS METRICS LOCATION '{tmp_path}/metrics'")
    assert tables.layer_schema("marts") == "MARTS" and tables.layer_schema(None, "base") == "base"
    assert tables.materialize(spark, df, "staging", "some_view").first().x == 1
    for _ in range(2):
        assert tables.materialize(spark, df, "metrics", "some_table").first().x == 1
    kinds = {t.name: t.isTemporary for t in spark.catalog.listTables("METRICS")}
    assert kinds["some_view"] and not kinds["some_table"]
    spark.sql("DROP SCHEMA METRICS CASCADE")


def test_store_scan_reaches_parquet(spark, schema, make):
    plan = make(
        [(s, "a", i, 1.0) for s in "rst" for i in range(3)],
        "store_id string, item_id string, slot_index int, predicted_units double",
    )
    tables.overwrite_table(plan, f"{schema}.predictions", ["store_id", "slot_index"])
    scan = tables.scan_store_predictions(spark, "s", f"{schema}.predictions")
    assert scan.count() == 3
    assert "EqualTo(store_id,s)" in scan._jdf.queryExecution().toString()
    # The id is a value, not SQL.
    assert tables.scan_store_predictions(spark, "s' OR '1'='1", plan).count() == 0


def test_nightly_run(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS MARTS LOCATION '{tmp_path}/marts'")
    d = m.dims(spark, SF)
    marts = build_marts(spark, m.logs(spark, SF), d)
    model, hold_out = forecast.train(marts["ml_training_features"], trees=3)
    assert forecast.evaluate(model, hold_out).first().new_mae >= 0
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS plans LOCATION '{tmp_path}/plans'")
    forecast.publish_plan(marts, d, datetime(2024, 1, 30).date(), model, "plans.predictions")
    plan = spark.table("plans.predictions")
    assert plan.count() == plan.select("store_id", "item_id", "slot_index").distinct().count() > 0
    assert plan.filter("predicted_at IS NULL").isEmpty()
    for schema in ("MARTS", "plans"):
        spark.sql(f"DROP SCHEMA {schema} CASCADE")
