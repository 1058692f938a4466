import os

import pytest
from pyspark.sql import functions as F

from slotcast.catalog import mapping as m
from slotcast.functions.slots import from_event_time, to_event_time
from slotcast.operators import profiles, waste as waste_ops
from slotcast.operators.inventory import replay_ticks
from slotcast.streaming import streams
from slotcast.streaming.inventory import stream_inventory

SF = "/root/testdata/sf0.01"


def drain(spark, df, build, folder):
    """Feed a log file by file, then one event of a year later, and return what came out."""
    later = df.limit(1).withColumn("created_at", F.lit("2025-01-01").cast("timestamp_ntz"))
    df.repartition(4).write.parquet(f"{folder}/in")
    later.write.mode("append").parquet(f"{folder}/in")
    sdf = build(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in"))
    sink = streams.file_sink(sdf, f"{folder}/out", f"{folder}/checkpoint")
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(sdf.schema).parquet(f"{folder}/out")


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago"])
def test_event_time_round_trip(spark, make, zone):
    df = make(
        [("2024-03-10 02:30:00.123456",), ("1969-12-31 23:59:59.999999",), ("2024-11-03 01:30:00",)],
        "at timestamp_ntz",
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = df.select("at", from_event_time(to_event_time("at")).alias("back")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert all(r["at"] == r["back"] for r in rows)


def test_slots_equal_the_batch(spark, tmp_path):
    # A delay longer than the log: no event is late, whatever the order of files.
    raw = m.raw_sales(spark, SF)
    out = drain(spark, raw, lambda s: streams.stream_slot_sales(s, "60 days"), tmp_path)
    batch = profiles.slot_sales(m.sales(spark, SF)).select("store_id", "item_id", "slot_index", "slot_quantity")
    rows = sorted(map(tuple, out.select(*batch.columns).collect()))
    assert rows == sorted(map(tuple, batch.collect()))


def test_stockouts_equal_the_batch(spark, tmp_path):
    raw = m.raw_stockouts(spark, SF)
    out = drain(spark, raw, lambda s: streams.stream_stockouts(s, "60 days"), tmp_path)
    batch = waste_ops.stockout_summary(m.stockouts(spark, SF)).select(*out.columns)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_updates_give_the_running_day_and_survive_a_repeat(spark, make, tmp_path):
    columns = "kind string, store_id string, item_id string, quantity int, price double, created_at timestamp_ntz"
    menu = make([("a", "side", 0.5)], "item_id string, category string, cost double")
    keys = ["store_id", "item_id", "waste_date"]
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for row in [("sales", "s", "a", 2, 1.5, "2024-01-01 10:00:00"), ("waste", "s", "a", 4, None, "2024-01-01 11:00:00"),
                ("sales", "s", "a", 1, 1.5, "2024-01-01 12:00:00")]:
        df = make([row], columns)
        df.write.mode("append").parquet(source)
        sdf = streams.stream_waste_today(spark.readStream.schema(df.schema).parquet(source), menu)
        sink = streams.upsert_sink(sdf, out, checkpoint, keys).trigger(availableNow=True)
        sink.start().awaitTermination()
    row = streams.read_upserts(spark, out, sdf.schema, keys).collect()
    assert [(r.sales_quantity, r.sales_revenue, r.waste_quantity, r.waste_cost) for r in row] == [(3, 4.5, 4, 2.0)]


def test_what_readers_read_follows_groups_not_triggers(spark, make, tmp_path):
    columns = "store_id string, item_id string, quantity int, created_at timestamp_ntz"
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    keys = ["store_id", "item_id", "sale_15min"]

    def run(times):
        for i in times:
            df = make([(f"s{k}", "a", 1, f"2024-01-01 {10 + k % 2}:00:00") for k in range(5)], columns)
            df.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
        sdf = streams.stream_slot_sales(stream, "1 day")
        streams.upsert_sink(sdf, out, checkpoint, keys).trigger(availableNow=True).start().awaitTermination()
        rows = streams.read_upserts(spark, out, sdf.schema, keys)
        files = rows.inputFiles()
        return sorted(r.slot_quantity for r in rows.collect()), len(files), sum(os.path.getsize(f.removeprefix("file:")) for f in files)

    few, n_few, read_few = run(range(8))
    many, n_many, read_many = run(range(42))
    assert few == [8] * 5 and many == [50] * 5
    assert read_many < 2 * read_few  # 50 triggers in place of 8
    stored = sum(f.stat().st_size for f in (tmp_path / "out").rglob("*.parquet"))
    assert stored < 3 * read_few  # folded folders do not pile up


def test_a_base_that_was_not_finished_is_not_read(spark, make, tmp_path):
    path, keys = str(tmp_path), ["k"]
    for epoch, value in enumerate("abc"):
        df = make([("x", value), (value, value)], "k string, v string")
        df.write.parquet(f"{path}/tail/epoch={epoch}")
    make([("x", "wrong")], "k string, v string").write.parquet(f"{path}/base/epoch=2")
    os.remove(f"{path}/base/epoch=2/_SUCCESS")
    for _ in range(3):
        rows = streams.read_upserts(spark, path, df.schema, keys)
        assert sorted(map(tuple, rows.collect())) == [("a", "a"), ("b", "b"), ("c", "c"), ("x", "c")]
        streams.fold_upserts(spark, path, df.schema, keys)
    assert len(rows.inputFiles()) == 1 or all("/base/" in f for f in rows.inputFiles())


def test_append_resumes_where_it_stopped(spark, make, tmp_path):
    rows = [("s", "a", 1, f"2024-01-0{d} 10:00:00") for d in (1, 2)]
    columns = "store_id string, item_id string, quantity int, created_at timestamp_ntz"
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for row in rows:
        df = make([row], columns)
        df.write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        streams.stream_append(stream, out, checkpoint, once=True).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    assert spark.read.parquet(out).filter("event_date = DATE'2024-01-02'").count() == 1


def test_inventory_equals_the_batch_on_its_first_day(spark, make, tmp_path):
    import random

    draw = random.Random(3)
    rows = [
        (s, i, draw.choice(["demand", "demand", "cook"]), f"2024-01-01 {draw.randrange(24):02d}:{draw.randrange(60):02d}:00", draw.randrange(1, 5))
        for s in "st" for i in "ab" for _ in range(60)
    ] + [("s", "b", "cook", "2024-01-01 23:30:00", 40)]
    events = make(rows, "store_id string, item_id string, kind string, at timestamp_ntz, quantity int")
    items = make([("a", 10, 1.5), ("b", 5, 3.0)], "item_id string, cook_time int, hold_time double")
    stores = make([("s", "24/7"), ("t", "5am-11pm")], "store_id string, hours string")
    out = drain(
        spark,
        events.withColumnRenamed("at", "created_at"),
        lambda s: stream_inventory(s.withColumnRenamed("created_at", "at"), items, stores, "2 days"),
        tmp_path,
    )
    batch = replay_ticks(
        events.filter("kind = 'demand'"), events.filter("kind = 'cook'"), items, stores
    )
    first_day = out.filter("tick < TIMESTAMP_NTZ'2024-01-02 00:00:00'")
    expected = sorted(map(tuple, batch.select(*out.columns).collect()))
    assert len(expected) > 100
    assert sorted(map(tuple, first_day.collect())) == expected
    # The last batch of that day is ready at 23:35 and expires three hours later.
    later = out.filter("tick = TIMESTAMP_NTZ'2024-01-02 02:45:00' AND wasted > 0")
    assert [(r.store_id, r.item_id, r.left_over) for r in later.collect()] == [("s", "b", 0)]
