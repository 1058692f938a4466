from datetime import timedelta

import pytest

from slotcast.operators import quality as batch_tests
from slotcast.streaming import quality, streams

COLUMNS = "store_id int, quantity int, price double, created_at timestamp_ntz"


def run(spark, folder, checkpoint="checkpoint"):
    schema = "store_id int, quantity int, price double, created_at timestamp_ntz"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    tested = quality.observed(stream, "tests", ["store_id", "price"], {"quantity": 1}, "created_at")
    tests = quality.BatchTests(spark, "tests", f"{folder}/tests")
    sink = streams.file_sink(tested.filter("quantity > 0"), f"{folder}/out", f"{folder}/{checkpoint}")
    quality.finish_tested(quality.start_tested(sink.trigger(availableNow=True), tests), tests)
    return quality.read_batches(spark, f"{folder}/tests")


@pytest.fixture
def log(make):
    return make(
        [
            (1, 2, 1.0, "2024-01-01 10:00:00.25"),
            (None, 0, None, "2024-01-01 11:00:00"),
            (2, None, 3.0, None),
            (None, -1, 3.0, "2024-01-01 09:00:00"),
            (3, 1, None, "2024-01-01 08:00:00"),
        ],
        COLUMNS,
    )


def test_batches_add_up_to_the_tests_of_the_table(spark, log, tmp_path):
    log.repartition(3).write.parquet(f"{tmp_path}/in")
    batches = run(spark, tmp_path)
    assert batches.select("batch").distinct().count() > 1
    rows = {(r["test"], r["column_name"]): (r["failures"], r["n_rows"]) for r in quality.totals(batches, "2024-01-01 10:31:00").collect()}
    nulls = {r["column_name"]: r["failures"] for r in batch_tests.not_null(log, ["store_id", "price"]).collect()}
    low = batch_tests.accepted_range(log, "quantity", 1).first()["failures"]
    assert rows == {
        ("not_null", "store_id"): (nulls["store_id"], 5),
        ("not_null", "price"): (nulls["price"], 5),
        ("accepted_range", "quantity"): (low, 5),  # rows that the sink's filter drops are tested too
        ("freshness", "created_at"): (0, 5),
    }


@pytest.mark.parametrize("as_of, stale", [("2024-01-01 11:30:00", 0), ("2024-01-01 11:30:00.000001", 1)])
def test_freshness_at_its_limit(spark, log, tmp_path, as_of, stale):
    log.repartition(2).write.parquet(f"{tmp_path}/in")
    found = quality.totals(run(spark, tmp_path), as_of, timedelta(minutes=30)).filter("test = 'freshness'")
    assert [r["failures"] for r in found.collect()] == [stale]


def test_a_repeated_batch_counts_once(spark, log, tmp_path):
    log.coalesce(1).write.parquet(f"{tmp_path}/in")
    before = run(spark, tmp_path).collect()
    again = run(spark, tmp_path, "another").collect()  # the same batch number, as after a lost commit
    assert sorted(map(str, before)) == sorted(map(str, again))


def test_a_restart_adds_only_new_batches(spark, log, tmp_path):
    log.coalesce(1).write.parquet(f"{tmp_path}/in")
    run(spark, tmp_path)
    log.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    n_rows = quality.totals(run(spark, tmp_path), "2024-01-01 12:00:00").select("n_rows").distinct().collect()
    assert [r["n_rows"] for r in n_rows] == [10]
