import random

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from slotcast.operators import features, model as ml, profiles, quality, staging
from slotcast.plans import forecast

KEY = "sale_date date, store_id string, item_id string, slot_index int"


def keys(df):
    return sorted((str(r.sale_date), r.store_id, r.item_id, r.slot_index) for r in df.collect())


@pytest.mark.parametrize("n", [1, 2, 5, 61, 200])
def test_split_is_the_sorted_prefix(make, n):
    draw = random.Random(n)
    rows = set()
    while len(rows) < n:
        # Most rows fall on one date and one store, as a hot key would.
        day = draw.choice(["2024-01-02"] * 6 + ["2024-01-01", "2024-01-03"])
        store = draw.choice("aaaab")
        rows.add((day, store, draw.choice("xyz"), draw.randrange(672)))
    train, test = ml.chronological_split(make(list(rows), KEY))
    ordered = sorted(rows)
    cut = int(n * 0.8)
    assert (keys(train), keys(test)) == (ordered[:cut], ordered[cut:])


def test_features_fill_unsold_dates(make):
    sales = staging.stage_sales(
        make(
            [("s", "a", 2, 1.0, "2024-01-01 08:00:00"), ("s", "b", 5, 1.0, "2024-01-08 09:00:00"),
             ("s", "b", 1, 1.0, "2024-01-09 09:00:00")],
            "store_id string, item_id string, quantity int, price double, created_at timestamp_ntz",
        )
    )
    slots = profiles.slot_sales(sales)
    stores = make([("s", "north")], "store_id string, region string")
    weather = make([("north", "2024-01-01", 50.5, True)], "region string, sale_date date, temp_f double, precip boolean")
    rows = as_dicts(
        features.training_features(slots, profiles.profile_of_slots(slots), stores, weather),
        "sale_date", "item_id",
    )
    assert [(str(r["sale_date"]), r["item_id"], r["slot_quantity"], r["temp_f"]) for r in rows] == [
        ("2024-01-01", "a", 2, 50.5), ("2024-01-01", "b", 0, 50.5),
        ("2024-01-08", "a", 0, None), ("2024-01-08", "b", 5, None), ("2024-01-09", "b", 1, None),
    ]


def test_features_of_a_profile_with_older_slots(make):
    # The profile knows a slot that is not in these sales.
    slots = make(
        [("s", "a", "2024-01-01", 32, 2)],
        "store_id string, item_id string, sale_date date, slot_index int, slot_quantity bigint",
    ).withColumn("day_of_week", F.lit(0))
    profile = make(
        [("s", "a", 0, 8, 32, 1.0, 1), ("s", "old", 0, 8, 33, 1.0, 1), ("s", "old", 4, 8, 417, 1.0, 1)],
        "store_id string, item_id string, day_of_week int, sale_hour int, slot_index int, "
        "avg_slot_quantity double, sample_size bigint",
    )
    stores = make([("s", "north")], "store_id string, region string")
    weather = make([], "region string, sale_date date, temp_f double, precip boolean")
    rows = as_dicts(features.training_features(slots, profile, stores, weather), "item_id")
    assert [(r["item_id"], r["slot_quantity"]) for r in rows] == [("a", 2), ("old", 0)]


def test_model_features(make):
    row = make(
        [("s", "a", "2024-01-06", 8, 0, 512, 5, 1, 0.5, 2, None, None)],
        "store_id string, item_id string, sale_date date, sale_hour int, sale_minute int, slot_index int, "
        "day_of_week int, slot_quantity bigint, avg_slot_quantity double, sample_size bigint, "
        "temp_f double, precip boolean",
    )
    made = features.model_features(row).first()
    assert (made.is_weekend, made.precip, made.temp_f) == (1, None, None)
    imputed = ml.impute_weather(features.model_features(row)).first()
    assert (imputed.precip, imputed.temp_f) == (0, 62.5)


def test_metrics_and_gain(make):
    df = make([(0.0, 1.0, 3.0), (4.0, 3.0, 4.0)], "y double, new double, base double")
    assert tuple(ml.regression_metrics(df, "y", "new").first()) == (1.0, 1.0)
    row = forecast.compare(df, "new", "base", "y").first()
    assert row.mae_improvement_pct == pytest.approx(100 * 0.5 / 1.5)


def test_urgency_report(make):
    # Actual above 2: T T T F F; forecast above 2: T F F T F.
    df = make(
        [(3.0, 3.0, 1.0), (3.0, 1.0, 1.0), (3.0, 2.0, 1.0), (2.0, 9.0, 1.0), (0.0, 0.0, 1.0)],
        "y double, yhat double, mean double",
    )
    rows = {r["label"]: r for r in as_dicts(ml.urgency_report(df, "y", "yhat", "mean"))}
    assert rows["URGENT"] | {} == {
        "label": "URGENT", "precision": 0.5, "recall": pytest.approx(1 / 3), "f1": 0.4, "support": 3,
    }
    assert rows["NORMAL"]["precision"] == pytest.approx(1 / 3)
    assert rows["accuracy"]["f1"] == 0.4 and rows["accuracy"]["support"] == 5
    assert rows["macro avg"]["recall"] == pytest.approx((1 / 3 + 0.5) / 2)
    assert rows["weighted avg"]["recall"] == pytest.approx((3 / 3 + 2 * 0.5) / 5)


def test_urgency_without_a_class(make):
    df = make([(0.0, 0.0, 1.0)], "y double, yhat double, mean double")
    rows = {r["label"]: r for r in as_dicts(ml.urgency_report(df, "y", "yhat", "mean"))}
    assert (rows["URGENT"]["precision"], rows["URGENT"]["f1"], rows["URGENT"]["support"]) == (0.0, 0.0, 0)


def test_labels_are_sorted(make):
    encoded, indexer = ml.encode_labels(make([("t", "b"), ("s", "a"), ("t", "a")], "store_id string, item_id string"))
    assert [list(x) for x in indexer.labelsArray] == [["s", "t"], ["a", "b"]]
    assert {(r.store_id, r.store_label) for r in encoded.collect()} == {("s", 0.0), ("t", 1.0)}


def test_model_learns_and_knows_its_items(make):
    rows = [
        (f"2024-01-{d:02d}", s, i, 8, 0, 32 + 96 * (d % 7), d % 7, 1.0, 3, 50.0 + d, d % 2 == 0, (5 if i == "b" else 1))
        for d in range(1, 29) for s in ("s", "t") for i in "ab"
    ]
    table = make(
        rows,
        "sale_date date, store_id string, item_id string, sale_hour int, sale_minute int, slot_index int, "
        "day_of_week int, avg_slot_quantity double, sample_size bigint, temp_f double, precip boolean, "
        "slot_quantity bigint",
    )
    model, hold_out = forecast.train(table, trees=20)
    row = forecast.evaluate(model, hold_out).first()
    assert row.new_mae < 0.5 * row.base_mae
    unseen = features.model_features(table).withColumn("item_id", F.lit("new")).limit(1)
    assert ml.predict_warm(model, unseen).first().predicted_units is not None
    assert {r.item_id for r in forecast.known_items(model, table).collect()} == {"a", "b"}


def test_quality(make):
    df = make([(1, "a"), (0, None), (None, "b")], "quantity int, item_id string")
    assert {tuple(r) for r in quality.not_null(df, ["quantity", "item_id"]).collect()} == {
        ("quantity", 1), ("item_id", 1),
    }
    assert quality.accepted_range(df, "quantity", 1).first().failures == 1
    times = make([("2024-01-01 00:00:00",)], "at timestamp_ntz")
    assert quality.freshness(times, "at", "2024-01-01 00:30:00").first().status == "pass"
    assert quality.freshness(times, "at", "2024-01-01 00:30:00.5").first().status == "warn"
    assert quality.freshness(times, "at", "2024-01-01 00:30:00.5").first().age_seconds == 1800
    assert not quality.row_count_invariant(df, df.limit(2)).first().holds


PLAN_SF = "/root/testdata/sf0.01"  # large enough for warm rows


@pytest.fixture(scope="module")
def fitted(spark):
    from slotcast.catalog.queries import _features

    return forecast.train(_features(spark, PLAN_SF), 8)


def test_every_prediction_is_the_walk_over_the_nodes(spark, fitted, tmp_path):
    from slotcast.catalog import mapping as m
    from slotcast.catalog.queries import _launch_inputs
    from slotcast.operators import plan as planning, trees

    model, test_rows = fitted
    forecast.save_model(model, str(tmp_path / "model"))
    nodes = trees.tree_nodes(spark, str(tmp_path / "model"))
    assert nodes.select("tree").distinct().count() == 8
    assert nodes.filter("(feature IS NULL) <> (left IS NULL)").count() == 0

    def differs(df):
        return df.filter(F.abs(F.col("predicted_units") - F.col("walked_units")) >= 1e-9).count()

    scored = trees.walk_trees(ml.predict_warm(model, test_rows), nodes, model)
    assert scored.count() > 100 and differs(scored) == 0
    assert scored.agg(F.count_distinct(F.round("walked_units", 6))).first()[0] > 10
    # The warm rows of a plan, which come through routing, weather and weekend.
    warm = []
    inputs = (m.stores(spark), m.menu(spark), *_launch_inputs(spark, PLAN_SF), F.lit("2024-01-30").cast("date"))

    def by_model(df):
        warm.append(df.count())
        return ml.predict_warm(model, df)

    planned = planning.production_plan(*inputs, by_model)
    walked = planning.production_plan(
        *inputs, lambda df: trees.walk_trees(df, nodes, model, "predicted_units")
    ).withColumnRenamed("predicted_units", "walked_units")
    both = planned.join(walked, ["store_id", "item_id", "slot_index"])
    assert warm[0] > 100
    assert both.count() == planned.count() == walked.count() and differs(both) == 0


def test_a_plan_that_loses_rows_is_not_published(spark, fitted, tmp_path, monkeypatch):
    from slotcast.catalog import mapping as m
    from slotcast.catalog.queries import _launch_inputs

    model, predict = fitted[0], ml.predict_warm
    profile, cold, ratio = _launch_inputs(spark, PLAN_SF)
    marts = {"baseline_profile": profile, "cold_start_profile": cold, "traffic_ratio": ratio}
    day = F.lit("2024-01-30").cast("date")
    spark.sql(f"CREATE SCHEMA published LOCATION '{tmp_path}/published'")
    forecast.publish_plan(marts, m.dims(spark, PLAN_SF), day, model, "published.plan")
    n = spark.table("published.plan").count()
    assert n > 1_000
    with monkeypatch.context() as patched:
        patched.setattr(ml, "predict_warm", lambda model, df: predict(model, df).limit(3))
        with pytest.raises(RuntimeError, match="rows for"):
            forecast.publish_plan(marts, m.dims(spark, PLAN_SF), day, model, "published.plan")
    assert spark.table("published.plan").count() == n
