"""One registered query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slotcast.catalog import mapping as m
from slotcast.functions.scoring import (
    classify_weather,
    service_level,
    stable_seed,
    waste_pct,
    weather_multiplier,
)
from slotcast.operators import (
    features,
    inventory,
    live,
    model as ml,
    plan,
    profiles,
    quality,
    scoring,
    trees,
    waste as waste_ops,
)
from slotcast.plans import forecast, refresh
from slotcast.plans.marts import build_marts
from slotcast.session import new_folder, stage
from slotcast.sources import events as event_source, results as results_source
from slotcast.schemas import MENU_CSV
from slotcast.sources.dims import read_dims_csv, read_dims_yaml, write_csv
from slotcast.sources.tables import overwrite_table, scan_store_predictions
from slotcast.streaming import quality as stream_tests, streams
from slotcast.streaming.inventory import stream_inventory as inventory_of_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register under the function's name, with floats rounded as in the SQL."""

    def rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run(spark, sf_dir)
        return df.select(
            *(
                F.round(f.name, 6).alias(f.name) if f.dataType.typeName() == "double" else f.name
                for f in df.schema
            )
        )

    QUERIES[run.__name__] = rounded
    return run


# --- shared inputs ---


def _slots(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.shared_slot_sales(m.sales(spark, sf))


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.time_of_day_profile(m.sales(spark, sf))


def _today(spark: SparkSession, sf: str) -> Column:
    return live.sim_now(m.raw_sales(spark, sf)).select(F.to_date("now")).scalar()


_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf: str, name: str, write: Callable[[str], None]) -> str:
    """The path of something that is derived from a table once in a session and read many times."""
    key = spark.sparkContext.applicationId, sf, name
    if key not in _STORED:
        path = new_folder(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def _live_log(spark: SparkSession, sf: str) -> str:
    """The three logs after a flush for each third of the month, one of them repeated, and a compaction."""

    def write(path: str) -> None:
        third = F.least(F.floor((F.dayofmonth("created_at") - 1) / 10), F.lit(2))
        for epoch in (0, 1, 1, 2):
            flush = m.log(spark, sf).filter(third == epoch)
            event_source.append_events(flush, epoch, path, m.SCHEMAS)
        event_source.compact_events(spark, path, date(2024, 1, 30), m.SCHEMAS)

    return _stored(spark, sf, "live-log", write)


def _clocks(spark: SparkSession, sf: str) -> DataFrame:
    """The store clocks that the log's commits keep."""
    return event_source.read_clocks(spark, _live_log(spark, sf), m.SCHEMAS)


def _since_midnight(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """What a read-out of today needs of a log: of sales the days of the clocks, whose newest they are, of
    others all from the first of these days on."""
    days = [r[0] for r in _clocks(spark, sf).select(F.to_date("now")).distinct().collect()]
    path = _live_log(spark, sf)
    if kind == "sales":
        return event_source.read_events(spark, path, kind, dates=days, schemas=m.SCHEMAS)
    since = datetime.combine(min(days, default=date.max), time())
    return event_source.read_events(spark, path, kind, since=since, schemas=m.SCHEMAS)


def _ahead(spark: SparkSession, sf: str) -> DataFrame:
    """Look-ahead demand from the published running sums."""
    path = _stored(spark, sf, "lookahead", lambda p: live.publish_lookahead(_forecast(spark, sf), p))
    return live.lookahead_of_index(spark.read.parquet(path), m.menu(spark), _clocks(spark, sf))


def _launch_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Profile, category profile and traffic ratio of the sales with a new item."""
    slots = profiles.shared_slot_sales(m.launch_sales(spark, sf))
    profile = profiles.profile_of_slots(slots)
    cold = profiles.cold_start_profile(profile, m.menu(spark))
    return profile, cold, profiles.store_traffic_ratio(slots)


def _grid_features(spark: SparkSession, sf: str, profile: DataFrame) -> DataFrame:
    grid = plan.store_item_slot_grid(m.stores(spark), m.menu(spark), _today(spark, sf))
    return plan.complete_features(grid, profile)


def _plan(spark: SparkSession, sf: str, **options) -> DataFrame:
    return plan.production_plan(
        m.stores(spark), m.menu(spark), *_launch_inputs(spark, sf), _today(spark, sf), **options
    )


def _features(spark: SparkSession, sf: str) -> DataFrame:
    slots = _slots(spark, sf)
    return features.training_features(
        slots, profiles.profile_of_slots(slots), m.stores(spark), m.weather(spark, sf)
    )


def _day_totals(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.arm_totals(m.store_days(spark, sf))


def _hold_out(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(features.model_features(_features(spark, sf)), "features")
    return ml.chronological_split(rows)[1]


# --- staging ---


@query
def stage_sales(spark, sf):
    return m.sales(spark, sf)


@query
def stage_waste(spark, sf):
    return m.waste(spark, sf)


@query
def stage_stockouts(spark, sf):
    return m.stockouts(spark, sf)


# --- aggregates ---


@query
def slot_sales(spark, sf):
    return profiles.slot_sales(m.sales(spark, sf))


@query
def store_dow_dates(spark, sf):
    return profiles.store_dow_dates(m.sales(spark, sf))


@query
def item_days_observed(spark, sf):
    return profiles.item_days_observed(m.sales(spark, sf))


@query
def time_of_day_profile(spark, sf):
    return _profile(spark, sf)


@query
def cold_start_profile(spark, sf):
    return profiles.cold_start_profile(_profile(spark, sf), m.menu(spark))


@query
def store_traffic_ratio(spark, sf):
    return profiles.store_traffic_ratio(m.sales(spark, sf))


@query
def stockout_summary(spark, sf):
    return waste_ops.stockout_summary(m.stockouts(spark, sf))


@query
def daily_item_sales(spark, sf):
    return waste_ops.daily_item_sales(m.sales(spark, sf))


@query
def daily_item_waste(spark, sf):
    return waste_ops.daily_item_waste(m.waste(spark, sf))


@query
def waste_percentage(spark, sf):
    return waste_ops.waste_percentage(m.waste(spark, sf), m.sales(spark, sf), m.menu(spark))


@query
def store_dates(spark, sf):
    return profiles.store_dates(m.sales(spark, sf))


# --- windows ---


@query
def latest_slot_per_item(spark, sf):
    slots = _slots(spark, sf)
    return profiles.latest_slot_per_item(slots, profiles.profile_of_slots(slots))


@query
def rolling_slot_demand(spark, sf):
    return profiles.rolling_slot_demand(profiles.slot_sales(m.sales(spark, sf)))


# --- live read-outs ---


@query
def sim_now(spark, sf):
    return live.sim_now(m.raw_sales(spark, sf))


@query
def store_clocks(spark, sf):
    return live.store_clocks(m.raw_sales(spark, sf))


@query
def committed_clocks(spark, sf):
    return _clocks(spark, sf)


@query
def missed_units_today(spark, sf):
    return live.missed_units_today(_since_midnight(spark, sf, "stockouts"), _clocks(spark, sf))


def _waste_today(spark, sf):
    sales, waste = (_since_midnight(spark, sf, kind) for kind in ("sales", "waste"))
    return live.waste_summary_today(sales, waste, m.menu(spark), _clocks(spark, sf))


@query
def waste_summary_today(spark, sf):
    return _waste_today(spark, sf)


@query
def category_group_kpis(spark, sf):
    return live.category_group_kpis(_waste_today(spark, sf))


def _forecast(spark, sf):
    return ml.baseline_forecast(_profile(spark, sf))


@query
def lookahead_demand(spark, sf):
    return live.lookahead_demand(_forecast(spark, sf), m.menu(spark), _clocks(spark, sf))


@query
def published_lookahead(spark, sf):
    return _ahead(spark, sf)


def _queue(spark, sf):
    stockouts = _since_midnight(spark, sf, "stockouts")
    return live.queue_of(_ahead(spark, sf), stockouts, m.menu(spark), _clocks(spark, sf))


@query
def production_queue(spark, sf):
    return _queue(spark, sf)


def _done(spark, sf):
    """Items whose waste was logged on the last day count as acknowledged."""
    now = _clocks(spark, sf).agg(F.max("now").alias("now"))
    done = live.today_totals(_since_midnight(spark, sf, "waste"), now, {"n": F.lit(1)})
    return done.select("store_id", "item_id")


@query
def open_items(spark, sf):
    return live.open_items(_queue(spark, sf), _done(spark, sf))


@query
def completed_items(spark, sf):
    return live.completed_items(_queue(spark, sf), _done(spark, sf))


@query
def replenishment(spark, sf):
    """Waste of the day so far stands for the shelf, stockouts for what is being cooked."""
    now = _clocks(spark, sf)
    waste, stockouts = (_since_midnight(spark, sf, kind) for kind in ("waste", "stockouts"))
    shelf = live.today_totals(waste, now, {"on_shelf": F.col("quantity")})
    kitchen = live.today_totals(stockouts, now, {"in_progress": F.col("quantity_requested")})
    on_hand = shelf.join(kitchen, ["store_id", "item_id"], "full_outer")
    return plan.replenishment(_ahead(spark, sf), on_hand, now)


# --- plan ---


@query
def store_item_slot_grid(spark, sf):
    """The grid of the whole chain, which grows with the suppliers."""
    return plan.store_item_slot_grid(m.chain(spark, sf), m.menu(spark), _today(spark, sf))


@query
def complete_features(spark, sf):
    return _grid_features(spark, sf, _launch_inputs(spark, sf)[0])


@query
def grid_features(spark, sf):
    return plan.grid_features(
        m.stores(spark), m.menu(spark), _launch_inputs(spark, sf)[0], _today(spark, sf)
    )


@query
def route_rows(spark, sf):
    return plan.route_rows(_grid_features(spark, sf, _launch_inputs(spark, sf)[0]))


@query
def cold_prediction(spark, sf):
    profile, cold, ratio = _launch_inputs(spark, sf)
    routed = plan.route_rows(_grid_features(spark, sf, profile))
    rows = plan.cold_prediction(routed.filter("route = 'cold'"), cold, ratio)
    return rows.select("store_id", "item_id", "slot_index", "predicted_units")


@query
def zero_prediction(spark, sf):
    routed = plan.route_rows(_grid_features(spark, sf, _launch_inputs(spark, sf)[0]))
    rows = plan.zero_prediction(routed.filter("route = 'zero'"))
    return rows.select("store_id", "item_id", "slot_index", "predicted_units")


@query
def attach_weather(spark, sf):
    """Slot sales under the weather of the last day, per region."""
    last = m.weather(spark, sf).filter(F.col("sale_date") == _today(spark, sf))
    return plan.attach_weather(profiles.slot_sales(m.sales(spark, sf)), m.stores(spark), last).select(
        "store_id", "item_id", "sale_date", "slot_index", "temp_f", "precip"
    )


@query
def production_plan(spark, sf):
    return _plan(spark, sf)


@query
def plan_summary(spark, sf):
    return plan.plan_summary(_plan(spark, sf))


@query
def top_items(spark, sf):
    return plan.top_items(_plan(spark, sf))


@query
def day_demand_totals(spark, sf):
    ml_arm = _plan(spark, sf).select(
        F.lit("ml").alias("arm"), "item_id", "slot_index", F.col("predicted_units").alias("target")
    )
    base_arm = _forecast(spark, sf).select(
        F.lit("baseline").alias("arm"), "item_id", "slot_index", F.col("predicted_units").alias("target")
    )
    return plan.day_demand_totals(ml_arm.unionByName(base_arm), m.menu(spark), 1)


@query
def available_items(spark, sf):
    """The items each store may make in the hour of its newest sale."""
    clocks = _clocks(spark, sf).withColumn("hour", F.hour("now")).withColumn("day", F.to_date("now"))
    items = sales_items(spark, sf)
    on_menu = items.join(m.menu(spark), "item_id").join(clocks, "store_id")
    return plan.available_items(on_menu, F.col("day"), F.col("hour")).select(
        "store_id", "item_id", "hour"
    )


def sales_items(spark, sf):
    """The items each store has sold."""
    return m.sales(spark, sf).select("store_id", "item_id").distinct()


@query
def open_hours_filter(spark, sf):
    return plan.open_hours_filter(
        profiles.slot_sales(m.sales(spark, sf)), m.stores(spark), "sale_hour"
    )


@query
def effective_price(spark, sf):
    """Daily sales at the price that holds on their weekday."""
    daily = (
        m.sales(spark, sf)
        .groupBy("store_id", "item_id", "sale_date", "day_of_week")
        .agg(F.sum("quantity").alias("units"))
    )
    priced = plan.effective_price(daily.join(m.menu(spark), "item_id"), F.col("day_of_week"))
    return priced.select(
        "store_id",
        "item_id",
        "sale_date",
        "effective_price",
        (F.col("units") * F.col("effective_price")).alias("revenue"),
    )


# --- training features and model ---


@query
def training_features(spark, sf):
    return _features(spark, sf)


@query
def model_features(spark, sf):
    return features.model_features(_features(spark, sf))


@query
def chronological_split(spark, sf):
    rows = stage(_features(spark, sf), "features")
    train, test = ml.chronological_split(rows)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    ).select("part", "store_id", "item_id", "sale_date", "slot_index")


@query
def baseline_forecast(spark, sf):
    return _forecast(spark, sf)


@query
def regression_metrics(spark, sf):
    return ml.regression_metrics(_hold_out(spark, sf), "slot_quantity", "avg_slot_quantity")


@query
def improvement_pct(spark, sf):
    """The profile mean against the constant forecast 1."""
    scored = _hold_out(spark, sf).withColumn("one", F.lit(1.0))
    return forecast.compare(scored, "avg_slot_quantity", "one")


@query
def urgency_report(spark, sf):
    """Forecast: one unit in slots with more than half a unit on average."""
    guess = F.when(F.col("avg_slot_quantity") > 0.5, 2.5 * F.col("avg_slot_quantity")).otherwise(0.0)
    return ml.urgency_report(_hold_out(spark, sf), "slot_quantity", guess, "avg_slot_quantity")


@query
def encode_labels(spark, sf):
    slots = profiles.slot_sales(m.sales(spark, sf))
    encoded, _ = ml.encode_labels(slots)
    return encoded.groupBy("store_id", "item_id", "store_label", "item_label").agg(
        F.sum("slot_quantity").alias("units")
    )


def _model_path(spark, sf):
    return _stored(spark, sf, "model", lambda p: forecast.save_model(forecast.train(_features(spark, sf))[0], p))


def _stored_model(spark, sf):
    """The model of a table's features, fitted once in a session, stored, and read back each time."""
    return forecast.load_model(_model_path(spark, sf))


@query
def boosted_trees(spark, sf):
    """Sizes of the split, errors of the profile mean on the hold-out, and whether the model's are finite.

    The trees' own numbers are those of this library alone, so no more than that is compared.
    """
    train, test = ml.chronological_split(stage(features.model_features(_features(spark, sf)), "features"))
    scored = ml.predict_warm(_stored_model(spark, sf), test)
    error = F.col("slot_quantity") - F.col("avg_slot_quantity")
    return scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.avg(F.abs(error)).alias("base_mae"),
        F.sqrt(F.avg(error * error)).alias("base_rmse"),
        F.bool_and(_finite("predicted_units")).alias("finite"),
    ).withColumn("train_rows", train.select(F.count(F.lit(1))).scalar())


@query
def tree_predictions(spark, sf):
    """Hold-out rows of each store, and whether the model predicts all of them as a walk over its nodes does."""
    model = _stored_model(spark, sf)
    scored = ml.predict_warm(model, _hold_out(spark, sf))
    nodes = trees.tree_nodes(spark, _model_path(spark, sf))
    walked = trees.walk_trees(scored, nodes, model)
    same = F.abs(F.col("predicted_units") - F.col("walked_units")) < 1e-9
    return walked.groupBy("store_id").agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(same).alias("same"))


def _finite(name: str) -> Column:
    return F.coalesce(F.abs(name) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(name)


@query
def production_plan_model(spark, sf):
    """The plan of the stored model under the last day's weather: route and prediction of every row.

    Warm rows say whether their prediction is finite, all others their exact prediction.
    """
    model = _stored_model(spark, sf)
    vocab = forecast.known_items(model, _profile(spark, sf))
    weather = m.weather(spark, sf).filter(F.col("sale_date") == _today(spark, sf))
    planned = _plan(
        spark, sf, model=lambda df: ml.predict_warm(model, df), vocab=vocab, weather_by_region=weather
    )
    key = ["store_id", "item_id", "slot_index"]
    routes = plan.route_rows(_grid_features(spark, sf, _launch_inputs(spark, sf)[0]), vocab)
    return planned.join(routes.select(*key, "route"), key).select(
        *key,
        "route",
        F.when(F.col("route") != "warm", F.col("predicted_units")).alias("predicted_units"),
        _finite("predicted_units").alias("finite"),
    )


# --- scoring ---


@query
def flatten_results(spark, sf):
    """The daily results through the nested document and back."""
    path = new_folder(spark, "results")
    days = scoring.nest_results(_day_totals(spark, sf))
    document = days.agg(F.collect_list(F.struct("date", "ml", "baseline")).alias("daily"))
    results_source.write_results_json(document, path)
    return scoring.flatten_results(results_source.read_results_json(spark, path))


@query
def results_document_totals(spark, sf):
    """The totals that the results document carries, written with its days and read back."""
    path = new_folder(spark, "document")
    results_source.write_results_document(_day_totals(spark, sf), path)
    return results_source.read_results_json(spark, path).select("cumulative.*")


@query
def arm_totals(spark, sf):
    return _day_totals(spark, sf)


@query
def daily_results_table(spark, sf):
    """The daily table after each date was appended, and the last one twice."""
    path = new_folder(spark, "daily")
    days = _day_totals(spark, sf)
    results_source.append_daily_result(days, path)
    results_source.append_daily_result(days.filter(F.col("date") == _today(spark, sf)), path)
    return results_source.read_daily_results(spark, path)


@query
def service_level_and_waste(spark, sf):
    return m.store_days(spark, sf).select(
        "date",
        "store_id",
        "arm",
        service_level("units_sold", "stockouts").alias("service_level"),
        waste_pct("waste_cost", "sales_revenue").alias("waste_pct"),
    )


@query
def classify_weather_days(spark, sf):
    """Store-days per weather bucket."""
    days = profiles.store_dates(m.sales(spark, sf)).join(m.stores(spark), "store_id")
    bucket = classify_weather("temp_f", "precip").alias("bucket")
    return (
        days.join(m.weather(spark, sf), ["region", "sale_date"])
        .groupBy(bucket)
        .agg(F.count(F.lit(1)).alias("store_days"))
    )


@query
def cumulative(spark, sf):
    return scoring.cumulative(_day_totals(spark, sf))


@query
def weather_impact(spark, sf):
    return scoring.weather_impact(m.store_days(spark, sf), m.stores(spark), m.weather(spark, sf))


@query
def weather_multiplier_days(spark, sf):
    """Daily sales of each category with the demand factor of the day's weather."""
    daily = waste_ops.daily_item_sales(m.sales(spark, sf))
    return (
        daily.join(m.menu(spark).select("item_id", "category"), "item_id")
        .join(m.stores(spark).select("store_id", "region"), "store_id")
        .join(m.weather(spark, sf), ["region", "sale_date"])
        .groupBy("region", "sale_date", "category")
        .agg(
            F.sum("sale_quantity").alias("units"),
            F.first(weather_multiplier("temp_f", "precip")).alias("day_factor"),
            F.first(weather_multiplier("temp_f", "precip", "category")).alias("category_factor"),
        )
    )


@query
def stable_seed_days(spark, sf):
    """A seed per store and trading day."""
    key = F.concat_ws("|", F.col("sale_date").cast("string"), F.col("store_id").cast("string"))
    return profiles.store_dates(m.sales(spark, sf)).select(
        "store_id", "sale_date", stable_seed(key).alias("seed")
    )


# --- supply and demand ---


def _supply(spark, sf):
    return m.raw_waste(spark, sf).select(
        "store_id", "item_id", "id", F.col("created_at").alias("at"), (F.col("quantity") * 2).alias("quantity")
    )


def _demand(spark, sf):
    return m.raw_sales(spark, sf).select(
        "store_id", "item_id", "id", F.col("created_at").alias("at"), "quantity"
    )


@query
def fifo_allocate(spark, sf):
    return inventory.fifo_allocate(_supply(spark, sf), _demand(spark, sf))


def _opening(spark, sf):
    """Two units of everything that a store with night hours sold on a day."""
    return (
        waste_ops.daily_item_sales(m.sales(spark, sf))
        .join(m.stores(spark).filter("hours = '24/7'").select("store_id"), "store_id", "left_semi")
        .select("store_id", "item_id", F.col("sale_date").alias("day"), F.lit(2).alias("quantity"))
    )


@query
def inventory_replay(spark, sf):
    return inventory.inventory_replay(
        _demand(spark, sf), _supply(spark, sf), m.menu(spark), m.stores(spark), _opening(spark, sf)
    )


# --- data tests ---


@query
def not_null(spark, sf):
    return quality.not_null(
        m.raw_sales(spark, sf), ["store_id", "item_id", "quantity", "price", "created_at"]
    )


@query
def accepted_range(spark, sf):
    return quality.accepted_range(m.raw_sales(spark, sf), "quantity", 1)


@query
def freshness(spark, sf):
    """The stockout log against the clock of the sales log."""
    as_of = live.sim_now(m.raw_sales(spark, sf))
    return quality.freshness(m.raw_stockouts(spark, sf), "created_at", as_of, timedelta(minutes=30))


@query
def row_count_invariant(spark, sf):
    profile, _, _ = _launch_inputs(spark, sf)
    return quality.row_count_invariant(_grid_features(spark, sf, profile), _plan(spark, sf))


# --- sources and sinks ---


def _written_log(spark, sf):
    path = new_folder(spark, "log")
    event_source.append_events(m.log(spark, sf), 0, path)
    event_source.append_events(m.log(spark, sf), 0, path)
    return path


@query
def read_events(spark, sf):
    """Daily units of each log after one flush that was written twice."""
    return _daily_units(spark, _written_log(spark, sf))


def _daily_units(spark, path):
    quantity = {"sales": "quantity", "waste": "quantity", "stockouts": "quantity_requested"}
    kinds = [
        event_source.read_events(spark, path, kind)
        .groupBy(F.lit(kind).alias("kind"), F.to_date("created_at").alias("day"))
        .agg(F.sum(c).alias("units"), F.count(F.lit(1)).alias("n_events"))
        for kind, c in quantity.items()
    ]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


@query
def union_stores(spark, sf):
    """Daily units per store from one folder per store."""
    path = new_folder(spark, "stores")
    m.raw_sales(spark, sf).write.partitionBy("store_id").parquet(path)
    return (
        event_source.read_store_folders(spark, path)
        .groupBy(F.col("store_id").cast("string").alias("store_id"), F.to_date("created_at").alias("sale_date"))
        .agg(F.sum("quantity").alias("units"))
    )


@query
def delete_from_cutoff(spark, sf):
    """The three logs, by day, after everything from 20 January 10:30 on was deleted."""
    folder = new_folder(spark, "logs")
    schema = "raw_" + folder[-8:]
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{folder}'")
    event_source.ensure_tables(spark, schema)
    tables = {"sales": "sales_events", "waste": "waste_log", "stockouts": "stockout_events"}
    names = {kind: f"{schema}.{table}" for kind, table in tables.items()}
    for kind, name in names.items():
        event_source.insert_events(m.log(spark, sf).filter(F.col("kind") == kind), kind, name)
    event_source.delete_from_cutoff(spark, list(names.values()), "2024-01-20 10:30:00")
    left = [
        spark.table(name)
        .groupBy(F.lit(kind).alias("kind"), F.col("event_date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.max("created_at").alias("newest"))
        for kind, name in names.items()
    ]
    return left[0].unionByName(left[1]).unionByName(left[2])


@query
def csv_round_trip(spark, sf):
    path = new_folder(spark, "csv")
    daily = waste_ops.daily_item_sales(m.sales(spark, sf))
    write_csv(daily, path)
    return spark.read.csv(path, header=True, schema=daily.schema)


def _named_text(df: DataFrame) -> DataFrame:
    """Ids as text, as the dimension files have them."""
    return df.withColumns({c: F.col(c).cast("string") for c in ("store_id", "item_id")})


@query
def waste_percentage_csv_dims(spark, sf):
    """Waste percent with the menu from a CSV file."""
    folder = new_folder(spark, "dims")
    days = F.concat(F.lit("["), F.concat_ws(", ", F.col("sale_days").cast("array<string>")), F.lit("]"))
    columns = [f.name for f in MENU_CSV]
    write_csv(m.menu(spark).withColumn("sale_days", days).select(*columns), f"{folder}/menu_items.csv")
    write_csv(m.stores(spark), f"{folder}/stores.csv")
    write_csv(m.weather(spark, sf), f"{folder}/weather_daily.csv")
    menu = read_dims_csv(spark, folder)["menu_items"]
    return waste_ops.waste_percentage(
        _named_text(m.waste(spark, sf)), _named_text(m.sales(spark, sf)), menu
    )


@query
def cold_start_profile_yaml_dims(spark, sf):
    """Category profile with the menu from a configuration file."""
    folder = new_folder(spark, "dims")

    def write(df: DataFrame, name: str, list_name: str, id_name: str) -> None:
        row = F.to_json(F.struct(F.col(id_name).cast("string").alias("id"), *df.drop(id_name).columns))
        lines = df.agg(F.array_join(F.collect_list(row), ", ").alias("rows"))
        text = F.concat(F.lit(f"{list_name}: ["), F.col("rows"), F.lit("]"))
        lines.select(text).coalesce(1).write.text(f"{folder}/{name}.yaml")

    write(m.menu(spark), "menu", "items", "item_id")
    write(m.stores(spark).withColumn("region", F.col("region").cast("string")), "stores", "stores", "store_id")
    menu = read_dims_yaml(spark, folder)["menu"]
    return profiles.cold_start_profile(_named_text(_profile(spark, sf)), menu)


@query
def store_predictions(spark, sf):
    """One store's predictions, from a table kept in store order."""
    folder = new_folder(spark, "forecast")
    schema = "forecast_" + folder[-8:]
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{folder}'")
    overwrite_table(_forecast(spark, sf), f"{schema}.predictions", ["store_id", "item_id"])
    return scan_store_predictions(spark, 5, f"{schema}.predictions")


def _refreshed(spark, sf):
    """The state of the profile marts after four flushes, each with a refresh.

    The second flush brings late events of days that the first one had, and a compaction follows it.
    """

    def write(path: str) -> None:
        day = F.dayofmonth("created_at")
        late = (F.col("id") % 7 == 0) & (day <= 12)
        flush = F.when(late, 1).when(day <= 12, 0).when(day <= 20, 1).when(day <= 28, 2).otherwise(3)
        log = m.log(spark, sf).filter("kind = 'sales'").withColumn("flush", flush)
        for epoch in range(4):
            event_source.append_events(log.filter(F.col("flush") == epoch), epoch, f"{path}/log", m.SCHEMAS)
            if epoch == 1:
                event_source.compact_events(spark, f"{path}/log", date(2024, 1, 20), m.SCHEMAS)
            refresh.refresh_profiles(spark, f"{path}/log", f"{path}/state", m.SCHEMAS)

    return _stored(spark, sf, "refreshed", write) + "/state"


@query
def refreshed_profile(spark, sf):
    return refresh.refreshed_profile(spark, _refreshed(spark, sf))


@query
def refreshed_cold_start(spark, sf):
    return profiles.cold_start_profile(refresh.refreshed_profile(spark, _refreshed(spark, sf)), m.menu(spark))


@query
def refreshed_traffic_ratio(spark, sf):
    return refresh.refreshed_traffic_ratio(spark, _refreshed(spark, sf))


@query
def marts(spark, sf):
    """Rows of every stored mart."""
    folder = new_folder(spark, "marts")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS MARTS LOCATION '{folder}'")
    built = build_marts(spark, m.logs(spark, sf), m.dims(spark, sf))
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("mart"), "n_rows")
        for name, df in built.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


# --- streams ---


def _stream(spark, sf, types):
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = (
        spark.readStream.schema(events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf)
    )
    return m.as_log(stream.filter(F.col("event_type").isin(*types)))


def _drain_updates(spark, sdf, name, keys):
    """Run a stream over what there is, and read the newest row of each group."""
    folder = new_folder(spark, name)
    sink = streams.upsert_sink(sdf, f"{folder}/out", f"{folder}/checkpoint", keys)
    sink.trigger(availableNow=True).start().awaitTermination()
    return streams.read_upserts(spark, f"{folder}/out", sdf.schema, keys)


def _drain(spark, sdf, name):
    """Run a stream over what there is into files, and read them."""
    folder = new_folder(spark, name)
    sink = streams.file_sink(sdf, f"{folder}/out", f"{folder}/checkpoint")
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(sdf.schema).parquet(f"{folder}/out")


@query
def stream_slot_sales(spark, sf):
    """All slots, those that the watermark has not closed too."""
    sdf = streams.stream_slot_sales(_stream(spark, sf, m.SALE_TYPES))
    return _drain_updates(spark, sdf, "slots", ["store_id", "item_id", "sale_15min"])


@query
def stream_stockouts(spark, sf):
    sdf = streams.stream_stockouts(_stream(spark, sf, (m.STOCKOUT_TYPE,)))
    return _drain_updates(spark, sdf, "stockouts", ["store_id", "item_id", "stockout_date", "stockout_hour"])


@query
def stream_waste_today(spark, sf):
    """Sales, revenue and waste of every day, the running one too."""
    sdf = streams.stream_waste_today(_stream(spark, sf, (*m.SALE_TYPES, m.WASTE_TYPE)), m.menu(spark))
    return _drain_updates(spark, sdf, "waste", ["store_id", "item_id", "waste_date"])


@query
def stream_append(spark, sf):
    folder = new_folder(spark, "append")
    sdf = _stream(spark, sf, m.SALE_TYPES).select(
        "store_id", "item_id", "quantity", "price", "created_at"
    )
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    for _ in range(2):  # the second run finds nothing new
        streams.stream_append(sdf, out, checkpoint, once=True).awaitTermination()
    return spark.read.parquet(out)


@query
def stream_append_logs(spark, sf):
    """Daily units of the three logs after a stream appended all events, and found nothing new."""
    folder = new_folder(spark, "logs")
    sdf = _stream(spark, sf, (*m.SALE_TYPES, m.WASTE_TYPE, m.STOCKOUT_TYPE))
    for _ in range(2):
        streams.stream_append_logs(
            sdf, f"{folder}/out", f"{folder}/checkpoint", once=True
        ).awaitTermination()
    return _daily_units(spark, f"{folder}/out")


@query
def stream_quality(spark, sf):
    """The tests of the sales log, observed on a stream of its days and added up over the batches."""
    folder = new_folder(spark, "tested")
    sales = m.raw_sales(spark, sf)
    days = sales.withColumn("day", F.to_date("created_at"))
    days.repartitionByRange("day").drop("day").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(sales.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    name = folder.rsplit("/", 1)[1]
    tested = stream_tests.observed(
        stream, name, ["store_id", "item_id", "quantity", "price", "created_at"], {"quantity": 1, "price": 10.0}, "created_at"
    )
    tests = stream_tests.BatchTests(spark, name, f"{folder}/tests")
    sink = streams.file_sink(tested, f"{folder}/out", f"{folder}/checkpoint").trigger(availableNow=True)
    stream_tests.finish_tested(stream_tests.start_tested(sink, tests), tests)
    now = m.log(spark, sf).agg(F.max("created_at"))
    return stream_tests.totals(stream_tests.read_batches(spark, f"{folder}/tests"), now)


@query
def stream_inventory(spark, sf):
    """Units requested and cooked in the closed ticks, and units that are not accounted for."""
    stream = _stream(spark, sf, (*m.SALE_TYPES, m.WASTE_TYPE))
    events = stream.select(
        "store_id",
        "item_id",
        F.when(F.col("kind") == "sales", "demand").otherwise("cook").alias("kind"),
        F.col("created_at").alias("at"),
        F.when(F.col("kind") == "sales", F.col("quantity")).otherwise(F.col("quantity") * 2).alias("quantity"),
    )
    ticks = _drain(spark, inventory_of_stream(events, m.menu(spark), m.stores(spark)), "inventory")
    at_end = F.max_by(F.col("left_over") + F.col("in_progress"), "tick")
    return ticks.groupBy("store_id", "item_id").agg(
        F.sum("requested").alias("requested"),
        F.sum("cooked").alias("cooked"),
        (F.sum("cooked") - F.sum("sold") - F.sum("wasted") - at_end).alias("unexplained"),
    )
