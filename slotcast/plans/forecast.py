"""Training, evaluation and the production plan, from the stored marts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.ml import Model, PipelineModel
from pyspark.sql import Column, DataFrame, Observation, functions as F

from slotcast.constants import TREES
from slotcast.operators import model as ml
from slotcast.operators.features import model_features
from slotcast.operators.plan import production_plan
from slotcast.plans.marts import Dims
from slotcast.session import stage
from slotcast.sources.tables import overwrite_table


def train(features: DataFrame, trees: int = TREES) -> tuple[Model, DataFrame]:
    """Fit on the earliest 80 % of the feature table; returns the model and the held-out rows.

    The features are staged once, since the split and every tree read them again.
    """
    rows = stage(model_features(features), "features")
    train_rows, test_rows = ml.chronological_split(rows)
    return ml.fit_boosted_trees(train_rows, trees), test_rows


def save_model(model: Model, path: str) -> None:
    """Store a fitted model, in place of any at ``path``; training and planning are separate runs."""
    model.write().overwrite().save(path)


def load_model(path: str) -> Model:
    return PipelineModel.load(path)


def evaluate(model: Model, test_rows: DataFrame) -> DataFrame:
    """MAE and RMSE of the model and of the profile mean on held-out rows, and the gain."""
    scored = ml.predict_warm(model, test_rows)
    return compare(scored, "predicted_units", "avg_slot_quantity")


def compare(scored: DataFrame, new: str, base: str, y: str = "slot_quantity") -> DataFrame:
    """Errors of two forecasts of the same rows and the improvement in percent, in one pass."""
    errors = {name: F.col(y) - F.col(c) for name, c in (("base", base), ("new", new))}
    sums = scored.agg(
        *(F.avg(F.abs(e)).alias(f"{name}_mae") for name, e in errors.items()),
        *(F.sqrt(F.avg(e * e)).alias(f"{name}_rmse") for name, e in errors.items()),
    )
    return sums.withColumns(
        {
            f"{m}_improvement_pct": ml.improvement_pct(F.col(f"base_{m}"), F.col(f"new_{m}"))
            for m in ("mae", "rmse")
        }
    )


def publish_plan(
    marts: dict[str, DataFrame],
    dims: Dims,
    as_of: date | Column,
    model: Model | str,
    table: str = "predictions",
    weather_by_region: DataFrame | None = None,
) -> None:
    """Write the plan, in store order, so that a store's dashboard reads few row groups.

    ``model`` is a fitted model or the path of a stored one. Rows are counted as the grid and the plan are
    written, so that a plan that lost or doubled rows is an error, and the table stays as it was.
    """
    model = load_model(model) if isinstance(model, str) else model
    predict: Callable[[DataFrame], DataFrame] = lambda df: ml.predict_warm(model, df)
    n_grid, n_plan = Observation("grid"), Observation("plan")
    plan = production_plan(
        dims.stores,
        dims.menu,
        marts["baseline_profile"],
        marts["cold_start_profile"],
        marts["traffic_ratio"],
        as_of,
        predict,
        known_items(model, marts["baseline_profile"]),
        weather_by_region,
        n_grid,
    )
    plan = stage(plan.observe(n_plan, F.count(F.lit(1)).alias("n")), "plan")
    if n_grid.get["n"] != n_plan.get["n"]:
        raise RuntimeError(f"the plan has {n_plan.get['n']} rows for {n_grid.get['n']} of the grid")
    stamped = plan.withColumn("predicted_at", F.localtimestamp())
    overwrite_table(stamped, table, ["store_id", "item_id", "slot_index"])


def known_items(model: Model, profile: DataFrame) -> DataFrame:
    """The item ids the model was trained on."""
    spark = profile.sparkSession
    labels = model.stages[0].labelsArray[1]
    ids = spark.createDataFrame([(label,) for label in labels], "item_id string")
    return ids.select(F.col("item_id").cast(profile.schema["item_id"].dataType))
