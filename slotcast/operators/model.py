"""The demand model: split, fit, predict and evaluate."""

from __future__ import annotations

import math

from pyspark.ml import Model, Pipeline
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

from slotcast.constants import (
    FEATURE_COLUMNS,
    LEARNING_RATE,
    NEUTRAL_PRECIP,
    NEUTRAL_TEMP_F,
    SEED,
    TRAIN_FRACTION,
    TREES,
    URGENCY_THRESHOLD,
)
from slotcast.functions.prefix import units_before
from slotcast.functions.slots import col
from slotcast.session import shared_folder

ROW_ORDER = ("sale_date", "store_id", "item_id", "slot_index")


def _indexer() -> StringIndexer:
    return StringIndexer(
        inputCols=["store_id", "item_id"],
        outputCols=["store_label", "item_label"],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )


def encode_labels(df: DataFrame) -> tuple[DataFrame, StringIndexerModel]:
    """Add ``store_label`` and ``item_label``, numbered in sorted order (runs a job)."""
    indexer = _indexer().fit(df)
    return indexer.transform(df), indexer


def chronological_cut(df: DataFrame, frac: float = TRAIN_FRACTION) -> tuple | None:
    """The last training row in (date, store, item, slot) order, or None if there is none.

    Runs two jobs. The rows of each date, which the driver may hold, tell the date and the place on it. The
    rows of that date alone are counted per slot, and running totals that go item by item and store by
    store find the slot at that place, so no row is ranked against the whole table.
    """
    day, *rest = ROW_ORDER
    counts = {r[day]: r["n"] for r in df.groupBy(day).agg(F.count(F.lit(1)).alias("n")).collect()}
    place = math.floor(sum(counts.values()) * frac)
    if place <= 0:
        return None
    for cut in sorted(counts, key=lambda d: (d is not None, d)):
        if place <= counts[cut]:
            break
        place -= counts[cut]
    if cut is None:
        return None
    slots = df.filter(F.col(day) == F.lit(cut)).groupBy(*ROW_ORDER).agg(F.count(F.lit(1)).alias("n"))
    running = units_before(slots, [day], [rest[-1]], "n", rest[:-1], "before")
    here = (F.col("before") < place) & (F.col("before") + F.col("n") >= place)
    found = running.filter(here).select(*rest).first()
    return None if found is None else (cut, *found)


def chronological_split(df: DataFrame, frac: float = TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    """The earliest ``frac`` of the rows, and the rest. Ties of a date go by store, item and slot.

    Reads ``df`` several times (see :func:`chronological_cut`): pass a table or a staged frame.
    """
    cut = chronological_cut(df, frac)
    if cut is None:
        return df.filter(F.lit(False)), df
    day = F.col(ROW_ORDER[0])
    ties = F.struct(*ROW_ORDER[1:]) <= F.struct(*(F.lit(v) for v in cut[1:]))
    in_train = (day < F.lit(cut[0])) | ((day == F.lit(cut[0])) & ties)
    # The bound on the date alone reaches the scan.
    return df.filter((day <= F.lit(cut[0])) & in_train), df.filter((day >= F.lit(cut[0])) & ~in_train)


def impute_weather(df: DataFrame) -> DataFrame:
    """A neutral day where the weather is unknown."""
    return df.withColumns(
        {
            "temp_f": F.coalesce("temp_f", F.lit(NEUTRAL_TEMP_F)),
            "precip": F.coalesce("precip", F.lit(NEUTRAL_PRECIP)),
        }
    )


def fit_boosted_trees(
    df: DataFrame,
    trees: int = TREES,
    learning_rate: float = LEARNING_RATE,
    seed: int = SEED,
    max_bins: int = 255,
) -> Model:
    """Boosted regression trees on the model features (runs jobs).

    Labels are ordinal numbers to the trees, not categories; without their metadata the number of
    stores does not bound the bins. Lineage is cut in the shared folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    numeric = SQLTransformer(
        statement="SELECT *, store_label + 0.0D AS store_number, item_label + 0.0D AS item_number "
        "FROM __THIS__"
    )
    inputs = ["store_number", "item_number", *FEATURE_COLUMNS[2:]]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    booster = GBTRegressor(
        featuresCol="features",
        labelCol="slot_quantity",
        predictionCol="predicted_units",
        maxIter=trees,
        stepSize=learning_rate,
        seed=seed,
        maxBins=max_bins,
        checkpointInterval=10,
    )
    return Pipeline(stages=[_indexer(), numeric, assembler, booster]).fit(impute_weather(df))


def predict_warm(model: Model, df: DataFrame) -> DataFrame:
    """Add ``predicted_units``; the original ids stay, so nothing has to be decoded."""
    made = ["store_label", "item_label", "store_number", "item_number", "features"]
    return model.transform(impute_weather(df)).drop(*made)


def baseline_forecast(profile: DataFrame) -> DataFrame:
    """The profile mean as the target of each store, item and slot."""
    return profile.select(
        "store_id", "item_id", "slot_index", F.col("avg_slot_quantity").alias("predicted_units")
    )


def regression_metrics(df: DataFrame, y: str | Column, yhat: str | Column) -> DataFrame:
    error = col(y) - col(yhat)
    return df.agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse")
    )


def improvement_pct(base: Column, new: Column) -> Column:
    return (base - new) / base * 100


def urgency_report(
    df: DataFrame,
    y: str | Column,
    yhat: str | Column,
    avg: str | Column,
    threshold: float = URGENCY_THRESHOLD,
) -> DataFrame:
    """Precision, recall, F1 and support of "demand is above ``threshold`` times its average".

    One row per class, then accuracy and the plain and weighted means of the classes. A ratio
    without cases is 0. Everything comes from the four cells of one aggregate.
    """
    limit = col(avg) * threshold
    actual, predicted = col(y) > limit, col(yhat) > limit
    cells = df.agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))

    def of_class(hit: str, false_alarm: str, missed: str) -> dict[str, Column]:
        h, a, m = F.col(hit), F.col(false_alarm), F.col(missed)
        return {
            "precision": ratio(h, h + a),
            "recall": ratio(h, h + m),
            "f1": ratio(2 * h, 2 * h + a + m),
            "support": h + m,
        }

    normal, urgent = of_class("tn", "fn", "fp"), of_class("tp", "fp", "fn")
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    none = F.lit(None).cast("double")
    accuracy = {
        "precision": none,
        "recall": none,
        "f1": ratio(F.col("tp") + F.col("tn"), total),
        "support": total,
    }
    scores = ("precision", "recall", "f1")
    macro = {s: (normal[s] + urgent[s]) / 2 for s in scores} | {"support": total}
    weighted = {
        s: ratio(normal[s] * normal["support"] + urgent[s] * urgent["support"], total) for s in scores
    } | {"support": total}
    rows = {
        "NORMAL": normal,
        "URGENT": urgent,
        "accuracy": accuracy,
        "macro avg": macro,
        "weighted avg": weighted,
    }
    structs = (
        F.struct(F.lit(label).alias("label"), *(c.alias(name) for name, c in row.items()))
        for label, row in rows.items()
    )
    return cells.select(F.inline(F.array(*structs)))
