"""The fitted trees as a table, and predictions by walking it.

A stored model's nodes are an ordinary table: it can be read, joined and compared without the library that
fitted it. The walk goes down all trees at once, level by level, and shares no code with the
model's own prediction.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from slotcast.constants import FEATURE_COLUMNS
from slotcast.operators.model import impute_weather
from slotcast.session import folders

#: What the trees split on, in the order of their feature numbers.
INPUTS = ("store_label", "item_label", *FEATURE_COLUMNS[2:])


def tree_nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """A row per node of a stored model: tree, weight, node, feature and threshold (go left up to it), left and
    right child, value, rows it was fitted on and gain. A leaf has no feature."""
    stages = os.path.join(model_path, "stages")
    name = next(n for n in folders(spark, stages) if "GBT" in n)
    weights = spark.read.parquet(os.path.join(stages, name, "treesMetadata")).toDF("tree", "about", "weight")
    n = F.col("nodeData")
    leaf = n["leftChild"] < 0
    inner = {"feature": n["split"]["featureIndex"], "threshold": n["split"]["leftCategoriesOrThreshold"][0],
             "left": n["leftChild"], "right": n["rightChild"], "gain": n["gain"]}
    return (
        spark.read.parquet(os.path.join(stages, name, "data"))
        .select(
            F.col("treeID").alias("tree"),
            n["id"].alias("node"),
            n["prediction"].alias("value"),
            n["rawCount"].alias("n_rows"),
            *(F.when(~leaf, c).alias(name) for name, c in inner.items()),
        )
        .join(weights.select("tree", "weight"), "tree")
    )


def walk_trees(df: DataFrame, nodes: DataFrame, model: Model, name: str = "walked_units") -> DataFrame:
    """Add the weighted sum of the leaves that each row reaches (runs a small job for the nodes).

    ``model`` only numbers stores and items. The nodes are bounded by the number and depth of the trees, not by
    the data.
    """
    rows = nodes.orderBy("tree", "node").toPandas()
    root = rows.groupby("tree", sort=True).size().cumsum().shift(fill_value=0).to_numpy()
    first = rows["tree"].map(dict(enumerate(root))).to_numpy()
    leaf = rows["feature"].isna().to_numpy()
    feature = rows["feature"].fillna(0).to_numpy(np.int64)
    threshold = rows["threshold"].fillna(0.0).to_numpy()
    stay = np.arange(len(rows))
    left = np.where(leaf, stay, first + rows["left"].fillna(0).to_numpy(np.int64))
    right = np.where(leaf, stay, first + rows["right"].fillna(0).to_numpy(np.int64))
    value = (rows["value"] * rows["weight"]).to_numpy()

    def walk(x: pd.Series) -> pd.Series:
        sums = []
        for a in range(0, len(x), 2_000):  # rows times trees are held at once
            some = np.stack(x.iloc[a : a + 2_000].to_numpy())
            at = np.broadcast_to(root, (len(some), len(root)))
            while not leaf[at].all():
                goes_left = np.take_along_axis(some, feature[at], 1) <= threshold[at]
                at = np.where(goes_left, left[at], right[at])
            sums.append(value[at].sum(1))
        return pd.Series(np.concatenate(sums) if sums else [], dtype=float)

    numbered = model.stages[0].transform(impute_weather(df))
    inputs = F.array(*(F.col(c).cast("double") for c in INPUTS))
    return numbered.withColumn(name, F.pandas_udf(walk, DoubleType())(inputs)).drop("store_label", "item_label")
