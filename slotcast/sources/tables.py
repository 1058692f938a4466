"""Shared tables, layers and parameterised scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Views are cheap to redefine; tables are computed once per run.
LAYERS = {"staging": "view", "intermediate": "view", "marts": "table", "metrics": "table"}


def overwrite_table(df: DataFrame, name: str, cluster_by: list[str] | None = None) -> None:
    """Replace a table (runs a job).

    With ``cluster_by``, rows are spread by ranges of these columns and sorted inside each file,
    so that a later filter on them skips files and row groups.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    df.write.mode("overwrite").saveAsTable(name)


def layer_schema(layer: str | None, default: str = "default") -> str:
    """A layer's schema is its name in capitals; without a layer, the default schema."""
    return default if layer is None else layer.upper()


def materialize(spark: SparkSession, df: DataFrame, layer: str, name: str) -> DataFrame:
    """Publish a model as its layer asks for: a view, or a table in the layer's schema."""
    if LAYERS[layer] == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    schema = layer_schema(layer)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    overwrite_table(df, f"{schema}.{name}")
    return spark.table(f"{schema}.{name}")


def scan_store_predictions(
    spark: SparkSession, store_id: str | int, table: str | DataFrame = "predictions"
) -> DataFrame:
    """The predictions of one store, with the id bound as a parameter."""
    source = spark.table(table) if isinstance(table, str) else table
    return spark.sql(
        "SELECT store_id, item_id, slot_index, predicted_units FROM {source} "
        "WHERE store_id = :store_id",
        args={"store_id": store_id},
        source=source,
    )
