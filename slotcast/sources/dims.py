"""Dimension files: stores, menu and weather."""

from __future__ import annotations

import os
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from slotcast.schemas import MENU, MENU_CSV, STORES, WEATHER


def read_dims_csv(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """``stores``, ``menu_items`` and ``weather_daily`` with fixed schemas.

    Columns are found by the names in the header, in any order; further ones are left out, and a
    missing one is an error. ``sale_days`` is a list in text form and becomes an array.
    """

    def read(name: str, schema: StructType) -> DataFrame:
        text = spark.read.csv(os.path.join(folder, f"{name}.csv"), header=True)
        missing = [f.name for f in schema if f.name not in text.columns]
        if missing:
            raise ValueError(f"{name}.csv has no column {', '.join(missing)}")
        return text.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))

    menu = read("menu_items", MENU_CSV)
    return {
        "stores": read("stores", STORES),
        "menu_items": menu.withColumn("sale_days", F.from_json("sale_days", "array<int>")),
        "weather_daily": read("weather_daily", WEATHER),
    }


def read_dims_yaml(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """``menu`` and ``stores`` from configuration files.

    These are hand-written lists, so the driver parses them; Spark reads the text, from any file
    system. ``added`` becomes a date whether the parser returns it as text or as a date.
    """
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("read_dims_yaml needs PyYAML; use read_dims_csv without it") from missing

    def load(name: str, list_name: str) -> list[dict]:
        text = spark.read.text(os.path.join(folder, f"{name}.yaml"), wholetext=True).first()
        return yaml.safe_load(text["value"])[list_name]

    def frame(rows: list[dict], schema: StructType, id_name: str) -> DataFrame:
        # Numbers may be written without a point, and dates come as text or as dates.
        readers = {"double": float, "date": lambda v: date.fromisoformat(str(v))}
        values = []
        for row in rows:
            named = row | {id_name: row["id"]}
            values.append(
                tuple(
                    None
                    if named.get(f.name) is None
                    else readers.get(f.dataType.typeName(), lambda v: v)(named[f.name])
                    for f in schema
                )
            )
        return spark.createDataFrame(values, schema)

    return {
        "menu": frame(load("menu", "items"), MENU, "item_id"),
        "stores": frame(load("stores", "stores"), STORES, "store_id"),
    }


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with a header line."""
    df.write.mode("overwrite").csv(path, header=True)
