"""Event logs: one folder per kind, partitioned by date, all stores together.

What a log holds is told by its commits (``sources.commits``), not by what lies in its folders.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from slotcast.functions.slots import ntz
from slotcast.schemas import LOGS
from slotcast.session import stage
from slotcast.sources import commits

DATE = "event_date"
FLUSH = "flush"  # which write a row came from; until it is committed, the row is not there

Schemas = dict[str, StructType]


def _layout(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(FLUSH, StringType()), StructField(DATE, DateType())])


def read_events(
    spark: SparkSession,
    path: str,
    kind: str,
    since: datetime | None = None,
    dates: Iterable[date] | None = None,
    schemas: Schemas = LOGS,
) -> DataFrame:
    """A log with its fixed schema: the files that are committed, and no others.

    ``since`` prunes files, date folders and row groups; ``dates`` leaves those days' files alone.
    """
    schema = schemas[kind]
    wanted = None if dates is None else set(dates)
    files = [
        f["file"]
        for f in commits.files(spark, path, kind)
        if (since is None or (f["event_date"] is not None and f["event_date"] >= since.date()))
        and (wanted is None or f["event_date"] in wanted)
    ]
    if not files:
        return spark.createDataFrame([], schema)
    events = spark.read.schema(_layout(schema)).option("basePath", os.path.join(path, kind)).parquet(*files)
    if since is not None:
        events = events.filter(
            (F.col(DATE) >= F.to_date(ntz(since))) & (F.col("created_at") >= ntz(since))
        )
    return events.select(*schema.names)


def read_store_folders(spark: SparkSession, path: str) -> DataFrame:
    """Logs that come one folder per store (``store_id=...``), in one scan.

    Whatever stores there are, are read; the id is the folder's. Columns meet by name; missing ones
    are null.
    """
    return spark.read.option("mergeSchema", True).parquet(path)


def union_stores(stores: dict[str, DataFrame]) -> DataFrame:
    """Tag each store's frame with its id and stack them; for a few stores, one plan branch each.

    Columns meet by name; missing ones are null. Many stores belong in folders, see
    :func:`read_store_folders`.
    """
    tagged = (df.withColumn("store_id", F.lit(store_id)) for store_id, df in stores.items())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _as_log(df: DataFrame, schema: StructType) -> DataFrame:
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*columns, F.to_date("created_at").alias(DATE))


def append_events(df: DataFrame, epoch: int, path: str, schemas: Schemas = LOGS) -> None:
    """Write one flush of events with a ``kind`` column to the logs (runs jobs).

    All flushes share the date folders. A flush counts from its commit on, which is one small file written
    last: a flush that failed before leaves rows that nobody reads, and one that is repeated after its
    commit writes nothing. Flushes of one log come from one writer at a time, each under its own
    ``epoch``.
    """
    spark = df.sparkSession
    if epoch in commits.epochs(spark, path):
        return
    df.persist()  # one flush; read once, written to the logs
    try:
        entries = [_write(df.filter(F.col("kind") == kind), kind, path, schema) for kind, schema in schemas.items()]
        newest = df.filter("kind = 'sales'").groupBy("store_id").agg(F.max("created_at").alias("last"))
        commits.commit(spark, path, [*entries, commits.clock_entries(newest)], epoch)
    finally:
        df.unpersist()


def _write(df: DataFrame, kind: str, path: str, schema: StructType) -> DataFrame:
    """Add rows to a log's date folders, as yet uncommitted; returns the entries of their files."""
    spark, folder, flush = df.sparkSession, os.path.join(path, kind), uuid.uuid4().hex
    rows = _as_log(df, schema).withColumn(FLUSH, F.lit(flush))
    days = [r[DATE] for r in rows.select(DATE).distinct().collect()]  # the days of one flush
    # Rebalancing keeps files large: few per date, and a date with much data gets several.
    rows.select(*schema.names, FLUSH, DATE).hint("rebalance", DATE).write.mode("append").partitionBy(DATE).parquet(folder)
    of_days = F.lit(False)
    for day in days:
        of_days |= F.col(DATE).eqNullSafe(F.lit(day))
    stored = spark.read.schema(_layout(schema)).parquet(folder).filter(of_days & (F.col(FLUSH) == flush))
    return commits.file_entries(stored, kind)


def compact_events(spark: SparkSession, path: str, before: date, schemas: Schemas = LOGS) -> None:
    """Rewrite the days before ``before`` that lie in several files (runs jobs).

    Commits what the log holds as a whole, so that readers need no older commit. Files that were replaced
    stay until :func:`remove_replaced`, for readers that still have them in their plans.
    """
    new, replaced = [], []
    for kind, schema in schemas.items():
        of_day: dict[date, list[str]] = {}
        for f in commits.files(spark, path, kind):
            if f["event_date"] is not None and f["event_date"] < before:
                of_day.setdefault(f["event_date"], []).append(f["file"])
        days = [d for d, some in of_day.items() if len(some) > 1]
        if days:
            rows = read_events(spark, path, kind, dates=days, schemas=schemas)
            new.append(_write(rows, kind, path, schema))
            replaced += [f for d in days for f in of_day[d]]
    commits.commit_snapshot(spark, path, new, replaced)


def remove_replaced(spark: SparkSession, path: str) -> None:
    """Delete the files and commits that the newest compaction replaced."""
    commits.remove_replaced(spark, path)


def read_clocks(spark: SparkSession, path: str, schemas: Schemas = LOGS) -> DataFrame:
    """The time of the newest sale of each store, from the commits; no event is read."""
    store = schemas["sales"]["store_id"].dataType
    return commits.clocks(spark, path).withColumn("store_id", F.col("store_id").cast(store))


def insert_events(df: DataFrame, kind: str, table: str) -> None:
    """Append events of one kind to a catalog table (runs a job)."""
    # Rebalancing keeps files large: few per date, and a date with much data gets several.
    _as_log(df, LOGS[kind]).hint("rebalance", DATE).write.mode("append").insertInto(table)


def delete_from_cutoff(spark: SparkSession, tables: list[str], cutoff: datetime | date) -> None:
    """Delete events with ``created_at >= cutoff`` from date-partitioned tables (runs jobs).

    Later dates are dropped as partitions without being read; only the cutoff's own date is
    rewritten. Events without a time are kept. Every step may be repeated, so an interrupted run is
    finished by running it again.
    """
    cutoff_day = str(cutoff)[:10]
    whole_day = str(cutoff)[11:] in ("", "00:00:00")
    for table in tables:
        values = (row.partition.split("=")[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect())
        days = sorted(v for v in values if _is_day(v))
        dropped = [d for d in days if d > cutoff_day or (whole_day and d == cutoff_day)]
        if cutoff_day in days and not whole_day:
            kept = stage(
                spark.table(table).filter(
                    (F.col(DATE) == F.lit(cutoff_day).cast("date"))
                    & (F.col("created_at") < ntz(cutoff))
                ),
                "kept",
            )
            if kept.isEmpty():
                dropped.append(cutoff_day)
            else:
                _replace_partitions(kept, table)
        if dropped:
            specs = ", ".join(f"PARTITION ({DATE} = DATE'{d}')" for d in dropped)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def _is_day(value: str) -> bool:
    """False for the partition of rows without a date."""
    try:
        date.fromisoformat(value)
    except ValueError:
        return False
    return True


def _replace_partitions(df: DataFrame, table: str) -> None:
    """Overwrite only the partitions that ``df`` has rows in."""
    conf, key = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        conf.set(key, before)


def ensure_tables(spark: SparkSession, schema: str = "raw") -> None:
    """Create the three log tables where they do not exist yet, partitioned by date."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    names = {"sales": "sales_events", "waste": "waste_log", "stockouts": "stockout_events"}
    for kind, name in names.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LOGS[kind])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {schema}.{name} ({columns}, {DATE} date) "
            f"USING parquet PARTITIONED BY ({DATE})"
        )
