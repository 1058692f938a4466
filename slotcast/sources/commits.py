"""Commits of an event log: which files count, and the newest sale of each store.

A commit is one Parquet file in a folder of its own (``_commits/version=n``), written by one Spark write
after all it names. It holds an entry for each new file with its day, rows and time range, an entry for
each store that sold with the time of its newest sale, and its epoch. A snapshot holds the entries
of the whole log and makes older commits superfluous. So a reader's work follows the files of
the log and the flushes since the last compaction, never the events.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from slotcast.session import folders, remove

ENTRIES = StructType(
    [
        StructField("entry", StringType()),  # file, clock, epoch, replaced or snapshot
        StructField("kind", StringType()),
        StructField("file", StringType()),
        StructField("event_date", DateType()),
        StructField("n_rows", LongType()),
        StructField("first", TimestampNTZType()),
        StructField("last", TimestampNTZType()),
        StructField("store_id", StringType()),
        StructField("epoch", LongType()),
    ]
)
_WITH_VERSION = StructType([*ENTRIES.fields, StructField("version", LongType())])


def _folder(path: str) -> str:
    return os.path.join(path, "_commits")


def _entries(df: DataFrame, entry: str) -> DataFrame:
    given = df.withColumn("entry", F.lit(entry))
    return given.select(
        *((F.col(f.name) if f.name in given.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ENTRIES)
    )


def file_entries(stored: DataFrame, kind: str) -> DataFrame:
    """An entry for each file of freshly written rows."""
    per_file = stored.groupBy(F.col("_metadata.file_path").alias("file"), "event_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("created_at").alias("first"), F.max("created_at").alias("last")
    )
    return _entries(per_file.withColumn("kind", F.lit(kind)), "file")


def clock_entries(newest: DataFrame) -> DataFrame:
    """An entry for each store, from (store_id, last)."""
    return _entries(newest.dropna(subset=["store_id"]), "clock")


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in folders(spark, _folder(path)) if name.startswith("version="))


def _write(spark: SparkSession, path: str, entries: list[DataFrame]) -> None:
    version = max(versions(spark, path), default=-1) + 1
    every = reduce(DataFrame.unionByName, entries)
    every.coalesce(1).write.parquet(os.path.join(_folder(path), f"version={version}"))  # one file: all or nothing


def commit(spark: SparkSession, path: str, entries: list[DataFrame], epoch: int) -> None:
    """Make a flush count (runs a job)."""
    of_epoch = _entries(spark.range(1).select(F.lit(epoch).alias("epoch")), "epoch")
    _write(spark, path, [*entries, of_epoch])


def state(spark: SparkSession, path: str) -> DataFrame:
    """The entries that hold now: those of the newest snapshot and of all commits after it."""
    known = versions(spark, path)
    if not known:
        return spark.createDataFrame([], ENTRIES)
    every = spark.read.schema(_WITH_VERSION).parquet(_folder(path))
    snapshots = every.filter("entry = 'snapshot'").agg(F.max("version")).first()[0]
    return every.filter(F.col("version") >= (known[0] if snapshots is None else snapshots)).drop("version")


def files(spark: SparkSession, path: str, kind: str) -> list[Row]:
    """The files of a log with their days: names and days only, as Spark's own file index has them."""
    of_kind = state(spark, path).filter((F.col("entry") == "file") & (F.col("kind") == kind))
    return of_kind.select("file", "event_date", "n_rows", "first", "last").collect()


def epochs(spark: SparkSession, path: str) -> set[int]:
    return {r["epoch"] for r in state(spark, path).filter("entry = 'epoch'").select("epoch").collect()}


def clocks(spark: SparkSession, path: str) -> DataFrame:
    """(store_id, now): the time of each store's newest sale."""
    return state(spark, path).filter("entry = 'clock'").groupBy("store_id").agg(F.max("last").alias("now"))


def changed_days(spark: SparkSession, path: str, after: int, kind: str = "sales") -> set:
    """The days of a log that flushes after the commit ``after`` wrote to.

    Where commits after it are gone, those that a snapshot replaced, all days count as changed.
    """
    known = versions(spark, path)
    if not known:
        return set()
    every = spark.read.schema(_WITH_VERSION).parquet(_folder(path)).filter(F.col("version") > after)
    if after + 1 >= known[0]:
        snapshots = every.filter("entry = 'snapshot'").select("version")
        every = every.join(F.broadcast(snapshots), "version", "left_anti")  # one row for each compaction kept
    days = every.filter((F.col("entry") == "file") & (F.col("kind") == kind)).select("event_date").distinct()
    return {r["event_date"] for r in days.collect()}


def commit_snapshot(spark: SparkSession, path: str, new: list[DataFrame], replaced: list[str]) -> None:
    """Commit all that holds, with the entries ``new`` in place of the files ``replaced`` (runs a job)."""
    held = state(spark, path)
    old = spark.createDataFrame([(f,) for f in replaced], "file string")
    kept = held.filter("entry = 'file'").join(old, "file", "left_anti").select(*ENTRIES.names)
    marked = _entries(spark.range(1), "snapshot")
    newest = clock_entries(clocks(spark, path).withColumnRenamed("now", "last"))
    _write(spark, path, [kept, newest, held.filter("entry = 'epoch'"), _entries(old, "replaced"), marked, *new])


def remove_replaced(spark: SparkSession, path: str) -> None:
    """Delete what the newest snapshot replaced: data files, and all commits before it."""
    gone = state(spark, path).filter("entry = 'replaced'").select("file").collect()
    remove(spark, *(r["file"] for r in gone))
    every = spark.read.schema(_WITH_VERSION).parquet(_folder(path))
    newest = every.filter("entry = 'snapshot'").agg(F.max("version")).first()[0]
    old = [v for v in versions(spark, path) if newest is not None and v < newest]
    remove(spark, *(os.path.join(_folder(path), f"version={v}") for v in old))
