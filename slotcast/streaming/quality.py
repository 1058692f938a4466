"""Data tests on streams: not-null, range and freshness, observed on every micro-batch.

The counts are aggregates that Spark makes while the batch runs (``Dataset.observe``), so they cost no
second pass. A listener stores them, one small file per batch; totals add up over batches.
"""

from __future__ import annotations

import os
import threading
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from slotcast.functions.slots import ntz, to_event_time

SCHEMA = "test string, column_name string, failures long, n_rows long, newest timestamp_ntz"
NOT_NULL, RANGE, FRESHNESS = "not_null", "accepted_range", "freshness"


def observed(sdf: DataFrame, name: str, required: list[str], least: dict[str, float], time: str) -> DataFrame:
    """``sdf`` as it is, with its tests under ``name`` in the progress of every micro-batch.

    Counts nulls of ``required`` columns and values below the bounds in ``least`` (nulls are not counted),
    and keeps the newest ``time``. It goes before any operator that drops or groups rows.
    """
    return sdf.observe(
        name,
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.col(time)).cast("string").alias(f"{FRESHNESS}.{time}"),
        *(F.count_if(F.col(c).isNull()).alias(f"{NOT_NULL}.{c}") for c in required),
        *(F.count_if(F.col(c) < lo).alias(f"{RANGE}.{c}") for c, lo in least.items()),
    )


class BatchTests(StreamingQueryListener):
    """Stores what :func:`observed` found under ``name`` below ``path``, a folder for each batch.

    A batch that is retried overwrites its folder. Batches without rows leave none. A path belongs to
    one checkpoint. ``failed`` holds the error if a batch's tests could not be stored.
    """

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path
        self.failed: Exception | None = None
        self.ended: dict[str, threading.Event] = {}

    def end_of(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is None or not found["n_rows"]:
            return
        try:
            self._store(event.progress.batchId, found)
        except Exception as e:  # a listener's error would be logged and lost
            self.failed = e

    def onQueryTerminated(self, event) -> None:
        self.end_of(event.runId).set()

    def _store(self, batch: int, found: Row) -> None:
        def row(label: str, value):
            test, column = label.split(".", 1)
            fresh = test == FRESHNESS
            return F.struct(
                F.lit(test).alias("test"),
                F.lit(column).alias("column_name"),
                F.lit(None if fresh else value).cast("long").alias("failures"),
                F.lit(found["n_rows"]).cast("long").alias("n_rows"),
                F.lit(value if fresh else None).cast("timestamp_ntz").alias("newest"),
            )

        rows = [row(label, value) for label, value in found.asDict().items() if label != "n_rows"]
        one = self.spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))
        one.write.mode("overwrite").parquet(os.path.join(self.path, f"batch={batch}"))


def start_tested(writer: DataStreamWriter, tests: BatchTests) -> StreamingQuery:
    """Start a stream whose tests are stored."""
    tests.spark.streams.addListener(tests)
    return writer.start()


def finish_tested(query: StreamingQuery, tests: BatchTests, wait: float = 60.0) -> None:
    """Wait until a stream has ended and its last batch's tests are stored; raises what went wrong."""
    try:
        query.awaitTermination()
        if not tests.end_of(query.runId).wait(wait):  # progress comes after the batch, by another thread
            raise TimeoutError(f"no end of {query.runId} was told within {wait} s")
    finally:
        tests.spark.streams.removeListener(tests)
    if tests.failed:
        raise tests.failed


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The tests of every batch."""
    return spark.read.schema(f"{SCHEMA}, batch long").parquet(path)


def totals(
    batches: DataFrame, as_of: datetime | str | DataFrame, max_age: timedelta = timedelta(minutes=30)
) -> DataFrame:
    """(test, column_name, failures, n_rows) over all batches, as the tests of one table would give them.

    Freshness fails, with a 1, if the newest time of all batches is older than ``max_age`` at ``as_of``.
    """
    at = as_of.scalar() if isinstance(as_of, DataFrame) else ntz(as_of)
    age = F.unix_micros(to_event_time(at)) - F.unix_micros(to_event_time("newest"))
    stale = (age > max_age // timedelta(microseconds=1)).cast("long")
    sums = batches.groupBy("test", "column_name").agg(
        F.sum("failures").alias("counted"), F.sum("n_rows").alias("n_rows"), F.max("newest").alias("newest")
    )
    failures = F.when(F.col("test") == FRESHNESS, stale).otherwise(F.col("counted"))
    return sums.select("test", "column_name", failures.alias("failures"), "n_rows")
