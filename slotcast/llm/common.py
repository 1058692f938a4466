"""Helpers shared by the corpus operators: inputs, Arrow batches, staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of ``documents``, in their order.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="slotcast-llm-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests on one machine) gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = _own_folder()
    return os.path.join(folder, f"{name}-{uuid.uuid4().hex}")


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove staged tables that nothing will read again; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (runs a job); cuts the lineage."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_rows(df: DataFrame, count: int, limit: int) -> DataFrame:
    """``df``, of ``count`` rows at most, as a side of joins that do not broadcast it beyond ``limit`` rows.

    Spark would decide by the size of the files. A staged table of ids is many times as large in
    memory, first in the driver, and several such joins run at once.
    """
    return df.hint("merge") if count > limit else df


def stage_buckets(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """Write ``df`` to the shared folder, bucketed by ``keys``, and read it back (runs a job).

    There are as many buckets as a shuffle has partitions, so a join on ``keys`` moves the other side
    only. The catalog forgets the table at once; its files stay.
    """
    spark = df.sparkSession
    buckets, known = shuffle_partitions(spark), f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys).write.option("path", scratch(spark, name)).option("compression", "zstd")
    dealt.bucketBy(buckets, *keys).saveAsTable(known)
    table = spark.table(known)
    spark.sql(f"DROP TABLE {known}")
    return table


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def by_batch(
    docs: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply a function of one Arrow batch to ``docs``. ``make`` runs once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            if batch.num_rows:
                yield one(batch)
                pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


#: Spark's own limits of an Arrow batch, and those for whole texts, of which a worker holds a batch as it
#: comes, as strings and as results, and the executor one in its own buffers.
_BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4m"),
}


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator reads, under its own names, so that others cannot clash.

    Where the session still has Spark's own limits of an Arrow batch, they are lowered for texts.
    """
    conf = docs.sparkSession.conf
    for name, (own, lower) in _BATCH.items():
        if conf.get(name) == own:
            conf.set(name, lower)
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        *[F.col(f"`{c}`") for c in more],
    )
