"""Running totals that no single task has to compute alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from slotcast.functions.slots import has_all


def units_before(
    df: DataFrame, keys: list[str], order: list[str], value: str, buckets: list[str], name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` (not negative) over the earlier rows of the same key.

    ``buckets`` are columns that grow with ``order``, from coarse to fine. Rows run up only inside
    their finest bucket; where a bucket starts follows from the totals of the buckets before it,
    which is the same problem on far fewer rows. A key with a third of all rows thus spreads over
    as many tasks as it has buckets. Rows without a key or bucket are left out.

    A bucket's total is its last running value, and the filter is the one that the join would
    add, so that rows and totals share one scan and one shuffle.
    """
    inside = [*keys, *buckets]
    earlier = (
        Window.partitionBy(*inside)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    running = df.filter(has_all(*inside)).withColumn(name, F.coalesce(F.sum(value).over(earlier), F.lit(0)))
    if not buckets:
        return running
    totals = running.groupBy(*inside).agg(F.max(F.col(name) + F.col(value)).alias("_units"))
    start = f"{name}_of_bucket"
    starts = units_before(totals, keys, buckets[-1:], "_units", buckets[:-1], start)
    return (
        running.join(starts.drop("_units"), inside)
        .withColumn(name, F.col(name) + F.col(start))
        .drop(start)
    )
