import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from slotcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Frames from rows, with times and dates given as text."""
    from pyspark.sql import functions as F

    def build(rows, columns):
        named = [c.split() for c in columns.split(", ")]
        text = ", ".join(
            f"{name} {'string' if kind in ('date', 'timestamp_ntz') else kind}" for name, kind in named
        )
        df = spark.createDataFrame(rows, text)
        return df.select(*(F.col(name).cast(kind).alias(name) for name, kind in named))

    return build


def as_dicts(df, *order):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(r[c] for c in order)) if order else rows
