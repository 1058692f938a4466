"""A corpus pipeline over ``documents``: each stage is one operator of ``slotcast.llm``.

Every stage takes the rows its predecessor kept and all but the last return the columns of
``documents``. What a stage decides takes effect: documents go, or their text changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm.common import DOCUMENT_COLUMNS, scratch, table
from slotcast.llm.decontaminate import remove_leaks
from slotcast.llm.language import determined
from slotcast.llm.near_dups import remove_near_duplicates
from slotcast.llm.packing import pack
from slotcast.llm.pii import redact


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return determined(docs.select(*DOCUMENT_COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return remove_near_duplicates(docs.select(*DOCUMENT_COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return remove_leaks(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    clean = redact(docs.select(*DOCUMENT_COLUMNS))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Learned models decide in three stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
