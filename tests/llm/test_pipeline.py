import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from slotcast.llm.common import DOCUMENT_COLUMNS, table
from slotcast.llm.decontaminate import contaminated
from slotcast.llm.near_dups import near_duplicates

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, as the pipeline writes and rereads them."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), table(spark, SF, "documents"), []
    odd = [(10**6 + i, text, None, None, None) for i, text in enumerate([None, "", "123 456", "Some words mail me@x.org"])]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out.append(docs)
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs.withColumn("extra", F.lit(1)), SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns(stages):
    for df in stages[1:5]:
        assert tuple(df.columns) == DOCUMENT_COLUMNS
    assert "sequence_id" in stages[5].columns


def test_decisions_take_effect(spark, stages):
    start, known, unique, clean, private, packed = stages
    assert ids(start) - ids(known) == {10**6, 10**6 + 1, 10**6 + 2}
    kept = near_duplicates(known)
    assert ids(unique) == ids(kept.where("kept")) and near_duplicates(unique).where("not kept").count() == 0
    leaked = contaminated(unique, table(spark, SF, "benchmark")).where("contaminated")
    assert ids(leaked) and ids(clean) == ids(unique) - ids(leaked)
    assert ids(private) == ids(clean)
    texts = {r["doc_id"]: r for r in private.collect()}
    assert texts[10**6 + 3]["text"] == "Some words mail <email>" and texts[10**6 + 3]["n_chars"] == 23
    changed = clean.join(private.select("doc_id", F.col("text").alias("new")), "doc_id").where("text <> new")
    assert 0 < changed.count() < clean.count()
    assert ids(packed) == ids(private)


def test_empty_input(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, SF).count() == 0
