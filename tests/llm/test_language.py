import zlib

from pyspark.sql import functions as F

from slotcast.llm.language import counts, determined, fit, identify, predict, sample


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = identify(docs).collect()
    assert len(out) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = docs.withColumn("lang", F.when(out, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("y"))
    assert sorted(map(tuple, identify(docs).collect())) == sorted(map(tuple, identify(other).collect()))


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !? 34", "fr"), (None, "le chat et la souris", "fr"), (4, "the cat and a dog", "en")]
    rows += [(6, "the house of a man", None), (6, "the house of a man", None), (7, "x " * 60000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(2))
    out = identify(df).collect()
    assert len(out) == len(rows)
    assert {r["doc_id"] for r in out if r["lang_pred"] == "und"} == {1, 2, 3}
    kept = determined(df)
    assert kept.columns == df.columns and kept.count() == 5
    assert identify(df.limit(0)).count() == 0
    assert {r["lang_pred"] for r in identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_two_levels():
    texts = {"en": "the and of with", "de": "der und von mit", "fr": "le et de avec", "es": "el y de con"}
    rows = [(k, f"{v} {v.split()[i % 4]}") for k, v in texts.items() for i in range(8)]
    import numpy as np

    model = fit(np.stack([counts(t) for _, t in rows]), [k for k, _ in rows])
    assert model["tops"] == ["germanic", "romance"] and set(model["pairs"]) == {("de", "en"), ("es", "fr")}
    assert all(predict(model, counts(t))[0] == k for k, t in rows)


def test_every_labelled_language_is_learned(spark):
    sizes = {f"x{i}": 500 for i in range(8)} | {"rare": 25, "last": 4}
    rows = [(f"{lang} text {'word ' * (i % 7)}{chr(97 + i % 26)}{i}", lang) for lang, n in sizes.items() for i in range(n)]
    rows += [(f"copied {i % 2}", "copies") for i in range(2000)] + [(f"{i} !?", "none") for i in range(50)]
    ids = [i for i in range(20000) if zlib.crc32(str(i).encode()) % 5]
    df = spark.createDataFrame([(k, *r) for k, r in zip(ids, rows)], "doc_id long, text string, lang string")
    got = {r["lang"]: r["count"] for r in sample(df, 60, 440).groupBy("lang").count().collect()}
    assert got == {f"x{i}": 40 for i in range(8)} | {"rare": 25, "last": 4, "copies": 2}
