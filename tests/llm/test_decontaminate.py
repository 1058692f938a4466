from pyspark.sql import functions as F

from slotcast.llm.decontaminate import contaminated, remove_leaks

ITEM = "If a train travels 60 km in 2 hours, what is the average speed of Anna on her way to Paris?"
DOCS = [
    (1, "Well. if a train travels 75 miles in 3 days, what is the average speed of Bob on her way to Rome? Yes."),
    (2, "nothing of the kind, though a train travels far on its way to some place and back again each day"),
    (3, None),
    (4, "I wrote short text here!"),
    (4, "another row of one id"),
    (5, "it says: " + ITEM + " and more"),
    (6, "If a train travels fast in the night, what is the average delay of one on the way to work?"),
    (7, ""),
    (8, "word " * 50000 + ITEM),
]


def frames(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("item_id", F.lit(9)).withColumn("hash", F.lit("x"))
    items = spark.createDataFrame(
        [(1, ITEM), (1, ITEM), (2, "Short text here"), (3, None), (4, "")], "item_id long, text string"
    )
    return docs, items


def test_templates(spark):
    docs, items = frames(spark)
    out = {r["doc_id"]: r for r in contaminated(docs, items).collect()}
    assert {k for k, r in out.items() if r["contaminated"]} == {1, 4, 5, 8}
    assert out[1]["reparameterised"] and not out[5]["reparameterised"] and not out[8]["reparameterised"]
    assert out[5]["share"] == 1.0 and out[5]["item_id"] == 1 and out[4]["item_id"] == 2


def test_slots_must_be_consistent(spark):
    item = "Tom has 5 apples and gives 5 apples to his friend who eats all of them today"
    rows = [
        (1, "Tom has 8 apples and gives 8 apples to his friend who eats all of them today"),
        (2, "Tom has 8 apples and gives 9 apples to his friend who eats all of them today"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r["doc_id"]: r["contaminated"] for r in contaminated(docs, items).collect()} == {1: True, 2: False}


def test_removal_and_empty_tables(spark):
    docs, items = frames(spark)
    left = remove_leaks(docs, items)
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 6, 7] and left.columns == docs.columns
    assert remove_leaks(docs, items.limit(0)).count() == len(DOCS)
    assert contaminated(docs.limit(0), items).count() == 0


def test_planted_items_are_found(spark):
    d = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    texts = [r["text"] for r in items.collect()]
    want = {r["doc_id"] for r in docs.collect() if any(t in (r["text"] or "") for t in texts)}
    assert want == {r["doc_id"] for r in contaminated(docs, items).where("contaminated").collect()}


def judged(spark, item, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    return {r["doc_id"]: r for r in contaminated(docs, items).collect()}


def test_conflicting_slots_only_drop_their_windows(spark):
    tail = "to a friend who eats all of them while the others look on and wait for what may come of it in the end"
    item = "Tom has 5 apples and gives 5 apples " + tail
    out = judged(
        spark,
        item,
        [
            item.replace("has 5", "has 8").replace("gives 5", "gives 9"),
            item.replace("gives 5", "gives 6"),
            "Tom has 8 apples and gives 9 apples to no one as it is his own meal",
            "Tom has 5 apples and gives 6 apples to his friend",
        ],
    )
    assert [out[i]["contaminated"] for i in range(3)] == [True, True, False]
    assert out[0]["n_windows"] < out[1]["n_windows"] and out[1]["share"] == 1.0 and out[1]["reparameterised"]
    short = "Tom has 5 apples and gives 5 apples to his friend"
    assert judged(spark, short, [short.replace("gives 5", "gives 6")])[0]["contaminated"]


def test_passages_of_long_items(spark):
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "klmnprstvwxz"]
    item = " ".join(words)
    out = judged(
        spark,
        item,
        [
            "Some say " + " ".join(words[130:180]) + " and no more",
            "Some say " + " ".join(words[130:142]) + " and no more",
            "Some say " + " ".join(words[130:136] + ["so"] + words[136:142]) + " and no more",
        ],
    )
    assert [out[i]["contaminated"] for i in range(3)] == [True, False, False]
    assert 0 < out[0]["share"] < 0.25


def test_items_of_few_words(spark):
    out = judged(spark, "What is 12 + 7?", ["He asked: what is 12 + 7? No answer", "What is 13 + 7?", "see What is 12 + 7 here"])
    assert [out[i]["contaminated"] for i in range(3)] == [True, False, True]
    title = "The Quick Brown Fox Jumps Over The Lazy Dog By The Old River"
    out = judged(spark, title, [f"We read {title} today", "We read The Slow Brown Hen Walks Under The Busy Cow Near The New River"])
    assert [out[i]["contaminated"] for i in range(2)] == [True, False]
    numbers = "1 2 3 4 5 6 7 8 9 10 11 12 13 14"
    out = judged(spark, numbers, [f"it counts {numbers} so", "it counts 2 3 4 5 6 7 8 9 10 1 1 1 1 1 so", "9 8 7 6 5 4 3 2 1 0 9 8 7 6"])
    assert [out[i]["contaminated"] for i in range(3)] == [True, True, False]
