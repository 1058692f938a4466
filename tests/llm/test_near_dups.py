import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from slotcast.llm import near_dups
from slotcast.llm.near_dups import BINS, _borrow_order, band_keys, near_duplicates, remove_near_duplicates, shingles


def word_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {k: word_shingles(x) for k, x in rows}
    least = {k: k for k in sets}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                least[y] = x
    return {(k, len(sets[k]), find(k), find(k) == k) for k in ids}


def fixture():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(4000)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    rows = []
    for n in (1, 3, 5, 8, 30, 120, 400):
        for _ in range(4):
            original = words(n)
            rows.append(" ".join(original))
            for _ in range(9):  # copies with up to a few edits, on both sides of the limit
                copy = list(original)
                for _ in range(rng.randint(0, 1 + n // 25)):
                    at = rng.randrange(len(copy))
                    copy[at : at + 1] = words(rng.randint(0, 2)) or ["x"]
                rows.append(rng.choice([" ", "\n", "\t "]).join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    original = words(150)  # far copies of one text, with edits that several of them share
    for _ in range(150):
        copy = list(original)
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(0, len(copy) - 1, 5)
            copy[at : at + 1] = rng.choice([[], [], ["x"], words(1), words(2)])
        rows.append(" ".join(copy))
    passage = words(60)
    rows += [" ".join([*words(40), *passage, *words(40)]) for _ in range(40)]
    rows += ["", "  \n", None, None]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(order[i] * 3 - 100, x) for i, x in enumerate(rows)]


def test_components_like_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("n")).withColumn("a", F.lit(1))
    out = near_duplicates(df)
    assert {tuple(r) for r in out.collect()} == brute(rows)


def test_removal_keeps_one_of_each(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "z"), (4, None), (None, "a b c d e f g"), (3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(0))
    left = remove_near_duplicates(df)
    assert Counter(r["doc_id"] for r in left.collect()) == Counter([1, 3, 3, 4, None]) and left.columns == df.columns
    assert near_duplicates(df.limit(0)).count() == 0


def test_sketch_estimates_likeness():
    rng = np.random.default_rng(0)
    order = _borrow_order(BINS)
    shared = 0
    for _ in range(200):
        both = rng.integers(0, 2**63, 60, dtype=np.uint64)
        a = np.unique(np.concatenate([both, rng.integers(0, 2**63, 10, dtype=np.uint64)]) * np.uint64(2))
        b = np.unique(np.concatenate([both, rng.integers(0, 2**63, 10, dtype=np.uint64)]) * np.uint64(2))
        shared += (band_keys(a, order) == band_keys(b, order)).any()
    assert shared == 200  # likeness 0.75


def test_long_and_short_texts():
    assert len(shingles("")) == 0 and len(shingles("a b")) == 1 and len(shingles("a " * 100000)) == 1


def broadcasts(df):
    """Lines of the joins of a plan that broadcast a side."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search("Broadcast(HashJoin|NestedLoop)", line)]


def test_only_sieves_are_broadcast_beyond_short_lists(spark, monkeypatch):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found, stage = [], near_dups.stage
    monkeypatch.setattr(near_dups, "stage", lambda df, name: found.extend((name, x) for x in broadcasts(df)) or stage(df, name))
    monkeypatch.setattr(near_dups, "LISTED", 0)
    out = near_duplicates(df)
    assert {tuple(r) for r in out.collect()} == brute(rows)
    left = remove_near_duplicates(df)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(k for k, _, _, kept in brute(rows) if kept)
    found += [("end", x) for x in broadcasts(out) + broadcasts(left)]
    assert found and [x for x in found if "sieve_page" not in x[1]] == []


def test_list_of_few_ids_with_many_entries_is_not_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)] + [(None, "none")], "doc_id long, text string")
    ids = spark.createDataFrame([(i, list(range(200))) for i in range(0, 50, 10)], "doc_id long, roles array<long>")
    monkeypatch.setattr(near_dups, "LISTED", 900)
    met = near_dups._only(docs, ids, 1000)
    assert {r["doc_id"] for r in met.collect()} == set(range(0, 50, 10)) and met.columns == ["doc_id", "text", "roles"]
    assert all("sieve_page" in x for x in broadcasts(met))


def test_sieve_holds_all_listed_ids_in_bounded_pages(spark):
    docs = spark.range(400_000).withColumnRenamed("id", "doc_id").withColumn("a", F.lit("a"))
    ids = docs.where("doc_id % 40 = 3").select("doc_id")
    out = near_dups._sieved(docs, ids, 10_000)
    listed = out.where("doc_id % 40 = 3 and maybe_listed").count()
    others = out.where("doc_id % 40 <> 3 and maybe_listed").count()
    assert listed == 10_000 and others < 0.08 * 390_000 and out.columns == ["doc_id", "a", "maybe_listed"]
    pages = near_dups._sieve(docs.select("doc_id"), 10**12)
    assert pages.count() == near_dups.PAGES and pages.where("octet_length(sieve_bits) <> 4096").isEmpty()


def test_removal_moves_only_texts_that_pass_the_sieve(spark, monkeypatch):
    rows = [(i, f"{i} b c d e f {i // 2}") for i in range(20)] + [(20, "0 b c d e f 0"), (None, "0 b c d e f 0"), (20, "z")]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("sieve", F.lit(0))
    monkeypatch.setattr(near_dups, "LISTED", 0)
    left = remove_near_duplicates(df)
    assert len(broadcasts(left)) == 2 and all("sieve_page" in x for x in broadcasts(left))
    assert left.columns == df.columns and left.schema["doc_id"].dataType == df.schema["doc_id"].dataType
    assert Counter(r["doc_id"] for r in left.collect()) == Counter([*range(20), None])
