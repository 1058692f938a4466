import math
import re

from pyspark.sql import functions as F

from slotcast.llm.licenses import BASE, TEMPLATES, Index, document_frequency, licenses, scan, words_of


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    at, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        at += found
        labels.update([label] * bool(found))
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


TEXTS = {
    1: "Some text. Licensed under the Apache License, Version 2.0.\nEnd",
    2: "Released under the MIT License.",
    3: "This work is licensed under the GNU General Public License, version 3. All rights reserved. ALL RIGHTS RESERVED",
    4: "Licensed under CC BY-NC 4.0. über cc é by",
    5: "we visited the public park under the old license plate, version two",
    6: "",
    7: None,
    8: "cc by " * 30000,
    9: "apache license apache",
}


def test_base_places_and_labels(spark):
    rows = [*TEXTS.items(), (None, "all rights reserved"), (2, TEXTS[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("labels", F.lit(1))
    out = licenses(df).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    for k, text in TEXTS.items():
        r = by[k]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text or "")
    assert by[1]["labels"] == "apache-2.0" and by[2]["labels"] == "mit" and by[3]["labels"] == "gpl,gpl-3.0,reserved"
    assert by[4]["labels"] == "cc-by,cc-by-nc-4.0" and by[5]["labels"] == "" and by[9]["labels"] == ""
    assert all(0 <= r["score"] <= 1 for r in out)
    assert licenses(df.limit(0)).count() == 0


def test_whole_table_like_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in licenses(docs).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(texts[r["doc_id"]])


def brute_labels(text):
    """Labels of the templates whose notice stands in the text word for word, and of the base phrases."""
    words = f" {' '.join(re.findall('[0-9a-z]+', text.lower()))} "
    return {k for k, (notice, _) in TEMPLATES.items() if f" {notice} " in words} | {v for k, v in BASE.items() if f" {k} " in words}


def test_no_template_is_left_out_of_a_long_file(spark):
    notices = [notice for notice, _ in TEMPLATES.values()]
    long = [TEMPLATES[k][0] for k in ("isc", "bsd", "mit-text")]
    texts = [". ".join(notices), ". ".join(notices[::-1]), ". ".join(notices[::2])]
    texts += [". ".join([*long, TEMPLATES[k][0]]) for k in ("mit", "cc-by-4.0", "lgpl", "cc0-1.0")]
    rows = [*enumerate(texts), *[(100 + i, f"some other words {i} the of a license") for i in range(20)]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in licenses(df).collect()}
    index = Index()
    frequency, total = document_frequency(df, index)
    weight = {w: math.log((1 + total) / (1 + frequency.get(w, 0))) + 0.1 for w in index.words}
    for i, text in rows:
        words, found = words_of(text), set(filter(None, out[i]["labels"].split(",")))
        every = {w: list(TEMPLATES) for w in set(words) & index.words if w == min(set(words) & index.words)}
        _, base, extra, score = scan(index, weight, every, words, 0.7)  # tries all templates
        assert found == base | extra and abs(out[i]["score"] - score) < 1e-9
        assert brute_labels(text) <= found and (i < 100 or not found)
