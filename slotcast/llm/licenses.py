"""License scans with a positional index of rare words (operator 6).

Templates are short, well-known licence notices. An inverted index holds, for each template word,
its positions in the templates. One pass counts in how many documents each of these words occurs;
the second tries each template whose rarest key word stands in the document, however many these are,
and intersects the postings of its words by relative position: word places that agree on where a
template would start vote for it with their inverse document frequency. A template counts where an alignment gathers enough of its weight and
its mandatory key phrase stands there word for word.

Base phrases are counted at all their places, whatever the templates say.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm.common import by_batch, narrow, table, texts_of

#: Base phrases and their labels, as given.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: label -> (notice, mandatory key phrase); wording of the public licences.
TEMPLATES = {
    "agpl-3.0": ("gnu affero general public license version 3", "affero general public license"),
    "apache-2.0": ("licensed under the apache license version 2 0", "apache license"),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms",
    ),
    "bsl-1.0": ("boost software license version 1 0", "boost software license"),
    "cc-by-4.0": ("licensed under cc by 4 0", "cc by 4 0"),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", "cc by nc"),
    "cc-by-nc-nd-4.0": ("licensed under cc by nc nd 4 0", "cc by nc nd"),
    "cc-by-nc-sa-4.0": ("licensed under cc by nc sa 4 0", "cc by nc sa"),
    "cc-by-nd-4.0": ("licensed under cc by nd 4 0", "cc by nd"),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", "cc by sa"),
    "cc0-1.0": ("cc0 1 0 universal public domain dedication", "cc0"),
    "epl-2.0": ("eclipse public license version 2 0", "eclipse public license"),
    "gpl-2.0": ("licensed under the gnu general public license version 2", "general public license version 2"),
    "gpl-3.0": ("licensed under the gnu general public license version 3", "general public license version 3"),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "permission to use copy modify and or distribute this software",
    ),
    "lgpl": ("gnu lesser general public license", "lesser general public license"),
    "mit": ("released under the mit license", "mit license"),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "permission is hereby granted free of charge",
    ),
    "mpl-2.0": ("mozilla public license version 2 0", "mozilla public license"),
    "reserved": ("all rights reserved", "all rights reserved"),
    "unlicense": ("this is free and unencumbered software released into the public domain", "unencumbered software"),
}
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)
# In UTF-8, the letters of a word are digits, small letters, and all bytes of other code points.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+").findall


def words_of(text: str) -> list[bytes]:
    return _WORD(text.encode().lower())  # bytes lower-case A-Z only


class Index:
    """Template words with their postings, and the words of the base phrases."""

    def __init__(self, templates: dict[str, tuple[str, str]] = TEMPLATES, base: dict[str, str] = BASE):
        split = lambda phrase: phrase.encode().split()
        self.templates = {k: (split(notice), split(key)) for k, (notice, key) in templates.items()}
        self.base = [(split(phrase), label) for phrase, label in base.items()]
        self.postings = defaultdict(list)
        for label, (notice, key) in self.templates.items():
            for i, word in enumerate(notice):
                self.postings[word].append((label, i))
        self.words = set(self.postings)
        for phrase, _ in [*self.base, *[(key, "") for _, key in self.templates.values()]]:
            self.words.update(phrase)


def _starts(places: dict[bytes, list[int]], phrase: list[bytes]) -> list[int]:
    """All places where the words of a phrase stand one after the other."""
    if any(w not in places for w in phrase):
        return []
    sets = [set(places[w]) for w in phrase[1:]]
    return [p for p in places[phrase[0]] if all(p + i + 1 in s for i, s in enumerate(sets))]


def rarest_words(index: Index, weight: dict[bytes, float]) -> dict[bytes, list[str]]:
    """The templates by the rarest word of their mandatory key phrase; none counts without that word."""
    out = defaultdict(list)
    for label, (_, key) in index.templates.items():
        out[max(key, key=lambda w: (weight[w], w))].append(label)
    return out


def scan(index: Index, weight: dict[bytes, float], rarest: dict[bytes, list[str]], words: list[bytes], enough: float):
    """Base places and labels, and the method's labels with the best share of a template's weight."""
    places = defaultdict(list)
    for i, word in enumerate(words):
        if word in index.words:
            places[word].append(i)
    found, base_labels = [], set()
    for phrase, label in index.base:
        at = _starts(places, phrase)
        if at:
            found += at
            base_labels.add(label)
    best = {}
    for label in (label for word in rarest.keys() & places.keys() for label in rarest[word]):
        notice, key = index.templates[label]
        keys = _starts(places, key)
        if not keys:
            continue
        votes = Counter()
        for word in set(notice):
            for i in (i for name, i in index.postings[word] if name == label):
                for p in places.get(word, ()):
                    votes[p - i] += weight[word]
        total = sum(weight[w] for w in notice)
        length = len(notice)
        for start, got in votes.items():
            at = bisect_left(keys, start - 2)
            if got >= enough * total and at < len(keys) and keys[at] < start + length:
                best[label] = max(best.get(label, 0.0), got / total)
    score = max(best.values(), default=1.0 if base_labels else 0.0)
    return found, base_labels, set(best), min(1.0, score)


def document_frequency(docs: DataFrame, index: Index) -> tuple[dict[bytes, int], int]:
    """In how many documents each template word occurs, and how many documents there are (runs a job)."""

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = Counter()
            for text in texts_of(batch):
                counts.update(index.words.intersection(words_of(text)))
            rows = [("", batch.num_rows), *[(w.decode(), n) for w, n in counts.items()]]
            words, n = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        return one

    sums = by_batch(docs, make, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = {r["word"]: r["n"] for r in sums.collect()}  # bounded by the words of the templates
    total = rows.pop("", 0)
    return {w.encode(): n for w, n in rows.items()}, total


def licenses(docs: DataFrame, enough: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License phrases and labels of every whole text (runs a job for the word frequencies).

    Every template that can count is tried: where the word of highest inverse document frequency of
    its key phrase occurs. Null texts count as empty and have no labels. Repeated
    rows each get a row, null ids are kept, other columns are not read; an empty table gives an
    empty result.
    """
    docs, index = narrow(docs, id_col, text_col), Index()
    frequency, total = document_frequency(docs, index)
    weight = {w: math.log((1 + total) / (1 + frequency.get(w, 0))) + 0.1 for w in index.words}
    rarest = rarest_words(index, weight)

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text in texts_of(batch):
                words = words_of(text)
                at, base, extra, score = scan(index, weight, rarest, words, enough)
                rows.append(
                    (
                        len(words),
                        len(at),
                        min(at, default=None),
                        max(at, default=None),
                        ",".join(sorted(base)),
                        ",".join(sorted(base | extra)),
                        score,
                    )
                )
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)

        return one

    return by_batch(docs, make, SCHEMA)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))
