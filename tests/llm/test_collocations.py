import random
import re
from collections import Counter

import numpy as np
import pytest

from slotcast.llm.collocations import MisraGries, collocations


def brute_force(rows, threshold, top):
    """Every phrase counted as text, every cut tried."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, masses = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        found = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            masses[lang] += len(words)
            for k in range(1, 6):
                found.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        n, rows = masses[lang], []
        often = {p: a for p, a in found.items() if a >= threshold}
        for p, a in often.items():
            inside = any(
                q[i : i + len(p)] == p and 100 * b >= 100 * a
                for q, b in often.items()
                if len(q) > len(p)
                for i in range(len(q) - len(p) + 1)
            )
            if len(p) > 1 and not inside:
                score, _, l, r = min(
                    (1000 * a * n // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]])
                    for k in range(1, len(p))
                )
                rows.append((score, a, " ".join(p), l, r))
        rows.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n, s) for i, (s, a, p, l, r) in enumerate(rows[:top])]
    return sorted(out)


def results(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(3)
    words = ["der", "Die", "das", "été", "New", "york", "x-1", "語", "in", "of", "𝒳"]
    fixed = ["New York in of das Die der", "in\tof  das", "a" * 50_000]
    rows = []
    for i in range(300):
        some = [pick.choice(words) for _ in range(pick.randint(0, 60))]
        if i % 3 == 0:
            some.insert(len(some) // 2, pick.choice(fixed))
        text = "".join(w + pick.choice([" ", " ", " ", " ", "  ", "\t", ", ", "\n", ".", "!\r"]) for w in some)
        rows.append((text, pick.choice(["en", "de", None])))
    return [*rows, *rows[:40], ("", "en"), (None, "fr"), (" \t ", None), ("same same " * 400, "de")]


@pytest.mark.parametrize("threshold, top", [(5, 2000), (12, 7)])
def test_equals_brute_force(spark, texts, threshold, top):
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(5)
    got = results(collocations(docs, threshold, top))
    assert got == brute_force(texts, threshold, top)
    assert got


def test_other_columns_and_empty_tables(spark, texts):
    schema = "n long, gram string, text string, word string, lang string, score long"
    rows = [(1, "g", t, "w", x, 3) for t, x in texts[:60]]
    assert results(collocations(spark.createDataFrame(rows, schema), 5)) == brute_force(texts[:60], 5, 2000)
    assert results(collocations(spark.createDataFrame([], schema), 5)) == []
    assert results(collocations(spark.createDataFrame([(1, "", "once only", "", "en", 1)], schema), 5)) == []


def test_summaries_lose_no_frequent_key():
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 2**62, 300_000), np.repeat(np.arange(50), 100), rng.integers(100, 900, 90_000)])
    keys = rng.permutation(keys).astype(np.uint64)
    summary = MisraGries(len(keys) // 100 + 1, 100)
    for part in np.array_split(keys, 40):
        summary.add(*np.unique(part, return_counts=True))
        assert summary.removed < 100
    distinct, counts = np.unique(keys, return_counts=True)
    found = set(summary.frequent().tolist())
    assert set(distinct[counts >= 100].tolist()) <= found
    assert summary.removed > 0 and len(found) < 5_000  # of some 300,000
