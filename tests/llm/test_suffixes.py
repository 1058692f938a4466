import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from slotcast.llm import suffixes


def brute(rows, length):
    seen = Counter()
    for _, x in rows:
        data = (x or "").encode()
        seen.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = Counter()
    for k, x in rows:
        data = (x or "").encode()
        cut = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                cut[i : i + length] = b"\1" * length
        kept = bytes(v for v, c in zip(data, cut) if not c)
        spans = sum(1 for i, c in enumerate(cut) if c and (i == 0 or not cut[i - 1]))
        out[k, len(data), sum(cut), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def fixture():
    rng = random.Random(3)
    words = ["alpha", "be", "gam", "d", "é", "zz ", "The "]

    def text(n):
        return "".join(rng.choice(words) for _ in range(n))

    base = [text(60) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [
            rng.choice(base)[rng.randint(0, 40) : rng.randint(60, 250)] if rng.random() < 0.6 else text(rng.randint(0, 25))
            for _ in range(rng.randint(0, 6))
        ]
        rows.append((i if i % 17 else None, "".join(parts) if i % 23 else None))
    rows += [(500, "a" * 900), (501, "ab" * 300), (502, ""), (503, "x" * 39), (504, "y" * 40), (7, rows[8][1])]
    return rows + [(600 + i, rows[9][1]) for i in range(5)]


@pytest.mark.parametrize("hot", [20_000, 2])
def test_like_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("gram", F.lit("x"))
    got = Counter(tuple(r) for r in suffixes.remove_repeats(df, 40).collect())
    assert got == brute(rows, 40)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(df).count() == 0


def test_segments_name_the_same_windows(monkeypatch):
    texts = [x.encode() for _, x in fixture() if x]
    def windows():
        out = Counter()
        for which, gram, _, start, n, offset in suffixes.anchors_of(texts, 40, 13):
            for i, g, s, k, o in zip(which, gram, start, n, offset):
                for j in range(k):
                    out[int(i), int(s) + j, int(g), int(s) + int(o)] += 1
        return out
    whole = windows()
    assert sum(whole.values()) == sum(max(0, len(t) - 39) for t in texts) and set(whole.values()) == {1}
    monkeypatch.setattr(suffixes, "_SEGMENT", 300)
    assert windows() == whole


def test_merge_keeps_order_and_prefixes():
    rng = random.Random(1)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 40))) for _ in range(7)]
    coded = [suffixes.front_code(run) for run in runs]
    decoded = [suffixes.front_decode(*c) for c in coded]
    got = list(suffixes.merge(decoded))
    assert [s for _, s, _ in got] == sorted(s for run in runs for s in run)
    last = b""
    for known, s, _ in got:
        assert known == suffixes.common_prefix(last, s)
        last = s
