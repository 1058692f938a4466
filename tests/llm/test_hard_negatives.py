import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotcast.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, box string, v int, query string"


def brute_force(rows, is_anchor, n_positives=5, n_negatives=5, low=80):
    known = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, v, label) in enumerate(known):
        if not is_anchor(i):
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w)), j, other == label)
            for m, (j, w, other) in enumerate(known)
            if m != n and len(w) == len(v)
        ]
        scored.sort()
        for s, j, _ in [x for x in scored if x[2]][:n_positives]:
            fit = [x for x in scored if not x[2] and low * -s <= 100 * -x[0] <= 100 * -s][:n_negatives]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fit)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, x, "b", 1, "q") for i, v, x in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hn.hard_negatives(df, F.col("vec_id") % 10 == 0, **options).collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 9))
    rows = [(i, (centres[i % 6] + rng.normal(size=9)).tolist(), int(rng.integers(0, 4))) for i in range(700)]
    rows += [(i, [0.5] * 9, i % 3) for i in range(700, 1_000)]  # one vector that a third of all rows share
    rows += [(i, rng.integers(-1, 2, 9).astype(float).tolist(), 1) for i in range(1_000, 1_060)]  # many ties
    rows += [(2_000, None, 1), (2_010, [1.0] * 9, None), (None, [1.0] * 9, 1), (2_020, [math.nan] + [1.0] * 8, 1)]
    rows += [(2_030, [math.inf] + [1.0] * 8, 1), (2_040, [None] + [1.0] * 8, 1), (2_050, [], 1), (2_051, [], 2)]
    rows += [(3_000 + i, rng.normal(size=3).tolist(), i % 2) for i in range(40)]  # of another size
    return rows + [rows[0], rows[20], rows[710], (40, rows[41][1], 3)]  # repeated rows, and a repeated id


@pytest.mark.parametrize("box_rows, axes", [(4_096, 3), (50, 3), (64, 1)])
def test_equals_brute_force(spark, rows, box_rows, axes):
    want = brute_force(rows, lambda i: i % 10 == 0)
    assert len(want) > 1_000
    assert run(spark, rows, box_rows=box_rows, axes=axes) == want


def test_few_requests_at_once_and_other_numbers(spark, rows, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 7)
    monkeypatch.setattr(hn, "CHUNK", 3)
    want = brute_force(rows[:500], lambda i: i % 10 == 0, 2, 9, 50)
    assert run(spark, rows[:500], box_rows=40, n_positives=2, n_negatives=9, low_percent=50) == want


def test_small_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0, 2.0], 1)]) == []
    assert run(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]) == [(0, 1, 1, 2, 65_536, 256 * 230)]


def test_numbers_beyond_floating_point(spark):
    big = [(i, [float(2**21 + i), 3.0, float(-(2**20))], i % 3) for i in range(60)]
    assert run(spark, big) == brute_force(big, lambda i: i % 10 == 0)
    with pytest.raises(Exception, match="64-bit"):
        run(spark, [(i, [1e30, 1.0], 1) for i in range(3)])


def test_the_tree_prunes():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 4)) * 2_000
    rows = np.concatenate([c + rng.normal(size=(200, 4)) * 20 for c in centres]).astype(np.int64)
    tree = hn.Tree(np.arange(len(rows)), np.zeros(len(rows), np.int64), rows)
    leaves = -(-len(rows) // hn.LEAF)
    looked = []
    tree.rows = lambda leaf: looked.append(leaf) or slice(leaf * hn.LEAF, (leaf + 1) * hn.LEAF)
    one = np.zeros(1, np.int64)
    best, ids = hn.search(tree, rows[:1], one, True, one + hn._LEAST, one + hn._MOST, one + hn._LEAST, 5)
    want = np.sort(rows @ rows[0])[::-1][:5]
    assert best[0].tolist() == want.tolist() and len(looked) < leaves / 4
    looked.clear()
    lo, hi = int(want[4] * 0.4), int(want[4] * 0.5)
    best, ids = hn.search(tree, rows[:1], one, True, one + lo, one + hi, one + hn._LEAST, 5)
    inside = np.sort([s for s in rows @ rows[0] if lo <= s <= hi])[::-1][:5]
    assert best[0][: len(inside)].tolist() == inside.tolist() and len(looked) < leaves / 2
