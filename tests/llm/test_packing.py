import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotcast.llm.packing import Ids, least_squares, pack, places, plan_windows

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_ids_are_the_tokenizers(tokenizer):
    ids = Ids(tokenizer, memory=20_000)
    rng = random.Random(8)
    parts = [*" \n\tabTS1É'éßẞ<|>sſµª²́İΣ.,!\x85　中&", "<|endoftext|>", "'S ", "it's", "Straße", "don't"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.of(text), "<u4").tolist() == want, text
        every, n = ids.of_all([text, "", text], np.array([2], "<u4").tobytes())
        assert every.tolist() == [*want, 2, 2, *want, 2] and n.tolist() == [len(want) + 1, 1, len(want) + 1]
    assert len(ids.chunks) + len(ids.chunks.old) < 100  # bounded by bytes


def test_every_id_lies_in_one_place(spark, tokenizer):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["the", "cat", "Haus", "über", "12"]) for _ in range(rng.choice([0, 1, 7, 300, 1500, 9000]))) for _ in range(60)]
    texts += [None, "", "same words here"] + ["same words here"] * 30
    rows = list(enumerate(texts)) + [(None, "no id"), (5, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rank", F.lit(1)).withColumn("salt", F.lit(2))
    out = pack(df, PATH).collect()
    pieces = {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append(r)
    for doc in set(k for k, _ in rows):
        want = []
        for k, x in rows:
            if k == doc:
                ids = np.array([*tokenizer.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
                for at in range(0, len(ids), 4096):
                    piece = ids[at : at + 4096]
                    want.append((at, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
        got = [(r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces[doc]]
        assert sorted(got) == sorted(want)
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert pack(df.limit(0), PATH).count() == 0


def test_plan_uses_each_length_as_often_as_it_occurs():
    rng = np.random.default_rng(3)
    counts = np.bincount(np.minimum(4096, rng.geometric(1 / 900, 20000)), minlength=4097)
    plan = plan_windows(counts, 4096)
    used = np.zeros(4097, int)
    for combo, times in plan:
        assert times > 0 and sum(combo) <= 4096
        for length in combo:
            used[length] += times
    assert (used == counts).all()
    room = sum((4096 - sum(c)) * t for c, t in plan)
    assert room <= 0.01 * 4096 * sum(t for _, t in plan)
    by_length = {}
    for length, first, end, _, _ in places(plan):
        by_length.setdefault(length, []).append((first, end))
    for length, ranges in by_length.items():
        ranges.sort()
        assert ranges[0][0] == 0 and ranges[-1][1] == counts[length]
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))


def test_least_squares_meets_an_exact_histogram():
    counts = np.zeros(11)
    counts[[7, 3, 6, 4]] = 50, 50, 20, 20
    x = least_squares([(7, 3), (6, 4), (4, 3, 3)], counts, rounds=400)
    assert np.allclose(x, [50, 20, 0], atol=0.5)
