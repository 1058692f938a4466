import random

import pytest
from pyspark.sql import functions as F

from slotcast.llm.token_counts import count_pieces, count_tokens, pretokens

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_pretokens_add_up(model):
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice(" \n\tab1é<s>.▁　x\0") for _ in range(rng.randint(1, 12)))
        words = pretokens(text)
        counts = count_pieces(model, words)
        assert sum(counts[w] for w in words) == len(model.encode(text)), text


def test_counts(spark, model):
    texts = ["", None, " ", "a  b ", "</s> <s>", "über\n\n  x", "word " * 20000, "a" * 30000, "w", "w"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "w")], "doc_id long, text string")
    out = count_tokens(df.withColumn("n_tokens", F.lit("x")), PATH, memo=3).collect()
    assert len(out) == len(texts) + 1
    for r in out:
        text = texts[r["doc_id"]] or "" if r["doc_id"] is not None else "w"
        n = len(model.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 4096)
    assert count_tokens(df.limit(0), PATH).count() == 0
