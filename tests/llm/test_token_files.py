import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from slotcast.llm import token_files as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "word", "Don't", " ", "  ", "\n", " \n ", "\t", "x-1,", "12345", "été", "語語", "<|endoftext|>", "<|end", " ",
    " ", "\x1c", "\x85", "'ll", "...", "🙂", "á", "İ", "​", "A" * 90,
]


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(5)
    made = ["".join(pick.choice(PARTS) + pick.choice(["", " "]) for _ in range(pick.randint(0, 30))) for _ in range(1_500)]
    return [*made, "", None, " ", "  ", " a", "a ", "  a  b ", "b\n  c", "long text, no end " * 20_000, "語" * 60_000]


def test_words_give_the_ids_of_whole_texts(texts):
    with open(PATH, encoding="utf8") as f:
        model = f.read()
    tokenizer, encoder = Tokenizer.from_str(model), tf.Encoder(model)
    small = tf.Encoder(model, memory=4_000)  # forgets most of what it met
    for text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.of(text or ""), "<u4").tolist() == ids
        assert small.of(text or "") == encoder.of(text or "")
    ids, n = encoder.of_all([t or "" for t in texts], np.array([0], "<u4").tobytes())
    every = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(x) + 1 for x in every] and ids.tolist() == [i for x in every for i in [*x, 0]]
    for known in (small.pretokens, small.after_blank):
        assert len(known) + len(known.old) < 40


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, {}
    for doc, text in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out[doc] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def stored(spark, texts, tmp_path_factory):
    rows = [(i * 7 % len(texts) * 10, t) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("tokens"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS shard", "2 AS first").repartition(6)
    tf.write_tokens(docs, PATH, path, group_bytes=4 << 10, page_rows=50)
    return path, expected([(d, t or "") for d, t in rows])


def test_round_trip(spark, stored):
    path, want = stored
    got = {r["doc_id"]: tuple(r[1:]) for r in tf.checksums(tf.read_tokens(spark, path)).collect()}
    assert got == {d: w[:3] for d, w in want.items()}
    ids = {r["doc_id"]: r["tokens"] for r in tf.read_tokens(spark, path).collect()}
    assert ids == {d: w[3] for d, w in want.items()}


def test_reading_in_part(spark, stored):
    path, want = stored
    some = tf.read_tokens(spark, path, docs=(1_000, 1_200))
    assert {r["doc_id"]: r["tokens"] for r in some.collect()} == {d: w[3] for d, w in want.items() if 1_000 <= d <= 1_200}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,1000)" in plan and "LessThanOrEqual(doc_id,1200)" in plan
    meta = tf.read_tokens(spark, path, tokens=False)
    assert {r["doc_id"]: r["start"] for r in meta.collect()} == {d: w[0] for d, w in want.items()}
    assert "tokens:array" not in meta._jdf.queryExecution().executedPlan().toString()
    every = [i for d in sorted(want) for i in want[d][3]]
    for start, length in [(0, 10), (4_321, 5_000), (len(every) - 7, 100), (len(every) + 5, 3)]:
        span = sorted(tf.read_span(spark, path, start, length).collect(), key=lambda r: r["start"])
        assert [i for r in span for i in r["tokens"]] == every[start : start + length]
        assert not span or span[0]["start"] == start


def test_files(stored):
    path, want = stored
    encodings, groups, last = {}, 0, -1
    for name in sorted(glob.glob(f"{path}/data/*.parquet")):
        meta = pq.ParquetFile(name).metadata
        ids = pq.read_table(name)["doc_id"].to_pylist()
        assert ids == sorted(ids) and (not ids or ids[0] > last)
        last = ids[-1] if ids else last
        for g in range(meta.num_row_groups):
            groups += 1
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                assert column.has_offset_index and column.has_column_index
                encodings.setdefault(column.path_in_schema, set()).update(column.encodings)
    assert "RLE_DICTIONARY" in encodings["tokens.list.element"]
    for name in ("doc_id", "first", "n_tokens"):
        assert "DELTA_BINARY_PACKED" in encodings[name] and "RLE_DICTIONARY" not in encodings[name]
    assert groups > len(glob.glob(f"{path}/data/*.parquet"))


def test_empty_and_repeated(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    tf.write_tokens(empty, PATH, f"{tmp_path}/e")
    assert tf.read_tokens(spark, f"{tmp_path}/e").count() == 0
    assert tf.read_span(spark, f"{tmp_path}/e", 0, 5).count() == 0
    rows = [(1, "one two"), (1, "one two"), (1, "three"), (None, "none"), (2, None)]
    tf.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), PATH, f"{tmp_path}/r")
    got = tf.read_tokens(spark, f"{tmp_path}/r").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 1, 1, 2]
    ends = [r["start"] + r["n_tokens"] for r in got]
    assert [r["start"] for r in got] == [0, *ends[:-1]] and got[-1]["tokens"] == [0]
