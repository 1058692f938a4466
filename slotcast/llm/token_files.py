"""Token ids in Parquet files that can be read in part (operator 11).

One row holds a document: ``doc_id``, its ``shard``, ``first`` (ids of the shard before it),
``n_tokens`` and ``tokens``, a list of ids. Rows are in ascending ``doc_id`` order, within a shard and
over the shards. Files are written by Spark's own Parquet writer, so a lost executor costs a task:

* ids are dictionary-encoded, so that an id takes as many bits as the vocabulary asks for; the numbers
  beside them grow slowly and are delta-encoded;
* row groups have a size limit and pages a row limit, and every file carries column and offset
  indexes, so a reader of some documents or positions touches the pages that hold them, and a reader
  of the metadata never touches the ids.

A small table beside the files (``shards``) has the ids before each shard: a position of the whole
collection is a shard's base and a position in it.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm.common import narrow, scratch, shuffle_partitions, table, texts_of
from slotcast.llm.known import Known, joined_ids, text_runs
from slotcast.llm.merges import Merges, Words, byte_letters

ROWS = "doc_id long, shard int, first long, n_tokens long, tokens array<int>"
SHARDS = "shard int, base long, n_tokens long, n_docs long, first_doc long, last_doc long"


# Letters, digits and signs whose classes this module knows by itself; others go to the tokenizer.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ\\n\\t\\r]*").fullmatch
_PRETOKENS = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_LETTERS}0-9\\s]+|\\s+(?!\\S)|\\s+"
).findall


class Encoder:
    """Ids of whole texts as 32-bit little-endian bytes, for a byte-level vocabulary that splits by its
    usual pattern.

    A blank between two other characters always starts a new pre-token, so the ids of a text are those of
    its words, each with the blank before it. The distinct plain words of some texts are cut and merged
    together (:class:`Words`). Other words come from bounded tables of what was met before, where a
    word of simple characters is cut here and any other goes to the tokenizer whole.
    """

    def __init__(self, model: str, memory: int = 32 << 20):
        import regex
        from tokenizers import Tokenizer

        if array("I").itemsize != 4 or sys.byteorder != "little":
            raise RuntimeError("ids are written as this machine's 32-bit little-endian integers")
        self.tokenizer = Tokenizer.from_str(model)
        self.bpe = self.tokenizer.model
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if not all(t.startswith("<|") and " " not in t for t in special):
            raise ValueError("special tokens are told by their first two signs, and hold no blank")
        self.blanks = regex.compile(r"\s\s").search
        self.words_of = regex.compile(r"(?<=\S) (?=\S)").split
        self.letters = byte_letters()
        self.merges = Merges(model, self.bpe)
        self.pretokens = Known(self._pretoken, memory // 4)
        self.after_blank = Known(self._after_blank, memory - memory // 4)
        self.plain = Words(self.merges, self.after_blank.__getitem__, blank=True, lower=False, digits=False)

    def _pretoken(self, text: str) -> bytes:
        spelled = text.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.bpe.tokenize(spelled)]).tobytes()

    def _after_blank(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():  # a pre-token by itself
            return array("I", [t.id for t in self.bpe.tokenize(self.letters[32] + word)]).tobytes()
        return self._word(" " + word)

    def _word(self, word: str) -> bytes:
        if _SIMPLE(word, 1 if word[:1] == " " else 0) and "<|" not in word:
            return b"".join(map(self.pretokens.__getitem__, _PRETOKENS(word)))
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def of(self, text: str) -> bytes:
        if not text:
            return b""
        if self.blanks(text):  # runs of white space stay in one word
            first, *words = self.words_of(text)
        else:  # a blank at the start is taken by the word after it
            first, *words = text.split(" ")
        return (self._word(first) if first else b"") + b"".join(map(self.after_blank.__getitem__, words))

    def of_all(self, texts: list[str], end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end``, and the number of each."""
        whole = [bool(self.blanks(t)) for t in texts]
        split = pc.split_pattern(pa.array([("" if w else t) for t, w in zip(texts, whole)], pa.string()), " ")
        # Words at the start have no blank before them; a text with runs of white space is one word here.
        first = [self.of(t) if w else self._word(t.partition(" ")[0]) if t else b"" for t, w in zip(texts, whole)]
        return joined_ids(split, self.plain, end, first)


@lru_cache(maxsize=1)
def _encoder(model: str) -> Encoder:
    """Kept by a Python worker between its tasks, within the encoder's bound on bytes."""
    return Encoder(model)


def encode(docs: DataFrame, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of the file format: documents in order, each with its ids and the end id.

    Only the texts are shuffled, once, by ranges of the id; rows of one id are spread by their text.
    A null or empty text has the end id alone; repeated rows are documents of their own, those
    with a null id come first, other columns are not read.
    """
    with open(tokenizer_path, encoding="utf8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file
    end = np.array([end_id], np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, before = _encoder(shared.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            docs, texts = batch.column("doc_id"), texts_of(batch)
            for a, b in text_runs(texts):
                ids, n = encoder.of_all(texts[a:b], end)
                ends = np.cumsum(n)
                columns = [
                    docs.slice(a, b - a),
                    pa.array(np.full(b - a, shard, np.int32)),
                    pa.array(before + ends - n),
                    pa.array(n),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids.view(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "shard", "first", "n_tokens", "tokens"])
                before += int(ends[-1])

    order = ["doc_id", F.xxhash64("text")]
    parts = shuffle_partitions(docs.sparkSession)
    ordered = narrow(docs, id_col, text_col).repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
    return ordered.mapInArrow(run, ROWS)


def write_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    path: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_bytes: int = 32 << 20,
    page_rows: int = 1_000,
) -> None:
    """Encode ``docs`` and write them to ``path`` (runs jobs). Written again, ``path`` is replaced.

    ``group_bytes`` bounds a row group before compression, ``page_rows`` the rows of a page. Empty
    tables give a readable empty collection. See :func:`encode` for nulls and repeated rows.
    """
    rows = encode(docs, tokenizer_path, end_id, id_col, text_col)
    options = {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",  # numbers without a dictionary are delta-encoded
        "parquet.block.size": group_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#tokens.list.element": "true",
        "parquet.dictionary.page.size": 4 << 20,  # holds any vocabulary of a million ids
    }
    rows.write.mode("overwrite").options(**options).parquet(os.path.join(path, "data"))
    spark = docs.sparkSession
    shards = (
        read_rows(spark, path)
        .groupBy("shard")
        .agg(
            F.sum("n_tokens").alias("n_tokens"),
            F.count(F.lit(1)).alias("n_docs"),
            F.min("doc_id").alias("first_doc"),
            F.max("doc_id").alias("last_doc"),
        )
        .orderBy("shard")
        .collect()  # a row for each task of the writing job
    )
    base, known = 0, []
    for s in shards:
        known.append((s["shard"], base, s["n_tokens"], s["n_docs"], s["first_doc"], s["last_doc"]))
        base += s["n_tokens"]
    spark.createDataFrame(known, SHARDS).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "shards"))


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows. What is not selected is not read."""
    return spark.read.schema(ROWS).parquet(os.path.join(path, "data"))


def read_tokens(spark: SparkSession, path: str, docs: tuple[int, int] | None = None, tokens: bool = True) -> DataFrame:
    """Documents with ``start``, the ids of all documents before them.

    ``docs`` asks for ids from the first to the last one named, and reads the pages that may hold them.
    ``tokens=False`` leaves the ids in the files.
    """
    rows = read_rows(spark, path)
    if docs is not None:
        rows = rows.filter(F.col("doc_id").between(*docs))
    columns = ["doc_id", "start", "n_tokens", *(["tokens"] if tokens else [])]
    return _with_start(spark, path, rows).select(*columns)


def _shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(os.path.join(path, "shards"))


def _with_start(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    bases = _shards(spark, path).select("shard", "base")  # a row for each task of the writing job
    return rows.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("first"))


def read_span(spark: SparkSession, path: str, start: int, length: int) -> DataFrame:
    """The part of every document that lies in a span of the whole collection: (doc_id, start, tokens).

    Only the shards and pages that overlap the span are read.
    """
    end = start + length
    hit = _shards(spark, path).filter((F.col("base") < end) & (F.col("base") + F.col("n_tokens") > start))
    found = hit.select("shard", "base").collect()  # the shards of one span
    if not found:
        return read_tokens(spark, path).select("doc_id", "start", "tokens").limit(0)
    rows = read_rows(spark, path)
    inside: Column = F.lit(False)
    for s in found:
        inside |= (
            (F.col("shard") == s["shard"])
            & (F.col("first") < end - s["base"])
            & (F.col("first") + F.col("n_tokens") > start - s["base"])
        )
    placed = _with_start(spark, path, rows.filter(inside))
    skip = F.greatest(F.lit(start) - F.col("start"), F.lit(0)).cast("int")
    upto = F.least(F.lit(end) - F.col("start"), F.col("n_tokens")).cast("int")
    return placed.select(
        "doc_id", (F.col("start") + skip).alias("start"), F.slice("tokens", skip + 1, upto - skip).alias("tokens")
    )


def checksums(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Adds ``ids_crc32``, the checksum of the ids as unsigned 32-bit little-endian integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(tokens)
            ids = memoryview(lists.values.to_numpy().astype("<u4", copy=False)).cast("B")
            ends = lists.offsets.to_pylist()
            sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            others = [batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays([*others, pa.array(sums, pa.int64())], names=names)

    rest = [f for f in rows.schema if f.name != tokens]
    names = [*(f.name for f in rest), "ids_crc32"]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest]
    return rows.mapInArrow(run, ", ".join([*columns, "ids_crc32 long"]))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return checksums(read_tokens(spark, path))
