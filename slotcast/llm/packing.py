"""Packing of documents into windows by non-negative least squares (operator 10).

1. Every document is tokenized and cut into full windows and one rest; each piece keeps its length
   and the checksum of its ids, not the ids.
2. The histogram of piece lengths has at most ``window`` bars, so the driver may hold it. Shallow
   combinations of lengths that fill a window are enumerated, non-negative least squares finds how
   often each repeats, and the rounded-down repeats leave a small histogram that is packed greedily,
   largest length first.
3. The n-th piece of a length goes to the n-th place that the plan has for that length. Places are
   found by rank, and ranks by counts of salted groups, so a length that a third of all pieces
   share is no hot key.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotcast.llm.common import by_batch, narrow, stage, table, texts_of
from slotcast.llm.known import Known, joined_ids, text_runs
from slotcast.llm.merges import Merges, Words, byte_letters

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

# Letters that normalisation leaves as they are and that lower-case one by one.
_LETTERS = "a-zß-öø-ÿ"
_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ \\n\\t\\r]*").fullmatch
_WORDS = re.compile(f"[{_LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^{_LETTERS}0-9\\s]+").findall


class Ids:
    """Ids of whole texts as little-endian 32-bit integers, through bounded tables of known words.

    White space separates words in this vocabulary and is dropped, so a text's ids are those of
    its chunks between blanks and line ends. The distinct plain chunks of some texts are cut and merged
    together (:class:`Words`); of others, one of simple characters is cut into words here, and any
    other goes to the tokenizer whole.
    The tables are bounded by bytes and belong to one task.
    """

    def __init__(self, tokenizer, memory: int = 24 << 20, merges: Merges | None = None):
        self.tokenizer = tokenizer
        self.bpe = tokenizer.model
        self.letters = byte_letters()
        self.merges = merges or Merges(tokenizer.to_str(), self.bpe)
        self.words = Known(self._word, memory // 2)
        self.chunks = Known(self._chunk, memory // 2)
        self.plain = Words(self.merges, self.chunks.__getitem__, blank=False, lower=True, digits=True)

    def _word(self, word: str) -> bytes:
        spelled = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.bpe.tokenize(spelled)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if _SIMPLE(chunk) and "<|" not in chunk:
            return b"".join(map(self.words.__getitem__, _WORDS(chunk.lower())))
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def of(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))

    def of_all(self, texts: list[str], end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end``, and the number of each."""
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        return joined_ids(split, self.plain, end)


@lru_cache(maxsize=1)
def _tokenizer(model: str):
    """Tokenizer and merges, kept by a Python worker between its tasks: of the vocabulary's fixed size."""
    from tokenizers import Tokenizer

    if array("I").itemsize != 4 or sys.byteorder != "little":
        raise RuntimeError("ids are written as this machine's 32-bit little-endian integers")
    tokenizer = Tokenizer.from_str(model)
    return tokenizer, Merges(model, tokenizer.model)


def cut_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 4096,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Full windows and the rest of every document, each with the checksum of its ids.

    A null or empty text has the end id alone. Repeated rows are documents of their own.
    """
    with open(tokenizer_path, encoding="utf8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file
    end = np.array([end_id], "<u4").tobytes()

    def make():
        tokenizer, merges = _tokenizer(shared.value)
        known = Ids(tokenizer, merges=merges)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            docs, texts, parts = batch.column("doc_id"), texts_of(batch), []
            for a, b in text_runs(texts, 1_000_000):
                ids, n = known.of_all(texts[a:b], end)
                pieces = -(-n // window)
                doc = np.repeat(np.arange(b - a), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                length = np.minimum(n[doc] - start, window)
                data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                at = (np.cumsum(n) - n)[doc] + start
                crc = [zlib.crc32(data[4 * x : 4 * (x + k)]) for x, k in zip(at.tolist(), length.tolist())]
                parts.append((docs.slice(a, b - a).take(pa.array(doc)), start, length, crc, n[doc]))
            columns = [pa.concat_arrays([pa.array(c, pa.int64()) for c in column]) for column in zip(*parts)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        return one

    return by_batch(narrow(docs, id_col, text_col), make, PIECES)


def combinations(lengths: Iterable[int], counts: np.ndarray, window: int, width: int = 24) -> list[tuple[int, ...]]:
    """Combinations of up to four present lengths that fill the window exactly.

    All single lengths and pairs; for more, each length is put with the ``width`` most frequent
    shorter ones and closed by the exact rest.
    """
    present = np.zeros(window + 1, bool)
    present[list(lengths)] = True
    frequent = [int(x) for x in np.argsort(-counts[: window + 1], kind="stable")[:width] if present[x]]
    found = {(window,)} if present[window] else set()
    for a in np.flatnonzero(present).tolist():
        if present[window - a] and a < window:
            found.add(tuple(sorted((a, window - a), reverse=True)))
        for i, b in enumerate(frequent):
            rest = window - a - b
            if rest > 0 and present[rest]:
                found.add(tuple(sorted((a, b, rest), reverse=True)))
            for c in frequent[i:]:
                rest = window - a - b - c
                if rest > 0 and present[rest]:
                    found.add(tuple(sorted((a, b, c, rest), reverse=True)))
    return sorted(found)


def least_squares(combos: list[tuple[int, ...]], counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Repeats x >= 0 of each combination with the least squared difference from the histogram.

    Projected gradient with a step from each column's own curvature.
    """
    if not combos:
        return np.zeros(0)
    depth = max(map(len, combos))
    at = np.array([c + (0,) * (depth - len(c)) for c in combos])
    weight = (at > 0).astype(float)
    use = np.zeros(len(counts))
    np.add.at(use, at.ravel(), weight.ravel())
    use[0] = 0
    step = 1.0 / np.maximum(1.0, (weight * use[at]).sum(1))
    x = np.zeros(len(combos))
    target = counts.astype(float)
    target[0] = 0
    made = np.zeros(len(counts))
    for _ in range(rounds):
        gradient = ((target - made)[at] * weight).sum(1)
        x = np.maximum(0.0, x + step * gradient)
        made = np.zeros(len(counts))
        np.add.at(made, at.ravel(), (weight * x[:, None]).ravel())
        made[0] = 0
    return x


def plan_windows(counts: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, repeats) so that each length is used as often as it occurs."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    plan = []

    def take(combo: tuple[int, ...], times: int) -> None:
        for length in combo:
            left[length] -= times
        plan.append((combo, times))

    if left[window]:
        take((window,), int(left[window]))
    combos = combinations(np.flatnonzero(left).tolist(), left, window)
    repeats = least_squares(combos, left)
    for i in np.argsort(-repeats, kind="stable").tolist():
        need = {length: combos[i].count(length) for length in combos[i]}
        times = min(int(repeats[i]), *(int(left[length]) // n for length, n in need.items()))
        if times > 0:
            take(combos[i], times)
    while left.any():
        combo, room = [], window
        spare = left.copy()
        while room:
            fits = np.flatnonzero(spare[: room + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            combo.append(length)
            spare[length] -= 1
            room -= length
        need = {length: combo.count(length) for length in combo}
        take(tuple(combo), min(int(left[length]) // n for length, n in need.items()))
    return plan


def places(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, last rank + 1, first sequence, offset) that cover each length's ranks."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for combo, times in plan:
        offset = 0
        for length in combo:
            first = used.get(length, 0)
            rows.append((length, first, first + times, sequence, offset))
            used[length] = first + times
            offset += length
        sequence += times
    return rows


def rank_pieces(pieces: DataFrame, salts: int = 64) -> DataFrame:
    """Adds ``rank``, from 0 within each length. Groups of a length are salted by the document."""
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base")
    )
    within = Window.partitionBy("length", "salt").orderBy(*order)
    return (
        salted.withColumn("at", F.row_number().over(within) - 1)
        .join(bases, ["length", "salt"])
        .select(*pieces.columns, (F.col("base") + F.col("at")).alias("rank"))
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 4096,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their sequence and their offset in it (runs jobs).

    Sequences hold at most ``window`` ids. Null texts count as empty; an empty table gives an
    empty result; repeated rows are packed as often as they occur; other columns are not read.
    """
    spark = docs.sparkSession
    pieces = stage(cut_pieces(docs, tokenizer_path, window, end_id, id_col, text_col), "pieces")
    counts = np.zeros(window + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``window`` rows
        counts[row["length"]] = row["count"]
    names = "length long, first long, end long, sequence long, offset long"
    slots = spark.createDataFrame(places(plan_windows(counts, window)), names)
    fits = (
        (F.col("p.length") == F.col("s.length"))
        & (F.col("rank") >= F.col("s.first"))
        & (F.col("rank") < F.col("s.end"))
    )
    return (
        rank_pieces(pieces)
        .alias("p")
        .join(F.broadcast(slots).alias("s"), fits)  # bounded by the window, not by the documents
        .select(
            "doc_id",
            "start",
            "p.length",
            "ids_crc32",
            "doc_tokens",
            (F.col("s.sequence") + F.col("rank") - F.col("s.first")).alias("sequence_id"),
            F.col("s.offset").alias("offset"),
        )
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
