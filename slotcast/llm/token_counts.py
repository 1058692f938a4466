"""Token counts from distinct pre-tokens (operator 7).

A pre-token is a word with the white space before it. No piece of the vocabulary holds a word
mark after another character (checked when the model is loaded), so merges never cross the start
of a pre-token and the counts of the pre-tokens add up to the count of the text.

Each task keeps the distinct pre-tokens it has met with their number of pieces. The frequencies of
a document's pre-tokens are joined to that table and summed; ids of a text are never made. The
table is bounded by ``memo`` bytes, about, and starts anew beyond that, which costs time, not rows. No
shuffle is needed: a distributed join would move a row for each document and word.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from slotcast.llm.common import by_batch, narrow, table, texts_of

SPACE = "▁"
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_pretokens long"


def pretokens(text: str) -> list[str]:
    """Split a text at blanks, so that the counts of the parts add up.

    A run of blanks goes to the word after it; one blank of each run is the mark which the
    tokenizer puts before any text.
    """
    parts = text.replace(SPACE, " ").split(" ")  # the tokenizer makes no difference between them
    if "" not in parts:
        return parts
    out, blanks = [], 0
    for part in parts:
        if part:
            out.append(" " * blanks + part)
            blanks = 0
        else:
            blanks += 1
    if blanks and text:
        out.append(" " * (blanks - 1))  # "" is a single mark at the end, see count_pieces
    return out


def _load(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def count_pieces(pieces, words: list[str]) -> dict[str, int]:
    """Pieces of each distinct pre-token."""
    counts = dict(zip(words, map(len, pieces.encode(words, num_threads=1))))
    if "" in counts:
        counts[""] = len(pieces.encode("a ")) - len(pieces.encode("a"))
    return counts


def check_model(model: bytes) -> None:
    """Fail unless pre-tokens of this model are independent of each other."""
    pieces = _load(model)
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        if SPACE in piece.lstrip(SPACE):
            raise ValueError(f"piece {piece!r} spans words; counts of pre-tokens do not add up")
    if len(pieces.encode("  a")) <= len(pieces.encode("a")):
        raise ValueError("the model drops blanks; counts of pre-tokens do not add up")


def count_tokens(
    docs: DataFrame,
    model_path: str,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    memo: int = 96 << 20,
) -> DataFrame:
    """Number of pieces of every whole text.

    Null and empty texts have 0 tokens. Repeated rows each get a row, null ids are kept, and
    other columns of ``docs`` are not read. An empty table gives an empty result.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    check_model(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one model file of fixed size

    def make():
        pieces = _load(shared.value)
        known: dict[str, int] = {}
        held = 0

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal held
            tokens, distinct = [], []
            for text in texts_of(batch):
                frequencies = Counter(pretokens(text)) if text else Counter()
                new = [w for w in frequencies if w not in known]
                if new:
                    if held > memo:
                        known.clear()
                        held, new = 0, list(frequencies)
                    known.update(count_pieces(pieces, new))
                    held += sum(map(len, new)) * 2 + len(new) * 150
                tokens.append(sum(known[w] * n for w, n in frequencies.items()))
                distinct.append(len(frequencies))
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            counts = pa.array(tokens, pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), size, counts, pc.greater(counts, limit), pa.array(distinct, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_pretokens"],
            )

        return one

    return by_batch(narrow(docs, id_col, text_col), make, SCHEMA)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
