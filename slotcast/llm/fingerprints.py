"""Document fingerprints from prefix polynomial hashes (operator 3).

A prefix array holds, for two prime moduli, the sums of code points times falling powers of a base.
The hash of any span is one difference and one product, so equality of spans takes constant time
and the longest common extension of two places a binary search.

A fingerprint is the hash of the whole text and a sketch of the hashes of all spans of ``span``
code points: their range is cut into bins, of which each keeps its least hash. Equal texts have
equal fingerprints; the likeness of two fingerprints is the share of filled bins that agree, an
estimate of the Jaccard likeness of the two sets of spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm.common import narrow, shuffle_partitions, table, texts_of

#: Two primes below 2^31, and a base for each.
MODULI = np.array([2147483647, 2147483629], np.uint64)
BASES = np.array([911382323, 972663749], np.uint64)
SPAN, BINS = 16, 64
#: Texts under SHORT code points only have spans of SHORT_SPAN, others have both.
SHORT, SHORT_SPAN = 64, 4
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_prefix long"
)


class Powers:
    """Powers of the bases and of their inverses, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones((2, 1), np.uint64)

    def reach(self, n: int) -> None:
        if self.up.shape[1] > n:
            return
        size = 1 << int(n + 1).bit_length()
        inverse = [pow(int(b), -1, int(m)) for b, m in zip(BASES, MODULI)]
        tables = []
        for roots in (BASES.tolist(), inverse):
            rows = []
            for root, modulus in zip(roots, MODULI.tolist()):
                row, step = np.ones(1, np.uint64), root
                while len(row) < size:  # doubles: the second half is the first times one power
                    row = np.concatenate([row, row * np.uint64(step) % np.uint64(modulus)])
                    step = step * step % modulus
                rows.append(row)
            tables.append(np.stack(rows))
        self.up, self.down = tables


_POWERS = Powers()


class PrefixHashes:
    """The prefix arrays of one text."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = n = len(points)
        _POWERS.reach(n + 1)
        self.sums = np.zeros((2, n + 1), np.uint64)
        for i in range(2):
            terms = points * _POWERS.down[i, 1 : n + 1] % MODULI[i]
            np.cumsum(terms, out=self.sums[i, 1:])
            self.sums[i] %= MODULI[i]

    def spans(self, start, end) -> np.ndarray:
        """62-bit hashes of the spans [start, end); arrays of places give arrays of hashes."""
        parts = []
        for i in range(2):
            difference = self.sums[i, end] + MODULI[i] - self.sums[i, start]
            parts.append(difference % MODULI[i] * _POWERS.up[i, end] % MODULI[i])
        return parts[0] << np.uint64(31) | parts[1]

    def common(self, start: int, other: PrefixHashes, other_start: int) -> int:
        """Length of the longest common extension of two places, by binary search."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.spans(start, start + middle) == other.spans(other_start, other_start + middle):
                low = middle
            else:
                high = middle - 1
        return low


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def _sketch(hashes: PrefixHashes, span: int, bins: int) -> str:
    """Four hex digits per bin (blank: no span fell into it)."""
    sketch = [" " * 4] * bins
    if hashes.n:
        starts = np.arange(max(1, hashes.n - span + 1))
        values = _mix(hashes.spans(starts, np.minimum(starts + span, hashes.n)))
        values.sort()
        edges = np.arange(bins, dtype=np.uint64) << np.uint64(64 - bins.bit_length() + 1)
        first = np.searchsorted(values, edges)
        filled = np.append(first[1:], len(values)) > first
        for i in np.flatnonzero(filled).tolist():
            sketch[i] = f"{int(values[first[i]]) & 0xFFFF:04x}"
    return ".".join(sketch)


def fingerprint(hashes: PrefixHashes, span: int = SPAN, bins: int = BINS) -> str:
    """Whole-text hash, length, and the sketches: of long spans where the text is long, and of short ones."""
    whole = int(hashes.spans(0, hashes.n))
    spans = [span, SHORT_SPAN] if hashes.n >= SHORT else [SHORT_SPAN]
    return "-".join([f"{whole:016x}", f"{hashes.n:x}", *[_sketch(hashes, s, bins) for s in spans]])


def likeness(a: str, b: str) -> float:
    """Share of the bins filled in either fingerprint that agree; 1 for equal, 0 beside an empty text.

    Two long texts are compared by their long spans, any others by the short ones, which both have.
    """
    if a == b:
        return 1.0
    a, b = a.split("-")[2:], b.split("-")[2:]
    at = 0 if len(a) == len(b) else -1
    pairs = zip(a[at].split("."), b[at].split("."))
    used = [(x, y) for x, y in pairs if x != "    " or y != "    "]
    return sum(x == y for x, y in used) / len(used) if used else 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the start of the next."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (bucket, ahead, doc_id, text) in an order that puts each document before its next.

    Ranges of ids become buckets, and the first document of a bucket is also put, as ``ahead``, at
    the end of the bucket before it (of the last bucket for the first). Ids without a value come
    first; rows with one id follow each other by text. Runs two jobs over the ids.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    lowest = -(2**63)
    ranked = docs.select("doc_id", F.coalesce("doc_id", F.lit(lowest)).alias("order"), "text")
    ranked = ranked.withColumn("place", F.col("order").cast("double"))
    shares = [i / parts for i in range(1, parts)]
    splits = sorted(set(ranked.approxQuantile("place", shares, 0.1 / parts))) if shares else []
    cuts = [-float("inf"), *[x for x in splits if x > float(lowest)], float("inf")]
    if len(cuts) > 2:
        ranked = Bucketizer(splits=cuts, inputCol="place", outputCol="cut").transform(ranked)
        ranked = ranked.withColumn("bucket", F.col("cut").cast("int"))
    else:
        ranked = ranked.withColumn("bucket", F.lit(0))
    firsts = {r["bucket"]: r["first"] for r in ranked.groupBy("bucket").agg(F.min("order").alias("first")).collect()}
    filled = sorted(firsts)  # one entry for each bucket
    before = {b: filled[i - 1] for i, b in enumerate(filled)}
    first_of = F.array(*[F.lit(firsts.get(b)).cast("long") for b in range(len(cuts) - 1)])
    before_of = F.array(*[F.lit(before.get(b)).cast("int") for b in range(len(cuts) - 1)])
    here = F.struct(F.col("bucket"), F.lit(0).alias("ahead"))
    there = F.struct(F.get(before_of, F.col("bucket")).alias("bucket"), F.lit(1).alias("ahead"))
    places = F.when(F.col("order") == F.get(first_of, F.col("bucket")), F.array(here, there)).otherwise(F.array(here))
    return (
        ranked.select("doc_id", "order", "text", F.explode(places).alias("p"))
        .select("p.bucket", "p.ahead", "doc_id", "order", "text")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "ahead", "order", "text")
        .drop("order")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness (runs jobs).

    Null texts count as empty. A lone document is its own next one. Ids without a value come before
    all others, and rows that share an id follow each other by text. Other columns are not read; an
    empty table gives an empty result.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, done = None, []

        def finish(following: tuple) -> None:
            doc_id, text, hashes, mark = waiting
            _, next_text, _, next_mark = following
            changed = edited(text, next_text)
            other = PrefixHashes(changed) if changed != text else hashes
            other_mark = fingerprint(other) if changed != text else mark
            sha = hashlib.sha256(changed.encode()).hexdigest()
            near = likeness(mark, other_mark), likeness(mark, next_mark)
            done.append((doc_id, len(text), sha, mark, other_mark, *near, hashes.common(0, other, 0)))

        for batch in batches:
            rows = zip(
                batch.column("bucket").to_pylist(),
                batch.column("ahead").to_pylist(),
                batch.column("doc_id").to_pylist(),
                texts_of(batch),
            )
            for bucket, ahead, doc_id, text in rows:
                if ahead and waiting is None:
                    continue  # a further copy of the bucket's end
                hashes = PrefixHashes(text)
                new = (doc_id, text, hashes, fingerprint(hashes))
                if waiting is not None:
                    finish(new)
                waiting = None if ahead else new
            if done:
                kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int64()]
                names = [x.split()[0] for x in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
                done = []

    whole = narrow(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return with_next(whole).mapInArrow(pairs, SCHEMA)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
