"""Phrase collocations by Misra-Gries summaries per hash partition (operator 13).

1. One pass over the texts splits them into words and writes, per language, the sequences of 64-bit
   word hashes (0 between pieces) and the exact count of every word. That no two words share a hash
   that is frequent is checked; otherwise the pass is repeated with another seed.
2. Hashes of n-grams are counted within tasks and dealt to hash partitions. Each partition merges what
   the tasks send into one Misra-Gries summary. Its capacity exceeds the mass of a partition divided by
   the threshold, so what is taken from every counter stays below the threshold and no frequent n-gram
   is lost; where a partition is heavier than that, the summary grows rather than take more.
3. A phrase is frequent only if its parts are: pairs are searched among frequent words, longer phrases
   among surviving pairs. What survives goes to the next pass as a bitmap of fixed size, which may
   let more through but never less.
4. The second pass counts the surviving n-grams exactly, by the words themselves. Scores, cuts and
   the test for longer phrases are joins of the exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotcast.llm.common import discard, narrow, scratch, shuffle_partitions, table

LONGEST = 5
#: Two to this power is the number of bits of a bitmap: 16 MB, whatever the size of the input.
BITS = 27
#: Counters of one summary at most, by which the number of hash partitions is chosen.
COUNTERS = 4_000_000

_TEXT_BYTES = 3_000_000  # texts that a task splits at once; a longer text is split by itself
_ROW_WORDS = 65_536  # words in a stored sequence; documents are not cut
_GRAMS = 1_500_000  # hashes that a task gathers before it counts them
_SIGNS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _SIGNS + b"\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(_SIGNS) + b" "
)
_BREAK, _BLANK = 0, 1  # hashes that stand for the end of a piece and for no word

SPLIT = "kind string, lang string, word binary, hash binary, n long, words binary"


class _Hashes(dict):
    """64-bit hashes of words."""

    def __init__(self, seed: int):
        import xxhash

        self.digest = xxhash.xxh64_intdigest
        self.seed = seed
        self.update({b"": _BLANK, b"\n": _BREAK})

    def __missing__(self, word: bytes) -> int:
        self[word] = value = max(self.digest(word, self.seed), 2)
        return value


def _split(texts: list[bytes], seed: int) -> tuple[list[bytes], np.ndarray]:
    """The words of some texts and their hashes; pieces and texts end with a break."""
    joined = b"\n".join(texts).translate(_PLAIN).replace(b"\n", b" \n ") + b" \n"
    words = joined.split(b" ")
    return words, np.fromiter(map(_Hashes(seed).__getitem__, words), np.uint64, len(words))


def _split_batches(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    def rows(lang: str, texts: list[bytes]) -> pa.RecordBatch:
        words, hashes = _split(texts, seed)
        distinct, at, n = np.unique(hashes, return_index=True, return_counts=True)
        real = distinct > _BLANK
        found = [words[i] for i in at[real].tolist()]
        kept = hashes[hashes != _BLANK]
        ends = np.flatnonzero(kept == _BREAK) + 1
        cuts, last = [0], 0
        while last < len(kept):  # at breaks, so that no piece is cut
            i = np.searchsorted(ends, min(last + _ROW_WORDS, len(kept)))
            last = int(ends[i])
            cuts.append(last)
        sequences = [kept[a:b].astype("<u8").tobytes() for a, b in zip(cuts, cuts[1:])]
        a, b = len(found), len(sequences)
        columns = [
            pa.array(["word"] * a + ["words"] * b),
            pa.array([lang] * (a + b)),
            pa.array(found + [None] * b, pa.binary()),
            pa.array(distinct[real].astype(">u8").view("V8").tolist() + [None] * b, pa.binary()),
            pa.array(n[real].tolist() + [None] * b, pa.int64()),
            pa.array([None] * a + sequences, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["kind", "lang", "word", "hash", "n", "words"])

    for batch in batches:
        waiting: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        langs = batch.column("lang").to_pylist()
        for lang, text in zip(langs, batch.column("text")):
            text = text.as_buffer().to_pybytes() if text.is_valid else b""
            waiting.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] >= _TEXT_BYTES:
                yield rows(lang, waiting.pop(lang))
                size[lang] = 0
        for lang, texts in waiting.items():
            yield rows(lang, texts)


# --- hashes of n-grams ---


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def lang_seed(lang: str) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh64_intdigest(lang.encode()))


def gram_hashes(words: np.ndarray, seed: np.uint64, longest: int) -> list[np.ndarray]:
    """For each length up to ``longest``, the hash of the n-gram that starts at every word."""
    grams = [_mix(words + seed)]
    for n in range(2, longest + 1):
        longer = max(len(words) - n + 1, 0)
        grams.append(_mix(grams[-1][:longer] * np.uint64(0xD6E8FEB86659FD93) + words[n - 1 :][:longer]))
    return grams


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _in(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _bit(hashes)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _starts(words: np.ndarray, grams: list[np.ndarray], frequent: np.ndarray, pairs: np.ndarray | None):
    """For each length from 2 on, whether an n-gram may start at a word: all its words are frequent,
    and all its pairs survive where ``pairs`` is given."""
    good = (words != _BREAK) & _in(frequent, grams[0])
    two = good[:-1] & good[1:]
    if pairs is not None:
        two[two] = _in(pairs, grams[1][two])
    out = [two]
    for n in range(3, len(grams) + 1):
        out.append(out[-1][:-1] & two[n - 2 :])
    return out


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    for batch in batches:
        for lang, words in zip(batch.column("lang").to_pylist(), batch.column("words")):
            yield lang, np.frombuffer(words.as_buffer(), "<u8").astype(np.uint64, copy=False)


# --- summaries ---


class MisraGries:
    """A summary of weighted keys with ``capacity`` counters; merging is adding another one's counters.

    The count of a key is at least its counter and at most its counter plus ``removed``, which always
    stays below ``threshold``: where one more removal would reach it, the summary grows instead.
    By the usual argument that cannot happen while the mass is below capacity times threshold.
    """

    def __init__(self, capacity: int, threshold: int):
        self.capacity, self.threshold, self.removed = capacity, threshold, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held > max(self.capacity // 4, 100_000):
            self._merge()

    def _merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.held = [], 0
        self.keys, self.counts = _summed(keys, counts)
        if len(self.keys) > self.capacity:
            least = len(self.counts) - self.capacity - 1
            taken = int(np.partition(self.counts, least)[least])
            if self.removed + taken < self.threshold:
                left = self.counts > taken
                self.keys, self.counts = self.keys[left], self.counts[left] - taken
                self.removed += taken

    def frequent(self) -> np.ndarray:
        """All keys whose count may reach the threshold."""
        self._merge()
        return self.keys[self.counts + self.removed >= self.threshold]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def _partial_counts(sequences, lengths: tuple[int, int], bitmaps, parts: int) -> Iterator[pa.RecordBatch]:
    """Counted hashes of a task, as one row per hash partition that has any."""
    names = ["part", "hashes", "counts"]

    def counted(gathered: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(gathered), return_counts=True)
        part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # ascending, as the keys are
        ends = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
        used = np.flatnonzero(ends[1:] > ends[:-1])
        pick = [(int(ends[p]), int(ends[p + 1])) for p in used]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array([keys[a:b].tobytes() for a, b in pick], pa.binary()),
                pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in pick], pa.binary()),
            ],
            names=names,
        )

    first, last = lengths
    gathered, held = [], 0
    for lang, words in sequences:
        grams = gram_hashes(words, lang_seed(lang), last)
        starts = _starts(words, grams, *bitmaps)
        for n in range(first, last + 1):
            new = grams[n - 1][starts[n - 2]]
            if len(new):
                gathered.append(new)
                held += len(new)
        if held >= _GRAMS:
            yield counted(gathered)
            gathered, held = [], 0
    if held:
        yield counted(gathered)


def _bitmap(hashes: DataFrame, pieces: int = 64) -> np.ndarray:
    """The bitmap of a frame of hashes (runs a job): ``pieces`` rows of fixed size reach the driver."""
    size = (1 << BITS) // 8 // pieces

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, piece = np.zeros(size, np.uint8), None
        for batch in batches:
            if batch.num_rows:
                at = batch.column("bit").to_numpy()
                piece = int(at[0]) // (8 * size)
                at = at - piece * 8 * size
                np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        if piece is not None:
            yield pa.RecordBatch.from_arrays([pa.array([piece]), pa.array([bits.tobytes()])], names=["piece", "bits"])

    bit = F.shiftrightunsigned("hash", 64 - BITS).alias("bit")
    dealt = hashes.select(bit).repartitionById(pieces, F.shiftright("bit", BITS - 6).cast("int"))
    whole = np.zeros(size * pieces, np.uint8)
    for row in dealt.mapInArrow(build, "piece long, bits binary").collect():
        whole[row["piece"] * size :][:size] = np.frombuffer(row["bits"], np.uint8)
    return whole


def surviving_grams(
    sequences: DataFrame, lengths: tuple[int, int], bitmaps: list[np.ndarray], mass: int, threshold: int
) -> np.ndarray:
    """The bitmap of all n-grams of these lengths that may be frequent (runs a job)."""
    spark = sequences.sparkSession
    mass *= lengths[1] - lengths[0] + 1
    parts = max(shuffle_partitions(spark), -(-mass // (threshold * COUNTERS)))
    capacity = mass // (parts * threshold) + 1
    shared = spark.sparkContext.broadcast([*bitmaps, None][:2])  # of fixed size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _partial_counts(_sequences(batches), lengths, shared.value, parts)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = MisraGries(capacity, threshold)
        for batch in batches:
            for keys, counts in zip(batch.column("hashes"), batch.column("counts")):
                keys = np.frombuffer(keys.as_buffer(), np.uint64)
                summary.add(keys, np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64))
        found = summary.frequent()
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["hash"])

    partial = sequences.mapInArrow(count, "part int, hashes binary, counts binary")
    found = partial.repartitionById(parts, "part").mapInArrow(summarise, "hash long")
    return _bitmap(found)


# --- exact counts ---


def _row_hashes(rows: np.ndarray, seed: np.uint64) -> np.ndarray:
    """The n-gram hash of each row of words, as :func:`gram_hashes` gives it."""
    hashes = _mix(rows[:, 0] + seed)
    for n in range(1, rows.shape[1]):
        hashes = _mix(hashes * np.uint64(0xD6E8FEB86659FD93) + rows[:, n])
    return hashes


def _exact(rows: np.ndarray, counts: np.ndarray, seed: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows of words with their summed counts and their hashes, in the order of the hashes.

    Hashes only group; equality is that of the rows.
    """
    hashes = _row_hashes(rows, seed)
    order = np.argsort(hashes, kind="stable")
    rows, counts, hashes = rows[order], counts[order], hashes[order]
    first = np.r_[True, hashes[1:] != hashes[:-1]]
    same = np.r_[True, (rows[1:] == rows[:-1]).all(1)]
    if not (first | same).all():  # two n-grams share a hash, so their rows are put in order too
        order = np.lexsort([*rows.T, hashes])
        rows, counts, hashes = rows[order], counts[order], hashes[order]
        first = np.r_[True, (rows[1:] != rows[:-1]).any(1)]
    at = np.flatnonzero(first)
    return rows[at], np.add.reduceat(counts, at), hashes[at]


class _Counts:
    """Exact counts of the n-grams of one language and length."""

    def __init__(self, lang: str, n: int):
        self.seed, self.n, self.held, self.distinct = lang_seed(lang), n, 0, 0
        self.some: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        self.some.append((rows, counts))
        self.held += len(rows)
        if self.held > max(2 * self.distinct, _GRAMS // 4):
            rows, counts, _ = self.summed()
            self.some, self.held, self.distinct = [(rows, counts)], len(rows), len(rows)

    def summed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, counts = (np.concatenate(x) for x in zip(*self.some))
        return _exact(rows, counts, self.seed)


def exact_counts(sequences: DataFrame, bitmaps: list[np.ndarray], threshold: int) -> DataFrame:
    """Language, words and exact count of all n-grams of two words and more that reach the threshold.

    ``bitmaps`` are those of the frequent words, of the surviving pairs and of the longer survivors.
    ``gram`` holds the 64-bit hashes of the words, one after another. Tasks send their counts to the
    hash partitions in blocks, and a partition holds no more than its share of the survivors.
    """
    spark = sequences.sparkSession
    shared = spark.sparkContext.broadcast(bitmaps)  # of fixed size
    parts = shuffle_partitions(spark)

    def blocks(held: dict[tuple[str, int], _Counts]) -> Iterator[pa.RecordBatch]:
        for (lang, n), counted in held.items():
            rows, counts, hashes = counted.summed()
            part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            ends = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
            used = np.flatnonzero(ends[1:] > ends[:-1])
            pick = [slice(int(ends[p]), int(ends[p + 1])) for p in used]
            columns = [
                pa.array(used, pa.int32()),
                pa.array([lang] * len(used)),
                pa.array([n] * len(used), pa.int32()),
                pa.array([rows[x].astype("<u8").tobytes() for x in pick], pa.binary()),
                pa.array([counts[x].astype("<i8").tobytes() for x in pick], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "lang", "size", "grams", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, pairs, longer = shared.value
        held: dict[tuple[str, int], _Counts] = {}
        for lang, words in _sequences(batches):
            grams = gram_hashes(words, lang_seed(lang), LONGEST)
            starts = _starts(words, grams, frequent, pairs)
            for n in range(2, LONGEST + 1):
                at = np.flatnonzero(starts[n - 2])
                if n > 2:
                    at = at[_in(longer, grams[n - 1][at])]
                if len(at):
                    rows = words[at[:, None] + np.arange(n)]
                    held.setdefault((lang, n), _Counts(lang, n)).add(rows, np.ones(len(at), np.int64))
            if sum(c.n * c.held for c in held.values()) >= 2 * _GRAMS:
                yield from blocks(held)
                held = {}
        yield from blocks(held)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], _Counts] = {}
        for batch in batches:
            keys = zip(batch.column("lang").to_pylist(), batch.column("size").to_pylist())
            for (lang, n), grams, counts in zip(keys, batch.column("grams"), batch.column("counts")):
                rows = np.frombuffer(grams.as_buffer(), "<u8").reshape(-1, n)
                counts = np.frombuffer(counts.as_buffer(), "<i8")
                held.setdefault((lang, n), _Counts(lang, n)).add(rows, counts)
        for (lang, n), counted in held.items():
            rows, counts, _ = counted.summed()
            often = counts >= threshold
            keys = np.ascontiguousarray(rows[often].astype(">u8")).view(f"V{8 * n}").ravel().tolist()
            columns = [pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.binary()), pa.array(counts[often])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "a"])

    partial = sequences.mapInArrow(count, "part int, lang string, size int, grams binary, counts binary")
    return partial.repartitionById(parts, "part").mapInArrow(total, "lang string, gram binary, a long")


# --- scores ---


def _part(first: Column, words: Column) -> Column:
    """``words`` words of a gram from word ``first`` (from 0) on."""
    return F.substring("gram", first * 8 + 1, words * 8)


def score_phrases(grams: DataFrame, masses: DataFrame) -> DataFrame:
    """All candidates that no longer one of the same count holds, with the cut that scores least.

    ``grams`` has (lang, gram, a) of words and phrases, ``masses`` (lang, n). A part of a frequent
    phrase is frequent, so every cut finds both its parts. A longer candidate with the same count
    has its parts of one word less in between with that count too, so one step up decides.
    """
    size = F.length("gram") / 8
    phrases = grams.filter(size > 1)
    parts = grams.withColumnRenamed("a", "count")
    inside = (
        phrases.filter(size > 2)
        .select(
            "lang",
            F.explode(F.array(_part(F.lit(0), size.cast("int") - 1), _part(F.lit(1), size.cast("int") - 1))).alias("gram"),
            "a",
        )
        .distinct()
    )
    cuts = phrases.join(inside, ["lang", "gram", "a"], "left_anti").select(
        "*", F.explode(F.sequence(F.lit(1), size.cast("int") - 1)).alias("k")
    )
    rest = size.cast("int") - F.col("k")
    wide = "decimal(38,0)"
    scored = (
        cuts.withColumns({"left": _part(F.lit(0), F.col("k")), "right": _part(F.col("k"), rest)})
        .join(parts.select("lang", F.col("gram").alias("left"), F.col("count").alias("l")), ["lang", "left"])
        .join(parts.select("lang", F.col("gram").alias("right"), F.col("count").alias("r")), ["lang", "right"])
        .join(masses, "lang")
        .withColumn(
            "score",
            F.expr(f"(cast(1000 * a as {wide}) * cast(n as {wide})) div (cast(l as {wide}) * cast(r as {wide}))"),
        )
    )
    return (
        scored.groupBy("lang", "gram", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "gram", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def _named(ranked: DataFrame, words: DataFrame) -> DataFrame:
    """Adds ``phrase``. Takes the few phrases of a report; each has at most five words."""
    size = (F.length("gram") / 8).cast("int")
    at = ranked.select("lang", "gram", F.explode(F.sequence(F.lit(0), size - 1)).alias("at"))
    spelled = (
        at.withColumn("hash", F.substring("gram", F.col("at") * 8 + 1, F.lit(8)))
        .join(words.select("lang", "hash", F.col("word").cast("string").alias("word")), ["lang", "hash"])
        .groupBy("lang", "gram")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("parts"))
    )
    phrase = F.array_join("parts.word", " ").alias("phrase")
    return ranked.join(spelled.select("lang", "gram", phrase), ["lang", "gram"])


def _split_texts(docs: DataFrame, text_col: str, lang_col: str, threshold: int, tries: int = 5):
    """Paths of the stored sequences and of the word counts (runs jobs)."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
    )
    for seed in range(tries):
        path, counted = scratch(spark, "words"), scratch(spark, "word-counts")
        split = texts.mapInArrow(lambda batches, seed=seed: _split_batches(batches, seed), SPLIT)
        split.write.option("compression", "zstd").parquet(path)
        every = spark.read.schema(SPLIT).parquet(path).filter("kind = 'word'")
        every.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n")).write.parquet(counted)
        words = spark.read.schema("lang string, word binary, hash binary, n long").parquet(counted)
        shared = (
            words.groupBy("hash")
            .agg(F.min("word").alias("first"), F.max("word").alias("last"), F.sum("n").alias("n"))
            .filter((F.col("first") != F.col("last")) & (F.col("n") >= threshold))
        )
        if shared.isEmpty():
            return path, counted
        discard(spark, path, counted)
    raise RuntimeError("frequent words share their hashes with other words under every seed")


def collocations(
    docs: DataFrame,
    threshold: int = 100,
    top: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The first ``top`` phrases of two to five words of every language (runs jobs).

    Columns: lang, rank, phrase, a (its count), l and r (those of its two parts), n (words of the
    language), score. Null and empty texts have no words, a null language counts as ``und``, repeated
    rows count as often as they occur, and other columns are not read. Ties are broken by count,
    then by the phrase's bytes. An empty table, or one without frequent phrases, gives no rows.
    """
    spark = docs.sparkSession
    path, counted = _split_texts(docs, text_col, lang_col, threshold)
    sequences = spark.read.schema(SPLIT).parquet(path).filter("kind = 'words'").select("lang", "words")
    words = spark.read.schema("lang string, word binary, hash binary, n long").parquet(counted)
    mass = words.agg(F.sum("n")).first()[0] or 0

    common = words.filter(F.col("n") >= threshold)
    frequent = _bitmap(_single_hashes(common))
    pairs = surviving_grams(sequences, (2, 2), [frequent], mass, threshold)
    longer = surviving_grams(sequences, (3, LONGEST), [frequent, pairs], mass, threshold)
    phrases = exact_counts(sequences, [frequent, pairs, longer], threshold)
    singles = common.select("lang", F.col("hash").alias("gram"), F.col("n").alias("a"))
    stored = scratch(spark, "grams")
    phrases.write.parquet(stored)
    discard(spark, path)
    grams = spark.read.schema("lang string, gram binary, a long").parquet(stored).unionByName(singles)

    scored = score_phrases(grams, words.groupBy("lang").agg(F.sum("n").alias("n")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    short = scored.withColumn("place", F.rank().over(best)).filter(F.col("place") <= top).drop("place")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        _named(short, common)
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def _single_hashes(words: DataFrame) -> DataFrame:
    """The n-gram hash of single words, as the bitmap of words is asked for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.array([int.from_bytes(h, "big") for h in batch.column("hash").to_pylist()], np.uint64)
            seeds = np.array([lang_seed(x) for x in batch.column("lang").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_mix(hashes + seeds).view(np.int64))], names=["hash"])

    return words.select("lang", "hash").mapInArrow(run, "hash long")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
