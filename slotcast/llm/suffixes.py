"""Removal of repeated byte strings by a distributed merge sort of suffixes (operator 1).

A string of ``length`` bytes that starts at two places is found without sorting every suffix:

1. Anchors. Each window of ``length`` bytes names its least hashed gram of ``gram`` bytes, its
   anchor. Equal windows name equal anchors at equal offsets, and neighbouring windows mostly share
   one, so an anchor stands for a run of windows; the bytes of the run are its context.
2. Anchors whose gram occurs once go. Equal contexts collapse to one row with a count; a context
   that occurs twice is repeated as a whole. What remains are grams with several contexts, the
   edges of repeats.
3. Merge sort. The suffixes that start at these anchors, with the bytes left of them, are sorted in
   runs of bounded size, cut by sampled splitters, front-coded (length of the common prefix with the
   suffix before, and the rest) and exchanged. A loser tree merges the runs: every entry knows the
   length of its common prefix with the last winner, entries are compared by that length first,
   and bytes only behind a common prefix that both are known to have.
4. The common prefixes of the merged suffixes tell which windows agree to the right of an anchor,
   prefix hashes which agree to its left; a window is repeated if some other context agrees on both.
   Grams with more contexts than ``hot`` do not meet in one task: their windows are counted by
   hash instead.
5. Repeated windows go back to their documents by id and hash of the text, and the bytes are cut.

Texts are moved once, into a table bucketed by id and hash of the text; lists of anchors and spans come
to the buckets of their texts. Anchors, contexts and decisions are tables in the shared folder too. The
driver holds splitters only.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm.common import by_batch, narrow, shuffle_partitions, stage, stage_buckets, table, texts_of

LENGTH, GRAM = 200, 64
#: Contexts of one gram that a task takes; bytes of suffixes in a sorted run.
HOT, RUN_BYTES = 20_000, 32_000_000
_BASE = 0xC2B2AE3D27D4EB4F
_SEGMENT = 1 << 18
_PLACE_BITS = 24

ANCHORS = "doc long, t1 long, gram long, context long, start int, windows int, offset int"


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_BASE)
    return x ^ (x >> np.uint64(32))


def _sums(data: np.ndarray, up: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def _segment_anchors(data: np.ndarray, valid: np.ndarray, length: int, gram: int):
    """(gram hash, context hash, first window, windows, offset) of the anchors of valid windows."""
    up, down = _powers(_SEGMENT * 2 + length)
    sums, reach = _sums(data, up), length - gram + 1
    grams = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    low = np.uint64((1 << _PLACE_BITS) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    rows = np.concatenate([keys, np.full(-len(keys) % reach, 2**64 - 1, np.uint64)]).reshape(-1, reach)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - length + 1
    place = (np.minimum(behind[:n], ahead[reach - 1 : reach - 1 + n]) & low).astype(np.int64)
    changes = np.ones(n, bool)
    changes[1:] = (place[1:] != place[:-1]) | (valid[1:n] != valid[: n - 1])
    first = np.flatnonzero(changes)
    end = np.append(first[1:], n)
    good = valid[first]
    first, end = first[good], end[good]
    place = place[first]
    last = end - 1 + length
    context = _mix((sums[last] - sums[first]) * down[first] + _mix((place - first).astype(np.uint64) << np.uint64(16) | (end - first).astype(np.uint64)))
    return _mix(grams[place]), context, first, end - first, place - first


def anchors_of(texts: list[bytes], length: int, gram: int) -> Iterator[tuple]:
    """(text number, gram, context, start, windows, offset) arrays; windows never cross texts.

    Short texts are read together, long ones in segments that overlap by a window.
    """

    def flush(pieces):
        data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
        if len(data) < length:
            return
        valid = np.ones(len(data), bool)
        ends = np.cumsum([len(p) for _, _, p in pieces])
        for (_, _, piece), end in zip(pieces, ends):
            valid[max(end - length + 1, end - len(piece)) : end] = False
        gram_of, context, first, windows, offset = _segment_anchors(data, valid, length, gram)
        which = np.searchsorted(ends, first, side="right")
        begins = ends - np.array([len(p) for _, _, p in pieces])
        shift = np.array([at for _, at, _ in pieces])
        numbers = np.array([i for i, _, _ in pieces])
        yield numbers[which], gram_of, context, first - begins[which] + shift[which], windows, offset

    pieces, held = [], 0
    for i, text in enumerate(texts):
        if len(text) < length:
            continue
        for at in range(0, len(text) - length + 1, _SEGMENT):
            piece = text[at : at + _SEGMENT + length - 1]
            pieces.append((i, at, piece))
            held += len(piece)
            if held >= _SEGMENT:
                yield from flush(pieces)
                pieces, held = [], 0
    if pieces:
        yield from flush(pieces)


def anchor_table(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """All anchors of all texts, by the document's id and the hash of its text."""

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            doc, t1 = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("doc", "t1"))
            parts = [[] for _ in range(7)]
            for which, gram_of, context, start, windows, offset in anchors_of(
                [t.encode() for t in texts_of(batch)], length, gram
            ):
                columns = (doc[which], t1[which], gram_of.view(np.int64), context.view(np.int64), start, windows, offset)
                for part, column in zip(parts, columns):
                    part.append(column)
            kinds = [*[np.int64] * 4, *[np.int32] * 3]
            arrays = [pa.array((np.concatenate(p) if p else np.zeros(0)).astype(k)) for p, k in zip(parts, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in ANCHORS.split(", ")])

        return one

    return by_batch(docs.select("doc", "t1", "text"), make, ANCHORS)


# Front-coded runs and their merge ----------------------------------------------------------------


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, which is at least ``known``; earlier bytes are not read."""
    end = min(len(a), len(b))
    step = 16
    while known < end:
        x, y = a[known : known + step], b[known : known + step]
        if x != y:
            n = min(len(x), len(y))
            differs = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
            return known + (n if not differs else n - (differs.bit_length() + 7) // 8)
        known += step
        step *= 2
    return end


def front_code(strings: list[bytes]) -> tuple[np.ndarray, bytes]:
    """(lengths of common prefix and rest, concatenated rests) of sorted strings."""
    lengths, rests, last = np.zeros((len(strings), 2), np.int32), [], b""
    for i, s in enumerate(strings):
        known = common_prefix(last, s)
        lengths[i] = known, len(s) - known
        rests.append(s[known:])
        last = s
    return lengths, b"".join(rests)


def front_decode(lengths: np.ndarray, rests: bytes) -> Iterator[tuple[int, bytes]]:
    """(common prefix with the string before, string) of a front-coded run."""
    at, last = 0, b""
    for known, rest in lengths.tolist():
        last = last[:known] + rests[at : at + rest]
        at += rest
        yield known, last


def merge(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, bytes, int]]:
    """(common prefix with the string before, string, run) of all sorted runs, by a loser tree.

    Each run's head keeps the length of its common prefix with the last winner. Of two heads the
    one with the longer such prefix is smaller, without reading a byte; only at equal lengths are
    bytes compared, from that length on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list[bytes | None] = [None] * k
    known = [0] * k
    for i, run in enumerate(runs):
        first = next(run, None)
        heads[i] = first[1] if first else None

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows its common prefix with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        both = common_prefix(x, y, known[a])
        if both == len(x) or (both < len(y) and x[both] < y[both]):
            known[b] = both
            return a, b
        known[a] = both
        return b, a

    losers, level = [0] * k, list(range(k))
    base = k // 2
    while len(level) > 1:
        up = []
        for i in range(0, len(level), 2):
            winner, losers[base + i // 2] = play(level[i], level[i + 1])
            up.append(winner)
        level, base = up, base // 2
    winner = level[0]
    while heads[winner] is not None:
        yield known[winner], heads[winner], winner
        following = next(runs[winner], None)
        heads[winner], known[winner] = (following[1], following[0]) if following else (None, 0)
        node = (winner + k) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


# Exchange and decision ---------------------------------------------------------------------------

RUNS = "bucket int, run string, lengths binary, rests binary, facts binary, lefts binary"


def sorted_runs(needed: DataFrame, splitters: list[bytes], length: int) -> DataFrame:
    """Front-coded pieces of sorted runs, one for each bucket, from texts with their wanted anchors.

    ``facts`` holds gram, context, count, windows and offset of each suffix, ``lefts`` the bytes
    between the first window and the anchor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda x: x[0])
            keys = [x[0] for x in held]
            cuts = [0, *[bisect_left(keys, s) for s in splitters], len(keys)]
            rows = []
            for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    part = held[a:b]
                    lengths, rests = front_code(keys[a:b])
                    facts = np.array([x[1] for x in part], np.int64)
                    lefts = b"".join(x[2] for x in part)
                    name = xxhash.xxh3_128_hexdigest(facts.tobytes())
                    rows.append((bucket, name, lengths.tobytes(), rests, facts.tobytes(), lefts))
            kinds = [pa.int32(), pa.string(), *[pa.binary()] * 4]
            names = [x.split()[0] for x in RUNS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for text, wanted in zip(texts_of(batch), batch.column("wanted").to_pylist()):
                data = text.encode()
                for w in wanted:
                    anchor = w["start"] + w["offset"]
                    end = w["start"] + w["windows"] - 1 + length
                    facts = (w["gram"], w["context"], w["n"], w["windows"], w["offset"])
                    held.append((data[anchor:end], facts, data[w["start"] : anchor]))
                    size += end - w["start"] + 200
                if size > RUN_BYTES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return needed.mapInArrow(run, RUNS)


def _left_hashes(lefts: list[bytes], width: int) -> np.ndarray:
    """Hash of the last d bytes before each anchor, for d = 0 .. width."""
    up, _ = _powers(_SEGMENT * 2 + LENGTH)
    data = np.zeros((len(lefts), width), np.uint8)
    for i, left in enumerate(lefts):
        if left:
            data[i, : len(left)] = np.frombuffer(left[::-1], np.uint8)
    out = np.zeros((len(lefts), width + 1), np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:width], axis=1, out=out[:, 1:])
    return _mix(out)


def repeated_windows(prefixes: np.ndarray, facts: np.ndarray, lefts: list[bytes], length: int) -> np.ndarray:
    """For merged suffixes, which windows (by distance d left of the anchor) occur twice."""
    counts, windows, offset = facts[:, 2], facts[:, 3], facts[:, 4]
    width = int(offset.max()) if len(offset) else 0
    left = _left_hashes(lefts, max(width, 1))
    out = np.zeros((len(facts), width + 1), bool)
    for d in range(width + 1):
        on = np.flatnonzero((offset >= d) & (offset - windows < d))
        if not len(on):
            continue
        # suffixes between which no common prefix is too short form a class
        classes = np.cumsum(prefixes < length - d).astype(np.uint64)
        keys = _mix(classes[on]) ^ left[on, d]
        _, place, size = np.unique(keys, return_inverse=True, return_counts=True)
        out[on, d] = (size[place] >= 2) | (counts[on] >= 2)
    return out


def _intervals(flags: np.ndarray, offset: int) -> list[tuple[int, int]]:
    """First and last window, from the context's start, of each run of repeated windows."""
    on = np.flatnonzero(flags[: offset + 1][::-1])  # distance d is window offset - d
    if not len(on):
        return []
    breaks = np.flatnonzero(np.diff(on) > 1)
    return list(zip(on[np.append(0, breaks + 1)].tolist(), on[np.append(breaks, len(on) - 1)].tolist()))


ANSWERS = "gram long, context long, spans array<struct<a:int,b:int>>"
_SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def merged_answers(runs: DataFrame, parts: int, length: int, chunk: int = 20_000) -> DataFrame:
    """Merge the runs of each bucket and decide the windows of each context."""

    def decide(rows: list[tuple]) -> pa.RecordBatch:
        prefixes = np.array([r[0] for r in rows])
        facts = np.array([r[1] for r in rows], np.int64)
        flags = repeated_windows(prefixes, facts, [r[2] for r in rows], length)
        out = []
        for (gram, context, _, windows, offset), flag in zip(facts.tolist(), flags):
            spans = _intervals(flag, offset)
            if spans:
                out.append((gram, context, [{"a": a, "b": b} for a, b in spans]))
        kinds = [pa.int64(), pa.int64(), _SPANS]
        columns = zip(*out) if out else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["gram", "context", "spans"])

    def bucket(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        decoded, facts, lefts = [], [], []
        for row in rows:
            decoded.append(front_decode(np.frombuffer(row["lengths"], np.int32).reshape(-1, 2), row["rests"]))
            own = np.frombuffer(row["facts"], np.int64).reshape(-1, 5)
            facts.append(own)
            lefts.append((row["lefts"], np.append(0, np.cumsum(own[:, 4]))))
        at = [count() for _ in rows]
        held, last = [], None
        for prefix, _, run in merge(decoded):
            i = next(at[run])
            fact = facts[run][i].tolist()
            text, ends = lefts[run]
            if len(held) >= chunk and fact[0] != last:
                yield decide(held)
                held, prefix = [], 0
            last = fact[0]
            held.append((prefix, fact, text[ends[i] : ends[i + 1]]))
        if held:
            yield decide(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != at and rows:
                    yield from bucket(rows)
                    rows = []
                at = row["bucket"]
                rows.append(row)
        if rows:
            yield from bucket(rows)

    return runs.repartition(parts, "bucket").sortWithinPartitions("bucket", "run").mapInArrow(run, ANSWERS)


def counted_answers(needed: DataFrame, length: int) -> DataFrame:
    """The same decision for grams with very many contexts: windows counted by 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h1", "h2", "gram", "context", "n", "a"]
        for batch in batches:
            rows = []
            for text, wanted in zip(texts_of(batch), batch.column("wanted").to_pylist()):
                data = text.encode()
                for w in wanted:
                    for a in range(w["windows"]):
                        start = w["start"] + a
                        h = xxhash.xxh3_128_digest(data[start : start + length])
                        pair = int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)
                        rows.append((*pair, w["gram"], w["context"], w["n"], a))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    windows = needed.mapInArrow(run, "h1 long, h2 long, gram long, context long, n long, a long")
    windows = stage(windows, "windows")
    twice = windows.groupBy("h1", "h2").agg(F.sum("n").alias("times")).where("times > 1").select("h1", "h2")
    spans = F.transform(
        F.array_distinct(F.collect_list("a")), lambda a: F.struct(a.cast("int").alias("a"), a.cast("int").alias("b"))
    )  # at most ``length`` windows of a context
    return windows.join(twice, ["h1", "h2"], "left_semi").groupBy("gram", "context").agg(spans.alias("spans"))


def _entries(lists: DataFrame, name: str) -> int:
    return lists.select(F.sum(F.size(name))).first()[0] or 0


def _texts_with(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row for each text that has wanted anchors. Only the lists move, a bucket's are a part of its texts."""
    return docs.select("doc", "t1", "text").join(wanted.hint("shuffle_hash"), ["doc", "t1"])


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, t1, spans): first and last repeated windows of each text that has some (runs jobs)."""
    spark = docs.sparkSession
    anchors = stage(anchor_table(docs, length, gram), "anchors")
    twice = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    anchors = stage(anchors.join(twice, "gram", "left_semi"), "repeated-grams")
    place = ("doc", "t1", "start", "windows", "offset")  # of any one of the equal contexts
    contexts = anchors.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in place])
    contexts = stage(contexts, "contexts")
    several = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1")
    edges = contexts.join(several, "gram")
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.col("windows") - 1).alias("b")))
    answers = [
        contexts.join(several, "gram", "left_anti").where("n > 1").select("gram", "context", whole.alias("spans"))
    ]
    wants = F.collect_list(F.struct("gram", "context", "n", "start", "windows", "offset")).alias("wanted")
    near = stage(edges.where(F.col("contexts") <= HOT).groupBy("doc", "t1").agg(wants), "edges")
    texts = _texts_with(docs, near)
    parts = shuffle_partitions(spark)
    runs = sorted_runs(texts, _splitters(docs, near, parts, gram), length)
    answers.append(stage(merged_answers(runs, parts, length), "answers"))
    hot = stage(edges.where(F.col("contexts") > HOT).groupBy("doc", "t1").agg(wants), "hot")
    if not hot.isEmpty():
        answers.append(stage(counted_answers(_texts_with(docs, hot), length), "hot-answers"))
    known = answers[0]
    for more in answers[1:]:
        known = known.unionByName(more.select("gram", "context", "spans"))
    marked = anchors.join(known, ["gram", "context"]).select(
        "doc",
        "t1",
        F.explode(F.transform("spans", lambda s: F.struct((s["a"] + F.col("start")).alias("a"), (s["b"] + F.col("start")).alias("b")))).alias("s"),
    )
    return marked.groupBy("doc", "t1").agg(F.collect_set("s").alias("spans"))  # of one text


def _splitters(docs: DataFrame, wanted: DataFrame, parts: int, gram: int, keep: int = 64) -> list[bytes]:
    """Sampled grams, about ``keep`` for each part, that cut the suffixes into about equal buckets.

    Suffixes of one gram fall into one bucket. Runs a job.
    """
    total = max(1, _entries(wanted, "wanted"))
    share = max(1, total // (parts * keep))
    some = F.filter("wanted", lambda w: F.pmod(w["gram"], F.lit(share)) == 0)
    sample = wanted.select("doc", "t1", some.alias("wanted")).where(F.size("wanted") > 0)
    picked = _texts_with(docs, sample).select("text", F.explode("wanted").alias("w")).select(
        "text", (F.col("w.start") + F.col("w.offset")).alias("at")
    )

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = [t.encode()[a : a + gram] for t, a in zip(texts_of(batch), batch.column("at").to_pylist())]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])

        return one

    keys = sorted({bytes(r["key"]) for r in by_batch(picked, make, "key binary").collect()})
    return [keys[i * len(keys) // parts] for i in range(1, parts)] if len(keys) >= parts else keys


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text without the bytes of strings of ``length`` bytes that start at two places (runs jobs).

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256. Null texts count as empty, texts under
    ``length`` bytes stay whole, repeated rows are documents of their own (so long ones go whole).
    Null ids are kept, other columns are not read, an empty table gives an empty result. Grams are
    ``GRAM`` bytes, or a third of a shorter ``length``.
    """
    gram = GRAM if length >= 3 * GRAM else max(1, length // 3)
    text = F.coalesce("text", F.lit(""))
    docs = narrow(docs, id_col, text_col).select(
        "doc_id",
        F.coalesce("doc_id", F.lit(-(2**63))).alias("doc"),
        F.xxhash64(text).alias("t1"),
        text.alias("text"),
    )
    docs = stage_buckets(docs, "texts", "doc", "t1")
    found = stage(repeats(docs, length, gram), "repeats")
    joined = docs.join(found.hint("shuffle_hash"), ["doc", "t1"], "left").select("doc_id", "text", "spans")

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text, spans in zip(texts_of(batch), batch.column("spans").to_pylist()):
                data = text.encode()
                if not spans:
                    rows.append((len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                    continue
                kept, n_spans, removed, at = hashlib.sha256(), 0, 0, 0
                for a, b in sorted((s["a"], s["b"] + length) for s in spans):
                    if a > at or not n_spans:
                        kept.update(data[at:a])
                        n_spans += 1
                        removed += b - a
                        at = b
                    elif b > at:
                        removed += b - at
                        at = b
                kept.update(data[at:])
                rows.append((len(data), removed, n_spans, kept.hexdigest()))
            kinds = [*[pa.int64()] * 3, pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)

        return one

    return by_batch(joined, make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
