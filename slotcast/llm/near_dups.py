"""Near-duplicates by one-permutation hashing (operator 9).

1. One pass hashes each document's word shingles once. The hash range is cut into bins, the least
   hash of each bin is kept, and an empty bin borrows from the first filled bin of its own fixed
   random order of bins (densification without bias or runs of copies). Bands of bins are keys.
2. Documents with equal sets form a class; only its smallest id goes on.
3. Round one: every member of a bucket points to the bucket's smallest id, and each document keeps
   the hub that it shares most buckets with. So a group of n near copies costs n edges.
4. Round two confirms the other star edges between documents that are not yet in one component.
5. Round three takes what stars can miss: pairs in one bucket but in different components. First,
   shingles that no other document of such buckets has are counted; they cannot be common, and their
   number rules out nearly all pairs of far copies without comparing them. The rest is confirmed.

Every link is confirmed on full sets. Sets of hub and members meet in blocks of bounded size, so a
hub with many members is spread over tasks. Links, components and sketches stay in tables.

Nothing that grows with the input is broadcast: beyond a fixed number of rows tables meet by a merge
join, and texts are first sieved by a bitmap over hashes of the wanted ids of a fixed largest size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm.common import by_batch, by_rows, narrow, shuffle_partitions, stage, table, texts_of

BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
#: Members of a block, of which each has the hub's set once.
BLOCK = 512
#: Rows of a table that may be broadcast, which take up to 200 bytes each in the driver and every executor.
LISTED = 30_000
#: Pages of a sieve, of 4 KB each, and bits for each id as long as the pages suffice.
PAGES, PAGE_BITS, SPARSE = 1024, 8 * 4096, 16

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
SKETCH = "doc_id long, n_shingles long, key_hi long, key_lo long, bands array<long>"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    Words lie between ASCII white space, A-Z are lower-cased. Fewer words than a shingle has make
    one shingle; no word makes none.
    """
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found))], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = len(found) - words + 1
    out = each[:n].copy()
    for i in range(1, words):
        out = _mix(out) * _ODD[2] + each[i : i + n]
    return np.unique(_mix(out))


def _borrow_order(bins: int) -> np.ndarray:
    """For each bin, the fixed random order in which it looks for a filled one."""
    keys = _mix(np.arange(1, bins * bins + 1, dtype=np.uint64) * _ODD[3]).reshape(bins, bins)
    return np.argsort(keys, axis=1)


def band_keys(hashes: np.ndarray, order: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A key for each band of the densified one-permutation sketch of a sorted non-empty set."""
    bins = bands * rows
    edges = (np.arange(bins, dtype=np.uint64) * np.uint64(2**64 // bins)).astype(np.uint64)
    first = np.searchsorted(hashes, edges)
    end = np.append(first[1:], len(hashes))
    filled = end > first
    values = hashes[np.minimum(first, len(hashes) - 1)]
    if not filled.all():
        empty = np.flatnonzero(~filled)
        values[empty] = values[order[empty, filled[order[empty]].argmax(1)]]
    values = values.reshape(bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64) * _ODD[3]
    for i in range(rows):
        keys = _mix(keys) * _ODD[2] + values[:, i]
    return _mix(keys).view(np.int64)


def sketches(docs: DataFrame, words: int = 5) -> DataFrame:
    """Set size, set digest and band keys of every document; empty texts have no bands."""

    def make():
        order = _borrow_order(BINS)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, high, low, bands = [], [], [], []
            for text in texts_of(batch):
                hashes = shingles(text, words)
                digest = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64)
                sizes.append(len(hashes))
                high.append(int(digest[0]))
                low.append(int(digest[1]))
                bands.append(band_keys(hashes, order) if len(hashes) else None)
            arrays = [pa.array(x, pa.int64()) for x in (sizes, high, low)]
            bands = pa.array(bands, pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays, bands],
                names=["doc_id", "n_shingles", "key_hi", "key_lo", "bands"],
            )

        return one

    return by_batch(docs, make, SKETCH)


def _sieve(ids: DataFrame, count: int) -> DataFrame:
    """(page, bits): a bitmap of hashes of the ids; its pages have a fixed largest number."""
    pages = min(PAGES, 1 + count * SPARSE // PAGE_BITS)
    page, bit = _place(pages)
    bits = ids.select(page.alias("sieve_page"), bit.alias("bit")).repartition("sieve_page")
    return bits.groupBy("sieve_page").agg(F.bitmap_construct_agg("bit").alias("sieve_bits"))


def _place(pages: int) -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(pages * PAGE_BITS))
    return F.floor(at / PAGE_BITS), at.bitwiseAND(F.lit(PAGE_BITS - 1))


def _sieved(docs: DataFrame, ids: DataFrame, count: int) -> DataFrame:
    """``docs`` with ``maybe_listed``, which is true for all ``count`` ids and for few others."""
    page, bit = _place(min(PAGES, 1 + count * SPARSE // PAGE_BITS))
    byte = F.conv(F.hex(F.substring("sieve_bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10)
    found = F.getbit(byte.cast("int"), bit.bitwiseAND(F.lit(7)).cast("int")) == 1
    sieve = F.broadcast(_sieve(ids, count))
    return docs.join(sieve, page == F.col("sieve_page"), "left").select(
        *docs.columns, F.coalesce(found, F.lit(False)).alias("maybe_listed")
    )


def _only(docs: DataFrame, ids: DataFrame, entries: int) -> DataFrame:
    """Join ``docs`` to staged ``ids`` by doc_id; these are broadcast if they have few ``entries`` in all.

    Beyond that, the texts that pass the sieve move, and the others stay.
    """
    if entries <= LISTED:
        return docs.join(F.broadcast(ids), "doc_id")
    sieved = _sieved(docs, ids.select("doc_id"), ids.count())
    return sieved.where("maybe_listed").drop("maybe_listed").join(by_rows(ids, entries, LISTED), "doc_id")


def confirm(docs: DataFrame, pairs: DataFrame, count: int, words: int, percent: int) -> DataFrame:
    """(a, b, both, link) of ``count`` distinct pairs: common shingles, and whether the likeness suffices (runs jobs).

    A pair of which an id names several texts is as alike as its most alike texts.
    """
    spark = docs.sparkSession
    blocks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    placed = pairs.join(by_rows(blocks, count, LISTED), "a").select(
        "a", "b", F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("blocks"))).alias("block")
    )
    placed = stage(placed, "placed")
    roles = placed.select(F.col("a").alias("doc_id"), "block", F.lit(True).alias("hub"), "a").distinct()
    roles = roles.unionByName(
        placed.select(F.col("b").alias("doc_id"), "block", F.lit(False).alias("hub"), "a")
    )
    wanted = roles.groupBy("doc_id").agg(F.collect_list(F.struct("block", "hub", "a")).alias("roles"))
    wanted = stage(wanted, "wanted")
    entries = wanted.agg(F.sum(F.size("roles"))).first()[0] or 0

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "hub", "a", "b", "hashes"]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            rows, held = [], 0
            for doc, text, uses in zip(
                batch.column("doc_id").to_pylist(), texts_of(batch), batch.column("roles").to_pylist()
            ):
                hashes = shingles(text, words).tobytes()
                for use in uses:
                    rows.append((use["block"], use["hub"], use["a"], doc, hashes))
                    held += len(hashes)
                    if held > 16_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hubs = None, []
        for batch in batches:
            done = []
            for block, hub, a, b, hashes in zip(*[c.to_pylist() for c in batch.columns]):
                mine = np.frombuffer(hashes, np.uint64)
                if (block, a) != at:
                    at, hubs = (block, a), []
                if hub:
                    hubs.append(mine)
                    continue
                found = [(len(np.intersect1d(x, mine, assume_unique=True)), len(x) + len(mine)) for x in hubs]
                link = any(both and 100 * both >= percent * (size - both) for both, size in found)
                done.append((a, b, max((both for both, _ in found), default=0), link))
            if done:
                kinds = [*[pa.int64()] * 3, pa.bool_()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*done), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "both", "link"])

    met = (
        _only(docs, wanted, entries)
        .mapInArrow(sets, "block long, hub boolean, a long, b long, hashes binary")
        .repartition(shuffle_partitions(spark), "block")
        .sortWithinPartitions("block", "a", F.desc("hub"))
    )
    return stage(met.mapInArrow(compare, "a long, b long, both long, link boolean"), "links")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, comp): the smallest id that each linked document reaches (runs jobs).

    Labels go to neighbours and then jump to their label's label, so long chains take few rounds.
    """
    both = stage(
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        ),
        "edges",
    )
    labels = stage(both.groupBy(F.col("u").alias("doc_id")).agg(F.least("doc_id", F.min("v")).alias("comp")), "labels")
    count = labels.count()
    while True:
        near = (
            both.join(by_rows(labels.withColumnRenamed("doc_id", "v"), count, LISTED), "v")
            .groupBy(F.col("u").alias("doc_id"))
            .agg(F.min("comp").alias("near"))
        )
        lower = labels.join(by_rows(near, count, LISTED), "doc_id").select("doc_id", F.least("comp", "near").alias("to"), F.col("comp").alias("was"))
        heads = labels.select(F.col("doc_id").alias("to"), F.col("comp").alias("head"))
        new = lower.join(by_rows(heads, count, LISTED), "to").select("doc_id", F.least("to", "head").alias("comp"), "was")
        new = stage(new, "labels")
        if new.where("comp <> was").isEmpty():
            return new.select("doc_id", "comp")
        labels = new.select("doc_id", "comp")


def _with_components(rows: DataFrame, comps: DataFrame) -> DataFrame:
    return rows.join(by_rows(comps, comps.count(), LISTED), "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))


def _mixed(rows: DataFrame, count: int) -> DataFrame:
    """Rows of buckets that hold more than one component, with the bucket's most common one. ``count``: documents."""
    sizes = rows.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("size"))
    several = sizes.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("comps"), F.max_by("comp", F.struct("size", "comp")).alias("main")
    )
    return rows.join(by_rows(several.where("comps > 1").select("bucket", "main"), count, LISTED), "bucket")


def _shared(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, lone): how many shingles of a document no other one of ``ids`` has (runs a job)."""

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(text, words).view(np.int64) for text in texts_of(batch)]
            arrays = [batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "hashes"])

        return one

    sets = by_batch(_only(docs, ids, ids.count()), make, "doc_id long, hashes array<long>")
    once = (
        sets.select("doc_id", F.explode("hashes").alias("hash"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id"))
        .where("n = 1")
    )
    return once.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lone"))


def _pairs_across(rows: DataFrame, count: int, percent: int) -> DataFrame:
    """Pairs of a bucket that lie in different components and whose sizes allow a link.

    A link needs a common part of ``percent`` / (100 + percent) of both sizes together. It has none
    of the lone shingles of either side; where both were compared with one hub, it is made of what
    they share with the hub (``hub_both`` each) and of what they share beside it (``other`` each).
    Members of the bucket's main component meet only the others. A pair comes from its first band.
    """

    def side(rows: DataFrame, tag: str) -> DataFrame:
        names = ("doc_id", "n", "comp", "common", "hub", "hub_both", "other", "bands")
        return rows.select("bucket", "band", *[F.col(c).alias(f"{c}_{tag}") for c in names])

    one, two = side(rows.where("comp <> main"), "x"), side(rows.drop("band").withColumn("band", F.lit(0)), "y")
    most = F.when(
        F.col("hub_x") == F.col("hub_y"),
        F.least("hub_both_x", "hub_both_y") + F.least("other_x", "other_y"),
    ).otherwise(F.least("common_x", "common_y"))
    before = [F.slice(c, F.lit(1), one["band"]) for c in ("bands_x", "bands_y")]
    fits = (
        (one["bucket"] == two["bucket"])
        & (F.col("comp_x") != F.col("comp_y"))
        & ((100 + percent) * most >= percent * (F.col("n_x") + F.col("n_y")))
        & ~F.arrays_overlap(*before)
    )
    ends = F.least("doc_id_x", "doc_id_y").alias("a"), F.greatest("doc_id_x", "doc_id_y").alias("b")
    return one.join(by_rows(two, count, LISTED), fits).select(*ends).distinct()


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Component of every document under links of at least ``percent`` Jaccard likeness (runs jobs).

    Null and empty texts have no shingles and are linked with nothing. Rows without an id are
    returned unlinked (null component, kept). Rows that share an id are one node; each is
    returned. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = narrow(docs, id_col, text_col)
    known = stage(sketches(docs, words), "sketches")
    count = known.count()
    able = known.where("n_shingles > 0 and doc_id is not null")
    classes = able.groupBy("key_hi", "key_lo").agg(F.min("doc_id").alias("rep"))
    classed = able.join(by_rows(classes, count, LISTED), ["key_hi", "key_lo"])
    members = stage(classed.select("doc_id", "rep").distinct(), "members")
    reps = stage(
        classed.where("doc_id = rep").select("doc_id", F.col("n_shingles").alias("n"), "bands").dropDuplicates(["doc_id", "n"]),
        "reps",
    )
    exploded = F.posexplode("bands").alias("band", "bucket")
    rows = reps.select("doc_id", "n", exploded)

    hubs = rows.groupBy("bucket").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("size")).where("size > 1")
    star = stage(
        rows.join(by_rows(hubs, count, LISTED), "bucket")
        .where("doc_id <> a")
        .groupBy("a", F.col("doc_id").alias("b"))
        .agg(F.count(F.lit(1)).alias("shared")),
        "star",
    )
    best = star.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a")).select("a", "b")
    best = stage(best, "best")
    starred = best.count()
    checked = confirm(docs, best, starred, words, percent)
    links = checked.where("link").select("a", "b")
    # copies under one id with different texts stay one node through the class of each
    same = members.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    comps = components(links)

    seen, tried = best, starred
    more = star.join(by_rows(seen, tried, LISTED), ["a", "b"], "left_anti").select("a", "b")
    more = _across(more, comps)
    found = stage(more, "more")
    if others := found.count():
        links = links.unionByName(confirm(docs, found, others, words, percent).where("link").select("a", "b"))
        seen, tried = seen.unionByName(found), tried + others
        comps = components(links)

    rows = _with_components(reps, comps).select("doc_id", "n", exploded, "comp")
    rest = stage(_mixed(rows, count).drop("main"), "mixed")
    stars = checked.select(F.col("b").alias("doc_id"), F.col("a").alias("hub"), F.col("both").alias("hub_both"))
    near = rest.select("doc_id").distinct()
    near = near.unionByName(near.join(by_rows(stars, starred, LISTED), "doc_id").select(F.col("hub").alias("doc_id"))).distinct()
    lone = F.coalesce("lone", F.lit(0))
    rest = (
        rest.join(by_rows(_shared(docs, stage(near, "mixed-ids"), words), count, LISTED), "doc_id", "left")
        .withColumn("common", F.col("n") - lone)
        .where(100 * F.col("common") >= percent * F.col("n"))
        .join(by_rows(stars, starred, LISTED), "doc_id", "left")  # the hub is among ``near``, so it has no lone shingle of another
        .withColumn("hub", F.coalesce("hub", "doc_id"))
        .withColumn("hub_both", F.coalesce("hub_both", "n"))
        .withColumn("other", F.greatest(F.col("common") - F.col("hub_both"), F.lit(0)))
        .drop("lone")
    )
    bands = reps.select("doc_id", "bands").dropDuplicates(["doc_id"])
    rest = stage(_mixed(rest, count), "able").join(by_rows(bands, count, LISTED), "doc_id")
    pairs = _pairs_across(rest, count, percent).join(by_rows(seen, tried, LISTED), ["a", "b"], "left_anti")
    pairs = stage(pairs, "pairs")
    if across := pairs.count():
        links = links.unionByName(confirm(docs, pairs, across, words, percent).where("link").select("a", "b"))
    comps = components(links.unionByName(same))
    return known.join(by_rows(comps, comps.count(), LISTED), "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("comp", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("comp", "doc_id"), F.lit(True)).alias("kept"),
    )


def _across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    a = comps.select(F.col("doc_id").alias("a"), F.col("comp").alias("c_a"))
    b = comps.select(F.col("doc_id").alias("b"), F.col("comp").alias("c_b"))
    count = comps.count()
    joined = pairs.join(by_rows(a, count, LISTED), "a", "left").join(by_rows(b, count, LISTED), "b", "left")
    return joined.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def remove_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` without the documents that are not the smallest id of their component; all columns stay."""
    known = near_duplicates(docs, words, percent)
    gone = stage(known.where("not kept").select("doc_id").distinct(), "gone")
    count = gone.count()
    if count <= LISTED:
        return docs.join(F.broadcast(gone), "doc_id", "left_anti").select(*docs.columns)
    sieved = _sieved(docs, gone, count)
    stay, unsure = sieved.where("not maybe_listed"), sieved.where("maybe_listed")
    unsure = unsure.join(by_rows(gone, count, LISTED), "doc_id", "left_anti")
    return stay.select(*docs.columns).unionByName(unsure.select(*docs.columns))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
