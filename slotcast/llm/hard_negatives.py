"""Hard negatives by inner product, from an STR-packed R-tree (operator 12).

1. Vectors become integers. Of equal vectors with one label only the smallest ids can ever be returned, so
   no more than those enter the index; this is exact, and a vector that a third of all rows share is
   a few rows from then on.
2. Sort-tile-recursive packing: the coordinates with most spread are cut at quantiles, one after
   another, into tiles of about ``box_rows`` rows. A tile is a top box of the tree; a tile that came out
   too large (many equal coordinates) is cut further by the hash of its rows. Inside a box the same
   packing goes on down to leaves.
3. The minimum bounding box of a node gives an interval for the inner product with a query: every
   coordinate adds the smaller or larger of its two ends' products. Queries are sent to the boxes whose
   interval meets their score window, first to the most promising one, whose k-th score then closes
   boxes that lie strictly below it.
4. In a box, a best-first queue opens nodes by their highest upper end, for a block of queries at once.
   A query takes part in a node only where the node's interval meets its window and does not end
   strictly below the query's k-th score so far. Scores are exact integers.

Positives are a search without a window among rows of the same label; negatives one among the other
labels, in the window that the positive's score sets.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotcast.llm.common import scratch, shuffle_partitions, table

LEAF = 64
FAN_OUT = 8
#: Requests that one copy of a box answers, about.
BLOCK = 4_096
_LEAST, _MOST = -(2**62), 2**62  # beyond all scores

#: Boxes whose bounds a task holds at once while it finds the boxes a query has to ask.
CHUNK = 1_024

ROWS = "vec_id long, label long, v array<long>"
INDEX = "box long, vec_id long, label long, v array<long>"
BOUNDS = "box long, n_axes int, low array<long>, high array<long>"
HITS = "query long, lo long, hi long, vec_id long, score long"
MET = "query long, lo long, hi long, box long, top long"


# --- rows ---


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = 256) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, components as ``floor(scale * x)``."""
    x = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = x.dropna().filter(F.coalesce(finite, F.lit(False)))
    return x.withColumn("v", F.transform("v", lambda c: F.floor(c * scale).cast("long")))


def _first_of_equals(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest ids of each vector and label; no other can be among the first k of a search."""
    equal = Window.partitionBy("label", "v").orderBy("vec_id")
    return rows.withColumn("nth", F.row_number().over(equal)).filter(F.col("nth") <= k).drop("nth")


# --- packing ---


def _cuts(rows: DataFrame, boxes: int, axes: int) -> list[tuple[int, list[float]]]:
    """(coordinate, its inner cut points) of the tiling; two jobs, and a few numbers for the driver.

    The coordinates of most variance are cut, each at quantiles of the whole table.
    """
    size = rows.agg(F.max(F.size("v"))).first()[0]
    spread = rows.select(*(F.var_pop(F.get("v", F.lit(i))).alias(f"c{i}") for i in range(size))).first()
    by_spread = sorted(range(size), key=lambda i: (-(spread[i] or 0.0), i))
    chosen = by_spread[: max(1, min(axes, size))]
    slabs = round(boxes ** (1 / len(chosen)) + 0.499)
    shares = [j / slabs for j in range(1, slabs)]
    if not shares:
        return []
    ends = rows.select(
        *(F.percentile_approx(F.get("v", F.lit(i)), shares, 10_000).alias(f"c{i}") for i in chosen)
    ).first()
    return [(i, sorted(set(e or []))) for i, e in zip(chosen, ends)]


def _tile(cuts: list[tuple[int, list[float]]]) -> Column:
    """The number of a row's tile: its slab on each cut coordinate. Vectors of one size share tiles."""
    tile = F.size("v").cast("long")
    for axis, ends in cuts:
        at = F.coalesce(F.get("v", F.lit(axis)), F.lit(0))
        slab = F.aggregate(
            F.array(*(F.lit(e) for e in ends)), F.lit(0), lambda n, e: n + (at > e).cast("int")
        ) if ends else F.lit(0)
        tile = tile * (len(ends) + 1) + slab
    return tile


def _packed(rows: DataFrame, box_rows: int, axes: int) -> DataFrame:
    """The index: every row with its box."""
    n = rows.count()
    cuts = _cuts(rows, max(1, -(-n // box_rows)), axes) if n else []
    tiled = rows.withColumn("tile", _tile(cuts))
    sizes = tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))  # at most a row for each tile
    parts = F.ceil(F.col("n") / (2 * box_rows))
    part = F.pmod(F.xxhash64("vec_id", "label", "v"), parts)
    box = F.col("tile") * (1 << 24) + part
    return tiled.join(sizes, "tile").select(box.alias("box"), "vec_id", "label", "v").repartition("box")


def _bounds(index: DataFrame) -> DataFrame:
    """Minimum bounding boxes of the top boxes, from those of the boxes' rows in each Arrow batch."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            box = batch.column("box").to_numpy()
            for a, b in _runs(box):
                rows = _matrix(batch.column("v").slice(a, b - a))
                low, high = (rows.min(0), rows.max(0)) if rows.size else (rows[0], rows[0])
                columns = [[box[a]], [rows.shape[1]], [low], [high]]
                types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=["box", "n_axes", "low", "high"]
                )

    ends = F.posexplode_outer(F.arrays_zip("low", "high")).alias("at", "end")
    axes = (
        index.mapInArrow(some, BOUNDS)
        .select("box", "n_axes", ends)
        .groupBy("box", "n_axes", "at")
        .agg(F.min("end.low").alias("lo"), F.max("end.high").alias("hi"))
    )
    listed = F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "lo", "hi")))).alias("ends")
    return axes.groupBy("box", "n_axes").agg(listed).select(
        "box", "n_axes", F.col("ends.lo").alias("low"), F.col("ends.hi").alias("high")
    )


class Tree:
    """An R-tree over the rows of a box, packed by sort-tile-recursive."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = _str_order(vectors)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        starts = np.arange(0, len(ids), LEAF)
        if vectors.shape[1]:
            low = np.minimum.reduceat(self.vectors, starts, axis=0)
            high = np.maximum.reduceat(self.vectors, starts, axis=0)
        else:
            low = high = np.zeros((len(starts), 0), self.vectors.dtype)
        self.levels = [(low, high)]  # leaves first
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            at = np.arange(0, len(low), FAN_OUT)
            if vectors.shape[1]:
                self.levels.append((np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)))
            else:
                self.levels.append((low[at], high[at]))

    def children(self, level: int, node: int) -> range:
        return range(node * FAN_OUT, min((node + 1) * FAN_OUT, len(self.levels[level - 1][0])))

    def rows(self, leaf: int) -> slice:
        return slice(leaf * LEAF, (leaf + 1) * LEAF)


def _str_order(vectors: np.ndarray) -> np.ndarray:
    """Rows in the order of their leaves: slabs by the widest coordinate, and so on inside each slab."""

    def pack(rows: np.ndarray, axes: list[int]) -> list[np.ndarray]:
        leaves = -(-len(rows) // LEAF)
        if leaves <= 1 or not axes:
            return [rows]
        rows = rows[np.argsort(vectors[rows, axes[0]], kind="stable")]
        slabs = int(np.ceil(leaves ** (1 / len(axes)) - 1e-9))
        step = LEAF * -(-leaves // slabs)
        return [part for i in range(0, len(rows), step) for part in pack(rows[i : i + step], axes[1:])]

    width = np.ptp(vectors, axis=0) if vectors.shape[1] and len(vectors) else np.zeros(0)
    return np.concatenate(pack(np.arange(len(vectors)), np.argsort(-width, kind="stable")[:3].tolist()))


# --- search ---


def _exact_type(vectors: np.ndarray, other: np.ndarray) -> type:
    """Floating point where all sums of products are exact in it, else 64-bit integers where they fit."""
    most = [float(np.abs(x.astype(float)).max()) if x.size else 0.0 for x in (vectors, other)]
    bound = most[0] * most[1] * max(vectors.shape[1], 1)
    if bound < 2**53:
        return np.float64
    if bound < 2**62:
        return np.int64
    raise ArithmeticError("inner products do not fit 64-bit integers")


def search(tree: Tree, queries: np.ndarray, labels, same: bool, lo, hi, floor, k: int):
    """The first ``k`` rows of each query: (scores, ids), a row for each query, ids of -1 where none.

    ``same`` asks for rows of the query's label, otherwise for others; scores lie in [lo, hi] and
    count from ``floor`` on, a score that k other rows are known to reach.
    """
    kind = _exact_type(tree.vectors, queries)
    vectors, q = tree.vectors.astype(kind), queries.astype(kind)
    levels = [(a.astype(kind), b.astype(kind)) for a, b in tree.levels]
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    best = np.full((len(q), k), _LEAST, np.int64)
    ids = np.full((len(q), k), -1, np.int64)
    kth = np.maximum(floor, lo)

    def interval(level: int, nodes, some):
        low, high = (x[nodes] for x in levels[level])
        top = plus[some] @ high.T + minus[some] @ low.T
        least = plus[some] @ low.T + minus[some] @ high.T
        return least.astype(np.int64), top.astype(np.int64)

    queue: list[tuple[int, int, int, np.ndarray, np.ndarray]] = []

    def offer(level: int, nodes: range, some: np.ndarray) -> None:
        least, top = interval(level, list(nodes), some)
        for j, node in enumerate(nodes):
            open_to = (top[:, j] >= kth[some]) & (least[:, j] <= hi[some])
            if open_to.any():
                ends = top[open_to, j]
                heapq.heappush(queue, (-int(ends.max()), level, node, some[open_to], ends))

    offer(len(levels) - 1, range(len(levels[-1][0])), np.arange(len(q)))
    while queue:
        _, level, node, some, ends = heapq.heappop(queue)
        some = some[ends >= kth[some]]  # the k-th scores may have risen meanwhile
        if not len(some):
            continue
        if level:
            offer(level - 1, tree.children(level, node), some)
            continue
        rows = tree.rows(node)
        scores = (q[some] @ vectors[rows].T).astype(np.int64)
        mine = tree.labels[rows][None, :] == labels[some][:, None]
        fits = (mine == same) & (scores >= kth[some][:, None]) & (scores <= hi[some][:, None])
        some, scores, fits = some[fits.any(1)], scores[fits.any(1)], fits[fits.any(1)]
        if not len(some):
            continue
        found = np.where(fits, scores, _LEAST)
        found_ids = np.where(fits, tree.ids[rows][None, :], -1)
        all_scores, all_ids = np.hstack([best[some], found]), np.hstack([ids[some], found_ids])
        first = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        best[some] = np.take_along_axis(all_scores, first, 1)
        ids[some] = np.take_along_axis(all_ids, first, 1)
        kth[some] = np.maximum(kth[some], best[some, -1])
    ids[best == _LEAST] = -1
    return best, ids


def _matrix(column: pa.ListArray) -> np.ndarray:
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy().reshape(len(column), width)


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of the runs of equal values."""
    n = len(columns[0])
    if not n:
        return []
    change = np.zeros(n - 1, bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    ends = [0, *(np.flatnonzero(change) + 1).tolist(), n]
    return list(zip(ends, ends[1:]))


# --- requests beside what answers them ---


def _side_by_side(held: DataFrame, asked: DataFrame, make: Callable, answer: Callable, schema: str) -> DataFrame:
    """Meets the rows of ``asked`` with those of ``held`` that have the same ``part``.

    A task holds what ``make`` gives for one part, and passes the requests by in batches. Requests of a part
    go in blocks of about ``BLOCK``, each with its own copy of the part, so that one that all ask
    is no hot key.
    """
    blocks = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows, requests = ([c for c in df.columns if c != "part"] for df in (held, asked))

    def side(df: DataFrame, block: Column, asks: bool) -> DataFrame:
        row, request = F.struct(*rows), F.struct(*requests)
        given = {"held": F.lit(None) if asks else row, "asked": request if asks else F.lit(None)}
        return df.join(blocks, "part").select(
            "part", block.alias("block"), F.lit(asks).alias("asks"), *(c.alias(n) for n, c in given.items())
        )

    spread = F.pmod(F.xxhash64("query", "lo", "hi"), F.col("blocks")).cast("int")
    together = side(held, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), False).unionByName(side(asked, spread, True))
    parts = shuffle_partitions(held.sparkSession)
    dealt = together.repartition(parts, "part", "block").sortWithinPartitions("part", "block", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, ready = None, [], None
        for batch in batches:
            part, block, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "block", "asks"))
            for a, b in _runs(part, block, asks):
                if at != (part[a], block[a]):
                    at, waiting, ready = (part[a], block[a]), [], None
                name = "asked" if asks[a] else "held"
                some = pa.RecordBatch.from_struct_array(batch.column(name).slice(a, b - a))
                if not asks[a]:
                    waiting.append(some)
                elif waiting or ready is not None:
                    if ready is None:
                        ready = make(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
                        waiting = []
                    yield from answer(ready, some)

    return dealt.mapInArrow(run, schema)


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy() for n in names]


def _ask(index: DataFrame, requests: DataFrame, same: bool, k: int) -> DataFrame:
    """The first ``k`` hits of each request (box, query, lo, hi, floor, label, v) in its box."""

    def make(rows: pa.RecordBatch) -> Tree:
        return Tree(*_numbers(rows, "vec_id", "label"), _matrix(rows.column("v")))

    def answer(tree: Tree, some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        query, lo, hi, floor, label = _numbers(some, "query", "lo", "hi", "floor", "label")
        best, ids = search(tree, _matrix(some.column("v")), label, same, lo, hi, floor, k)
        row, nth = np.nonzero(best > _LEAST)
        columns = [query[row], lo[row], hi[row], ids[row, nth], best[row, nth]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "lo", "hi", "vec_id", "score"])

    held, asked = index.withColumnRenamed("box", "part"), requests.withColumnRenamed("box", "part")
    return _side_by_side(held, asked, make, answer, HITS)


def _met(bounds: DataFrame, requests: DataFrame) -> DataFrame:
    """(request, box, upper end) of all boxes whose interval meets the request's window.

    The bounds are held in chunks, so a task's memory does not follow the number of boxes.
    """
    chunks = max(1, -(-bounds.count() // CHUNK))

    def make(rows: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        return rows.column("box").to_numpy(), _matrix(rows.column("low")), _matrix(rows.column("high"))

    def answer(boxes: tuple[np.ndarray, ...], some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        box, low, high = boxes
        query, lo, hi = _numbers(some, "query", "lo", "hi")
        q = _matrix(some.column("v"))
        kind = _exact_type(np.concatenate([low, high]), q)
        plus, minus = np.maximum(q, 0).astype(kind), np.minimum(q, 0).astype(kind)
        low, high = low.astype(kind).T, high.astype(kind).T
        for a in range(0, len(q), 256):
            b = slice(a, a + 256)
            top = (plus[b] @ high + minus[b] @ low).astype(np.int64)
            least = (plus[b] @ low + minus[b] @ high).astype(np.int64)
            row, at = np.nonzero((top >= lo[b, None]) & (least <= hi[b, None]))
            columns = [query[b][row], lo[b][row], hi[b][row], box[at], top[row, at]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "lo", "hi", "box", "top"])

    size = F.size("v").cast("long") * (1 << 32)
    asked = requests.withColumn("part", F.explode(F.sequence(size, size + (chunks - 1))))
    chunk = F.pmod(F.xxhash64("box"), F.lit(chunks))
    held = bounds.withColumn("part", F.col("n_axes").cast("long") * (1 << 32) + chunk)
    return _side_by_side(held, asked, make, answer, MET)


_REQUEST = ["query", "lo", "hi"]


def _first(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy(*_REQUEST).orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def nearest(index: DataFrame, bounds: DataFrame, requests: DataFrame, same: bool, k: int) -> DataFrame:
    """The first ``k`` rows of each request, over all boxes, with their ``rank`` (runs jobs).

    ``requests`` has (query, lo, hi, label, v), and wants rows of its label (``same``) or of all others. The
    box whose interval reaches highest answers first; its k-th score closes all boxes that end
    strictly below it.
    """
    met = _store(_met(bounds, requests), "met", MET)
    home = met.groupBy(*_REQUEST).agg(F.max_by("box", F.struct("top", "box")).alias("home"))
    first = requests.join(home, _REQUEST).select(
        F.col("home").alias("box"), *_REQUEST, F.lit(_LEAST).alias("floor"), "label", "v"
    )
    at_home = _store(_ask(index, first, same, k), "hits", HITS)
    kth = F.when(F.count(F.lit(1)) == k, F.min("score")).alias("kth")
    floors = home.join(_first(at_home, k).groupBy(*_REQUEST).agg(kth), _REQUEST, "left").select(
        *_REQUEST, "home", F.coalesce("kth", F.lit(_LEAST)).alias("floor")
    )
    others = (
        met.join(floors, _REQUEST)
        .filter((F.col("box") != F.col("home")) & (F.col("top") >= F.col("floor")))
        .join(requests, _REQUEST)
        .select("box", *_REQUEST, "floor", "label", "v")
    )
    return _first(at_home.unionByName(_ask(index, others, same, k)), k)


def _store(df: DataFrame, name: str, schema: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _listed(found: DataFrame, *keys: str) -> DataFrame:
    """The hits of a request as one short list, best first."""
    nth = F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score")))
    return found.groupBy(*keys).agg(F.transform(nth, lambda h: F.struct(h["vec_id"], h["score"])).alias("hits"))


def hard_negatives(
    vectors: DataFrame,
    anchors: Column | None = None,
    n_positives: int = 5,
    n_negatives: int = 5,
    low_percent: int = 80,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    box_rows: int = 4_096,
    axes: int = 3,
) -> DataFrame:
    """Negatives of every anchor and positive, by rank (runs jobs).

    ``anchors`` is a condition on ``vec_id``; without one, every row is an anchor. The positives of an
    anchor are its first ``n_positives`` other rows of its label by inner product, ties by id; the
    negatives of a positive are the first rows of other labels whose score lies between
    ``low_percent`` of the positive's score and that score, so a negative positive score has none.

    Rows with a null id, label or vector, or with a component that is null or not finite take no part.
    Vectors of different sizes never meet. Repeated rows are rows of their own, each as anchor, positive
    and negative. An empty table gives no rows; other columns are not read. Scores beyond 64-bit
    integers raise an error.
    """
    rows = _store(quantised(vectors, id_col, vector_col, label_col), "vectors", ROWS)
    k = max(n_positives + 1, n_negatives)
    index = _store(_packed(_first_of_equals(rows, k), box_rows, axes), "tree", INDEX)
    bounds = _store(_bounds(index), "boxes", BOUNDS)
    chosen = rows if anchors is None else rows.filter(anchors)
    # Anchors that agree in vector and label ask the same, so each distinct one asks once.
    distinct = chosen.select("label", "v").distinct().withColumn("query", F.monotonically_increasing_id())
    queries = _store(distinct, "queries", "label long, v array<long>, query long")

    all_scores = queries.withColumns({"lo": F.lit(_LEAST), "hi": F.lit(_MOST)})
    near = nearest(index, bounds, all_scores, True, n_positives + 1)
    near = _store(near.select("query", "vec_id", "score", "rank"), "near", "query long, vec_id long, score long, rank int")
    low = F.expr(f"(cast(score as decimal(38,0)) * {low_percent} + 99) div 100").alias("lo")
    windows = near.filter("score >= 0").select("query", low, F.col("score").alias("hi")).distinct()
    windows = _store(windows.join(queries, "query"), "windows", "query long, lo long, hi long, label long, v array<long>")
    far = _listed(nearest(index, bounds, windows, False, n_negatives), "query", F.col("hi").alias("positive_score"))

    own = F.aggregate(F.transform("v", lambda x: x * x), F.lit(0).cast("long"), lambda a, b: a + b)
    of_anchor = chosen.join(queries, ["label", "v"]).select(F.col("vec_id").alias("anchor_id"), "query", own.alias("own"))
    # The anchor itself goes from the list, once; it need not be in it where many rows score higher.
    at = F.array_position("hits", F.struct(F.col("anchor_id").alias("vec_id"), F.col("own").alias("score"))).cast("int")
    others = F.when(at == 0, F.col("hits")).otherwise(
        F.concat(F.slice("hits", 1, at - 1), F.slice("hits", at + 1, n_positives + 1))
    )
    positives = (
        of_anchor.join(_listed(near, "query"), "query")
        .select("anchor_id", "query", F.explode(F.slice(others, 1, n_positives)).alias("p"))
        .select("anchor_id", "query", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    )
    return (
        positives.join(far, ["query", "positive_score"])
        .select("anchor_id", "positive_id", "positive_score", F.posexplode("hits").alias("at", "n"))
        .select(
            "anchor_id",
            "positive_id",
            (F.col("at") + 1).alias("rank"),
            F.col("n.vec_id").alias("negative_id"),
            "positive_score",
            F.col("n.score").alias("negative_score"),
        )
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the id is divisible by 7 the label moves by one; every hundredth id is an anchor."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)
