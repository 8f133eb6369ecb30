"""Hard negatives by inner product, searched in STR-packed R-trees.

Rows are ordered by label and first coordinate over all tasks, which cuts each label into
slabs. A slab's rows are tiled by sort-tile-recursive packing of its widest coordinates and
stored as pages, each a small R-tree: leaves of ``LEAF`` rows, boxes of ``FANOUT`` children.
The product of an anchor with anything in a box lies between the sums of the least and the
greatest product of each coordinate. A search takes the boxes of a page best bound first;
a box goes if it lies outside all score windows of the anchor, or strictly below the k-th
result so far. Ties with the k-th stay, as a smaller id may win.

Anchors are a stated set of queries against all rows: they go to the pages in blocks of a
fixed size, and each task keeps the k best of each anchor. Results of tasks are merged by a
window over the anchor, at most k rows from a task. The first search gives the positives of
an anchor, whose scores are the windows of the second one.

Scores are exact: products of whole numbers in double precision where their sums stay below
2^53, else in Python's integers; beyond 64 bits they are cut to the largest long.

Nulls: rows without label, vector or ``vec_id``, or with a component that is null or not
finite, take no part. Vectors may differ in length, components that one lacks count as 0.
Repeated rows are rows of their own: another copy of an anchor may be its positive. An empty
table gives no rows. Other columns are ignored; vectors have no bound on their length but
that a row fits a Spark value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callgrove.llm.common import code_on_workers, stored, table
from callgrove.plans.ranking import top_k

#: Contract: which rows are anchors, which labels move, how many results, in which window.
ANCHOR_EVERY, MOVE_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
LOW_PERCENT, HIGH_PERCENT = 50, 95

#: Rows of a leaf, children of a box, rows of a page, anchors sent to the pages at once.
LEAF, FANOUT, PAGE, ANCHORS = 32, 16, 8192, 16384
#: Anchors searched side by side in a task, and the most boxes each takes in a round.
SIDE_BY_SIDE, BOXES = 512, 32


def participants(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, components as whole numbers."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % MOVE_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    rows = vectors.where("vec_id is not null and label is not null and embedding is not null").where(~bad)
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        moved.alias("label"),
        F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long")).alias("vector"),
    )


# ------------------------------------------------------------------ trees


def str_order(vectors: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Row order of sort-tile-recursive packing: leaves are runs of ``leaf`` rows.

    Only as many coordinates are cut as there are tiles to halve, the widest first.
    """
    n, width = vectors.shape
    if n <= leaf or not width:
        return np.arange(n)
    spans = vectors.max(axis=0).astype(float) - vectors.min(axis=0).astype(float)
    cuts = min(width, int(np.ceil(np.log2(-(-n // leaf)))))
    axes = np.argsort(-spans, kind="stable")[:cuts]

    def tile(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        if len(rows) <= leaf:
            return [rows]
        rows = rows[np.argsort(vectors[rows, axes[depth]], kind="stable")]
        if depth == len(axes) - 1:
            return [rows]
        tiles = -(-len(rows) // leaf)
        slabs = int(np.ceil(tiles ** (1 / (len(axes) - depth))))
        # Slabs hold whole leaves, so that the last leaf alone may be short.
        size = -(-tiles // slabs) * leaf
        return [t for i in range(0, len(rows), size) for t in tile(rows[i : i + size], depth + 1)]

    return np.concatenate(tile(np.arange(n), 0))


def pages(rows: DataFrame, page: int = PAGE) -> DataFrame:
    """Packed pages (label, first, width, ids, vectors); a row is named by ``first`` + position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = TaskContext.get().partitionId() << 40
        label, ids, vectors = None, [], []

        def closed() -> pa.RecordBatch:
            width = max(len(v) for v in vectors)
            matrix = np.zeros((len(vectors), width), np.int64)
            for row, v in zip(matrix, vectors, strict=True):
                row[: len(v)] = v
            order = str_order(matrix)
            narrow = np.abs(matrix.astype(float)).max(initial=0) < 1 << 31
            blob = matrix[order].astype("<i4" if narrow else "<i8").tobytes()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([label], pa.int64()), pa.array([named], pa.int64()), pa.array([width], pa.int32()),
                    pa.array([np.array(ids, np.int64)[order]], pa.list_(pa.int64())), pa.array([blob], pa.binary()),
                ],
                ["label", "first", "width", "ids", "vectors"],
            )

        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch.column("vector").value_lengths().to_numpy(zero_copy_only=False))
            begin = 0
            for own, vec_id, end in zip(
                batch.column("label").to_pylist(), batch.column("vec_id").to_pylist(), ends.tolist(), strict=True
            ):
                if ids and (own != label or len(ids) == page):
                    yield closed()
                    named += len(ids)
                    ids, vectors = [], []
                label = own
                ids.append(vec_id)
                vectors.append(flat[begin:end].copy())
                begin = end
        if ids:
            yield closed()

    # The last key splits rows that are equal in all others.
    keys = ["label", F.get("vector", F.lit(0)), "vec_id", F.monotonically_increasing_id()]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys[:3])
    return ordered.mapInArrow(run, "label long, first long, width int, ids array<long>, vectors binary")


def matrix_of(blob: bytes, rows: int, width: int) -> np.ndarray:
    kind = "<i4" if len(blob) == 4 * rows * width else "<i8"
    return np.frombuffer(blob, kind).reshape(rows, width).astype(np.int64)


class Tree:
    """Boxes of a page by level, leaves first; ``lows[k][j]`` to ``highs[k][j]``."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        self.vectors, self.leaf, self.fanout = vectors, leaf, fanout
        starts = np.arange(0, len(vectors), leaf)
        self.lows = [np.minimum.reduceat(vectors, starts, axis=0)]
        self.highs = [np.maximum.reduceat(vectors, starts, axis=0)]
        while len(self.lows[-1]) > 1:
            starts = np.arange(0, len(self.lows[-1]), fanout)
            self.lows.append(np.minimum.reduceat(self.lows[-1], starts, axis=0))
            self.highs.append(np.maximum.reduceat(self.highs[-1], starts, axis=0))


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with the points of each box."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T


class Best:
    """The k best (score, id) of each slot: higher scores first, ties by smaller id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score = np.zeros(0)
        self.kth = np.full(slots, -np.inf, object)

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.isin(self.slot, slot)
        slot = np.concatenate([self.slot[touched], slot])
        score = np.concatenate([self.score[touched], score])
        ids = np.concatenate([self.id[touched], ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        begins = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.repeat(begins, np.diff(np.r_[begins, len(slot)]))
        kept = rank < self.k
        full = rank == self.k - 1
        self.kth[slot[full]] = score[full]
        self.slot = np.concatenate([self.slot[~touched], slot[kept]])
        self.score = np.concatenate([self.score[~touched], score[kept]])
        self.id = np.concatenate([self.id[~touched], ids[kept]])


def search(
    tree: Tree, names: np.ndarray, ids: np.ndarray, anchors: np.ndarray, own: np.ndarray,
    slots: np.ndarray, lows: np.ndarray, highs: np.ndarray, best: Best,
) -> int:
    """Offer the rows of a page to ``best``, whose results stay those of all rows seen.

    Row i of ``slots``, ``lows`` and ``highs`` has the score windows of anchor i, which is
    itself the row named ``own[i]``. Returns the number of leaves that were scored.
    """

    def wanted(rows: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether the box of each pair may hold a result of some window of its anchor."""
        found = np.zeros(least.shape, bool)
        shape = (-1,) + (1,) * (least.ndim - 1)
        for w in range(slots.shape[1]):
            floor = np.maximum(lows[rows, w], best.kth[slots[rows, w]].astype(lows.dtype))
            found |= (most >= floor.reshape(shape)) & (least <= highs[rows, w].reshape(shape))
        return found

    everyone = np.arange(len(anchors))
    alive, bounds = np.ones((len(anchors), 1), bool), np.zeros((len(anchors), 1))
    for level in range(len(tree.lows) - 1, -1, -1):
        low, high = tree.lows[level], tree.highs[level]
        if level < len(tree.lows) - 1:
            alive = np.repeat(alive, tree.fanout, axis=1)[:, : len(low)]
        least, bounds = intervals(anchors, low, high)
        alive &= wanted(everyone, least, bounds)
        if not alive.any():
            return 0
    # The queue of each anchor: its leaves, best bound first.
    queue = np.argsort(np.where(alive, -bounds, np.inf), axis=1, kind="stable")
    waiting = alive.sum(axis=1)
    at, step, scored = 0, 1, 0
    while at < waiting.max():
        taken = queue[:, at : at + step]
        rows, columns = np.nonzero(at + np.arange(taken.shape[1]) < waiting[:, None])
        leaves = taken[rows, columns]
        still = wanted(rows, least[rows, leaves], bounds[rows, leaves])
        rows, leaves = rows[still], leaves[still]
        scored += len(rows)
        order = np.argsort(leaves, kind="stable")
        rows, leaves = rows[order], leaves[order]
        edges = np.flatnonzero(np.diff(leaves, prepend=-1, append=-1)) if len(rows) else np.zeros(0, int)
        offered: list[tuple] = []
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            first = int(leaves[begin]) * tree.leaf
            who = rows[begin:end]
            scores = anchors[who] @ tree.vectors[first : first + tree.leaf].T
            other = names[None, first : first + tree.leaf] != own[who][:, None]
            for w in range(slots.shape[1]):
                floor = np.maximum(lows[who, w], best.kth[slots[who, w]].astype(lows.dtype))
                i, j = np.nonzero(other & (scores >= floor[:, None]) & (scores <= highs[who, w][:, None]))
                if len(i):
                    offered.append((slots[who[i], w], scores[i, j], ids[first + j]))
        if offered:
            best.offer(*(np.concatenate(part) for part in zip(*offered, strict=True)))
        at, step = at + step, min(2 * step, BOXES)
    return scored


# ------------------------------------------------------------------ searches on Spark


def _widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _exact_type(anchors: np.ndarray, vectors: np.ndarray) -> type:
    """Doubles if all sums of products stay exact, else Python's integers."""
    size = np.abs(anchors.astype(float)).max(initial=0) * np.abs(vectors.astype(float)).max(initial=0)
    return np.float64 if size * vectors.shape[1] < 1 << 53 else object


def _searched(spark: SparkSession, packed: DataFrame, block: list, k: int, same: bool) -> DataFrame:
    """(anchor, window, id, score): the k best of each task, anchor and window.

    ``block`` has rows (anchor, label, vector, scores); without scores the one window, 0,
    is unbounded, else each score makes a window that is named by it.
    """
    shared = spark.sparkContext.broadcast([tuple(row) for row in block])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        width = max((len(r[2]) for r in rows), default=0)
        names = np.array([r[0] for r in rows], np.int64)
        labels = np.array([r[1] for r in rows], np.int64)
        matrix = np.zeros((len(rows), width), np.int64)
        for line, r in zip(matrix, rows, strict=True):
            line[: len(r[2])] = r[2]
        windows = [[None] if r[3] is None else r[3] for r in rows]
        most = max((len(w) for w in windows), default=0)
        slots = np.arange(len(rows) * most).reshape(len(rows), most)
        # Unused windows are empty: their low end lies above their high end.
        lows, highs = np.full(slots.shape, np.inf, object), np.full(slots.shape, -np.inf, object)
        for i, scores in enumerate(windows):
            for w, score in enumerate(scores):
                lows[i, w] = -np.inf if score is None else -(-LOW_PERCENT * score // 100)
                highs[i, w] = np.inf if score is None else HIGH_PERCENT * score // 100
        best = Best(slots.size, k)
        for batch in batches:
            for p in range(batch.num_rows):
                label, first, own_width = (batch.column(c)[p].as_py() for c in ("label", "first", "width"))
                found = batch.column("ids")[p].values.to_numpy()
                vectors = matrix_of(batch.column("vectors")[p].as_py(), len(found), own_width)
                wide = max(width, own_width)
                vectors = _widened(vectors, wide)
                chosen = np.flatnonzero((labels == label) == same)
                kind = _exact_type(matrix, vectors)
                tree = Tree(vectors.astype(kind))
                place = first + np.arange(len(found))
                for start in range(0, len(chosen), SIDE_BY_SIDE):
                    part = chosen[start : start + SIDE_BY_SIDE]
                    anchors = _widened(matrix[part], wide).astype(kind)
                    search(
                        tree, place, found, anchors, names[part], slots[part],
                        lows[part].astype(kind), highs[part].astype(kind), best,
                    )
        at = best.slot // max(most, 1), best.slot % max(most, 1)
        ceiling = (1 << 63) - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names[at[0]], pa.int64()),
                pa.array([windows[i][w] or 0 for i, w in zip(*at, strict=True)], pa.int64()),
                pa.array(best.id, pa.int64()),
                pa.array([max(-ceiling, min(ceiling, int(s))) for s in best.score], pa.int64()),
            ],
            ["anchor", "window", "id", "score"],
        )

    return packed.mapInArrow(run, "anchor long, window long, id long, score long")


def _merged(spark: SparkSession, packed: DataFrame, anchors: DataFrame, blocks: int, k: int, same: bool) -> DataFrame:
    """The k best of each anchor and window over all pages: one search for each block."""
    found = None
    for number in range(blocks):
        block = anchors.where(F.col("block") == number).select("anchor", "label", "vector", "scores").collect()
        part = stored(_searched(spark, packed, block, k, same))
        found = part if found is None else found.unionByName(part)
    return top_k(found, ["anchor", "window"], [F.desc("score"), F.asc("id")], k)


def _anchors(packed: DataFrame, every: int, block: int) -> tuple[DataFrame, int]:
    """(anchor, anchor_id, label, vector, block) of the rows that search, and the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in range(batch.num_rows):
                label, first, width = (batch.column(c)[p].as_py() for c in ("label", "first", "width"))
                ids = batch.column("ids")[p].values.to_numpy()
                vectors = matrix_of(batch.column("vectors")[p].as_py(), len(ids), width)
                at = np.flatnonzero(ids % every == 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first + at), pa.array(ids[at]), pa.array(np.full(len(at), label)),
                        pa.array(list(vectors[at]), pa.list_(pa.int64())),
                    ],
                    ["anchor", "anchor_id", "label", "vector"],
                )

    found = stored(packed.mapInArrow(run, "anchor long, anchor_id long, label long, vector array<long>"))
    blocks = -(-found.count() // block)
    return found.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(max(blocks, 1)))), blocks


def hard_negatives(
    vectors: DataFrame, *, anchor_every: int = ANCHOR_EVERY, page: int = PAGE, block: int = ANCHORS
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark = vectors.sparkSession
    code_on_workers(spark)
    packed = stored(pages(participants(vectors), page))
    anchors, blocks = _anchors(packed, anchor_every, block)
    if not blocks:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    alone = anchors.withColumn("scores", F.lit(None).cast("array<long>"))
    positives = stored(
        _merged(spark, packed, alone, blocks, POSITIVES, same=True).select(
            "anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        )
    )
    # At most POSITIVES scores for an anchor.
    scores = positives.groupBy("anchor").agg(F.collect_set("positive_score").alias("scores"))
    with_windows = stored(anchors.join(scores, "anchor"))
    negatives = _merged(spark, packed, with_windows, blocks, NEGATIVES, same=False).select(
        "anchor", F.col("window").alias("positive_score"), F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    rank = F.row_number().over(
        Window.partitionBy("anchor", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    )
    ranked = negatives.withColumn("rank", rank)
    return (
        positives.join(ranked, ["anchor", "positive_score"])
        .join(anchors.select("anchor", "anchor_id"), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP12_SQL = f"""
WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % {MOVE_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows_ a, rows_ b WHERE a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND {LOW_PERCENT} * positive_score <= 100 * score AND 100 * score <= {HIGH_PERCENT} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
