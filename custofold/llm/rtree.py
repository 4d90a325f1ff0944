"""Hard negatives by exact search in R-trees packed by sort-tile-recursion.

Every vector has whole numbers as components and a label. An anchor's positives are the nearest other rows of its own
label by inner product; around each positive's score lies a window, and the negatives are the nearest rows of
other labels whose score falls into it.

Packing: rows are cut into slabs along the coordinate of largest variance, each slab into tiles along the next one
(one range exchange, whose partitions are the tiles), and each tile is cut on along the coordinate of largest spread
down to leaves of ``LEAF`` rows; ``FAN`` leaves make an inner node. A box of lowest and highest components bounds
each node, and so, coordinate by coordinate, the inner product of an anchor with any row inside from both sides.

Search: anchors travel in blocks to the tiles. A queue of nodes, the one with the best possible score inside the
window first, drops those that lie outside the window or strictly below the kth best score so far; leaves are taken
from it in handfuls that grow, so that one multiplication serves many rows. The best of all tiles are merged by rank.

Every answer is exact. Boxes of many coordinates are wide: where rows are spread evenly over all directions few boxes can be
dropped, and the work is anchors times rows, which no exact method avoids there.

Copies: of rows with one vector and one label only so many as an answer can hold (the smallest ids) enter the
trees, so a vector that many rows share takes no more room than any other and loses no answer.

Defined cases: rows with a null id, label or vector, a null or non-finite component, or one beyond
``LIMIT`` in size take no part. Vectors of different length: the missing components count as 0. Whole copies of a
row count once; other rows with the anchor's id are no partners of it. Ties: the smaller id first. Without
rows, positives or rows in a window there is no answer row. Other columns are left behind, so none can clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custofold.llm.common import stored, trimmed

TILE_ROWS = 8192
LEAF = 32
FAN = 16
BLOCK_ROWS = 128
HANDFUL = 64
LIMIT = 1 << 26

TILE = "tile long, kind int, ids binary, labels binary, rows binary, scores binary"
TILE_NAMES = ["tile", "kind", "ids", "labels", "rows", "scores"]


def points(df: DataFrame, vec_id: str, label: str | Column, components: Column) -> DataFrame:
    """``vec_id``, ``label``, ``v`` (whole numbers) of the rows that take part, whole copies once.

    ``components`` is an array of doubles or whole numbers.
    """
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) <= LIMIT))
    rows = df.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        (F.col(label) if isinstance(label, str) else label).cast("int").alias("label"),
        components.alias("v"),
    )
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & good)
    return rows.select("vec_id", "label", F.col("v").cast("array<long>").alias("v")).distinct()


def str_order(rows: np.ndarray) -> np.ndarray:
    """An order of the rows in which every ``LEAF`` in a row are a leaf: slabs along the widest coordinate, again and again."""
    out: list[np.ndarray] = []

    def cut(own: np.ndarray, dims: int) -> None:
        leaves = -(-len(own) // LEAF)
        if leaves <= 1:
            out.append(own)
            return
        slabs = max(2, int(np.ceil(leaves ** (1 / dims))))
        widest = int(np.argmax(np.ptp(rows[own], axis=0))) if rows.shape[1] else 0
        own = own[np.argsort(rows[own, widest], kind="stable")] if rows.shape[1] else own
        size = -(-leaves // slabs) * LEAF
        for begin in range(0, len(own), size):
            cut(own[begin : begin + size], max(1, dims - 1))

    cut(np.arange(len(rows)), max(1, min(rows.shape[1], int(np.log2(max(2, len(rows) // LEAF))))))
    return np.concatenate(out) if out else np.empty(0, np.int64)


class Tree:
    """One tile: rows in the order of leaves, and the boxes of leaves and inner nodes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.low, self.high = [], []
        low = high = rows
        for size in (LEAF, FAN):
            starts = np.arange(0, len(low), size)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.low.append(low)
            self.high.append(high)

    def bounds(self, anchors: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and highest inner product of each anchor with anything inside each node."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        low, high = self.low[level].T, self.high[level].T
        return up @ low + down @ high, up @ high + down @ low


class Best:
    """The k best (score, id) so far: larger scores, then smaller ids, first."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.empty(0)
        self.ids = np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(self.ids) == self.k:
            worth = scores >= self.scores[-1]
            scores, ids = scores[worth], ids[worth]
        if not len(ids):
            return
        scores, ids = np.concatenate([self.scores.astype(scores.dtype), scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[first], ids[first]

    def beats(self, bound: float) -> bool:
        """Whether nothing of at most this score can enter any more."""
        return len(self.ids) == self.k and bound < self.scores[-1]


def search(tree: Tree, anchor: np.ndarray, allowed: np.ndarray, low: float, high: float, k: int,
           inner: tuple[np.ndarray, np.ndarray], leaves: tuple[np.ndarray, np.ndarray], seen: dict) -> Best:
    """The k best allowed rows of a tile with a score from ``low`` to ``high``; best nodes first.

    ``inner`` and ``leaves`` are the anchor's bounds with the nodes of both levels; ``seen`` keeps its scores with leaves.
    """
    best = Best(k)
    queue = [
        (-min(top, high), True, node)
        for node, (bottom, top) in enumerate(zip(inner[0].tolist(), inner[1].tolist(), strict=True))
        if top >= low and bottom <= high
    ]
    heapq.heapify(queue)
    handful = 1
    n_leaves = len(leaves[0])
    while queue:
        take: list[int] = []
        while queue and len(take) < handful:
            bound, is_inner, node = heapq.heappop(queue)
            if best.beats(-bound):
                queue = []
            elif is_inner:
                for leaf in range(node * FAN, min(n_leaves, node * FAN + FAN)):
                    if leaves[1][leaf] >= low and leaves[0][leaf] <= high:
                        heapq.heappush(queue, (-min(leaves[1][leaf], high), False, leaf))
            else:
                take.append(node)
        handful = min(HANDFUL, 2 * handful)
        missing = [n for n in take if n not in seen]
        if missing:
            at = np.concatenate([np.arange(n * LEAF, min(len(tree.ids), n * LEAF + LEAF)) for n in missing])
            scores = tree.rows[at] @ anchor
            begin = 0
            for n in missing:
                end = begin + min(LEAF, len(tree.ids) - n * LEAF)
                seen[n] = (at[begin:end], scores[begin:end])
                begin = end
        if take:
            at = np.concatenate([seen[n][0] for n in take])
            scores = np.concatenate([seen[n][1] for n in take])
            good = allowed[at] & (scores >= low) & (scores <= high)
            best.add(scores[good], tree.ids[at[good]])
    return best


def matrix(raw: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4").reshape(rows, -1)


def same_kind(*matrices: np.ndarray) -> list[np.ndarray]:
    """Doubles where every sum of products is exact in them, else 64-bit integers; shorter rows are filled up with 0."""
    width = max(m.shape[1] for m in matrices)
    size = width
    for m in matrices:
        size *= int(np.abs(m).max(initial=0))
    kind = np.float64 if size < 1 << 53 else np.int64
    return [np.pad(m.astype(kind), ((0, 0), (0, width - m.shape[1]))) for m in matrices]


def pack_tiles(rows: DataFrame, n_tiles: int, copies: int) -> DataFrame:
    """The trees' rows: one packed row a tile, in the order of its leaves; stored.

    A tile's key is the number of its partition; a partition that the range exchange has made too large gives several tiles
    with one key.
    """
    same = Window.partitionBy("v", "label").orderBy("vec_id")
    kept = rows.withColumn("__rank", F.row_number().over(same)).where(F.col("__rank") <= copies).drop("__rank")
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    own = [F.coalesce(F.get("v", F.lit(i)), F.lit(0)) for i in range(dims)]
    spread = rows.agg(*[F.var_pop(c).alias(str(i)) for i, c in enumerate(own)]).first() if dims else []
    first, second, *_ = [*np.argsort([-(s or 0) for s in spread], kind="stable").tolist(), 0, 0]
    slabs = max(1, int(np.ceil(np.sqrt(n_tiles))))
    order = ["vec_id"]
    if dims and slabs > 1:
        fractions = [i / slabs for i in range(1, slabs)]
        cuts = rows.agg(F.percentile_approx(own[first], fractions).alias("c")).first()["c"]
        slab = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < own[first]))
        order = [slab, own[second], "vec_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, count = TaskContext.get().partitionId(), [], 0

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            own = packed_rows(table["v"].combine_chunks())
            at = str_order(own)
            ids, labels = np.asarray(table["vec_id"])[at], np.asarray(table["label"])[at]
            payload = [ids.astype("<i8").tobytes(), labels.astype("<i4").tobytes(), own[at].tobytes(), None]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            columns = [pa.array([x], t) for x, t in zip([tile, 0, *payload], kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=TILE_NAMES)

        for batch in batches:
            for begin in range(0, batch.num_rows, TILE_ROWS):
                piece = batch.slice(begin, TILE_ROWS)
                if count + piece.num_rows > 2 * TILE_ROWS:
                    yield packed()
                    held, count = [], 0
                held.append(piece)
                count += piece.num_rows
        if held:
            yield packed()

    return stored(kept.repartitionByRange(n_tiles, *order).sortWithinPartitions(*order).mapInArrow(trimmed(run), TILE))


def packed_rows(column: pa.ListArray) -> np.ndarray:
    """The vectors of a list column as one matrix of 32-bit integers, shorter ones filled up with 0."""
    offsets = np.asarray(column.offsets).astype(np.int64)
    sizes = np.diff(offsets)
    flat = np.asarray(column.values)[offsets[0] : offsets[-1]]
    out = np.zeros((len(column), int(sizes.max(initial=0))), "<i4")
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def pack_blocks(anchors: DataFrame) -> DataFrame:
    """Anchors, ``BLOCK_ROWS`` to a packed row: ids, labels, vectors, and the scores whose windows are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(begin, BLOCK_ROWS)
                scores = packed_scores(piece.column("scores"))
                payload = [
                    np.asarray(piece.column("vec_id")).astype("<i8").tobytes(),
                    np.asarray(piece.column("label")).astype("<i4").tobytes(),
                    packed_rows(piece.column("v")).tobytes(),
                    scores,
                ]
                columns = [pa.array([0], pa.int64()), pa.array([1], pa.int32()), *(pa.array([p], pa.binary()) for p in payload)]
                yield pa.RecordBatch.from_arrays(columns, names=TILE_NAMES)

    return anchors.select("vec_id", "label", "v", "scores").mapInArrow(run, TILE)


def packed_scores(column: pa.ListArray) -> bytes:
    """How many scores each anchor has, then the scores."""
    lists = [v or [] for v in column.to_pylist()]
    return np.array([len(x) for x in lists] + [s for x in lists for s in x], "<i8").tobytes()


def score_lists(raw: bytes, rows: int) -> list[list[int]]:
    numbers = np.frombuffer(raw, "<i8").tolist()
    out, at = [], rows
    for size in numbers[:rows]:
        out.append(numbers[at : at + size])
        at += size
    return out


def search_tiles(
    tiles: DataFrame, blocks: DataFrame, n_tiles: int, same_label: bool, k: int, window: tuple[int, int] | None
) -> DataFrame:
    """``anchor_id``, ``asked`` (the positive's score, 0 for none), ``vec_id``, ``score``: the k best of every tile.

    Every block meets every tile: a query set against all rows. A tile's task holds its tree and streams the blocks.
    """
    names = ["anchor_id", "asked", "vec_id", "score"]

    def found(trees: list[Tree], row: dict) -> Iterator[tuple]:
        ids = np.frombuffer(row["ids"], "<i8")
        labels = np.frombuffer(row["labels"], "<i4")
        vectors = matrix(row["rows"], len(ids))
        asked = score_lists(row["scores"], len(ids))
        for tree in trees:
            rows, anchors = same_kind(tree.rows, vectors)
            own = Tree(tree.ids, tree.labels, rows)
            leaves, inner = own.bounds(anchors, 0), own.bounds(anchors, 1)
            for i, anchor in enumerate(anchors):
                allowed = (own.labels == labels[i]) == same_label
                allowed &= own.ids != ids[i]
                seen: dict = {}
                for score in asked[i] if window else [0]:
                    low, high = (-(-window[0] * score // 100), window[1] * score // 100) if window else (-np.inf, np.inf)
                    if low > high:
                        continue
                    best = search(
                        own, anchor, allowed, low, high, k, tuple(b[i] for b in inner), tuple(b[i] for b in leaves), seen
                    )
                    if len(best.ids):
                        yield np.full(len(best.ids), ids[i]), np.full(len(best.ids), score), best.ids, best.scores.astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, trees = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in TILE_NAMES}
                if row["tile"] != tile:
                    tile, trees = row["tile"], []
                if row["kind"] == 0:
                    ids = np.frombuffer(row["ids"], "<i8")
                    trees.append(Tree(ids, np.frombuffer(row["labels"], "<i4"), matrix(row["rows"], len(ids))))
                elif out := list(found(trees, row)):
                    columns = [np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    keys = tiles.agg(F.collect_set("tile")).scalar()  # one number a tile
    everywhere = blocks.withColumn("tile", F.explode(keys))
    both = tiles.unionByName(everywhere.select(*TILE_NAMES))
    dealt = both.repartition(n_tiles, "tile").sortWithinPartitions("tile", "kind")
    return dealt.mapInArrow(trimmed(run), "anchor_id long, asked long, vec_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of all tiles, with their rank; each task cuts its own rows first."""
    order = Window.partitionBy("anchor_id", "asked").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """For each anchor of ``points`` and each of its positives the first negatives whose score is from ``window[0]`` to
    ``window[1]`` hundredths of the positive's.

    ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.
    """
    rows = stored(rows)
    n_tiles = max(1, -(-rows.count() // tile_rows))
    tiles = pack_tiles(rows, n_tiles, max(n_positives + 1, n_negatives))
    anchors = rows.where(is_anchor)
    blocks = pack_blocks(anchors.withColumn("scores", F.array().cast("array<long>")))
    near = ranked(search_tiles(tiles, blocks, n_tiles, True, n_positives, None), n_positives)
    positives = stored(near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    asked = positives.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("scores"))  # at most n_positives
    told = anchors.join(asked, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "v", "scores")
    far = ranked(search_tiles(tiles, pack_blocks(told), n_tiles, False, n_negatives, window), n_negatives)
    answers = far.select(
        "anchor_id", F.col("asked").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return positives.join(answers, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
