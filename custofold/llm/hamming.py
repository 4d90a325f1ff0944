"""Nearest neighbours by inner product with multi-index hashing.

Vectors are turned by rotations and cut to signs. A rotation is learned (iterative quantisation) on a bounded
sample: the directions of the vectors are turned until they lie near the corners of a cube; several rotations,
from different beginnings, give a code of ``bits`` bits. A code is split into substrings of eight bits, each
with its own index: a list of the codes for each of its 256 values. Two codes within distance r agree in some
substring up to r // (number of substrings) bits (pigeonhole), so probing those values in every index finds
every code within r. The true distances of what was found are checked, and the rest is ranked by the exact
inner product in double precision.

The radius is fitted on the sample: it holds ``recall`` of the pairs of a sample vector and one of its ``k``
nearest others there. In all data the nearest vectors are nearer than in a sample, so it errs on the wide side.
A query that finds fewer than ``k`` within the radius of a block takes the next wider radius until it has ``k``
(or all).

All rows are indexed. Blocks of vectors (by hash of the id) meet blocks of queries in one task each; a task
holds one block of either kind, and returns at most ``k`` rows for each of its queries. Where the probed lists
would hold more entries than the block has codes, the codes are gone through once instead, which finds the same.

Inner products of vectors of different length: every vector is scaled by the greatest length and given one
more component, so that inner product order becomes the order of angles. The greatest length is found over all
rows. Defined cases: vectors that are null, zero, or hold a null or non-finite component take no part, neither
do rows without id, nor vectors whose dimension is not the most frequent one (the smaller on a tie). Rows that
share an id are neighbours of others each by itself, never of each other. Ties go to the smaller id. An empty
table gives no rows. Other columns are left behind.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS, SAMPLE, RECALL = 256, 4096, 0.98
BLOCK, QUERY_BLOCK = 16_384, 4_096
POPULATION = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v`` (doubles) of the vectors that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (size["d"] if size else 0))


@dataclass
class Coder:
    """Learned rotations, the greatest length, and the fitted radius."""

    longest: float
    rotations: list[np.ndarray]
    radius: int = 0

    def directions(self, x: np.ndarray) -> np.ndarray:
        x = x / self.longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
        return np.hstack([x, rest[:, None]])

    def query_directions(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))])

    def codes(self, directions: np.ndarray) -> np.ndarray:
        """Packed bits, a byte for each substring."""
        return np.packbits(np.hstack([directions @ r > 0 for r in self.rotations]), axis=1)


def learned_rotation(x: np.ndarray, size: int, seed: int, rounds: int = 20) -> np.ndarray:
    """A rotation of ``size`` directions whose signs lie near the rotated vectors."""
    rng = np.random.default_rng(seed)
    start = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0][:, :size]
    turn = start
    for _ in range(rounds):
        corners = np.where(x @ turn > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(x.T @ corners, full_matrices=False)
        turn = u @ v
    return turn


def fit(rows: DataFrame, bits: int = BITS, sample: int = SAMPLE, k: int = 20, recall: float = RECALL) -> Coder | None:
    """A coder fitted on the ``sample`` rows that come first by a hash of their id."""
    longest = rows.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()[0]
    if longest is None:
        return None
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).toArrow()
    x = np.array(picked.column("v").to_pylist())
    coder = Coder(float(longest) * (1 + 1e-12), [])
    spread = coder.directions(x)
    size = spread.shape[1]
    for seed in range(-(-bits // size)):
        coder.rotations.append(learned_rotation(spread, min(size, bits - seed * size), seed))
    own, asked = coder.codes(spread), coder.codes(coder.query_directions(x))
    found = []
    for i in range(0, len(x), max(1, len(x) // 512)):
        near = x @ x[i]
        near[i] = -np.inf
        best = np.argsort(-near, kind="stable")[: min(k, len(x) - 1)]
        found.append(POPULATION[own[best] ^ asked[i]].sum(axis=1, dtype=np.int64))
    distances = np.concatenate(found)
    coder.radius = int(np.quantile(distances, recall)) + 1 if len(distances) else bits
    return coder


class MultiIndex:
    """The codes of a block, with a list of codes for every value of every substring."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.substrings = codes.shape[1]
        self.lists = np.argsort(codes, axis=0, kind="stable")
        ordered = np.take_along_axis(codes, self.lists, axis=0)
        self.begins = np.stack([np.searchsorted(ordered[:, j], np.arange(257)) for j in range(self.substrings)])
        self.wide = np.ascontiguousarray(np.pad(codes, ((0, 0), (0, -codes.shape[1] % 8)))).view(np.uint64)

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All rows whose code lies within the radius, and their distances."""
        flips = radius // self.substrings
        probes = [np.flatnonzero(POPULATION[np.arange(256) ^ int(c)] <= flips) for c in code]
        entries = sum(int((self.begins[j, p + 1] - self.begins[j, p]).sum()) for j, p in enumerate(probes))
        if entries < len(self.codes):
            parts = [
                self.lists[self.begins[j, value] : self.begins[j, value + 1], j]
                for j, p in enumerate(probes)
                for value in p.tolist()
            ]
            rows = np.unique(np.concatenate(parts))
        else:
            rows = np.arange(len(self.codes))
        asked = np.pad(code, (0, -len(code) % 8)).view(np.uint64)
        distance = np.bitwise_count(self.wide[rows] ^ asked).sum(axis=1, dtype=np.int64)
        near = distance <= radius
        return rows[near], distance[near]


def search_block(vec_ids, vectors, query_ids, queries, coder: Coder, k: int) -> pd.DataFrame:
    """The ``k`` best rows of a block for each query."""
    index = MultiIndex(coder.codes(coder.directions(vectors)))
    asked = coder.codes(coder.query_directions(queries))
    bits = 8 * index.substrings
    out = []
    for i, query_id in enumerate(query_ids.tolist()):
        radius = coder.radius
        while True:
            rows, _ = index.within(asked[i], radius)
            rows = rows[vec_ids[rows] != query_id]
            if len(rows) >= k or radius >= bits:
                break
            radius = min(bits, radius + index.substrings)
        score = vectors[rows] @ queries[i]
        best = np.lexsort([vec_ids[rows], -score])[:k]
        out.append(pd.DataFrame({"query_id": query_id, "vec_id": vec_ids[rows[best]], "score": score[best]}))
    columns = ["query_id", "vec_id", "score"]
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in columns})


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, coder: Coder | None = None, **options) -> DataFrame:
    """For every query row its ``k`` nearest: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    ``is_query`` is a condition on ``vec_id``. Query rows that share an id are asked once, by the smallest vector.
    """
    rows = usable(vectors)
    spark = vectors.sparkSession
    coder = coder or fit(rows, k=k, **options)
    if coder is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    n, q = rows.count(), asked.count()
    blocks, query_blocks = -(-n // BLOCK), max(1, -(-q // QUERY_BLOCK))
    held = rows.select(
        F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"),
        "vec_id",
        "v",
    )
    sought = asked.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(query_blocks)).cast("int").alias("query_block"),
        "vec_id",
        "v",
    )
    sent = spark.sparkContext.broadcast(coder)

    def search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        index = index.sort_values("vec_id", kind="stable")
        return search_block(
            index["vec_id"].to_numpy(), np.stack(index["v"]), queries["vec_id"].to_numpy(), np.stack(queries["v"]), sent.value, k
        )

    by = ["block", "query_block"]
    found = (
        held.groupBy(*by).cogroup(sought.groupBy(*by)).applyInPandas(search, "query_id long, vec_id long, score double")
    )
    # Each block has sent at most k rows for a query; tasks cut to k again before anything is shuffled.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
