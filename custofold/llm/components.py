"""Connected components of links by alternating large-star and small-star steps.

Every step is a join and an aggregation that combines before it shuffles, so a node with very many links is
no group that has to fit anywhere; the joins are ones that adaptive execution can split. Each task first
replaces its own links by a forest with the same components. Forests of many tasks repeat the same nodes, so they are dealt out
by node and made forests again: then a node has one link, and the joins grow with the nodes, not with the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custofold.llm.common import stored

LINKS = "a long, b long"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node reachable) that connect what the given links connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            break
    kept = label != np.arange(len(nodes))
    return nodes[kept], nodes[label[kept]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of growing parts of a task's links: memory is bounded by the nodes of about a million links."""
    a = b = np.empty(0, np.int64)
    fresh = 0
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy(zero_copy_only=False)])
        b = np.concatenate([b, batch.column(1).to_numpy(zero_copy_only=False)])
        fresh += batch.num_rows
        if fresh > 200_000:
            a, b = forest(a, b)
            fresh = 0
            if len(a) > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a = b = np.empty(0, np.int64)
    if len(a):
        a, b = forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of all nodes that are not the smallest themselves.

    ``links`` holds two long columns; links of a node with itself and links with a null are left out.
    """
    a, b = (F.col(c).cast("long") for c in links.columns[:2])
    pairs = links.select(a.alias("a"), b.alias("b")).where("a <> b")
    forests = pairs.mapInArrow(_local, LINKS).repartition("a").mapInArrow(_local, LINKS)
    edges = stored(forests.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        edges = stored(
            small.where("b <> low")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(low.select("a", F.col("low").alias("b")))
            .distinct()
        )
        # Stars are the only fixed point: the number of links and the sums of both ends stay.
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")
        ).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now
