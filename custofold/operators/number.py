"""Dense row numbers over a whole table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from custofold.sources.store import Store

# Spark numbers the rows of a partition in the low 33 bits of ``monotonically_increasing_id``.
ROW_BITS = 33


def row_index(
    store: Store, df: DataFrame, order: Sequence[str | Column], table: str, out: str = "ROW_INDEX"
) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... over all rows in this order, as a row number without partitions would be less one.

    One range exchange sorts the rows; each task numbers its own, and the table is stored with these numbers.
    What lies before a partition is the sum of the counts of those before it: one number a partition
    comes to the driver and goes back as a broadcast. No task sees more than its partition. Rows that are equal
    in ``order`` are numbered in any order, so give columns that tell them apart where that matters; they also
    keep equal rows from meeting in one partition.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    own = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    stored = store.materialize(dealt.withColumns({"__part": F.spark_partition_id(), "__row": own}), table)
    counts = sorted((r["__part"], r["count"]) for r in stored.groupBy("__part").count().collect())
    before = accumulate((n for _, n in counts), initial=0)
    offsets = [(part, start) for (part, _), start in zip(counts, before, strict=False)]
    starts = store.spark.createDataFrame(offsets, "__part int, __start long")
    numbered = stored.join(F.broadcast(starts), "__part")
    return numbered.select(*df.columns, (F.col("__start") + F.col("__row")).alias(out))
