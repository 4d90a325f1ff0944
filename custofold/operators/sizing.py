"""Size checks behind every broadcast and every collected group.

Nothing here guesses: a frame is measured by one aggregate job before it is marked for broadcast, and
a group is counted before its values are gathered into one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
MAX_ITEMS = 100_000
PART = "DOC_PART"


@dataclass(frozen=True)
class Measured:
    """A frame together with its measured size."""

    frame: DataFrame
    rows: int
    text_bytes: int
    listed: int = 0

    def small(self, max_bytes: int = BROADCAST_BYTES) -> bool:
        # 16 bytes per row stand for the fixed part of a row in the broadcast hash table.
        return self.text_bytes + 16 * self.rows * max(1, len(self.frame.columns)) <= max_bytes

    def hinted(self, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """The frame marked for broadcast when it fits, else unmarked (a shuffle join then serves)."""
        return F.broadcast(self.frame) if self.small(max_bytes) else self.frame


def measure(df: DataFrame, where: str | None = None) -> Measured:
    """Row count and text size of a frame, in one job with a one-row result.

    With the name of a boolean column as ``where``, of the rows where it is true; ``listed`` counts all rows.
    """
    counted = [c for c in df.columns if c != where]
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in counted), F.lit(0))
    taken = F.lit(True) if where is None else F.col(where)
    row = df.agg(
        F.count(F.lit(1)).alias("listed"),
        F.count_if(taken).alias("n"),
        F.sum(F.when(taken, width.cast("long"))).alias("b"),
    ).first()
    frame = df if where is None else df.where(where).select(*counted)
    return Measured(frame, row["n"], row["b"] or 0, row["listed"])


def on_renamed(keys: Sequence[str]) -> Column:
    """Null-safe equality of each key with its ``__`` namesake on the other side of a join."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])


BLOCK_ROWS = 100_000
#: Rows that a task gets where rows are dealt by their key: at most about so many, and at least so many where there are few.
TASK_ROWS, FEW_ROWS = 200_000, 20_000


def dealt(values: DataFrame, by: Sequence[str], rows: int) -> DataFrame:
    """The rows with those that agree in ``by`` in one task; ``rows``: how many there are in all."""
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = max(1, min(parts, -(-rows // FEW_ROWS)), -(-rows // TASK_ROWS))
    return values.repartition(number, *by)


def place(
    values: DataFrame,
    keys: Sequence[str],
    max_items: int = MAX_ITEMS,
    anchor: Column | None = None,
    max_bytes: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Give every value row the number of the document part it belongs to, in column ``DOC_PART``.

    A key with at most ``max_items`` distinct rows keeps all of them in part 0. A larger key is split by a
    hash of the value into as many parts as it needs, so no group that is collected afterwards grows with
    the data, and copies of one value always meet in the same part. No row is dropped for its size; whole copies
    of a row in a key of more than ``max_items`` rows are.

    ``anchor`` marks the row that makes a key a document; it is given to every part of its key, and values of an
    oversize key without such a row are left out here (they belong to no document).
    """
    frames = placed(values, keys, max_items, anchor, max_bytes, block_rows)
    return reduce(DataFrame.unionByName, frames)


def placed(
    values: DataFrame,
    keys: Sequence[str],
    max_items: int = MAX_ITEMS,
    anchor: Column | None = None,
    max_bytes: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
    by: Sequence[str] | None = None,
) -> list[DataFrame]:
    """``place`` as frames that have no key in common, each to be gathered by key and part for itself.

    Rows (copies included) are counted first, from the key columns alone. Keys of at most ``block_rows`` rows (or
    ``max_items``, if that is more) are dealt to tasks once, by the columns ``by`` (by default all of the key): copies are
    removed, rows counted and parts gathered where they lie, so their values are shuffled once whatever ``max_items`` is. Only
    the rows of larger keys are counted by a shuffle of their own, which spreads them over all tasks, and then dealt by part.
    """
    keys, block_rows = list(keys), max(block_rows, max_items)
    rest = [c for c in values.columns if c not in keys]
    renamed = [F.col(k).alias(f"__{k}") for k in keys]
    counted = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    sizes = counted.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    rows, most = sizes["rows"] or 0, sizes["most"] or 0
    if most <= max_items:
        return [dealt(values, by or keys, rows).withColumn(PART, F.lit(0))]

    held = F.lit(True) if anchor is None else anchor

    def with_part(df: DataFrame, parts: Column) -> DataFrame:
        part = F.pmod(F.xxhash64(*rest), parts).cast("int")
        if anchor is not None:
            part = F.explode(F.when(anchor, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(part)))
        return df.withColumn(PART, part).select(*values.columns, PART)

    def in_place(df: DataFrame) -> DataFrame:
        own = Window.partitionBy(*keys)
        known = {"__n": F.count(F.lit(1)).over(own), "__held": F.max(held).over(own)}
        found = dealt(df, by or keys, rows).distinct().withColumns(known).where(F.col("__held") | (F.col("__n") <= max_items))
        return with_part(found, F.ceil(F.col("__n") / max_items).cast("int")).sortWithinPartitions(*keys, PART)

    if most <= block_rows:
        return [in_place(values)]
    crowded = measure(counted.where(F.col("n") > block_rows).select(*renamed))
    large = values.join(crowded.hinted(max_bytes), on_renamed(keys), "left_semi").distinct()
    exact = (
        large.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"), F.max(held).alias("__held"))
        .where(F.col("__held") | (F.col("__n") <= max_items))
        .select(*renamed, F.ceil(F.col("__n") / max_items).cast("int").alias("__parts"))
    )
    exact = F.broadcast(exact) if crowded.small(max_bytes) else exact
    split = with_part(large.join(exact, on_renamed(keys)), F.col("__parts"))
    # After a shuffle join the rows of a large key sit together: spread them by part before grouping.
    split = split if crowded.small(max_bytes) else split.repartition(*keys, PART)
    return [in_place(values.join(crowded.hinted(max_bytes), on_renamed(keys), "left_anti")), split]


def place_bytes(
    values: DataFrame,
    keys: Sequence[str],
    max_bytes: int,
    anchor: Column | None = None,
    block_rows: int = BLOCK_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``place`` by encoded size: ``DOC_PART`` such that the values of a part have at most ``max_bytes`` as JSON text.

    Whole copies are removed. A key that fits has part 0 only. The values of a larger key are put in a row, and the
    bytes before a value decide its part. Values of more than half the limit have parts of their own and come first;
    with the largest of the others ``m``, a new part begins every ``max_bytes - m + 1`` bytes, so no part passes the limit.
    Only a value that is larger than the limit by itself does.

    The row is made of blocks of about ``block_rows`` values by a hash of the value: sums run inside each block, then over the
    totals of a key's blocks, so no key, however large, is one task. ``anchor`` marks the rows that are repeated
    on every part; their size is taken off the limit, and keys without one are left out where they are too large.
    """
    keys = list(keys)
    rest = [c for c in values.columns if c not in keys]
    held = F.lit(False) if anchor is None else anchor
    rows = values.distinct().withColumns({"__size": F.octet_length(F.to_json(F.struct(*rest))), "__anchor": held})
    sizes = rows.groupBy(*keys).agg(
        F.sum("__size").alias("__all"),
        F.count_if(~F.col("__anchor")).alias("__n"),
        F.coalesce(F.max(F.when(F.col("__anchor"), F.col("__size"))), F.lit(0)).alias("__base"),
        F.max("__anchor").alias("__held"),
    )
    room = F.greatest(F.lit(max_bytes) - F.col("__base"), F.lit(1)).alias("__room")
    renamed = [F.col(k).alias(f"__{k}") for k in keys]
    blocks = F.ceil(F.greatest("__n", F.lit(1)) / block_rows).alias("__blocks")
    large = measure(sizes.where(F.col("__all") > max_bytes).select(*renamed, room, blocks, "__held"))
    if large.rows == 0:
        return rows.select(*values.columns, F.lit(0).alias(PART))
    rows = rows.join(large.hinted(broadcast_bytes), on_renamed(keys), "left")
    fitting = rows.where(F.col("__blocks").isNull()).select(*values.columns, F.lit(0).alias(PART))
    rows = rows.where(F.col("__blocks").isNotNull() & (F.col("__held") | F.lit(anchor is None)))
    rows = rows.drop(*[f"__{k}" for k in keys])

    own = rows.where(~F.col("__anchor"))
    big = F.col("__size") > F.col("__room") / 2
    own = own.withColumn("__block", F.pmod(F.xxhash64(*rest), F.col("__blocks")))
    own = own.withColumns({"__big": big.cast("long"), "__small": F.when(big, 0).otherwise(F.col("__size"))})
    inside = Window.partitionBy(*keys, "__block").orderBy(*rest).rowsBetween(Window.unboundedPreceding, -1)
    before = {f"{c}_in": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in ("__big", "__small")}
    totals = own.groupBy(*keys, "__block").agg(*[F.sum(c).alias(c) for c in ("__big", "__small")], F.max("__small").alias("__m"))
    along = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    totals = totals.select(
        *renamed,
        F.col("__block").alias("__block_of"),
        *[F.coalesce(F.sum(c).over(along), F.lit(0)).alias(f"{c}_before") for c in ("__big", "__small")],
        F.sum("__big").over(whole).alias("__bigs"),
        F.max("__m").over(whole).alias("__largest"),
    )
    own = own.withColumns(before).join(totals, on_renamed(keys) & (F.col("__block") == F.col("__block_of")))
    step = F.col("__room") - F.col("__largest") + 1
    start = F.col("__small_before") + F.col("__small_in")
    part = F.when(F.col("__big") == 1, F.col("__big_before") + F.col("__big_in")).otherwise(
        F.col("__bigs") + F.floor(start / step)
    )
    own = own.select(*values.columns, part.cast("int").alias(PART))
    placed = fitting.unionByName(own)
    if anchor is None:
        return placed
    parts = own.groupBy(*keys).agg(F.max(PART).alias("__last")).select(*renamed, "__last")
    bases = rows.where(F.col("__anchor")).select(*values.columns).join(parts, on_renamed(keys), "left")
    numbers = F.explode(F.sequence(F.lit(0), F.coalesce("__last", F.lit(0)))).alias(PART)
    return placed.unionByName(bases.select(*values.columns, numbers))
