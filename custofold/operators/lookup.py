"""Code translation through the value-set table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custofold.operators.sizing import BROADCAST_BYTES, measure

# Actions that switch a row of the table off (a NULL action switches it off as well).
BLOCKED_ACTIONS = ("STOP", "BLOCK")


@dataclass(frozen=True)
class Lookup:
    """The usable rows of a value-set table, whether they were measured to fit a broadcast, and how many rows
    (unusable ones too) the table lists."""

    rows: DataFrame
    small: bool
    listed: int

    @classmethod
    def of(cls, table: DataFrame, max_bytes: int = BROADCAST_BYTES) -> Lookup:
        usable = ~F.col("OUT_ACTION_CODE").isin(*BLOCKED_ACTIONS)
        rows = table.where(usable).select("VALUE_SET_NAME", "COLUMN_1_STRING_VALUE", "VSL_LKP_VALUE")
        size = measure(table.select(*rows.columns, usable.alias("__usable")), "__usable")
        return cls(rows, size.small(max_bytes), size.listed)

    def hinted(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df


def lookup(
    df: DataFrame,
    table: Lookup,
    code: str,
    out: str,
    set_name: str | None = None,
    set_col: str | None = None,
) -> DataFrame:
    """Add ``out``: the looked-up value of column ``code``, NULL on a miss.

    The value set is either the constant ``set_name`` or read per row from ``set_col``. A code listed
    several times gives one row per listing, as a left join does. A table too large to broadcast is joined
    by shuffle, where adaptive execution splits a frequent code on the data side.
    """
    if (set_name is None) == (set_col is None):
        raise ValueError("give either set_name or set_col")
    known = table.rows.select(
        F.col("VALUE_SET_NAME").alias("__set"),
        F.col("COLUMN_1_STRING_VALUE").alias("__code"),
        F.col("VSL_LKP_VALUE").alias(out),
    )
    on = F.col(code) == F.col("__code")
    if set_name is not None:
        known = known.where(F.col("__set") == set_name)
    else:
        on = on & (F.col(set_col) == F.col("__set"))
    return df.join(table.hinted(known), on, "left").drop("__set", "__code")


def lookup_constant(df: DataFrame, table: Lookup, set_name: str, code: str, out: str) -> DataFrame:
    """Like ``lookup`` for a code that is the same for every row.

    The matching values are gathered once (a one-row scalar subquery over the measured table) and expanded
    in place, so no join is planned at all.
    """
    hits = table.rows.where((F.col("VALUE_SET_NAME") == set_name) & (F.col("COLUMN_1_STRING_VALUE") == code))
    # Wrapped in a struct so that a listed NULL value still counts as a hit.
    listed = hits.agg(F.collect_list(F.struct("VSL_LKP_VALUE"))).scalar()
    kept = df.columns
    return df.select(*kept, F.explode_outer(listed).alias("__hit")).select(
        *kept, F.col("__hit.VSL_LKP_VALUE").alias(out)
    )


#: Rows of a frequent code are dealt to pieces of this share of an average partition.
PIECE = 1 / 8
#: So many codes are watched when frequent ones are looked for.
WATCHED = 10_000


def frequent(df: DataFrame, columns: Sequence[str], parts: int) -> DataFrame:
    """The value combinations that hold more than ``PIECE`` of an average partition, and how many pieces they need.

    A sketch of ``WATCHED`` counters finds them in one pass; there are at most ``parts / PIECE`` of them. Its counts are never
    too low, so no frequent code is missed.
    """
    most = min(WATCHED // 2, int(parts / PIECE))
    items = F.expr(f"approx_top_k(to_json(struct({', '.join(f'`{c}`' for c in columns)})), {most}, {WATCHED})")
    row = df.where(F.coalesce(*[F.col(c) for c in columns]).isNotNull()).agg(F.count(F.lit(1)).alias("n"), items.alias("top")).first()
    size = max(1.0, (row["n"] or 0) / parts * PIECE)
    hot = [(r["item"], math.ceil(r["count"] / size)) for r in row["top"] or [] if r["count"] > size]
    return df.sparkSession.createDataFrame(hot, "__item string, __pieces int")


def lookup_spread(
    df: DataFrame,
    table: Lookup,
    code: str,
    out: str,
    set_name: str | None = None,
    set_col: str | None = None,
) -> DataFrame:
    """``lookup`` against a table too large to broadcast where few codes hold most of the rows.

    Codes that would fill a partition are found first. Their rows are dealt to pieces by a hash of the row, and their
    listings are repeated once a piece, so a code's rows are joined in as many tasks as they are worth. Rows with
    no code find nothing and are dealt out likewise. Whole copies of one row stay together. The result is that of
    ``lookup``.
    """
    if (set_name is None) == (set_col is None):
        raise ValueError("give either set_name or set_col")
    keys = [code] if set_col is None else [set_col, code]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(frequent(df, keys, parts))  # at most parts / PIECE rows
    known = table.rows.select(
        F.col("VALUE_SET_NAME").alias("__set"),
        F.col("COLUMN_1_STRING_VALUE").alias("__code"),
        F.col("VSL_LKP_VALUE").alias(out),
    )
    if set_name is not None:
        known = known.where(F.col("__set") == set_name)
    own = ["__code"] if set_col is None else ["__set", "__code"]
    listed = F.to_json(F.struct(*[F.col(o).alias(k) for o, k in zip(own, keys, strict=True)]))
    known = known.withColumn("__item", listed).join(hot, "__item", "left").drop("__item")
    pieces = F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1)
    known = known.withColumn("__piece", F.explode(pieces)).drop("__pieces")
    rows = df.withColumn("__item", F.to_json(F.struct(*keys))).join(hot, "__item", "left")
    none = F.when(F.col(code).isNull(), F.lit(int(parts / PIECE)))
    piece = F.pmod(F.xxhash64(*df.columns), F.coalesce(none, "__pieces", F.lit(1)))
    rows = rows.withColumn("__own", piece).drop("__item", "__pieces")
    on = (F.col(code) == F.col("__code")) & (F.col("__own") == F.col("__piece"))
    if set_col is not None:
        on = on & (F.col(set_col) == F.col("__set"))
    return rows.join(known, on, "left").drop("__set", "__code", "__own", "__piece")
