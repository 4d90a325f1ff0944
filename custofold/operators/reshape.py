"""Wide columns to typed rows, and edges seen from their ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custofold.operators.match import with_match


def unpivot_typed(
    df: DataFrame,
    columns: Sequence[tuple[str, str | Column]],
    type_name: str,
    value_name: str,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per (input row, listed column): the given type text and the column's value as text.

    A column may be listed under several types. The input is read once, whatever the number of columns.
    """
    kept = list(df.columns if keep is None else keep)
    cells = [
        F.struct(
            F.lit(kind).alias(type_name),
            (F.col(c) if isinstance(c, str) else c).cast("string").alias(value_name),
        )
        for kind, c in columns
    ]
    return df.select(*kept, F.explode(F.array(*cells)).alias("__cell")).select(*kept, "__cell.*")


def edges_within(
    edges: DataFrame,
    id1: str,
    id2: str,
    known1: DataFrame,
    known2: DataFrame | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Distinct edges whose two ends both occur in the one-column frames of known ids.

    ``distinct=False`` saves a shuffle where a later step removes copies anyway.
    """
    known2 = known1 if known2 is None else known2
    both = with_match(with_match(edges, known1.toDF(id1), [id1]), known2.toDF(id2), [id2])
    return both.distinct() if distinct else both


def edges_oriented(edges: DataFrame, id1: str, id2: str, kind: str, as_is: Sequence[str], swapped: Sequence[str]) -> DataFrame:
    """Edges of the listed types only; those of a ``swapped`` type have their two ends exchanged."""
    turn = F.col(kind).isin(*swapped)
    return (
        edges.where(F.col(kind).isin(*as_is, *swapped))
        .withColumns({"__a": F.when(turn, F.col(id2)).otherwise(F.col(id1)), "__b": F.when(turn, F.col(id1)).otherwise(F.col(id2))})
        .withColumns({id1: F.col("__a"), id2: F.col("__b")})
        .drop("__a", "__b")
    )


def edges_both_ends(edges: DataFrame, id1: str, id2: str, out: str, distinct: bool = True) -> DataFrame:
    """Every edge twice, once for each end, the end's id in ``out``; read once."""
    rest = [c for c in edges.columns if c not in (id1, id2)]
    rows = edges.select(F.explode(F.array(id1, id2)).alias(out), *rest)
    return rows.distinct() if distinct else rows


def relation_types(edges: DataFrame, id1: str, id2: str, kind: str, out: str) -> DataFrame:
    """The distinct (id, type) pairs of both ends; gather them with ``collect_subdocs``."""
    return edges_both_ends(edges.select(id1, id2, F.col(kind).alias(out)), id1, id2, id1)
