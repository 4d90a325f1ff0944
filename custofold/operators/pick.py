"""One row per key: the latest, or the one with the best status.

The rank window followed by ``= 1`` lets Spark cut every input partition to one row per key before the
shuffle (``WindowGroupLimit``), so a key with a large share of all rows sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_by(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where(F.col("__rank") == 1).drop("__rank")


def _ties(df: DataFrame, used: Sequence[str], ties: Sequence[str] | None) -> list[Column]:
    names = ties if ties is not None else sorted(c for c in df.columns if c not in used)
    return [F.col(c).asc_nulls_last() for c in names]


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    time: str | Column | Sequence[str | Column],
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the greatest ``time`` of every key (NULL times last).

    Rows of equal time are ordered by ``ties``, by default all remaining columns, so the pick does not
    depend on the order of the input.
    """
    times = [time] if isinstance(time, str | Column) else list(time)
    order = [(F.col(t) if isinstance(t, str) else t).desc_nulls_last() for t in times]
    used = [*keys, *[t for t in times if isinstance(t, str)]]
    return _first_by(df, keys, [*order, *_ties(df, used, ties)])


def priority_pick(
    df: DataFrame,
    keys: Sequence[str],
    status: str,
    ranking: Sequence[str],
    then: Sequence[Column] = (),
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The row of every key whose status comes first in ``ranking``; unlisted and NULL statuses come last."""
    rank = F.lit(len(ranking))
    for position, value in reversed(list(enumerate(ranking))):
        rank = F.when(F.col(status) == value, F.lit(position)).otherwise(rank)
    return _first_by(df, keys, [rank.asc(), *then, *_ties(df, keys, ties)])
