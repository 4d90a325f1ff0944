"""Keeping rows by the presence or absence of a partner row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _matched(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    # One row per key on the searched side: its copies never travel.
    probe = other.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    on = F.lit(True)
    for k in keys:
        left, right = F.col(k), F.col(f"__{k}")
        on = on & (left.eqNullSafe(right) if null_safe else left == right)
    return df.join(probe, on, how)


def with_match(df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose keys occur in ``other``."""
    return _matched(df, other, keys, "left_semi", null_safe)


def without_match(df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose keys do not occur in ``other``."""
    return _matched(df, other, keys, "left_anti", null_safe)


def read_matching(table: DataFrame, keys: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Selected columns of the stored rows whose key is in ``keys``; the key list stays distributed."""
    wanted = list(dict.fromkeys([*columns, *on]))
    return with_match(table.select(*wanted), keys, on).select(*columns)


KEY_BUCKET = "KEY_BUCKET"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key: a hash of its texts, so that a key stored as a number and one read as text agree."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("long")


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows with ``KEY_BUCKET``, by which a table is to be partitioned for ``read_bucketed``."""
    return df.withColumn(KEY_BUCKET, key_bucket(keys, buckets))


def read_bucketed(
    table: DataFrame, keys: DataFrame, on: Sequence[str], columns: Sequence[str], buckets: int
) -> DataFrame:
    """``read_matching`` of a table partitioned by ``KEY_BUCKET`` that opens only the buckets of the keys asked for.

    The distinct buckets of the keys, at most ``buckets`` rows, are broadcast; dynamic partition pruning takes them to the
    scan before it lists its files. The keys themselves stay distributed, however many there are.
    """
    wanted = with_bucket(keys.select(*on), on, buckets).distinct()
    # the comparison tells the optimizer that this side selects
    asked = wanted.select(KEY_BUCKET).where(F.col(KEY_BUCKET) >= 0).distinct()
    own = table.select(*dict.fromkeys([*columns, *on, KEY_BUCKET])).join(F.broadcast(asked), KEY_BUCKET, "left_semi")
    return with_match(own, wanted, [KEY_BUCKET, *on]).select(*columns)
