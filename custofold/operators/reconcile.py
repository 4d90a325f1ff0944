"""Which of the staged change records count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custofold.functions.time import newest
from custofold.operators.pick import latest_by
from custofold.schemas import (
    CHANGED,
    DATASETS,
    EXTRACT_TS,
    FLAG,
    INSERT_FLAG,
    INSERTED,
    KIND,
    RELATION_KEY,
    TAG,
    Tags,
)
from custofold.sources.landing import dataset_columns


def event_counts(df: DataFrame, keys: Sequence[str], out: str = "CNT") -> DataFrame:
    """Number of events per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def _merge(
    inserts: DataFrame, changes: DataFrame, keys: Sequence[str], time: Sequence[str | Column], ties: Sequence[str] | None
) -> DataFrame:
    return inserts.distinct().unionByName(latest_by(changes, keys, time, ties))


def reconcile(
    df: DataFrame,
    keys: Sequence[str],
    time: Sequence[str | Column],
    flag: str = FLAG,
    insert: str = INSERT_FLAG,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """All distinct inserts, plus the latest update or delete of every key. Rows without a flag are left out.

    Copies of an insert are removed inside every task before the shuffle, and the changes of a key are cut
    to the latest one per task, so neither a record sent many times nor a busy key piles up.
    NULL key parts are equal to each other.
    """
    return _merge(df.where(F.col(flag) == insert), df.where(F.col(flag) != insert), keys, time, ties)


def reconcile_dataset(df: DataFrame, dataset: str, tag: str, keys: Sequence[str] | None = None) -> DataFrame:
    """One dataset of the mixed batch, reconciled.

    Only the dataset's own columns travel: a landing row is some seventy columns wide, most of them empty.
    Records are known by customer, system and instance; a relationship has no customer of its own and is
    known by its two ends and its type. Other ``keys`` may be given, e.g. with the address number for customers
    that have several addresses. A staged batch (with ``CHANGE_KIND``) is read partition by partition.
    """
    own = RELATION_KEY if dataset == "relationship" else ("CUSTOMER_ID",)
    keys = list(keys) if keys else [*own, "SRC_SYS_ID", "SRC_SYS_INST_ID"]
    columns = list(dict.fromkeys([*DATASETS[dataset].columns, *keys, FLAG, EXTRACT_TS]))
    rows = df.where(F.col(TAG) == tag)
    inserts, changes = rows.where(F.col(FLAG) == INSERT_FLAG), rows.where(F.col(FLAG) != INSERT_FLAG)
    if KIND in df.columns:
        inserts, changes = inserts.where(F.col(KIND) == INSERTED), changes.where(F.col(KIND) == CHANGED)
    kept = _merge(inserts.select(*columns), changes.select(*columns), keys, newest(EXTRACT_TS), None)
    return dataset_columns(kept, dataset)


def reconcile_all(
    df: DataFrame, tags: Tags, keys: Mapping[str, Sequence[str]] | None = None
) -> dict[str, DataFrame]:
    """All nine datasets of the batch, reconciled; ``keys`` may give a dataset other keys than the usual ones."""
    return {name: reconcile_dataset(df, name, tags[name], (keys or {}).get(name)) for name in DATASETS}
