"""Sub-documents: gathering them per key, attaching them, and building whole documents.

Every array-shaped result has one format: a row per key and ``DOC_PART``. A key with at most ``max_items`` distinct
values has part 0 only; a larger one has parts 0, 1, 2, ... that share its values between them, because one row has
to fit into one task and document stores limit the size of a document. The base columns are filled on every
part. Nothing is dropped, and no row holds an unbounded array. ``stack_values`` gives the same content one value
per row, without any limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custofold.operators.sizing import MAX_ITEMS, PART, place_bytes, placed

BASE = "__base"


def collect_subdocs(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    name: str,
    max_items: int = MAX_ITEMS,
    max_bytes: int | None = None,
) -> DataFrame:
    """The distinct values of every key as one sorted array ``name`` (see the module text on ``DOC_PART``).

    With ``max_bytes`` the encoded size of a part is limited (``place_bytes``) instead of the number of its values.
    Key sizes are checked by a job of their own, so pass a stored frame when the input is costly.
    """
    item = F.col(value) if isinstance(value, str) else value
    values = df.select(*keys, item.alias(name)).where(F.col(keys[0]).isNotNull())
    frames = placed(values, keys, max_items) if max_bytes is None else [place_bytes(values, keys, max_bytes)]
    gathered = [f.groupBy(*keys, PART).agg(F.sort_array(F.collect_set(name)).alias(name)) for f in frames]
    return reduce(DataFrame.unionByName, gathered)


def attach(
    base: DataFrame,
    section: DataFrame,
    keys: Sequence[str],
    shape: str = "array",
    max_items: int = MAX_ITEMS,
    part: str = PART,
) -> DataFrame:
    """Left join of one section to the documents; rows without the first key are left out.

    ``shape="array"`` gathers the section's single value column into one array per key and part first; column
    ``part`` tells the parts apart (0 where the section has nothing for a key). ``shape="rows"`` repeats the
    document once per distinct value; several sections attached this way multiply.
    """
    if shape == "rows":
        return base.join(section.distinct(), list(keys), "left").where(F.col(keys[0]).isNotNull())
    if shape != "array":
        raise ValueError(f"unknown shape {shape!r}")
    (name,) = [c for c in section.columns if c not in keys]
    gathered = collect_subdocs(section, keys, name, name, max_items).withColumnRenamed(PART, part)
    joined = base.join(gathered, list(keys), "left").where(F.col(keys[0]).isNotNull())
    return joined.withColumn(part, F.coalesce(part, F.lit(0)))


def stack_values(base: DataFrame, sections: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Base rows and section values under each other: the keys, and one filled column per row.

    Each section frame holds the keys and one column named as the section. Values whose key has a NULL part
    match no document in a join on that key, so they are left out. Each task's rows are in the order of their keys, by
    which they pack better in a stored table and in the shuffle of ``fold_documents``.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rest = [c for c in base.columns if c not in keys]
    frames = [base.select(*keys, F.struct(*rest).alias(BASE))]
    frames += [f.select(*keys, name).where(complete) for name, f in sections.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).sortWithinPartitions(*keys)


def fold_documents(
    values: DataFrame,
    keys: Sequence[str],
    max_items: int = MAX_ITEMS,
    max_bytes: int | None = None,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Documents from stacked values: one shuffle gathers all sections at once.

    Rows are dealt to tasks by the columns ``by`` of the key (by default all), so a later step by these needs no shuffle.

    With ``max_bytes`` the encoded size of a part, its base row included, is limited instead of the number of values.

    Every section becomes a sorted array (NULL where a document has no value in it, as after a left join). Keys
    without a base row give no document; of several base rows of a key the smallest counts. Store ``values``
    before calling this: it is read twice, the first time for its keys only.
    """
    keys = list(keys)
    sections = [c for c in values.columns if c not in (*keys, BASE)]
    anchor = F.col(BASE).isNotNull()
    values = values.where(F.col(keys[0]).isNotNull())
    if max_bytes is None:
        frames = placed(values, keys, max_items, anchor, by=by)
    else:
        frames = [place_bytes(values, keys, max_bytes, anchor)]
    gathered = [F.min(BASE).alias(BASE), *[F.collect_set(name).alias(name) for name in sections]]
    return (
        reduce(DataFrame.unionByName, [f.groupBy(*keys, PART).agg(*gathered) for f in frames])
        .where(F.col(BASE).isNotNull())
        .select(*keys, f"{BASE}.*", *[F.when(F.size(n) > 0, F.sort_array(n)).alias(n) for n in sections], PART)
    )


def assemble(
    base: DataFrame,
    sections: Mapping[str, DataFrame],
    keys: Sequence[str],
    shape: str = "array",
    max_items: int = MAX_ITEMS,
) -> DataFrame:
    """Whole documents from a base frame and its sections, in either shape."""
    if shape == "array":
        return fold_documents(stack_values(base, sections, keys), keys, max_items)
    if shape != "rows":
        raise ValueError(f"unknown shape {shape!r}")
    docs = base
    for section in sections.values():
        docs = attach(docs, section, keys, "rows")
    return docs.distinct()
