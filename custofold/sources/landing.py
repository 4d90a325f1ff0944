"""The landing batch: reading it, staging it, and taking it apart by dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custofold.schemas import (
    BATCH,
    BROKEN,
    CHANGED,
    DATASETS,
    FLAG,
    INSERT_FLAG,
    INSERTED,
    KIND,
    LANDING,
    LOAD,
    LOADED,
    REASON,
    RECORD,
    RECORDS,
    STAGED,
    TAG,
    Tags,
)
from custofold.sources.store import Store


def read_landing(spark: SparkSession, path: str | list[str], schema: T.StructType = LANDING) -> DataFrame:
    """Tagged records of JSON lines files. Malformed lines and records without a tag are left out."""
    return spark.read.schema(schema).json(path).where(F.col(TAG).isNotNull())


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All records of JSON lines files, also those that nothing can be done with; a malformed line is kept as text."""
    return spark.read.schema(RECORDS).option("columnNameOfCorruptRecord", BROKEN).json(path)


def with_reason(records: DataFrame, tags: Tags) -> DataFrame:
    """The records of ``read_records`` with the reason for which a run cannot use them (NULL: it can)."""
    reason = (
        F.when(F.col(BROKEN).isNotNull(), MALFORMED)
        .when(F.col(TAG).isNull(), NO_TAG)
        .when(~F.col(TAG).isin(*tags.values.values()), UNKNOWN_TAG)
        .when(F.col(FLAG).isNull(), NO_FLAG)
    )
    for name, spec in DATASETS.items():
        for column in spec.required:
            reason = reason.when((F.col(TAG) == tags[name]) & F.col(column).isNull(), f"no {column}")
    return records.withColumn(REASON, reason)


#: The reason in the stage of those that nothing is wrong with: a folder's name is better no NULL.
USABLE = "usable"
MALFORMED, NO_TAG, UNKNOWN_TAG, NO_FLAG = "malformed line", "no tag", "unknown tag", "no event flag"
REASONS = sorted({MALFORMED, NO_TAG, UNKNOWN_TAG, NO_FLAG, *(f"no {c}" for d in DATASETS.values() for c in d.required)})


def usable_records(judged: DataFrame) -> DataFrame:
    """The records that a run can use."""
    return judged.where(F.col(REASON).isNull()).drop(REASON, BROKEN)


def rejected_records(judged: DataFrame) -> DataFrame:
    """``REASON`` and the record as text of all others."""
    return judged.where(F.col(REASON).isNotNull()).select(REASON, _whole().alias(RECORD))


def _whole() -> Column:
    return F.coalesce(BROKEN, F.to_json(F.struct(*LANDING.names)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order; a column the frame lacks becomes a typed NULL."""
    given = {f.name: f.dataType for f in df.schema.fields}
    return df.selectExpr(
        *[
            f"`{f.name}`"
            if given.get(f.name) == f.dataType
            else f"CAST({f'`{f.name}`' if f.name in given else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in schema.fields
        ]
    )


def empty_dataset(spark: SparkSession, dataset: str) -> DataFrame:
    """No rows, with the columns of the dataset."""
    return spark.createDataFrame([], DATASETS[dataset].schema)


def _kind() -> Column:
    inserted = F.col(FLAG) == INSERT_FLAG
    return F.when(inserted, INSERTED).when(~inserted, CHANGED)


LOAD_PARTS = [LOAD, REASON, TAG, KIND]


def stage_load(store: Store, records: DataFrame, table: str, tags: Tags, load: str, again: bool = False) -> dict[str, int]:
    """Stage one load of records, usable and refused ones, in one pass; how many there are of each reason ('': usable).

    The records are parsed once: the write sorts them out by load, reason, tag and kind into folders, and the
    counts are observed while it runs. With ``again`` the folders of this load are replaced, so that a
    load that is staged a second time is there once; else rows are added.
    """
    bad = F.col(REASON).isNotNull()
    rows = with_reason(records, tags).withColumns({RECORD: F.when(bad, _whole()), KIND: F.when(~bad, _kind())})
    reason = F.coalesce(REASON, F.lit(USABLE))
    rows = rows.withColumns({TAG: F.when(~bad, F.col(TAG)), LOAD: F.lit(load), REASON: reason}).select(*LOADED.names)
    seen = Observation(f"load {load}")
    counts = [F.count_if(F.col(REASON) == r).alias(r) for r in REASONS]
    rows = rows.observe(seen, F.count_if(F.col(REASON) == USABLE).alias(USABLE), *counts)
    (store.replace if again else store.append)(rows, table, LOAD_PARTS)
    found = seen.get
    return {"": found[USABLE], **{r: found[r] for r in REASONS if found[r]}}


def staged_records(store: Store, table: str) -> DataFrame:
    """The usable records that ``stage_load`` has left in the stage."""
    return store.read(table, LOADED).where(F.col(REASON) == USABLE).select(*STAGED.names)


def store_rejects(store: Store, stage: str, table: str, batch: int) -> None:
    """The refused records of the stage as the rejects of a batch; storing them again replaces them."""
    refused = store.read(stage, LOADED).where(F.col(REASON) != USABLE).select(REASON, RECORD)
    store.replace(refused.withColumn(BATCH, F.lit(batch)), table, [BATCH])


def stage_batch(store: Store, batch: DataFrame, table: str) -> DataFrame:
    """Add the batch's tagged records to the stage and return all that is staged.

    The stage still holds what a failed run left behind, so nothing is lost and nothing is taken twice.
    Files are partitioned by tag and by insert or change: each later read opens only what it needs.
    """
    rows = conform(batch, LANDING).where(F.col(TAG).isNotNull()).withColumn(KIND, _kind())
    store.append(rows, table, [TAG, KIND])
    return store.read(table, STAGED)


def reset_stage(store: Store, table: str, loads: bool = False) -> None:
    """Empty the stage; called once the documents of all its records are stored. ``loads``: it is one of ``stage_load``."""
    store.clear(table, LOADED if loads else STAGED, LOAD_PARTS if loads else [TAG, KIND])


def dataset_columns(rows: DataFrame, dataset: str) -> DataFrame:
    """The columns of a dataset with its blank defaults; rows without a required value are left out."""
    spec = DATASETS[dataset]
    for name in spec.required:
        rows = rows.where(F.col(name).isNotNull())
    rows = rows.select(*spec.columns)
    return rows.na.fill("", list(spec.blanked)) if spec.blanked else rows


def split_by_tag(df: DataFrame, dataset: str, tag: str) -> DataFrame:
    """One dataset of the mixed batch: the rows with its tag, in its columns."""
    return dataset_columns(df.where(F.col(TAG) == tag), dataset)


def split_all(df: DataFrame, tags: Tags) -> dict[str, DataFrame]:
    """All nine datasets by name."""
    return {name: split_by_tag(df, name, tags[name]) for name in DATASETS}
