"""Named tables behind one small interface.

With a file format every table is a folder of numbered versions. ``overwrite`` writes a new version and
then commits its number to the table's log, so a reader (also one inside the very plan that is being
written) keeps the version it started from, and a failed overwrite changes nothing. With any other format
(a document database, JDBC) the calls pass straight through to that connector.

A table has one writer at a time: versions are numbered without a lock, and an append to the live version
may be seen half-way by a reader on file systems whose commit is not atomic.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_FORMATS = frozenset({"parquet", "orc", "json"})
#: Files are packed with this unless the options say otherwise.
CODECS = {"parquet": "zstd", "orc": "zstd"}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LOG_SCHEMA = T.StructType([T.StructField("version", T.LongType()), T.StructField("freed", T.LongType())])


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that runs inside are removed at its end, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


@dataclass(frozen=True)
class Store:
    """Tables under ``base`` (file formats), or in the collections a connector knows by ``name_option``."""

    spark: SparkSession
    base: str = ""
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    name_option: str = "collection"

    @property
    def _versioned(self) -> bool:
        return self.fmt in FILE_FORMATS

    def _log(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/{table}/_log"

    def _folder(self, table: str, version: int) -> str:
        return f"{self.base.rstrip('/')}/{table}/v{version}"

    def version(self, table: str) -> int | None:
        """The committed version of a table, None when it was never written (0 for a connector's)."""
        if not self._versioned:
            return 0
        try:
            log = self.spark.read.schema(LOG_SCHEMA).json(self._log(table))
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return log.agg(F.max("version")).first()[0]

    def _note(self, table: str, what: str, version: int) -> None:
        self.spark.range(version, version + 1).select(F.col("id").alias(what)).coalesce(1).write.mode("append").json(
            self._log(table)
        )

    def exists(self, table: str) -> bool:
        return self.version(table) is not None

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The table's rows. Give a schema where the format does not carry one."""
        reader = self.spark.read.format(self.fmt).options(**self.options)
        reader = reader.schema(schema) if schema is not None else reader
        if not self._versioned:
            return reader.option(self.name_option, table).load()
        version = self.version(table)
        if version is None:
            raise LookupError(f"table {table!r} does not exist in {self.base!r}")
        return reader.load(self._folder(table, version))

    def _write(self, df: DataFrame, table: str, mode: str, version: int, partition_by: Sequence[str]) -> None:
        writer = df.write.format(self.fmt).options(**self.options)
        if not self._versioned:
            writer.mode("append" if mode == "replace" else mode)
            writer.option(self.name_option, table).save()
            return
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        # A session set to dynamic overwrite would keep stale partitions of a failed attempt.
        replaced = "dynamic" if mode == "replace" else "static"
        writer.mode("overwrite" if mode == "replace" else mode)
        if self.fmt in CODECS and "compression" not in self.options:
            writer.option("compression", CODECS[self.fmt])
        with shuffles_removed(self.spark):
            writer.option("partitionOverwriteMode", replaced).save(self._folder(table, version))

    def append(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Add rows to the current version; the first append creates the table."""
        version = self.version(table) if self._versioned else 0
        if version is None:
            self.overwrite(df, table, partition_by)
        else:
            self._write(df, table, "append", version, partition_by)

    def replace(self, df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
        """Replace those partitions that the frame has rows of; the others stay. The first call creates the table.

        Writing the same rows a second time changes nothing, so a step that died after its write can be repeated.
        A connector has no partitions: there the rows are added.
        """
        version = self.version(table) if self._versioned else 0
        if version is None:
            self.overwrite(df, table, partition_by)
        else:
            self._write(df, table, "replace", version, partition_by)

    def overwrite(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Replace the table's rows; the frame may read the same table."""
        if not self._versioned:
            self._write(df, table, "overwrite", 0, ())
            return
        version = self.version(table)
        new = 0 if version is None else version + 1
        # Leftovers of an overwrite that failed before its commit are replaced.
        self._write(df, table, "overwrite", new, partition_by)
        self._note(table, "version", new)

    def clear(self, table: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
        """A truly empty table: no rows and no placeholder that later batches would have to skip."""
        self.overwrite(self.spark.createDataFrame([], schema), table, partition_by)

    def release(self, table: str, schema: T.StructType) -> None:
        """Free the space of the rows of a table that nothing reads any more; a connector's stay until they are replaced."""
        version = self.version(table) if self._versioned else None
        if version is not None:
            self._write(self.spark.createDataFrame([], schema).coalesce(1), table, "overwrite", version, ())

    def expire(self, table: str, keep: int = 1) -> None:
        """Free the space of all versions before the last ``keep``; their folders stay, empty.

        The log says up to which version this was done before, so every version is freed once, however many
        runs failed in between.
        """
        version = self.version(table) if self._versioned else None
        newest = (version or 0) - keep
        if newest < 0:
            return
        freed = self.spark.read.schema(LOG_SCHEMA).json(self._log(table)).agg(F.max("freed")).first()[0]
        for old in range(0 if freed is None else freed + 1, newest + 1):
            folder = self._folder(table, old)
            try:
                schema = self.spark.read.format(self.fmt).load(folder).schema
            except AnalysisException as e:
                if e.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                    continue  # that version holds no files
                raise
            self.spark.createDataFrame([], schema).write.format(self.fmt).mode("overwrite").save(folder)
        if freed is None or freed < newest:
            self._note(table, "freed", newest)

    def materialize(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write a frame and read it back with its own schema: lineage ends here, and later steps read it once per need."""
        self.overwrite(df, table, partition_by)
        return self.read(table, df.schema)
