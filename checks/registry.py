"""The list of registered queries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables as attributes, e.g. ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def query(name: str, sql: str | None = None):
    """Register a function of the tables under a name, with the SQL that must give the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def scratch(spark: SparkSession) -> str:
    """A new folder name below the session's shared folder; a local one only where one machine runs everything."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/') if shared else tempfile.mkdtemp(prefix='run-')}/{uuid.uuid4().hex}"
