"""Rows as JSON messages for a topic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def publish_payload(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One text column ``value`` with the row as a JSON object (NULL fields are left out)."""
    names = list(df.columns if columns is None else columns)
    return df.select(F.to_json(F.struct(*names)).cast("string").alias("value"))


def publish(df: DataFrame, topic: str, options: Mapping[str, str], fmt: str = "kafka") -> None:
    """Send every row to the topic. ``options`` carry the connection, e.g. ``kafka.bootstrap.servers``."""
    publish_payload(df).write.format(fmt).options(topic=topic, **options).mode("append").save()
