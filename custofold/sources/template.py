"""Landing records of any shape, read by a template of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE, VALUE = "LINE", "VALUE"
UNKNOWN, MISTYPED, MALFORMED = "unknown", "mistyped", "malformed"


def read_variants(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line of JSON lines files: its text, and its value as a VARIANT (NULL where it is no JSON).

    No field is lost and none is cast: what a later template names is still there.
    """
    return spark.read.text(path).select(F.col("value").alias(LINE), F.try_parse_json("value").alias(VALUE))


def field(name: str, kind: str = "string") -> Column:
    """A top-level field of the VARIANT, NULL where it is missing or cannot be cast."""
    if "'" in name and '"' in name:
        raise ValueError(f"no path names a field with both kinds of quotes: {name}")
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(VALUE, f"$[{quote}{name}{quote}]", kind)


def by_template(rows: DataFrame, template: T.StructType) -> DataFrame:
    """The columns of the template from ``read_variants``; lines that are no JSON object are left out."""
    good = rows.where(F.schema_of_variant(VALUE).startswith("OBJECT"))
    return good.select(*[field(f.name, f.dataType.simpleString()).alias(f.name) for f in template.fields])


def drift(rows: DataFrame, template: T.StructType) -> DataFrame:
    """How the records differ from the template: ``COLUMN``, ``PROBLEM``, ``FOUND`` (the kind of value) and ``N``.

    ``unknown``: a field that the template does not name. ``mistyped``: a value that is no NULL and not of
    the template's type (whole numbers fit every number type). ``malformed``: a line that is no JSON object; its
    column is NULL. Counting is by map-side sums; the report has a row for each field name and kind.
    """
    kind = F.regexp_extract(F.schema_of_variant(VALUE), "^[A-Z]+", 0)
    whole = rows.withColumn("__kind", F.coalesce(kind, F.lit("NONE")))
    malformed = whole.where(F.col("__kind") != "OBJECT").select(
        F.lit(None).cast("string").alias("COLUMN"), F.lit(MALFORMED).alias("PROBLEM"), F.col("__kind").alias("FOUND")
    )
    objects = whole.select(VALUE, "__kind")
    exploded = rows.sparkSession.tvf.variant_explode(F.col(VALUE).outer()).toDF("pos", "key", "__field")
    fields = objects.where(F.col("__kind") == "OBJECT").lateralJoin(exploded)
    fields = fields.select("key", F.col("__field").alias("__value"))
    found = F.regexp_extract(F.schema_of_variant("__value"), "^[A-Z]+", 0)
    fitting = F.lit(False)
    for names, kinds in _fitting(template):
        fitting = fitting | (F.col("key").isin(names) & found.isin(kinds))
    known = F.col("key").isin(template.names)
    odd = fields.where(~known | ~(fitting | found.isin("VOID"))).select(
        F.col("key").alias("COLUMN"), F.when(known, MISTYPED).otherwise(UNKNOWN).alias("PROBLEM"), found.alias("FOUND")
    )
    return malformed.unionByName(odd).groupBy("COLUMN", "PROBLEM", "FOUND").agg(F.count(F.lit(1)).alias("N"))


def _fitting(template: T.StructType) -> list[tuple[list[str], list[str]]]:
    """The template's columns by the kinds of JSON values that fit them."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in template.fields:
        if isinstance(f.dataType, T.IntegralType):
            kinds = ("BIGINT",)
        elif isinstance(f.dataType, T.NumericType):
            kinds = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
        elif isinstance(f.dataType, T.BooleanType):
            kinds = ("BOOLEAN",)
        else:
            kinds = ("STRING",)
        groups.setdefault(kinds, []).append(f.name)
    return [(names, list(kinds)) for kinds, names in groups.items()]
