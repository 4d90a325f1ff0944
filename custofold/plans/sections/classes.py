"""Classifications and indicator flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custofold.functions import blank_to, clean, code_concat, has_value, parse_ts
from custofold.operators import Lookup, lookup
from custofold.operators.reshape import unpivot_typed
from custofold.schemas import DOC_KEY, EXTRACT_TS

# Value sets of the classifications with their columns, and the flag names.
CLASS_COLUMNS = (
    ("RD HOME OWNERSHIP STATUS", "HOME_OWNER_IND"),
    ("RD DISABILITY", "DISABILITY_CODE"),
    ("RD MARITAL STATUS", "CUSTOMER_STATUS"),
    ("RD INDIVIDUAL MARKET SEGMENT", "SEGMENT_CODE"),
    ("RD INDIVIDUAL EMPLOYMENT STATUS", "OCCUPATION_CODE"),
    ("RD RBS EMPLOYEE", "OCCUPATION_CODE"),
    ("RD INDIVIDUAL JOB TITLE CODE", "OCCUPATION_CODE"),
    ("RD INDIVIDUAL JOB TITLE", "OCCUPATION_CODE"),
    ("RD BANK ID", "BANK_ID"),
    ("RD CUSTOMER OWNED BY", "CUSTOMER_OWNED_BY"),
)
SENSITIVITY = "RD SENSITIVITY FLAG"
RING_FENCE = "RD RING FENCE INDICATOR"
POLITICALLY_EXPOSED = "RD POLITICALLY EXPOSED INDICATOR"
YES = "Yes"
EXPOSED_TYPE, EXPOSED_VALUE = "PEP", "Y"


def classification(data: Mapping[str, DataFrame], table: Lookup) -> DataFrame:
    """``CLASS``: ten classification values per individual, each looked up in its own value set."""
    columns = [
        (name, clean(c) if c == "CUSTOMER_OWNED_BY" else F.col(c)) for name, c in CLASS_COLUMNS
    ]
    rows = unpivot_typed(
        data["individual"].withColumn(EXTRACT_TS, parse_ts(EXTRACT_TS)),
        columns,
        "CLASS_SET_NAME",
        "ORIG_CLASS_VAL_ID",
        [*DOC_KEY, "SRC_EVT_TYP_FLG", "LAST_CHNG_DATE", EXTRACT_TS],
    ).where(has_value("ORIG_CLASS_VAL_ID"))
    rows = lookup(rows, table, "ORIG_CLASS_VAL_ID", "CLASS_VAL_ID", set_col="CLASS_SET_NAME")
    fields = ["SRC_EVT_TYP_FLG", "ORIG_CLASS_VAL_ID", "LAST_CHNG_DATE", EXTRACT_TS, "CLASS_SET_NAME", "CLASS_VAL_ID"]
    return rows.select(*DOC_KEY, F.struct(*fields).alias("CLASS"))


def flags(data: Mapping[str, DataFrame]) -> DataFrame:
    """``IDV_FLAG``: sensitivity, ring fence and politically exposed flags.

    The sub-document carries the flag's type and name only, so no value is looked up.
    """
    people = data["individual"]
    rules = F.array(
        F.when(
            has_value("DISABILITY_CODE"),
            F.struct(F.lit(YES).alias("INDICATOR_TYPE"), F.lit(SENSITIVITY).alias("INDICATOR_NAME")),
        ),
        F.struct(
            blank_to(code_concat(clean("BANK_ID"), clean("CUSTOMER_OWNED_BY"))).alias("INDICATOR_TYPE"),
            F.lit(RING_FENCE).alias("INDICATOR_NAME"),
        ),
    )
    own = (
        people.select(
            *DOC_KEY,
            F.col("LAST_CHNG_DATE").alias("SRC_SYS_CHG_DT"),
            EXTRACT_TS,
            "SRC_EVT_TYP_FLG",
            F.explode(rules).alias("__rule"),
        )
        .where(F.col("__rule").isNotNull())
        .select("*", "__rule.INDICATOR_TYPE", "__rule.INDICATOR_NAME")
        .drop("__rule")
    )
    reported = (
        data["indicators"]
        .where((F.col("INDICATOR_TYPE") == EXPOSED_TYPE) & (clean("INDICATOR_VALUE") == EXPOSED_VALUE))
        .select(
            *DOC_KEY,
            F.col("UPDATE_DATE_TIME").alias("SRC_SYS_CHG_DT"),
            EXTRACT_TS,
            "SRC_EVT_TYP_FLG",
            F.lit(YES).alias("INDICATOR_TYPE"),
            F.lit(POLITICALLY_EXPOSED).alias("INDICATOR_NAME"),
        )
    )
    fields = ["INDICATOR_TYPE", "INDICATOR_NAME", "SRC_SYS_CHG_DT", EXTRACT_TS, "SRC_EVT_TYP_FLG"]
    return own.unionByName(reported).select(*DOC_KEY, F.struct(*fields).alias("IDV_FLAG"))
