"""Countries of citizenship, nationality and tax residence."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custofold.functions import clean, default_today, has_value, newest
from custofold.operators import Lookup, latest_by, lookup, with_match
from custofold.plans.sections.identity import COUNTRY_SET
from custofold.schemas import DOC_KEY, EXTRACT_TS

# Country type names and their value set.
COUNTRY_TYPE_SET = "RD COUNTRY TYPES"
CITIZENSHIP_TYPE = "COUNTRY OF CITIZENSHIP"
NATIONALITY_TYPE = "COUNTRY OF NATIONALITY"
TAX_TYPE = "TAX RESIDENCY COUNTRY"


def countries(data: Mapping[str, DataFrame], table: Lookup, today: dt.date | None = None) -> DataFrame:
    """``IDV_CNTRY``: the latest row per customer, country and country type over all three sources."""
    people = data["individual"].select("CUSTOMER_ID")

    def named(rows: DataFrame, country: str, *types: str) -> DataFrame:
        return rows.select(
            *DOC_KEY,
            F.col(country).alias("__country"),
            F.col(EXTRACT_TS).alias("__time"),
            "SRC_EVT_TYP_FLG",
            F.explode(F.array(*[F.lit(t) for t in types])).alias("__type"),
        )

    taxed = latest_by(
        with_match(data["tax_residence"].where(has_value("CTRY_OF_TAXATION")), people, ["CUSTOMER_ID"]),
        ["CUSTOMER_ID", "CTRY_OF_TAXATION"], "TAX_CRE_TIMESTAMP",
    )
    national = latest_by(
        data["individual"]
        .where(has_value("CTRY_OF_NATIONALTY"))
        .select(*DOC_KEY, "CTRY_OF_NATIONALTY", "LAST_CHNG_DATE", EXTRACT_TS, "SRC_EVT_TYP_FLG"),
        ["CUSTOMER_ID", "CTRY_OF_NATIONALTY"], "LAST_CHNG_DATE",
    )
    # The pick below takes the latest of these by the same time, so they need no pick of their own.
    citizen = with_match(data["citizenship"].where(has_value("ADDNL_CITIZENSHIP")), people, ["CUSTOMER_ID"])

    rows = (
        named(taxed, "CTRY_OF_TAXATION", TAX_TYPE)
        .unionByName(named(national, "CTRY_OF_NATIONALTY", CITIZENSHIP_TYPE, NATIONALITY_TYPE))
        .unionByName(named(citizen, "ADDNL_CITIZENSHIP", CITIZENSHIP_TYPE, NATIONALITY_TYPE))
    )
    rows = latest_by(rows, ["CUSTOMER_ID", "__country", "__type"], newest("__time"))
    rows = rows.withColumn("__country", clean("__country"))
    rows = lookup(rows, table, "__type", "CNTRY_TYPE_ID", set_name=COUNTRY_TYPE_SET)
    rows = lookup(rows, table, "__country", "CNTRY_ID", set_name=COUNTRY_SET)
    return rows.select(
        *DOC_KEY,
        F.struct(
            "CNTRY_TYPE_ID",
            "CNTRY_ID",
            default_today("__time", today).alias("SRC_SYS_CHG_DT"),
            "SRC_EVT_TYP_FLG",
        ).alias("IDV_CNTRY"),
    )
