"""E-mail addresses and phone numbers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custofold.functions import blank_to, clean, code_concat, has_value, parse_ts
from custofold.operators import Lookup, lookup, lookup_constant, unpivot_typed
from custofold.schemas import DOC_KEY, EXTRACT_TS

# The source system code of this feed, value set names, and phone types with their columns.
SOURCE_SYSTEM = "CDB"
SYSTEM_SET = "RD SRC SYSTEMS"
BRAND_SET = "RD BRAND NAMES"
PHONE_COLUMNS = (
    ("IND BUSINESS PHONE", "BUSINESS_PHONE_NO"),
    ("IND DAYTIME PHONE", "BUSINESS_PHONE_NO"),
    ("IND EVENING PHONE", "HOME_PHONE_NO"),
    ("IND LANDLINE PHONE", "HOME_PHONE_NO"),
    ("IND MOBILE PHONE", "MOBILE_PHONE_NO"),
)


def email(data: Mapping[str, DataFrame], table: Lookup) -> DataFrame:
    """``EMAIL``: addresses of known customers of the same system instance, with the customer's brand."""
    on = ["CUSTOMER_ID", "SRC_SYS_INST_ID"]
    # Only the distinct brands of a customer take part in the join, not every version of the customer.
    brands = data["individual"].select(
        *on, clean(code_concat("BANK_ID", "CUSTOMER_OWNED_BY")).alias("__brand")
    ).distinct()
    rows = lookup(data["email"].join(brands, on), table, "__brand", "SRC_BRND_ID", set_name=BRAND_SET)
    rows = lookup_constant(rows, table, SYSTEM_SET, SOURCE_SYSTEM, "DATA_SRC_ID")
    return rows.select(
        *DOC_KEY,
        F.struct(
            F.col("E_ADDR_TYPE").alias("EMAIL_TP_ID"),
            "DATA_SRC_ID",
            "SRC_BRND_ID",
            clean("E_ADDR").alias("EMAIL_ID_VAL"),
            F.col(EXTRACT_TS).alias("SRC_SYS_CHG_DT"),
            "SRC_EVT_TYP_FLG",
        ).alias("EMAIL"),
    )


def phone(data: Mapping[str, DataFrame], table: Lookup) -> DataFrame:
    """``PHONE``: three phone columns under five types; blank numbers are left out."""
    people = data["individual"].select(
        *DOC_KEY,
        "SRC_EVT_TYP_FLG",
        "BUSINESS_PHONE_NO",
        "HOME_PHONE_NO",
        "MOBILE_PHONE_NO",
        parse_ts(EXTRACT_TS).alias("SRC_SYS_CHG_DT"),
        blank_to("SRC_SYS_ID").alias("__system"),
        blank_to(code_concat("BANK_ID", "CUSTOMER_OWNED_BY")).alias("__brand"),
    )
    keep = [*DOC_KEY, "SRC_EVT_TYP_FLG", "SRC_SYS_CHG_DT", "__system", "__brand"]
    rows = unpivot_typed(people, PHONE_COLUMNS, "PHONE_TYP_ID", "PHONE_NUM", keep).where(has_value("PHONE_NUM"))
    rows = lookup(rows, table, "__system", "DATA_SRC_ID", set_name=SYSTEM_SET)
    rows = lookup(rows, table, "__brand", "SRC_BRND_ID", set_name=BRAND_SET)
    return rows.select(
        *DOC_KEY,
        F.struct(
            "PHONE_TYP_ID",
            clean("PHONE_NUM").alias("PHONE_NUM"),
            "DATA_SRC_ID",
            "SRC_BRND_ID",
            "SRC_SYS_CHG_DT",
            "SRC_EVT_TYP_FLG",
        ).alias("PHONE"),
    )
