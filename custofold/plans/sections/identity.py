"""Passports, national identity numbers and customer identifiers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custofold.functions import blank_to, clean, has_value, parse_ts
from custofold.operators import Lookup, lookup, lookup_constant
from custofold.plans.sections.contacts import BRAND_SET, SYSTEM_SET
from custofold.schemas import DOC_KEY, EXTRACT_TS

# Value set names and the codes looked up in them.
COUNTRY_SET = "RD COUNTRY CODES"
NATIONAL_ID_SET = "RD NATIONAL IDENTITY TYPE"
NATIONAL_ID_TYPE = "Individual National Insurance Number"
NATIONAL_ID_COUNTRY = "GBR"
IDENTIFIER_SET = "RD IDENTIFIER TYPES"
OWN_NUMBER = "CIN"
OTHER_NUMBER = "GURN"


def passport(data: Mapping[str, DataFrame], table: Lookup) -> DataFrame:
    """``PASSPORT``: every kept version's passport, with the issuing country looked up."""
    rows = data["individual"].where(has_value("PASSPORT_NO")).select(
        *DOC_KEY,
        clean("PASSPORT_NO").alias("PPT_NUM"),
        blank_to("PASSPORT_CTRY").alias("__country"),
        F.col("LAST_CHNG_DATE").alias("SRC_SYS_CHG_DT"),
        parse_ts(EXTRACT_TS).alias(EXTRACT_TS),
        "SRC_EVT_TYP_FLG",
    )
    rows = lookup(rows, table, "__country", "PPT_ISSUING_CNTRY_ID", set_name=COUNTRY_SET)
    fields = ["PPT_NUM", "PPT_ISSUING_CNTRY_ID", "SRC_SYS_CHG_DT", EXTRACT_TS, "SRC_EVT_TYP_FLG"]
    return rows.select(*DOC_KEY, F.struct(*fields).alias("PASSPORT"))


def national_id(data: Mapping[str, DataFrame], table: Lookup) -> DataFrame:
    """``IDVNATID``: the national insurance number, its type and country being constants of this feed."""
    rows = data["individual"].where(has_value("NATIONAL_INS_NO")).select(
        *DOC_KEY,
        F.col("NATIONAL_INS_NO").alias("NAT_IDENT_VAL"),
        F.col("LAST_CHNG_DATE").alias("SRC_SYS_CHG_DT"),
        parse_ts(EXTRACT_TS).alias(EXTRACT_TS),
        "SRC_EVT_TYP_FLG",
    )
    rows = lookup_constant(rows, table, NATIONAL_ID_SET, NATIONAL_ID_TYPE, "NAT_IDENT_TP")
    rows = lookup_constant(rows, table, COUNTRY_SET, NATIONAL_ID_COUNTRY, "ISSUING_CNTRY_ID")
    fields = ["NAT_IDENT_TP", "ISSUING_CNTRY_ID", "NAT_IDENT_VAL", "SRC_SYS_CHG_DT", EXTRACT_TS, "SRC_EVT_TYP_FLG"]
    return rows.select(*DOC_KEY, F.struct(*fields).alias("IDVNATID"))


def identifiers(data: Mapping[str, DataFrame], table: Lookup) -> DataFrame:
    """``IDVIDENT``: the customer id of every kept version, and one row for each other customer number.

    A blank system id is replaced for the lookup only; the document key keeps the raw value.
    """
    people = data["individual"].select(
        *DOC_KEY,
        blank_to("BANK_ID").alias("__brand"),
        blank_to("SRC_SYS_ID").alias("__system"),
        F.col("LAST_CHNG_DATE").alias("SRC_SYS_CHG_DT"),
        EXTRACT_TS,
        "SRC_EVT_TYP_FLG",
    ).distinct()
    numbers = data["gurn"].select("CUSTOMER_ID", F.col("GURN").alias("IDV_ID_VAL")).distinct()
    own = people.withColumns({"IDV_ID_VAL": F.col("CUSTOMER_ID"), "__type": F.lit(OWN_NUMBER)})
    other = people.join(numbers, "CUSTOMER_ID").withColumn("__type", F.lit(OTHER_NUMBER))
    rows = own.unionByName(other)
    rows = lookup(rows, table, "__type", "IDENT_TP_ID", set_name=IDENTIFIER_SET)
    rows = lookup(rows, table, "__brand", "SRC_BRND_ID", set_name=BRAND_SET)
    rows = lookup(rows, table, "__system", "DATA_SRC_ID", set_name=SYSTEM_SET)
    fields = ["IDENT_TP_ID", "DATA_SRC_ID", "SRC_BRND_ID", "IDV_ID_VAL", "SRC_SYS_CHG_DT", EXTRACT_TS, "SRC_EVT_TYP_FLG"]
    return rows.select(*DOC_KEY, F.struct(*fields).alias("IDVIDENT"))
