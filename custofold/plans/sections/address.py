"""The source address of a customer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custofold.functions import blank_to, clean, code_concat, newest, typed_null, value_if
from custofold.operators import (
    Lookup,
    best_answers,
    latest_by,
    lookup,
    lookup_constant,
    merge_verified,
    priority_pick,
    request_key,
    verification_requests,
)
from custofold.plans.sections.contacts import BRAND_SET, SOURCE_SYSTEM, SYSTEM_SET
from custofold.schemas import DOC_KEY, EXTRACT_TS

# Agreement statuses in order of preference, and those whose address is a postal one.
STATUS_ORDER = ("C", "A", "R")
POSTAL_STATUSES = ("C", "A")
LINES = ("ADDRESS_LINE_1", "ADDRESS_LINE_2", "ADDRESS_LINE_3", "ADDRESS_LINE_4", "ADDRESS_LINE_5", "POSTCODE")

SUB_DOCUMENT = (
    "RES_ADDR_LN_1_TX RES_ADDR_LN_2_TX RES_ADDR_LN_3_TX RES_ADDR_LN_4_TX RES_ADDR_LN_5_TX POSTAL_CITY_CD "
    "POSTAL_CNTRY_CD RES_POSTCODE_TX RES_CITY_CD VSL_SRC_BRAND_ID SRC_EXTRACT_TS SRC_EVT_TYP_FLG"
).split()


def address_rows(data: Mapping[str, DataFrame], table: Lookup) -> DataFrame:
    """One flat row per customer with an address: the best agreement decides about the postal lines.

    Only the agreement's status ranks the combinations of address, customer version and agreement, so each
    of the three is cut to one row per customer before they meet; no combination is ever built. Of a customer's
    addresses the newest counts.
    """
    by = ["CUSTOMER_ID"]
    home = latest_by(data["street_address"], by, newest(EXTRACT_TS)).drop(EXTRACT_TS)
    person = latest_by(
        data["individual"].select(*by, "BANK_ID", "CUSTOMER_OWNED_BY", EXTRACT_TS),
        by, newest(EXTRACT_TS),
    ).select(*by, blank_to(code_concat("BANK_ID", clean("CUSTOMER_OWNED_BY"))).alias("__brand"))
    deal = priority_pick(
        data["agreement"].select(*by, "CUST_ADDR_STATUS", EXTRACT_TS, "SRC_EVT_TYP_FLG"),
        by, "CUST_ADDR_STATUS", STATUS_ORDER, [t.desc_nulls_last() for t in newest(EXTRACT_TS)],
    )
    rows = home.join(person, by).join(deal, by, "left")
    rows = lookup_constant(rows, table, SYSTEM_SET, SOURCE_SYSTEM, "VSL_DATA_SRC_ID")
    rows = lookup(rows, table, "__brand", "VSL_SRC_BRAND_ID", set_name=BRAND_SET)
    postal = F.col("CUST_ADDR_STATUS").isin(*POSTAL_STATUSES)
    return rows.select(
        *DOC_KEY,
        "VSL_DATA_SRC_ID",
        *[value_if(postal, c).alias(f"addressLine{i}") for i, c in enumerate(LINES, 1)],
        *[clean(c).alias(f"RES_ADDR_LN_{i}_TX") for i, c in enumerate(LINES[:5], 1)],
        clean("POSTCODE").alias("RES_POSTCODE_TX"),
        *[typed_null().alias(c) for c in ("POSTAL_CITY_CD", "POSTAL_CNTRY_CD", "RES_CITY_CD")],
        "VSL_SRC_BRAND_ID",
        EXTRACT_TS,
        "SRC_EVT_TYP_FLG",
    )


POSTAL_LINES = tuple(f"addressLine{i}" for i in range(1, 7))


def address_requests(rows: DataFrame) -> DataFrame:
    """Keys and request texts for the postal lines of ``address_rows``; rows without any line ask for nothing."""
    asked = rows.where(F.coalesce(*POSTAL_LINES).isNotNull()).select(*POSTAL_LINES).distinct()
    keyed = asked.withColumn("request_key", request_key(*POSTAL_LINES))
    return verification_requests(keyed, POSTAL_LINES).select("request_key", "payload")


def with_verified_lines(rows: DataFrame, verified: DataFrame) -> DataFrame:
    """The rows with the five lines of the best answer in place of their own where it has a match code."""
    merged = merge_verified(rows.withColumn("request_key", request_key(*POSTAL_LINES)), best_answers(verified))
    known = F.col("verified_match_code").isNotNull()
    lines = {c: F.when(known, F.col(f"verified_{c}")).otherwise(F.col(c)) for c in POSTAL_LINES[:5]}
    return merged.withColumns(lines).select(*rows.columns)


def source_address(data: Mapping[str, DataFrame], table: Lookup, verified: DataFrame | None = None) -> DataFrame:
    """``VSL_DATA_SRC_ID``, the five postal lines and ``IDV_SRC`` per document key.

    ``verified`` holds the answers (``verification_results``) to ``address_requests``, if there are any.
    """
    rows = address_rows(data, table)
    if verified is not None:
        rows = with_verified_lines(rows, verified)
    return rows.select(
        *DOC_KEY,
        "VSL_DATA_SRC_ID",
        *POSTAL_LINES[:5],
        F.struct(*SUB_DOCUMENT).alias("IDV_SRC"),
    )
