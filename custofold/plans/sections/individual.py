"""The base of every document: one individual, their other customer numbers and relation types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custofold.functions import clean, code_concat, full_name, parse_ts, typed_null
from custofold.operators import edges_both_ends, latest_by, with_match
from custofold.plans.sections.relations import ORGANISATION_TYPES, SWAPPED_TYPES
from custofold.schemas import DATASETS, DOC_KEY, EXTRACT_TS

# Columns of a document that no source fills, and the two constant ids.
EMPTY_COLUMNS = (
    "ALIAS_NM FORMER_SURNM_NM SRC_ROWID LAST_UPDATE_DATE RBS_EMP_ID NI_NUM_VAL CITY_OF_RES_ID "
    "RES_ADDR_ST_DT RES_ADDR_END_DT MAIDEN_NM ROW_ACTION DATA_SRC_ID"
).split()
CONSTANT_IDS = {"CNTRY_OF_RISK_ID": -1, "LEGAL_CAPACITY_TP_ID": -1}
NAME_PARTS = (
    "CUSTOMER_TITLE CUSTOMER_FIRST_NAM CUSTOMER_FORENAM_1 CUSTOMER_FORENAM_2 CUSTOMER_FORENAM_3 "
    "CUSTOMER_SURNAME CUSTOMER_NAME_SFX"
).split()
TRIMMED = {
    "TAX_NUMBER": "TAX_NUMBER",
    "PLACE_OF_BIRTH": "PLACE_OF_BIRTH",
    "CTRY_OF_BIRTH": "CTRY_OF_BIRTH",
    "CUSTOMER_NAME_SFX": "CUSTOMER_NAME_SFX",
    "MIDDLE_NM_1": "CUSTOMER_FORENAM_1",
    "MIDDLE_NM_2": "CUSTOMER_FORENAM_2",
    "MIDDLE_NM_3": "CUSTOMER_FORENAM_3",
    "CUSTOMER_FIRST_NAM": "CUSTOMER_FIRST_NAM",
    "CUSTOMER_SURNAME": "CUSTOMER_SURNAME",
    "SALUTATION_NM": "CUSTOMER_TITLE",
}
UNCHANGED = (
    "CTRY_OF_RESIDENCE GRADUATION_DATE DECEASED_DATE FIRST_CONTACT_DATE DEPEND_CHILD_CNT CUSTOMER_DOB "
    "CUSTOMER_GENDER CUSTOMER_OWNED_BY SRC_EVT_TYP_FLG"
).split()


def _columns() -> list[Column]:
    return [
        *[F.col(k) for k in DOC_KEY],
        *[clean(source).alias(name) for name, source in TRIMMED.items()],
        *[F.col(name) for name in UNCHANGED],
        F.col(EXTRACT_TS).alias("CRT_DT"),
        clean(code_concat("BANK_ID", "CUSTOMER_OWNED_BY")).alias("BANK_ID"),
        full_name(*NAME_PARTS).alias("FULL_NM"),
        *[F.lit(v).alias(name) for name, v in CONSTANT_IDS.items()],
        *[typed_null().alias(name) for name in EMPTY_COLUMNS],
    ]


def individual_base(data: Mapping[str, DataFrame]) -> DataFrame:
    """One row per document key, from the latest version of the individual."""
    rest = sorted(set(DATASETS["individual"].columns) - set(DOC_KEY) - {EXTRACT_TS})
    latest = latest_by(data["individual"], DOC_KEY, [parse_ts(EXTRACT_TS), EXTRACT_TS], rest)
    return latest.select(*_columns())


def individual_rows(data: Mapping[str, DataFrame]) -> DataFrame:
    """One row per kept version and other customer number."""
    numbers = data["gurn"].select("CUSTOMER_ID", clean("GURN").alias("GURN")).distinct()
    return data["individual"].select(*_columns()).join(numbers, "CUSTOMER_ID", "left").distinct()


def document_keys(data: Mapping[str, DataFrame]) -> DataFrame:
    """The distinct document keys of the batch."""
    return data["individual"].select(*DOC_KEY).distinct()


def other_numbers(data: Mapping[str, DataFrame]) -> DataFrame:
    """``GURN``: the alternate customer numbers, matched by customer alone."""
    numbers = data["gurn"].select("CUSTOMER_ID", clean("GURN").alias("GURN")).where(F.col("GURN").isNotNull())
    return document_keys(data).join(numbers.distinct(), "CUSTOMER_ID").select(*DOC_KEY, "GURN")


def relation_kinds(data: Mapping[str, DataFrame]) -> DataFrame:
    """``RL_TP_ID``: the relation types a customer takes part in, where the second end is an individual."""
    known = data["individual"].select(F.col("CUSTOMER_ID").alias("CUSTOMER_ID_2"))
    edges = (
        data["relationship"]
        .where(F.col("REL_TYPE").isin(*ORGANISATION_TYPES, *SWAPPED_TYPES))
        .select("CUSTOMER_ID_1", "CUSTOMER_ID_2", F.col("REL_TYPE").alias("RL_TP_ID"))
    )
    pairs = edges_both_ends(
        with_match(edges, known, ["CUSTOMER_ID_2"]), "CUSTOMER_ID_1", "CUSTOMER_ID_2", "CUSTOMER_ID"
    )
    return document_keys(data).join(pairs, "CUSTOMER_ID").select(*DOC_KEY, "RL_TP_ID")
