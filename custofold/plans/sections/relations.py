"""Relationships between individuals, and between individuals and organisations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custofold.operators import Lookup, edges_both_ends, edges_within, lookup, lookup_constant, with_match
from custofold.schemas import DOC_KEY, EXTRACT_TS

# Relation types and their value set.
RELATION_SET = "RD CUST_REL_TYPES"
INDIVIDUAL_TYPE = "SB"
ORGANISATION_TYPES = ("SB", "ZB", "YB", "WB", "FB", "TB", "PB", "XB", "BB", "DB", "CB")
SWAPPED_TYPES = ("OO",)

EDGE = (
    "CUSTOMER_ID_1 CUSTOMER_ID_2 REL_TYPE DATE_CREATED SRC_SYS_INST_ID SRC_SYS_ID SRC_EVT_TYP_FLG "
    "SRC_EXTRACT_TS"
).split()


def individual_relations(data: Mapping[str, DataFrame], table: Lookup) -> DataFrame:
    """``RL_IDV``: relations whose two ends are both known, seen from either end."""
    ids = data["individual"].select("CUSTOMER_ID")
    edges = data["relationship"].where(F.col("REL_TYPE") == INDIVIDUAL_TYPE).select(*EDGE)
    rows = edges_both_ends(
        edges_within(edges, "CUSTOMER_ID_1", "CUSTOMER_ID_2", ids, distinct=False),
        "CUSTOMER_ID_1", "CUSTOMER_ID_2", "CUSTOMER_ID", distinct=False,
    )
    rows = lookup_constant(rows, table, RELATION_SET, INDIVIDUAL_TYPE, "RL_TP_ID")
    fields = ["REL_TYPE", "RL_TP_ID", "DATE_CREATED", EXTRACT_TS, "SRC_EVT_TYP_FLG"]
    return rows.select(*DOC_KEY, F.struct(*fields).alias("RL_IDV"))


def organisation_relations(data: Mapping[str, DataFrame], table: Lookup) -> DataFrame:
    """``IDVORG``: relations to organisations whose second end is an individual, seen from either end.

    The direction of an edge does not show in the sub-document, and both ends get the same one, so the
    ends of a swapped type need no exchange here (``edges_oriented`` does it where direction matters).
    """
    ids = data["individual"].select(F.col("CUSTOMER_ID").alias("CUSTOMER_ID_2"))
    edges = data["relationship"].where(F.col("REL_TYPE").isin(*ORGANISATION_TYPES, *SWAPPED_TYPES)).select(*EDGE)
    known = with_match(edges, ids, ["CUSTOMER_ID_2"])
    rows = edges_both_ends(known, "CUSTOMER_ID_1", "CUSTOMER_ID_2", "CUSTOMER_ID", distinct=False)
    rows = lookup(rows, table, "REL_TYPE", "RL_TP_ID", set_name=RELATION_SET)
    return rows.select(
        *DOC_KEY,
        F.struct("REL_TYPE", "RL_TP_ID", F.col("DATE_CREATED").alias("CRT_DT"), EXTRACT_TS, "SRC_EVT_TYP_FLG").alias("IDVORG"),
    )
