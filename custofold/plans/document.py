"""The customer document: base, sections, and both shapes of putting them together."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custofold.operators import Lookup, assemble, attach, collect_subdocs, fold_documents, stack_values
from custofold.operators.sizing import MAX_ITEMS
from custofold.plans import sections as s
from custofold.schemas import DOC_KEY

ADDRESS = "ADDRESS"
NUMBERS, KINDS = "GURN", "RL_TP_ID"


def section_frames(
    data: Mapping[str, DataFrame], table: Lookup, today: dt.date | None = None, verified: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The eleven sections in document order; the source address comes with its postal lines.

    ``verified`` holds the answers to ``address_requests``, if there are any.
    """
    return {
        "EMAIL": s.email(data, table),
        "PHONE": s.phone(data, table),
        "PASSPORT": s.passport(data, table),
        "CLASS": s.classification(data, table),
        "IDVNATID": s.national_id(data, table),
        "IDVIDENT": s.identifiers(data, table),
        "RL_IDV": s.individual_relations(data, table),
        "IDVORG": s.organisation_relations(data, table),
        "IDV_FLAG": s.flags(data),
        "IDV_CNTRY": s.countries(data, table, today),
        "IDV_SRC": s.source_address(data, table, verified),
    }


def document_values(
    data: Mapping[str, DataFrame], table: Lookup, today: dt.date | None = None, verified: DataFrame | None = None
) -> DataFrame:
    """Everything that goes into the documents, one value per row, ready to be stored and folded.

    The source address is a section like the others: its values hold the system code, the postal lines and the
    sub-document, one for every listing of the system code.
    """
    frames = section_frames(data, table, today, verified)
    address = frames.pop("IDV_SRC")
    rest = [c for c in address.columns if c not in DOC_KEY]
    frames = {
        NUMBERS: s.other_numbers(data),
        KINDS: s.relation_kinds(data),
        **frames,
        ADDRESS: address.select(*DOC_KEY, F.struct(*rest).alias(ADDRESS)),
    }
    return stack_values(s.individual_base(data), frames, DOC_KEY)


def fold_values(values: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """One document per key and part from stacked values; those of a customer lie in one task."""
    return fold_documents(values, DOC_KEY, max_items, by=DOC_KEY[:1])


def document_rows(
    data: Mapping[str, DataFrame], table: Lookup, today: dt.date | None = None, verified: DataFrame | None = None
) -> DataFrame:
    """The flat shape: a document is repeated for every combination of its values.

    Only e-mail and phone are arrays here. The row count of a customer is the product over the other
    sections, so this shape is for feeds known to have few values per customer.
    """
    frames = section_frames(data, table, today, verified)
    base = attach(s.individual_rows(data), s.relation_kinds(data), DOC_KEY, part=f"{KINDS}_PART")
    for name in ("EMAIL", "PHONE"):
        base = attach(base, frames.pop(name), DOC_KEY, part=f"{name}_PART")
    return assemble(base, frames, DOC_KEY, shape="rows")


def documents(
    data: Mapping[str, DataFrame],
    table: Lookup,
    shape: str = "array",
    today: dt.date | None = None,
    max_items: int = MAX_ITEMS,
    verified: DataFrame | None = None,
) -> DataFrame:
    """Customer documents straight from the datasets, without a store between the steps."""
    if shape == "array":
        return fold_values(document_values(data, table, today, verified), max_items)
    if shape == "rows":
        return document_rows(data, table, today, verified)
    raise ValueError(f"unknown shape {shape!r}")


def section_arrays(section: DataFrame, name: str, max_items: int = MAX_ITEMS) -> DataFrame:
    """One section gathered on its own."""
    return collect_subdocs(section, DOC_KEY, name, name, max_items)
