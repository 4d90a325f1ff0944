"""Where rows come from and go to."""

from custofold.sources.audit import audit_append, audit_rows, section_statuses, statuses_of
from custofold.sources.landing import (
    conform,
    dataset_columns,
    empty_dataset,
    read_landing,
    read_records,
    rejected_records,
    reset_stage,
    split_all,
    split_by_tag,
    stage_batch,
    stage_load,
    staged_records,
    store_rejects,
    usable_records,
    with_reason,
)
from custofold.sources.publish import publish, publish_payload
from custofold.sources.store import Store
from custofold.sources.template import by_template, drift, read_variants

__all__ = [
    "Store",
    "audit_append",
    "audit_rows",
    "by_template",
    "conform",
    "dataset_columns",
    "drift",
    "empty_dataset",
    "publish",
    "publish_payload",
    "read_landing",
    "read_records",
    "read_variants",
    "rejected_records",
    "reset_stage",
    "section_statuses",
    "split_all",
    "split_by_tag",
    "stage_batch",
    "stage_load",
    "staged_records",
    "statuses_of",
    "store_rejects",
    "usable_records",
    "with_reason",
]
