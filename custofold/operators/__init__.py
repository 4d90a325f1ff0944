"""DataFrame operators; each takes frames and returns a lazy frame."""

from custofold.operators.embed import assemble, attach, collect_subdocs, fold_documents, stack_values
from custofold.operators.enrich import (
    best_answers,
    merge_verified,
    request_key,
    verification_requests,
    verification_results,
)
from custofold.operators.lookup import Lookup, lookup, lookup_constant, lookup_spread
from custofold.operators.match import key_bucket, read_bucketed, read_matching, with_bucket, with_match, without_match
from custofold.operators.number import row_index
from custofold.operators.pick import latest_by, priority_pick
from custofold.operators.reconcile import event_counts, reconcile, reconcile_all, reconcile_dataset
from custofold.operators.reshape import (
    edges_both_ends,
    edges_oriented,
    edges_within,
    relation_types,
    unpivot_typed,
)
from custofold.operators.sizing import Measured, measure, place, place_bytes
from custofold.operators.snapshot import Snapshot

__all__ = [
    "Lookup",
    "Measured",
    "Snapshot",
    "assemble",
    "attach",
    "best_answers",
    "collect_subdocs",
    "edges_both_ends",
    "edges_oriented",
    "edges_within",
    "event_counts",
    "fold_documents",
    "key_bucket",
    "latest_by",
    "lookup",
    "lookup_constant",
    "lookup_spread",
    "measure",
    "merge_verified",
    "place",
    "place_bytes",
    "priority_pick",
    "read_bucketed",
    "read_matching",
    "reconcile",
    "reconcile_all",
    "reconcile_dataset",
    "relation_types",
    "request_key",
    "row_index",
    "stack_values",
    "unpivot_typed",
    "verification_requests",
    "verification_results",
    "with_bucket",
    "with_match",
    "without_match",
]
