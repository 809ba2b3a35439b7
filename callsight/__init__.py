"""Telecom analytics on Spark: call-record counts, subscriber profiles, top callers,
and balance-transfer fee checks, as plain ``DataFrame -> DataFrame`` operators that
work the same on batch tables and on Structured Streaming micro-batches."""

from callsight.operators.calls import (
    daily_totals,
    detections,
    distinct_files,
    enrich,
    finish_profile,
    hourly_counts,
    merge_profiles,
    outgoing,
    profile_partials,
    subscriber_profile,
    top_caller_per_day,
    top_k_per_group,
    total_by_subscriber,
)
from callsight.operators.fees import (
    classify_transfers,
    fee_exceptions,
    fee_summary,
    label_transfers,
    valid_transfers,
)

__all__ = [
    "classify_transfers",
    "daily_totals",
    "detections",
    "distinct_files",
    "enrich",
    "fee_exceptions",
    "fee_summary",
    "finish_profile",
    "hourly_counts",
    "label_transfers",
    "merge_profiles",
    "outgoing",
    "profile_partials",
    "subscriber_profile",
    "top_caller_per_day",
    "top_k_per_group",
    "total_by_subscriber",
    "valid_transfers",
]
