from callsight.streaming.jobs import files_stream, hourly_stream, hourly_window_stream, process_hourly_batch, total_stream
from callsight.streaming.snapshots import (
    committed_batch,
    compact_hourly,
    compact_profiles,
    compact_totals,
    current_hourly,
    current_profile_partials,
    current_totals,
    expire_folds,
    expire_partials,
    last_whole_batch,
    read_changed_totals,
)

__all__ = [
    "committed_batch",
    "compact_hourly",
    "compact_profiles",
    "compact_totals",
    "current_hourly",
    "current_profile_partials",
    "current_totals",
    "expire_folds",
    "expire_partials",
    "files_stream",
    "hourly_stream",
    "hourly_window_stream",
    "last_whole_batch",
    "process_hourly_batch",
    "read_changed_totals",
    "total_stream",
]
