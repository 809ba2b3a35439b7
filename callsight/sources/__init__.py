from callsight.sources.tables import (
    read_cdr_stream,
    read_collection,
    read_hourly,
    read_profile_partials,
    read_table,
    read_totals,
    register_view,
)

__all__ = [
    "read_cdr_stream",
    "read_collection",
    "read_hourly",
    "read_profile_partials",
    "read_table",
    "read_totals",
    "register_view",
]
