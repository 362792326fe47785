"""Scans, fixture derivations and sinks."""

from .fixtures import fixture_trips, fixture_yearly_trips, load_table, trips_from_events, trips_from_orders
from .sinks import roundtrip_report, to_raw_text, write_split, write_table, write_trips
from .trips import (
    MissingColumnsError,
    conform_trips,
    read_trips,
    read_trips_csv,
    read_trips_parquet,
    rows_to_df,
    source_fallback,
    temp_view,
    validate_columns,
)

__all__ = [
    "fixture_trips",
    "fixture_yearly_trips",
    "load_table",
    "trips_from_events",
    "trips_from_orders",
    "roundtrip_report",
    "to_raw_text",
    "write_split",
    "write_table",
    "write_trips",
    "MissingColumnsError",
    "conform_trips",
    "read_trips",
    "read_trips_csv",
    "read_trips_parquet",
    "rows_to_df",
    "source_fallback",
    "temp_view",
    "validate_columns",
]
