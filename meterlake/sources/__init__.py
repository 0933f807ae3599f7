"""Sources and sinks: dated CSV feeds in, a partitioned Parquet table out."""

from meterlake.sources.csv import (
    DayInputs,
    day_inputs,
    has_event_feed,
    read_events,
    read_feed,
    read_periodic,
    read_registry,
)
from meterlake.sources.table import (
    TableSpec,
    create_table,
    device_counts,
    ensure_schema,
    read_device,
    read_devices,
    read_table,
    table_exists,
    write_rows,
)

__all__ = [
    "DayInputs",
    "TableSpec",
    "create_table",
    "day_inputs",
    "device_counts",
    "ensure_schema",
    "has_event_feed",
    "read_device",
    "read_devices",
    "read_events",
    "read_feed",
    "read_periodic",
    "read_registry",
    "read_table",
    "table_exists",
    "write_rows",
]
