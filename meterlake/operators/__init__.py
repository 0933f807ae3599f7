"""DataFrame operators; each takes and returns DataFrames and never collects rows."""

from meterlake.operators.bitmap import bit_words, in_words, key_number
from meterlake.operators.conform import combine_feeds, conform
from meterlake.operators.merge import (
    DEFAULT_BROADCAST_KEYS,
    TimeBounds,
    bound_target,
    insert_missing,
    insert_missing_salted,
    stored_keys,
    time_range,
)
from meterlake.operators.report import (
    batch_report,
    delivery_report,
    device_stats,
    join_totals,
    listed_devices,
    with_totals,
)
from meterlake.operators.select import (
    DEFAULT_BROADCAST_IDS,
    first_row_per_device,
    fits_broadcast,
    known_devices,
    registry_ids,
    with_position,
)

__all__ = [
    "DEFAULT_BROADCAST_KEYS",
    "DEFAULT_BROADCAST_IDS",
    "TimeBounds",
    "batch_report",
    "bit_words",
    "bound_target",
    "combine_feeds",
    "conform",
    "delivery_report",
    "device_stats",
    "first_row_per_device",
    "fits_broadcast",
    "in_words",
    "insert_missing",
    "insert_missing_salted",
    "join_totals",
    "key_number",
    "known_devices",
    "listed_devices",
    "registry_ids",
    "stored_keys",
    "time_range",
    "with_position",
    "with_totals",
]
