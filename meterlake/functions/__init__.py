"""Column-expression helpers (all built-in Spark expressions, no UDFs)."""

from meterlake.functions.columns import (
    column,
    day_of,
    key_match,
    typed_null,
)

__all__ = ["column", "day_of", "key_match", "typed_null"]
