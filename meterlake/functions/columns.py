from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.schemas import Layout

_MICROS_PER_DAY = 86_400_000_000


def column(name: str, df: DataFrame | None = None) -> Column:
    """Exact reference to a column whose name may hold spaces, dots or '/'.

    With a DataFrame the reference is bound to it (needed after self-joins).
    """
    quoted = "`" + name.replace("`", "``") + "`"
    return df[quoted] if df is not None else F.col(quoted)


def typed_null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def key_match(left: str, right: str, layout: Layout) -> Column:
    """Row-key equality of two aliased relations: device =, time =, event
    null-safe =.

    A null device or time never matches (plain equality), a missing event
    equals a missing event. Columns are referenced through the relation
    aliases, so it also holds for a relation joined with itself. Catalyst
    plans this as an equi-join on the key.
    """

    def c(alias: str, name: str) -> Column:
        return F.col(f"{alias}.`{name}`")

    return (
        (c(right, layout.device) == c(left, layout.device))
        & (c(right, layout.time) == c(left, layout.time))
        & c(right, layout.event).eqNullSafe(c(left, layout.event))
    )


def day_of(time: Column, dtype: T.DataType) -> Column:
    """Calendar day of a timestamp that does not depend on the session time zone.

    An instant (``TimestampType``) maps to its UTC day; a wall-clock time
    (``TimestampNTZType``) to its own date. Used as the table's partition value,
    so it must come out the same in every session.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_date(time)
    if isinstance(dtype, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_micros(time) / F.lit(_MICROS_PER_DAY)).cast("int"))
    raise TypeError(f"time column must be a timestamp, got {dtype.simpleString()}")
