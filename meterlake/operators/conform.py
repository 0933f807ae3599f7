"""Conform differently shaped feeds to one layout and combine them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from meterlake.functions.columns import column, typed_null
from meterlake.schemas import Layout


def conform(df: DataFrame, mapping: Mapping[str, str | None], layout: Layout) -> DataFrame:
    """One projection to ``layout``: each layout column is taken from the feed
    column named in ``mapping`` (cast to the layout type where it differs) or
    is a typed null. Feed columns not named are dropped.

    Names are matched exactly, so the result does not depend on
    ``spark.sql.caseSensitive``.
    """
    unknown = set(mapping) - set(layout.names)
    if unknown:
        raise ValueError(f"mapping targets not in layout: {sorted(unknown)}")
    source_types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for f in layout.schema.fields:
        src = mapping.get(f.name)
        if src is None:
            exprs.append(typed_null(f.dataType).alias(f.name))
            continue
        if src not in source_types:
            raise ValueError(f"feed has no column {src!r} (for {f.name!r})")
        expr = column(src)
        if source_types[src] != f.dataType:
            expr = expr.cast(f.dataType)
        exprs.append(expr.alias(f.name))
    return df.select(*exprs)


def combine_feeds(periodic: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Bag union (duplicates kept) of conformed feeds; ``events=None`` when the
    event feed is not usable for the date. Matched by name, so a column-order
    drift cannot silently shift values."""
    if events is None:
        return periodic
    return periodic.unionByName(events)
