"""Names that do not clash with the columns of a frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.columns import column


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def own_columns(df: DataFrame) -> list[Column]:
    """All columns by their exact names."""
    return [column(c) for c in df.columns]


def keep_listed(rows: DataFrame, keys: list[str], listed: DataFrame) -> DataFrame:
    """One row for each row of ``listed`` (as many columns as ``keys``, the
    first may be null) from the rows that agree with it in all of them.

    A null-safe key is made of a value and a flag up front, so that the join
    and the removal of repeated rows share one hash partitioning: the wide
    rows are shuffled once.
    """
    kind = rows.schema[keys[0]].dataType
    value, flag = unused(rows, "_key"), unused(rows, "_none")

    def flat(df: DataFrame, first: str) -> DataFrame:
        return df.withColumns({value: F.coalesce(F.col(first), F.lit("0").cast(kind)), flag: F.col(first).isNull()})

    wide = flat(rows, keys[0])
    few = flat(listed, listed.columns[0]).select(value, flag, *[F.col(c).alias(k) for c, k in zip(listed.columns[1:], keys[1:], strict=True)])
    by = [value, flag, *keys[1:]]
    return wide.join(few.distinct(), by, "left_semi").dropDuplicates(by)
