"""Row selection: known devices, first row per device, ordered positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.columns import column
from meterlake.operators.bitmap import bit_words, in_words
from meterlake.schemas import Layout
from meterlake.scratch import checkpoint_dir

# Largest registry broadcast to every task: 1M ids (~8 MB of keys + hash map).
DEFAULT_BROADCAST_IDS = 1_000_000


def registry_ids(registry: DataFrame, layout: Layout, id_column: str = "id") -> DataFrame:
    """Device ids of a registry as a one-column frame named like the layout's
    device column; a null id is dropped (it can never match a row)."""
    ids = registry.select(column(id_column).cast("long").alias(layout.device))
    return ids.where(column(layout.device).isNotNull())


def fits_broadcast(df: DataFrame, max_rows: int) -> bool:
    """Size check before a broadcast (a distributed count, one number back)."""
    return df.count() <= max_rows


def known_devices(
    rows: DataFrame,
    ids: DataFrame,
    layout: Layout,
    broadcast_ids: bool | None = None,
    max_broadcast: int = DEFAULT_BROADCAST_IDS,
) -> DataFrame:
    """Rows of devices listed in ``ids`` (left semi join on the device).

    The id list is broadcast only after its size is checked (or when the
    caller already checked it: ``broadcast_ids``). A larger registry becomes
    an exact bitmap, up to 64 ids to a row, which is broadcast up to
    ``max_broadcast / 4`` rows (an entry is some four times as large). Only a
    registry beyond that is narrowed to the devices present in the batch (the
    distinct device column, semi-joined with the registry, checkpointed and
    counted); that list is broadcast when it fits, so the wide batch is not
    shuffled by device. Only beyond that does the semi join shuffle (AQE
    splits a skewed device). Rows with a null device never match.
    """
    if broadcast_ids is None:
        broadcast_ids = fits_broadcast(ids, max_broadcast)
    right = ids.select(column(layout.device).alias("_known_id"))
    if not broadcast_ids:
        checkpoint_dir(rows.sparkSession)
        words = bit_words(ids, column(layout.device)).checkpoint(eager=True)
        if fits_broadcast(words, max_broadcast // 4):
            return in_words(rows, column(layout.device, rows), F.broadcast(words))
        present = rows.select(column(layout.device).alias("_known_id")).distinct()
        right = present.join(right, "_known_id", "left_semi").checkpoint(eager=True)
        broadcast_ids = fits_broadcast(right, max_broadcast)
    if broadcast_ids:
        right = F.broadcast(right)
    return rows.join(right, column(layout.device, rows) == F.col("_known_id"), "left_semi")


def first_row_per_device(rows: DataFrame, layout: Layout) -> DataFrame:
    """First row of each device in (time, event, other columns) order, nulls
    first.

    The input is read once. Each task sorts its own rows by device and order
    and keeps one row per device (the limit that Spark puts below the exchange
    of a ranked window), so what is shuffled is at most one row per device and
    task, also for a device that holds a third of all rows or has no times at
    all. The sort spills; no row is held for longer than the next one.
    """
    dev = column(layout.device)
    rest = [n for n in layout.names if n not in (layout.device, layout.time, layout.event)]
    order = [column(n).asc_nulls_first() for n in (layout.time, layout.event, *rest)]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(dev).orderBy(*order)))
    return ranked.where("_rank = 1").select(*[column(n) for n in layout.names])


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Add the 1-based position of each row in a total order, computed
    distributedly: range-partition and sort, checkpoint (fixes partition
    assignment and ids), count rows per partition, and offset each row by
    the sizes of the partitions before it. Only the per-partition counts
    (one row per partition) are broadcast.
    """
    checkpoint_dir(df.sparkSession)
    # a row hash ends the range key: rows equal in the order columns but not
    # in others may lie in several ranges
    ranked = df.withColumn("_row_hash", F.xxhash64(*[column(c) for c in df.columns]))
    keys = [*order, F.col("_row_hash")]
    ordered = ranked.repartitionByRange(*keys).sortWithinPartitions(*keys)
    tagged = ordered.select(
        *[column(c) for c in df.columns],
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_row_id"),
    ).checkpoint(eager=True)
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # monotonically_increasing_id = (partition index << 33) + row index in partition
    local = F.col("_row_id") - F.shiftleft(F.col("_part").cast("long"), 33)
    return tagged.join(F.broadcast(offsets), "_part").select(
        *[column(c) for c in df.columns],
        (F.col("_offset") + local + F.lit(1)).cast("long").alias(name),
    )
