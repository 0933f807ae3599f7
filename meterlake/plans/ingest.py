"""Daily ingest as one set-based job over all devices.

Plan of ``store_batch`` (in brackets: what moves):

1. registry ids staged as they come, counted while they are written: the
   count says whether they may be broadcast;
2. the batch's known rows staged once as Parquet under the checkpoint folder
   [broadcast semi join; a larger registry is broadcast as a bitmap]. Row
   count, time range and the table's folders that the rows touch are observed
   during this one write. Later steps read only the columns they need, and a
   lost executor costs no re-parse of the CSV files;
3. a bitmap of fixed size of the batch's key hashes [partial aggregation, then
   a broadcast of bounded size];
4. possible matches = three columns of the touched folders, in the batch's time
   range (pushed down), that the bitmap lets through [nothing is shuffled];
   staged and counted while they are written: few in a daily load;
5. new rows = batch anti join possible matches [broadcast up to the limit,
   else a shuffled join with hot keys salted: a hash join while a task's share
   of the matches is bounded, else sort-merge], appended through one range
   shuffle of the wide rows; a large batch slice by slice in time, so that the
   shuffle files on disk are those of one slice;
6. report from registry and batch in one grouped sum (+ totals from the table)
   [checkpointed].

All staged files of a load are deleted at its end.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.columns import column
from meterlake.operators.bitmap import KEY_BITS, bit_words, in_words, key_number
from meterlake.operators.conform import combine_feeds, conform
from meterlake.operators.merge import (
    DEFAULT_BROADCAST_KEYS,
    TASK_KEYS,
    TimeBounds,
    bound_target,
    exact_time,
    insert_missing,
    insert_missing_salted,
    time_range,
)
from meterlake.operators.report import delivery_report, device_stats, join_totals, with_totals
from meterlake.operators.select import DEFAULT_BROADCAST_IDS, known_devices, registry_ids
from meterlake.schemas import CANONICAL_FEEDS, DayFeeds, Layout
from meterlake.scratch import checkpoint_dir, delete_path, scratch_path
from meterlake.sources.csv import day_inputs, has_event_feed, read_events, read_periodic, read_registry
from meterlake.sources.table import (
    TableSpec,
    device_counts,
    existing_folders,
    listing_session,
    most_folders,
    read_table,
    session_with,
    stored_folders,
    table_exists,
    write_rows,
)

log = logging.getLogger(__name__)

# Cells (rows x columns) of a batch that are shuffled at once; some 3 to 8 bytes
# each on disk. Each slice reads the staged batch twice (range sampling, write).
WRITE_CELLS = 1_500_000_000
# SESSION OPTION of the write: its shuffle files go when it is done, not at some garbage collection of the driver
_WRITE_OPTIONS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _stage(df: DataFrame, path: str, **seen: Column) -> tuple[DataFrame, dict]:
    """Written once as Parquet and read back with the same schema, and the
    aggregates ``seen`` of its rows, observed during the write."""
    observation = Observation()
    df.observe(observation, *[c.alias(n) for n, c in seen.items()]).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), observation.get


def target_keys(
    spark: SparkSession,
    spec: TableSpec,
    bounds: TimeBounds,
    folders: list[str] | None = None,
    device_ranges: DataFrame | None = None,
) -> DataFrame:
    """Keys of the stored rows of the folders that are in the batch's time
    range (and in a device's range)."""
    spark = listing_session(spark, spec)
    target = bound_target(read_table(spark, spec, keep_partition=True, folders=folders), spec.layout, bounds, device_ranges)
    return target.select(*[column(k) for k in spec.layout.key])


def possible_matches(keys: DataFrame, batch: DataFrame, layout: Layout, bits: int = KEY_BITS) -> DataFrame:
    """Target keys that the bitmap of the batch's key hashes lets through: all
    keys that the batch shares, and few others. Nothing is shuffled but the
    bitmap's words, at most ``bits / 64`` rows."""
    place = key_number(layout, bits)
    return in_words(keys, place, F.broadcast(bit_words(batch, place)))


def new_rows(
    batch: DataFrame, matches: DataFrame, n_matches: int, n_rows: int, layout: Layout, max_broadcast_keys: int
) -> DataFrame:
    """Rows of the (staged) batch whose key is not among the matches."""
    if n_matches == 0:
        return batch
    if n_matches <= max_broadcast_keys:
        return insert_missing(batch, matches, layout, "broadcast")
    tasks = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    strategy = "shuffle_hash" if n_matches <= TASK_KEYS * tasks else "merge"
    return insert_missing_salted(batch, matches, layout, n_rows, strategy=strategy)


def time_slices(batch: DataFrame, layout: Layout, parts: int) -> list[Column]:
    """Conditions that deal the rows into at most ``parts`` ranges of time of
    about equal row counts. Rows without a time are in the last one: a load
    that fails before it and is run again stores them once."""
    if parts < 2:
        return [F.lit(True)]
    time, dtype = column(layout.time), layout.type_of(layout.time)
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = F.transform(F.percentile_approx(time, shares), lambda t: exact_time(t, dtype))
    ends = [TimeBounds(c, c, dtype).low_literal() for c in dict.fromkeys(batch.agg(cuts.alias("cuts")).first()["cuts"] or [])]
    out = []
    for low, high in zip([None, *ends], [*ends, None]):
        above = F.lit(True) if low is None else time > low
        out.append(above & (time <= high) if high is not None else above | time.isNull())
    return out


def store_batch(
    rows: DataFrame,
    ids: DataFrame,
    spec: TableSpec,
    with_row_totals: bool = False,
    max_broadcast: int = DEFAULT_BROADCAST_IDS,
    max_broadcast_keys: int = DEFAULT_BROADCAST_KEYS,
    when_staged: Callable[[], None] | None = None,
) -> DataFrame:
    """Add to the table the rows of known devices whose key is not stored yet,
    and return the (materialized) report: device_id, listed, rows_stored
    [, rows_total]; the sum of ``listed`` is the registry's device count.

    ``rows`` must already have the table's layout; ``ids`` is a one-column
    frame of registry device ids. Safe to run again for the same batch:
    keyed rows are not duplicated. ``when_staged`` is called once ``rows`` and
    ``ids`` are staged: they are not read after that.
    """
    spark, lay = rows.sparkSession, spec.layout
    checkpoint_dir(spark)
    work = scratch_path(spark, "load")
    n = F.count(F.lit(1))
    try:
        registry, listed = _stage(ids.select(column(lay.device).alias(lay.device)), f"{work}/registry", n=n)
        known = known_devices(rows, registry, lay, listed["n"] <= max_broadcast, max_broadcast)
        exists = table_exists(spark, spec.path)
        time, dtype, folder = column(lay.time), lay.type_of(lay.time), spec.top_folder()
        seen = {"n": n, **time_range(time, time, dtype)}
        by_device = spec.partition_by == "device"
        if exists and folder is not None and not by_device and spec.fmt == "parquet":
            # at most the folders that the table has
            seen["folders"] = F.collect_set(F.when(folder.isin(existing_folders(spark, spec)), folder))
        batch, seen = _stage(known, f"{work}/batch", **seen)
        if when_staged is not None:
            when_staged()
        matches, n_matches = None, 0
        has_new = seen["n"] > 0
        if has_new and exists:
            bounds = TimeBounds(seen["lo"], seen["hi"], dtype)
            folders = sorted(seen["folders"]) if "folders" in seen else None
            if by_device and spec.fmt == "parquet":
                # a set of names per task and a list of literals would grow with the fleet
                folders = most_folders(spark, spec, batch.select(column(lay.device)))
            if folders and spec.partition_by == "bucket":
                inner = device_stats(batch.withColumn("_folder", spec.folder()), lay, by="_folder")
                folders = stored_folders(spark, spec, inner, "_folder")
            keys = target_keys(spark, spec, bounds, folders)
            matches, met = _stage(possible_matches(keys, batch, lay), f"{work}/matches", n=n)
            n_matches = met["n"]
            # without folders an empty write would leave an empty file
            if not spec.partition_columns and n_matches and new_rows(
                batch.select(*[column(k) for k in lay.key]), matches, n_matches, seen["n"], lay, max_broadcast_keys
            ).isEmpty():
                has_new = False
        if has_new:
            own = session_with(spark, _WRITE_OPTIONS).read.schema(batch.schema).parquet(f"{work}/batch")
            parts = -(-seen["n"] * len(lay.names) // WRITE_CELLS) if spec.partition_columns else 1
            slices = time_slices(batch, lay, parts)
            for part in slices:
                some, met, n_met = own, matches, n_matches
                if len(slices) > 1:
                    some = own.where(part)
                    met = met.where(part) if n_met else None
                    n_met = met.count() if n_met else 0
                write_rows(new_rows(some, met, n_met, seen["n"], lay, max_broadcast_keys), spec)
        report = delivery_report(registry, batch, lay).checkpoint(eager=True)
        if with_row_totals:
            report = _with_totals(spark, spec, report).checkpoint(eager=True)
        log.info("stored data from %d listed devices", listed["n"])
        return report
    finally:
        delete_path(spark, work)


def _with_totals(spark: SparkSession, spec: TableSpec, report: DataFrame) -> DataFrame:
    """The report with the stored rows of its devices, from folders that may
    hold a reporting one. One folder per device: from the files' footers (the
    folders that reach the driver are among those that the table has). With
    buckets: by a scan of the devices' buckets (at most ``spec.buckets`` numbers
    reach the driver)."""
    lay = spec.layout
    active = report.where(F.col("rows_stored") > 0)
    if spec.partition_by == "device" and spec.fmt == "parquet" and table_exists(spark, spec.path):
        folders = most_folders(spark, spec, active.select(column(lay.device)))
        return join_totals(report, device_counts(spark, spec, folders), lay)
    rows = read_table(spark, spec, keep_partition=True)
    if spec.partition_by == "bucket":
        used = active.select(spec.bucket_value(column(lay.device)).alias("bucket")).distinct().collect()
        rows = rows.where(F.col("bucket").isin([r["bucket"] for r in used]))
    return with_totals(report, rows, lay)


def load_day(spark: SparkSession, date: str, in_dir: str, spec: TableSpec, feeds: DayFeeds = CANONICAL_FEEDS):
    """(registry ids, combined conformed rows) of one delivery date."""
    paths = day_inputs(in_dir, date)
    ids = registry_ids(read_registry(spark, paths.registry, feeds.registry), spec.layout, feeds.registry_id)
    periodic = conform(read_periodic(spark, paths.periodic, feeds.periodic), feeds.periodic.mapping, spec.layout)
    events = None
    if has_event_feed(spark, paths.events, feeds.events):
        events = conform(read_events(spark, paths.events, feeds.events), feeds.events.mapping, spec.layout)
    else:
        log.info("event feed of %s unusable (missing columns or empty); periodic rows only", date)
    return ids, combine_feeds(periodic, events)


def ingest_day(
    spark: SparkSession,
    date: str,
    in_dir: str,
    spec: TableSpec,
    feeds: DayFeeds = CANONICAL_FEEDS,
    with_row_totals: bool = False,
    **kwargs,
) -> DataFrame:
    """Load one delivery date into the table; returns the report."""
    ids, rows = load_day(spark, date, in_dir, spec, feeds)
    report = store_batch(rows, ids, spec, with_row_totals=with_row_totals, **kwargs)
    log.info("stored data of %s", date)
    return report


def stored_rows(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """All stored rows in layout order."""
    return read_table(spark, spec).select(*[column(n) for n in spec.layout.names])
