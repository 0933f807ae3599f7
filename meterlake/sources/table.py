"""The measurement table: one path, partitioned, Parquet by default.

Layouts (``TableSpec.partition_by``):

* ``"month"`` (default) — directories by UTC month of the row time; files
  range-partitioned and sorted by (day, device, time, event). A daily load
  touches one or two months, and Parquet min/max statistics prune both a
  device read and the key scan of a merge.
* ``"day"`` — one directory per day (large fleets per day).
* ``"bucket"`` — month directories with ``buckets`` directories of devices
  (device modulo ``buckets``) inside: a device read opens one bucket a month,
  a daily load still one or two months.
* ``"device"`` — one directory per device, like one table per device;
  suits small fleets only (files grow with devices x loads).
* ``None`` — unpartitioned, still sorted.

``TableSpec.order="zorder"`` (month layout) sorts by a space-filling
key of device and day instead of by day first. A file then holds some devices
on some days, so a device read and a one-day read both open only part of a
backfilled month's files; a load of a single day is ordered by device either
way.

Partition values never become Python dates: folders are named and matched as
text that Spark makes, so any timestamp Spark can hold can be stored.

A Parquet path has no transaction log: concurrent writers to one table are
not isolated from each other. ``fmt="delta"`` may be passed where the Delta
package is on the class path; the operators do not change.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.columns import column, day_of
from meterlake.schemas import CANONICAL_LAYOUT, Layout
from meterlake.scratch import checkpoint_dir

log = logging.getLogger(__name__)

# bits of each side of the space-filling key; 32 cells hold a month's days
Z_BITS = 5
_GRAINS = ("month", "day", "bucket", "device", None)
# FIXED VALUE: folder value of a null partition
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class TableSpec:
    path: str
    layout: Layout = CANONICAL_LAYOUT
    partition_by: str | None = "month"
    fmt: str = "parquet"
    buckets: int = 16
    order: str = "time"

    def __post_init__(self):
        if self.order not in ("time", "zorder"):
            raise ValueError(f"order must be 'time' or 'zorder', got {self.order!r}")
        if self.order == "zorder" and self.partition_by != "month":
            raise ValueError("order='zorder' is for the month layout")
        if self.partition_by not in _GRAINS:
            raise ValueError(f"partition_by must be one of {_GRAINS}, got {self.partition_by!r}")

    @property
    def partition_columns(self) -> list[str]:
        """Names of the directory columns, outermost first."""
        if self.partition_by == "device":
            return [self.layout.device]
        return [f.name for f in self.derived_fields]

    @property
    def derived_fields(self) -> list[T.StructField]:
        """Directory columns that are not columns of the layout."""
        names = {"month": ["month"], "day": ["day"], "bucket": ["month", "bucket"]}.get(self.partition_by, [])
        return [T.StructField(n, T.IntegerType() if n == "bucket" else T.DateType(), True) for n in names]

    def time_value(self, time: Column) -> Column:
        """Value of the month or day directory of a row time."""
        day = day_of(time, self.layout.type_of(self.layout.time))
        return day if self.partition_by == "day" else F.trunc(day, "month")

    def bucket_value(self, device: Column) -> Column:
        return F.pmod(device, F.lit(self.buckets)).cast("int")

    def derived_values(self) -> dict[str, Column]:
        """Directory columns computed from a row."""
        time, device = column(self.layout.time), column(self.layout.device)
        return {
            f.name: self.bucket_value(device) if f.name == "bucket" else self.time_value(time)
            for f in self.derived_fields
        }

    def folder(self) -> Column | None:
        """Folder of a row below the table's path, as text; None where the
        layout has no folders of its own (device and unpartitioned)."""
        parts = [
            F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit(_NULL_FOLDER)))
            for name, value in self.derived_values().items()
        ]
        return F.concat_ws("/", *parts) if parts else None

    def top_folder(self) -> Column | None:
        """Name of a row's outermost folder; None without folders."""
        if self.partition_by == "device":
            return F.concat(F.lit(f"{self.layout.device}="), F.coalesce(column(self.layout.device).cast("string"), F.lit(_NULL_FOLDER)))
        whole = self.folder()
        return None if whole is None else F.substring_index(whole, "/", 1)

    @property
    def storage_schema(self) -> T.StructType:
        return T.StructType(list(self.layout.schema.fields) + self.derived_fields)


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when the path holds data; an absent or empty folder means "new".

    File-system errors are raised, never read as "absent": treating a failed
    probe as a new table could replace stored rows.
    """
    fs, hpath = _hadoop_fs(spark, path)
    if not fs.exists(hpath):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(hpath))


def _child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders in a path, in one text: a call to the
    JVM per name takes seconds for some thousand folders."""
    fs, root = _hadoop_fs(spark, path)
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(root))
    if not len(found):
        return []
    above = f"{found[0].getParent().toString()}/"
    names = jvm.org.apache.commons.lang3.ArrayUtils.toString(found)[1 + len(above) : -1].split(f",{above}")
    return [n for n in names if "=" in n and not n.startswith(("_", "."))]


def existing_folders(spark: SparkSession, spec: TableSpec) -> list[str]:
    """Names of the table's outermost folders."""
    return _child_folders(spark, spec.path)


def stored_folders(spark: SparkSession, spec: TableSpec, wanted: DataFrame, name: str) -> list[str]:
    """Those of the wanted folders (text column ``name``) that the table has.

    The table's own listing is matched with the wanted names in Spark, one
    directory level at a time, so what reaches the driver is bounded by the
    folders that exist.
    """
    found = [""]
    for depth in range(1, len(spec.partition_columns) + 1):
        existing = [
            "/".join(filter(None, (above, child)))
            for above in found
            for child in _child_folders(spark, "/".join(filter(None, (spec.path, above))))
        ]
        if not existing:
            return []
        level = wanted.select(F.substring_index(F.col(name), "/", depth).alias("_folder")).distinct()
        have = spark.createDataFrame([(e,) for e in existing], "_folder string")
        found = sorted(r["_folder"] for r in have.join(level, "_folder", "left_semi").collect())
    return found


# SESSION OPTION: tasks of a listing; Spark's default is a task per folder, up to 10,000
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_WAVES = 4  # listing tasks per core, with a folder per device


def session_with(spark: SparkSession, options: dict[str, str]) -> SparkSession:
    """A session of its own on the same context with the caller's options, then
    the given ones; the caller's stay as they are."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **options}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def listing_session(spark: SparkSession, spec: TableSpec) -> SparkSession:
    """The session to open the table with for a load's own scans: with a folder
    per device, one that lists many folders in each task."""
    if spec.partition_by != "device" or spec.fmt != "parquet":
        return spark
    return session_with(spark, {_LISTING: str(LISTING_WAVES * spark.sparkContext.defaultParallelism)})


def most_folders(spark: SparkSession, spec: TableSpec, wanted: DataFrame) -> list[str] | None:
    """Device layout: ``stored_folders`` of the wanted devices (first column),
    or None (all) where they are half of the table's folders or more: one walk
    over the table is then cheaper than a check of each path in the driver."""
    names = wanted.select(column(wanted.columns[0]).alias(spec.layout.device)).distinct().select(spec.top_folder().alias("_folder"))
    found = stored_folders(spark, spec, names, "_folder")
    return None if found and 2 * len(found) >= len(existing_folders(spark, spec)) else found


def read_table(
    spark: SparkSession, spec: TableSpec, keep_partition: bool = False, folders: list[str] | None = None
) -> DataFrame:
    """Open the table with its explicit schema (partition values are not
    re-inferred), columns in layout order. An absent table reads as empty.

    ``folders``: the only folders to open (see ``stored_folders``), so opening
    stays cheap however long the table's history is. Parquet only.
    """
    names = spec.layout.names + ([f.name for f in spec.derived_fields] if keep_partition else [])
    columns = [column(n) for n in names]
    if not table_exists(spark, spec.path) or folders == []:
        return spark.createDataFrame([], spec.storage_schema).select(*columns)
    reader = spark.read.format(spec.fmt)
    if spec.fmt != "parquet":
        return reader.load(spec.path).select(*columns)
    reader = reader.schema(spec.storage_schema)
    if folders is not None and spec.partition_columns:
        paths = [f"{spec.path.rstrip('/')}/{f}" for f in folders]
        return reader.option("basePath", spec.path).load(paths).select(*columns)
    return reader.load(spec.path).select(*columns)


def read_device(
    spark: SparkSession,
    spec: TableSpec,
    device_id: int,
    ordered: bool = False,
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Rows of one device, optionally from ``start`` to ``end`` (both
    included). Device and bucket layouts open only folders of the device,
    time layouts only folders of the period; within files the filters are
    pushed down and files are sorted by device and time."""
    lay = spec.layout
    rows = read_table(spark, spec, keep_partition=True).where(column(lay.device) == F.lit(device_id))
    if spec.partition_by == "bucket":
        rows = rows.where(F.col("bucket") == spec.bucket_value(F.lit(device_id).cast("long")))
    time = column(lay.time)
    folder = next((F.col(f.name) for f in spec.derived_fields if f.name != "bucket"), None)
    for bound, keeps in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is not None:
            rows = rows.where(keeps(time, bound))
            if folder is not None:
                rows = rows.where(keeps(folder, spec.time_value(bound)))
    rows = rows.select(*[column(n) for n in lay.names])
    if ordered:
        rows = rows.orderBy(time.asc_nulls_first(), column(lay.event).asc_nulls_first())
    return rows


def read_devices(spark: SparkSession, spec: TableSpec, ids: DataFrame, max_broadcast: int = 1_000_000) -> DataFrame:
    """Rows of all devices listed in ``ids`` (first column; repeats and nulls
    do not matter), in one scan.

    Up to ``max_broadcast`` counted ids are broadcast. In the bucket and device
    layouts the join is on the folder column too, so Spark opens only folders
    that some id falls in (dynamic partition pruning); in the others the ids
    meet the rows. More ids are joined by a shuffle.
    """
    lay = spec.layout
    wanted = ids.select(column(ids.columns[0]).cast("long").alias("_device")).where("_device IS NOT NULL").distinct()
    checkpoint_dir(spark)
    wanted = wanted.checkpoint(eager=True)
    rows = read_table(spark, spec, keep_partition=True)
    match = column(lay.device) == F.col("_device")
    # pruning is planned only for a filtered list; the bounds leave all of it
    if spec.partition_by == "bucket":
        wanted = wanted.withColumn("_bucket", spec.bucket_value(F.col("_device"))).where(F.col("_bucket") < spec.buckets)
        match = match & (F.col("bucket") == F.col("_bucket"))
    elif spec.partition_by == "device":
        low, high = wanted.agg(F.min("_device"), F.max("_device")).first()
        wanted = wanted.where(F.col("_device").between(low, high)) if low is not None else wanted
    if wanted.count() <= max_broadcast:
        wanted = F.broadcast(wanted)
    return rows.join(wanted, match, "left_semi").select(*[column(n) for n in lay.names])


# SESSION OPTIONS of the footer reads: Spark's newer Parquet reader, and counts from footers
_FOOTER_OPTIONS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def device_counts(spark: SparkSession, spec: TableSpec, folders: list[str] | None = None) -> DataFrame:
    """(device, n_rows) of the stored rows, of all folders or of the given
    ones (see ``stored_folders``); a device without rows has no row.

    In the device layout a folder holds one device, so Spark adds up the row
    counts of the files' footers and reads no column. Its reader for this is
    chosen by session options; they are set on a session of its own, which
    shares the context, and the caller's stay as they are. Other layouts
    and formats scan the device column.
    """
    if spec.partition_by == "device" and spec.fmt == "parquet" and folders != []:
        spark = session_with(listing_session(spark, spec), _FOOTER_OPTIONS)
    rows = read_table(spark, spec, folders=folders)
    return rows.groupBy(column(spec.layout.device)).agg(F.count(F.lit(1)).alias("n_rows"))


def sort_keys(spec: TableSpec) -> list[Column]:
    """Clustering of stored rows: directory columns first (the writer keeps an
    order only if it starts with them), then day, device, time, event (nulls
    first, so a periodic row precedes the events of its instant)."""
    lay = spec.layout
    time = column(lay.time)
    keys = [column(n) for n in spec.partition_columns]
    if spec.partition_by in ("month", None):
        keys.append(day_of(time, lay.type_of(lay.time)))
    if spec.partition_by != "device":
        keys.append(column(lay.device))
    return [k.asc_nulls_first() for k in [*keys, time, column(lay.event)]]


def device_splits(rows: DataFrame, spec: TableSpec) -> list[int]:
    """At most 2**Z_BITS - 1 device ids that cut the rows into about equal
    shares. One pass over the device column; only the ids reach the driver."""
    cells = 1 << Z_BITS
    shares = F.array(*[F.lit(i / cells) for i in range(1, cells)])
    cuts = rows.agg(F.percentile_approx(column(spec.layout.device), shares).alias("cuts")).first()["cuts"]
    return sorted(set(cuts or []))


def z_value(spec: TableSpec, splits: list[int]) -> Column:
    """Space-filling key: the bits of the day of the month and of the device's
    share in turn, the day's first. A null counts as zero."""
    lay = spec.layout
    time, device = column(lay.time), column(lay.device)
    day = F.coalesce(F.dayofmonth(day_of(time, lay.type_of(lay.time))), F.lit(0))
    share = F.lit(0)
    for cut in splits:
        share = share + F.when(device > F.lit(cut), 1).otherwise(0)
    key = F.lit(0)
    for bit in range(Z_BITS):
        for side, value in ((0, share), (1, day)):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(value, bit).bitwiseAND(F.lit(1)), 2 * bit + side))
    return key


def warn_of_timestamps(spark: SparkSession, layout: Layout) -> None:
    """INT96 timestamps have no min/max statistics, so time filters on the
    table could not skip row groups; the setting is the session owner's."""
    key = "spark.sql.parquet.outputTimestampType"
    if isinstance(layout.type_of(layout.time), T.TimestampType) and spark.conf.get(key) == "INT96":
        log.warning("set %s to TIMESTAMP_MICROS for row-group pruning by time", key)


# WRITE OPTIONS of the device layout, for tables on a local or mounted file system
# (file:). Hadoop starts a process (chmod) for each file it creates there, and a
# second one for the file's checksum file: most of the time of a file per device.
_FILE_PER_DEVICE = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_rows(rows: DataFrame, spec: TableSpec, mode: str = "append") -> None:
    """Store rows in layout order, clustered by ``sort_keys``.

    Range partitioning on the sort keys splits a hot device over several tasks
    by time instead of sending it to one task, and gives each file a narrow
    key range. The partition count is left to the session (AQE coalesces
    small ranges).
    """
    lay = spec.layout
    warn_of_timestamps(rows.sparkSession, lay)
    out = rows
    if [(f.name, f.dataType) for f in rows.schema.fields] != [(f.name, f.dataType) for f in lay.schema.fields]:
        out = rows.select(*[column(n).cast(lay.type_of(n)).alias(n) for n in lay.names])
    # a deterministic row hash, computed once, ends the range key: rows sharing
    # one key (e.g. a stuck meter clock) still spread over tasks, and a retried
    # task sends every row to the same range as before (unlike rand())
    helpers = {"_row_hash": F.xxhash64(*[column(n) for n in lay.names])}
    keys = [*sort_keys(spec), F.col("_row_hash").asc()]
    if spec.order == "zorder":
        helpers["_z"] = z_value(spec, device_splits(out, spec))
        keys.insert(len(spec.partition_columns), F.col("_z").asc())
    out = out.withColumns({**spec.derived_values(), **helpers})
    out = out.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*helpers)
    writer = out.write.format(spec.fmt).mode(mode)
    if spec.partition_columns:
        writer = writer.partitionBy(*spec.partition_columns)
    if spec.partition_by == "device" and spec.fmt == "parquet":
        writer = writer.options(**_FILE_PER_DEVICE)
    writer.save(spec.path)


def create_table(rows: DataFrame, spec: TableSpec) -> None:
    """First write of a table; fails if the path already holds data, by the
    same rule as ``table_exists`` (a new table never overwrites another, an
    empty folder may become one)."""
    if table_exists(rows.sparkSession, spec.path):
        raise FileExistsError(f"{spec.path} already holds data")
    write_rows(rows, spec)


def ensure_schema(spark: SparkSession, name: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``; tables themselves are addressed by path."""
    if not name.replace("_", "").isalnum():
        raise ValueError(f"invalid schema name {name!r}")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")
