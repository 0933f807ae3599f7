"""Plan shape: joins are hash-based on the full key, nothing pairs rows, and
the number of Spark jobs of a load does not grow with the number of devices."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meterlake.operators import TimeBounds, insert_missing, known_devices, registry_ids
from meterlake.plans import roles
from meterlake.plans.ingest import ingest_day
from meterlake.sources import TableSpec
from tests.conftest import SF_SMALL
from tests.feeds import write_day

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_known_devices_is_broadcast_semi_join(spark):
    rows = roles.combined_rows(spark, SF_SMALL)
    plan = _plan(known_devices(rows, roles.supplier_ids(spark, SF_SMALL), roles.NARROW))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert not any(b in plan for b in BAD)


def test_known_devices_large_registry_is_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = roles.combined_rows(spark, SF_SMALL)
        ids = roles.supplier_ids(spark, SF_SMALL)
        plan = _plan(known_devices(rows, ids, roles.NARROW, max_broadcast=3))
        assert "BroadcastHashJoin" not in plan and "LeftSemi" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_registry_narrowed_to_batch_devices_is_broadcast(spark):
    rows = roles.combined_rows(spark, SF_SMALL)
    ids = roles.customer_ids(spark, SF_SMALL)  # 150 ids, over the limit of 40
    kept = known_devices(rows, ids, roles.NARROW, max_broadcast=40)
    plan = _plan(kept)
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert kept.count() == rows.join(ids, "device_id", "left_semi").count()


def test_anti_join_on_full_null_safe_key(spark):
    rows = roles.combined_rows(spark, SF_SMALL)
    for strategy, op in (("merge", "SortMergeJoin"), ("broadcast", "BroadcastHashJoin")):
        plan = _plan(insert_missing(rows, rows, roles.NARROW, strategy))
        assert op in plan and "LeftAnti" in plan
        assert "isnull(event_id" in plan  # null-safe part of the key
        assert not any(b in plan for b in BAD)


def test_merge_strategy_shuffles_on_all_key_columns(spark):
    rows = roles.combined_rows(spark, SF_SMALL)
    plan = _plan(insert_missing(rows, rows, roles.NARROW, "merge"))
    exchanges = [line.split("hashpartitioning(")[1].split(")")[0] for line in plan.splitlines() if "hashpartitioning(" in line]
    # never the device alone: at least (device, time) plus the partition count
    assert exchanges and all(len(e.split(",")) >= 3 for e in exchanges)


def test_registry_ids_drop_nulls(spark):
    reg = spark.createDataFrame([(1,), (None,)], "id long")
    assert [r.device_id for r in registry_ids(reg, roles.NARROW).collect()] == [1]


def _jobs_for(spark, in_dir, date, path):
    group = f"jobs-{date}-{os.path.basename(path)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        ingest_day(spark, date, in_dir, TableSpec(path))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_job_count_does_not_grow_with_devices(spark, tmp_dir):
    few = [(i, i % 2, "2024-03-01 00:10:00", i) for i in range(4)]
    many = [(i, i % 40, "2024-03-01 00:10:00", i) for i in range(80)]
    write_day(tmp_dir, "few", devices=[0, 1], periodic_rows=few, event_rows=[(0, 1, "2024-03-01 00:00:00", 1)])
    write_day(tmp_dir, "many", devices=list(range(40)), periodic_rows=many, event_rows=[(0, 1, "2024-03-01 00:00:00", 1)])
    n_few = _jobs_for(spark, tmp_dir, "few", os.path.join(tmp_dir, "t1"))
    n_many = _jobs_for(spark, tmp_dir, "many", os.path.join(tmp_dir, "t2"))
    assert n_few == n_many


def test_a_load_takes_few_jobs(spark, tmp_dir):
    rows = [(i, i % 4, f"2024-03-01 00:{i:02d}:00", i) for i in range(20)]
    write_day(tmp_dir, "d", devices=[0, 1, 2, 3], periodic_rows=rows, event_rows=[(0, 1, "2024-03-01 00:00:00", 1)])
    path = os.path.join(tmp_dir, "t")
    first, both = _jobs_for(spark, tmp_dir, "d", path), _jobs_for(spark, tmp_dir, "d", path)  # one job group
    assert (first <= 11 and both - first <= 15), (first, both - first)


@pytest.mark.parametrize("partition_by", ["month", "bucket"])
def test_target_scan_is_pruned(spark, tmp_dir, partition_by):
    from meterlake.operators import TimeBounds, device_stats
    from meterlake.plans.ingest import target_keys
    from meterlake.sources import read_table, write_rows
    from meterlake.sources.table import stored_folders

    spec = TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW, partition_by, buckets=3)
    known = roles.known_rows(spark, SF_SMALL)
    write_rows(known, spec)
    # a batch of March 1996 plus one stray row of 2024: two months, not 28 years
    lo, hi = F.lit("1996-03-01").cast("timestamp_ntz"), F.lit("1996-03-31").cast("timestamp_ntz")
    stray = (F.col("device_id") == 7) & F.col("event_id").isNotNull() & (F.col("timestamp") < F.lit("2024-01-05").cast("timestamp_ntz"))
    batch = known.where(F.col("timestamp").between(lo, hi) | stray)
    stats = device_stats(batch.withColumn("_folder", spec.folder()), roles.NARROW, by="_folder")
    folders = stored_folders(spark, spec, stats, "_folder")
    assert set(folders) == {r._folder for r in stats.select("_folder").distinct().collect()}
    assert {f.split("/")[0] for f in folders} == {"month=1996-03-01", "month=2024-01-01"}
    opened = read_table(spark, spec, keep_partition=True, folders=folders)
    assert 0 < len(opened.inputFiles()) < len(read_table(spark, spec).inputFiles())
    t = F.min("timestamp").cast("string"), F.max("timestamp").cast("string")
    bounds = TimeBounds(*batch.agg(*t).first(), dtype=roles.NARROW.type_of("timestamp"))
    keys = target_keys(spark, spec, bounds, folders, device_ranges=stats)
    plan = _plan(keys)
    assert "GreaterThanOrEqual(timestamp" in plan and "LeftSemi" in plan
    assert keys.count() == batch.count() > 0  # every batch key is still in the bounded target


def test_the_wide_rows_are_shuffled_once(spark, tmp_dir):
    """With a target too large for any broadcast of its keys, only the few
    shared keys are broadcast, and the write's range shuffle is the only one
    that moves the measures."""
    from meterlake.plans import ingest
    from meterlake.sources import write_rows

    spec = TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW)
    known = roles.known_rows(spark, SF_SMALL)
    write_rows(known.where("device_id < 4"), spec)
    seen = {}

    def spy(rows, spec_, mode="append"):
        keys = [F.col("device_id").asc(), F.col("timestamp").asc()]
        seen["plan"] = _plan(rows.repartitionByRange(*keys))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    before, ingest.write_rows = ingest.write_rows, spy
    try:
        ingest.store_batch(known, roles.supplier_ids(spark, SF_SMALL), spec)
    finally:
        ingest.write_rows = before
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in seen["plan"].splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert len(moved) == 1 and "rangepartitioning" in moved[0]
    assert "BroadcastHashJoin" in seen["plan"] and "LeftAnti" in seen["plan"]


@pytest.mark.parametrize("partition_by", ["month", "day", "bucket", "device", None])
def test_files_are_in_key_order(spark, tmp_dir, partition_by):
    from meterlake.sources import write_rows

    spec = TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW, partition_by, buckets=2)
    rows = roles.known_rows(spark, SF_SMALL).where("device_id < 6 AND year(timestamp) IN (1996, 2024)")
    write_rows(rows, spec)
    files = [os.path.join(d, f) for d, _, names in os.walk(spec.path) for f in names if f.endswith(".parquet")]
    checked = 0
    for f in files:
        # the directory's device is not in the file
        names = [n for n in ("device_id", "timestamp", "event_id") if not (n == "device_id" and partition_by == "device")]
        own = [tuple(-1 if v is None else v for v in r) for r in zip(*(c.to_pylist() for c in pq.ParquetFile(f).read(names)), strict=True)]
        keys = [r if partition_by in ("device", "bucket", "day") else (r[1].date(), *r) for r in own]
        if partition_by == "bucket":
            keys = [(r[0], r[1], r[2]) for r in own]
        assert keys == sorted(keys)
        checked += len(keys) > 2
    assert checked >= (1 if partition_by is None else 3)


def _months_files(spark, path, order):
    """A month of 64 devices, an hourly row each, in files of 1,000 rows."""
    from meterlake.sources import write_rows

    rows = spark.range(0, 31 * 24 * 64).select(
        (F.col("id") % 64 * 1000).alias("device_id"),
        F.expr("timestamp_ntz'2024-03-01' + make_dt_interval(0, CAST(id div 64 AS INT))").alias("timestamp"),
    )
    rows = rows.unionByName(  # a null time and years out of the common
        spark.sql("SELECT 5000L AS device_id, EXPLODE(ARRAY(NULL, timestamp_ntz'0001-01-31', timestamp_ntz'9999-12-31')) AS timestamp")
    )
    rows = rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in roles.NARROW.schema.fields
    ])
    spec = TableSpec(path, roles.NARROW, order=order)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "1000")
    try:
        write_rows(rows, spec)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    folder = os.path.join(path, "month=2024-03-01")
    return rows, spec, [os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet")]


def _share_that_may_hold(files, name, low, high):
    """Share of row groups whose statistics overlap low to high."""
    hit = total = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(name)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= high and stats.max >= low
    return hit / total


def test_zorder_bounds_device_and_day_reads_of_a_month(spark, tmp_dir):
    import datetime as dt

    from meterlake.sources import read_device, read_table

    shares = {}
    for order in ("time", "zorder"):
        rows, spec, files = _months_files(spark, os.path.join(tmp_dir, order), order)
        assert len(files) >= 40
        devices = [_share_that_may_hold(files, "device_id", d, d) for d in range(0, 64_000, 1000)]
        days = [
            _share_that_may_hold(files, "timestamp", dt.datetime(2024, 3, d), dt.datetime(2024, 3, d, 23, 59)) for d in range(1, 32)
        ]
        shares[order] = max(devices), max(days)
        assert read_table(spark, spec).exceptAll(rows).isEmpty() and rows.exceptAll(read_table(spark, spec)).isEmpty()
        assert read_device(spark, spec, 5000).count() == 31 * 24 + 3
    assert shares["zorder"][0] <= 0.35 and shares["zorder"][1] <= 0.35
    assert shares["time"][0] > 0.6  # by day first, nearly every day's files may hold the device


def test_zorder_is_for_the_month_layout():
    with pytest.raises(ValueError):
        TableSpec("t", partition_by="device", order="zorder")
    with pytest.raises(ValueError):
        TableSpec("t", order="hilbert")


def test_loads_into_a_zorder_table_are_safe_to_repeat(spark, tmp_dir):
    from meterlake.sources import read_table

    stored = {}
    for order in ("time", "zorder"):
        in_dir = os.path.join(tmp_dir, f"in-{order}")
        spec = TableSpec(os.path.join(tmp_dir, f"t-{order}"), roles.NARROW, order=order)
        roles.write_day(spark, SF_SMALL, in_dir, roles.DAY_A)
        for _ in range(2):
            ingest_day(spark, roles.DAY_A[0], in_dir, spec, roles.NARROW_FEEDS)
        stored[order] = sorted(map(repr, read_table(spark, spec).collect()))
    assert stored["time"] == stored["zorder"] and stored["time"]


def test_device_read_opens_its_bucket_and_period(spark, tmp_dir):
    from meterlake.sources import read_device, read_table, write_rows

    spec = TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW, "bucket", buckets=5)
    known = roles.known_rows(spark, SF_SMALL)
    write_rows(known, spec)

    whole = len(read_table(spark, spec).inputFiles())
    one = read_device(spark, spec, 7)
    start, end = F.lit("1996-03-05").cast("timestamp_ntz"), F.lit("1996-04-02").cast("timestamp_ntz")
    period = read_device(spark, spec, 7, start=start, end=end)
    assert {f.split("bucket=")[1].split("/")[0] for f in _opened(one)} == {"2"}
    assert {f.split("month=")[1].split("/")[0] for f in _opened(period)} <= {"1996-03-01", "1996-04-01"}
    assert len(_opened(one)) < whole / 2
    assert one.count() == known.where("device_id = 7").count() > 0
    assert period.count() == known.where((F.col("device_id") == 7) & F.col("timestamp").between(start, end)).count() > 0


@pytest.mark.parametrize("partition_by", ["bucket", "device", "month"])
def test_read_of_many_devices_opens_their_folders(spark, tmp_dir, partition_by):
    from meterlake.sources import read_devices, write_rows

    spec = TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW, partition_by, buckets=5)
    known = roles.known_rows(spark, SF_SMALL)
    write_rows(known, spec)
    ids = spark.createDataFrame([(2,), (7,), (7,), (None,), (10**6,)], "id long")
    want = known.where("device_id IN (2, 7)").count()
    for limit in (10, 0):
        got = read_devices(spark, spec, ids, max_broadcast=limit)
        assert got.count() == want > 0
    assert read_devices(spark, spec, ids.where("id < 0")).count() == 0
    few = read_devices(spark, spec, ids)
    assert ("dynamicpruning" in _plan(few)) == (partition_by != "month")
    # 2 and 7 share bucket 2
    if partition_by == "bucket":
        assert {f.split("bucket=")[1].split("/")[0] for f in _opened(few)} == {"2"}


def _opened(df):
    """Files that rows come from (partition filters applied)."""
    return [r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect()]


def test_read_device_is_partition_or_pushed_filter(spark, tmp_dir):
    from meterlake.sources import read_device, write_rows

    known = roles.known_rows(spark, SF_SMALL)
    by_device = TableSpec(os.path.join(tmp_dir, "d"), roles.NARROW, partition_by="device")
    by_month = TableSpec(os.path.join(tmp_dir, "m"), roles.NARROW)
    write_rows(known, by_device)
    write_rows(known, by_month)
    plan_d = _plan(read_device(spark, by_device, 7))
    plan_m = _plan(read_device(spark, by_month, 7))
    assert "PartitionFilters: [isnotnull(device_id" in plan_d and "= 7)" in plan_d
    assert "EqualTo(device_id,7)" in plan_m
    want = known.where("device_id = 7").count()
    assert read_device(spark, by_device, 7).count() == read_device(spark, by_month, 7).count() == want > 0


@pytest.mark.parametrize("partition_by", ["device", "bucket", "month", None])
def test_device_counts_come_from_footers_where_a_folder_is_a_device(spark, tmp_dir, partition_by):
    from meterlake.sources import device_counts, write_rows

    spec = TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW, partition_by, buckets=3)
    assert device_counts(spark, spec).count() == 0
    known = roles.known_rows(spark, SF_SMALL)
    write_rows(known, spec)
    write_rows(known, spec)  # several files a device
    options = ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")
    before = [spark.conf.get(o) for o in options]
    counted = device_counts(spark, spec)
    want = {r.device_id: 2 * r["count"] for r in known.groupBy("device_id").count().collect()}
    assert {r.device_id: r.n_rows for r in counted.collect()} == want and want
    assert ("PushedAggregation: [COUNT(*)]" in _plan(counted)) == (partition_by == "device")
    # the caller's session keeps its options, also where its frames meet the counts
    assert [spark.conf.get(o) for o in options] == before
    met = known.select("device_id").distinct().join(counted, "device_id")
    assert ("PushedAggregation: [COUNT(*)]" in _plan(met)) == (partition_by == "device")
    assert {r.device_id: r.n_rows for r in met.collect()} == want
    if partition_by == "device":
        some = device_counts(spark, spec, ["device_id=2", "device_id=7"])
        assert {r.device_id: r.n_rows for r in some.collect()} == {d: n for d, n in want.items() if d in (2, 7)}
        assert device_counts(spark, spec, []).count() == 0


def test_device_folders_are_listed_in_few_tasks(spark, tmp_dir):
    """Neither a task nor a literal nor a JVM call per device folder: a load
    into a folder per device opens the table by one short listing."""
    from meterlake.plans import ingest
    from meterlake.sources import table, write_rows

    n, sc = 300, spark.sparkContext
    spec = TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW, partition_by="device")
    rows = spark.range(n).selectExpr(
        "id AS device_id", "timestamp_ntz'2024-01-01' AS timestamp", "id AS event_id", "1D AS qty", "1D AS price", "1D AS value", "'a' AS status"
    )
    write_rows(rows, spec)
    assert sorted(table.existing_folders(spark, spec)) == sorted(f"device_id={i}" for i in range(n))
    assert table.most_folders(spark, spec, rows.select("device_id")) is None
    assert table.most_folders(spark, spec, rows.selectExpr("device_id + 297")) == ["device_id=297", "device_id=298", "device_id=299"]
    assert table.most_folders(spark, spec, rows.selectExpr("device_id + 500")) == []
    bounds = TimeBounds("2024-01-01 00:00:00", "2024-01-02 00:00:00", roles.NARROW.type_of("timestamp"))
    for folders in (None, [f"device_id={i}" for i in range(n - 1)]):
        sc.setJobGroup(f"listing-{folders is None}-{tmp_dir}", "listing")
        try:
            keys = ingest.target_keys(spark, spec, bounds, folders)
            tracker = sc.statusTracker()
            jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"listing-{folders is None}-{tmp_dir}")]
            tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        assert tasks and max(tasks) <= table.LISTING_WAVES * sc.defaultParallelism < n - 1
        assert keys.count() == (n if folders is None else n - 1)


def test_two_loads_into_device_folders(spark, tmp_dir):
    from meterlake.plans import ingest

    spec = TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW, partition_by="device")
    rows, ids = roles.known_rows(spark, SF_SMALL), roles.supplier_ids(spark, SF_SMALL)
    some = rows.where("device_id < 4 AND event_id IS NULL")
    ingest.store_batch(some, ids, spec)
    for batch in (some.where("device_id = 2"), rows):  # few of the folders, then all
        report = ingest.store_batch(batch, ids, spec, with_row_totals=True)
        want = {r.device_id: r["count"] for r in ingest.stored_rows(spark, spec).groupBy("device_id").count().collect()}
        active = {r.device_id for r in batch.select("device_id").distinct().collect()}
        assert {r.device_id: r.rows_total for r in report.collect() if r.rows_total is not None} == {d: want[d] for d in active}
    added = rows.exceptAll(some).join(some.select("device_id", "timestamp"), ["device_id", "timestamp"], "left_anti")
    assert ingest.stored_rows(spark, spec).exceptAll(some).where("event_id IS NULL").count() == added.where("event_id IS NULL").count()


def test_wide_feed_files_are_packed_and_bounded(spark, tmp_dir):
    """A delivery of the wide feeds takes far less than its text, in files of
    a bounded number of lines, and reads back whole."""
    import glob

    from meterlake.schemas import PERIODIC_FEED
    from meterlake.sources.csv import day_inputs, read_periodic

    whole = ("d", (None, None), (None, None))
    roles.write_full_day(spark, SF_SMALL, tmp_dir, whole)
    path = day_inputs(tmp_dir, "d").periodic
    files = glob.glob(os.path.join(path, "part-*"))
    n = roles.table(spark, SF_SMALL, "lineitem").count()
    assert files and all(f.endswith(".gz") for f in files) and len(files) >= n / roles._PACKED["maxRecordsPerFile"]
    assert sum(map(os.path.getsize, files)) < 700 * n
    assert read_periodic(spark, path, PERIODIC_FEED).count() == n


def test_canonical_inputs_are_deleted_once_stored(spark, monkeypatch):
    from meterlake.plans import queries

    made = []

    def write(spark, sf_dir, in_dir, day):
        made.append(in_dir.removeprefix("file:"))
        assert not any(map(os.path.exists, made))
        os.makedirs(made[-1])
        return day[0]

    monkeypatch.setattr(queries.roles, "write_full_day", write)
    monkeypatch.setattr(queries, "ingest_day", lambda *args, **kwargs: None)
    queries.q_ingest_canonical(spark, SF_SMALL)
    assert len(made) == 2 and not any(map(os.path.exists, made))


def test_canonical_feeds_are_packed_closer_and_read_whole(spark, tmp_dir):
    import glob

    from meterlake.plans import queries
    from meterlake.schemas import PERIODIC_FEED
    from meterlake.sources.csv import day_inputs, has_event_feed, read_periodic

    whole = ("d", (None, None), (None, None))
    sizes = {}
    for name, packed in (("gzip", roles._PACKED), ("zstd", roles.ZSTD_PACKED)):
        roles.write_full_day(spark, SF_SMALL, f"{tmp_dir}/{name}", whole, packed)
        sizes[name] = sum(map(os.path.getsize, glob.glob(f"{day_inputs(f'{tmp_dir}/{name}', 'd').periodic}/part-*")))
    assert sizes["zstd"] < sizes["gzip"] / 3
    paths = day_inputs(f"{tmp_dir}/zstd", "d")
    assert all(f.endswith(".zstd") for p in (paths.periodic, paths.events) for f in glob.glob(f"{p}/part-*"))
    gzip = read_periodic(spark, day_inputs(f"{tmp_dir}/gzip", "d").periodic, PERIODIC_FEED)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")  # far less than a file: none is split
    try:
        zstd = read_periodic(spark, paths.periodic, PERIODIC_FEED)
        assert zstd.count() == gzip.count() and zstd.exceptAll(gzip).isEmpty()
        assert has_event_feed(spark, paths.events) and not has_event_feed(spark, paths.periodic)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    read = queries.q_canonical_feeds(spark, SF_SMALL).inputFiles()
    assert read and all(f.endswith(".zstd") for f in read)


@pytest.mark.parametrize("partition_by", ["month", "bucket", "device"])
def test_a_large_batch_is_stored_in_slices_of_time(spark, tmp_dir, monkeypatch, partition_by):
    """Each slice is bounded, all rows are stored once, those without a time
    come last, and no shuffle files of a slice stay."""
    from meterlake.plans import ingest

    rows, ids = roles.odd_time_rows(spark, SF_SMALL), roles.supplier_ids(spark, SF_SMALL)
    known = known_devices(rows, ids, roles.NARROW)
    n = known.count()
    monkeypatch.setattr(ingest, "WRITE_CELLS", n * len(roles.NARROW.names) // 4 + 7)
    sizes, write = [], ingest.write_rows

    def spy(part, spec_, mode="append"):
        sizes.append((part.count(), part.where("timestamp IS NULL").count()))
        write(part, spec_, mode)

    monkeypatch.setattr(ingest, "write_rows", spy)
    spec = TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW, partition_by, buckets=2)
    some = rows.where("device_id % 2 = 0")
    ingest.store_batch(some, ids, spec)
    first = len(sizes)
    for limit in (10_000_000, 5):  # matches of a slice broadcast, then shuffled
        ingest.store_batch(rows, ids, spec, max_broadcast_keys=limit)
    assert first == 2 and len(sizes) == first + 2 * 4
    assert all(size <= n * 0.3 for size, _ in sizes)
    assert [bool(timeless) for _, timeless in sizes] == [False, True] + [False, False, False, True] * 2
    stored, timed = ingest.stored_rows(spark, spec), "timestamp IS NOT NULL"
    for one, other in ((stored, known), (known, stored)):
        assert one.where(timed).exceptAll(other.where(timed)).isEmpty()
    nulls = known.where("timestamp IS NULL")
    assert stored.where("timestamp IS NULL").count() == 2 * nulls.count() + nulls.where("device_id % 2 = 0").count()


def test_shuffle_files_of_a_load_are_deleted_with_its_write(spark, tmp_dir):
    """And those that stay are of the narrow key and report shuffles."""
    from meterlake.plans import ingest

    def shuffled():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        tops = list(manager.localDirsString())
        return sum(os.path.getsize(os.path.join(d, f)) for top in tops for d, _, fs in os.walk(top) for f in fs if f.startswith("shuffle_"))

    rows, ids = roles.combined_rows(spark, SF_SMALL), roles.supplier_ids(spark, SF_SMALL)
    size, write, seen = shuffled(), ingest.write_rows, []
    spec = TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW)
    ingest.write_rows = lambda *a, **b: (seen.append(shuffled()), write(*a, **b), seen.append(shuffled()))
    try:
        ingest.store_batch(rows, ids, spec)
    finally:
        ingest.write_rows = write
    assert len(seen) == 2 and seen[1] <= seen[0]


def test_inputs_may_go_once_they_are_staged(spark, tmp_dir):
    from meterlake.plans import ingest
    from meterlake.scratch import delete_path

    in_dir, spec = os.path.join(tmp_dir, "in"), TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW, "month")
    kept = []

    def gone():
        kept.append(os.path.exists(spec.path))
        delete_path(spark, in_dir)

    date = roles.write_day(spark, SF_SMALL, in_dir)
    want = known_devices(ingest.load_day(spark, date, in_dir, spec, roles.NARROW_FEEDS)[1], roles.supplier_ids(spark, SF_SMALL), roles.NARROW).count()
    report = ingest.ingest_day(spark, date, in_dir, spec, roles.NARROW_FEEDS, when_staged=gone)
    assert kept == [False] and not os.path.exists(in_dir)
    assert want and ingest.stored_rows(spark, spec).count() == want == report.agg(F.sum("rows_stored")).first()[0]


def test_device_files_have_no_checksum_files(spark, tmp_dir):
    """A file per device is one file to create, also on a local file system."""
    from meterlake.sources import read_table, write_rows

    known = roles.known_rows(spark, SF_SMALL)
    for grain in ("device", "month"):
        spec = TableSpec(os.path.join(tmp_dir, grain), roles.NARROW, grain)
        for _ in range(2):
            write_rows(known, spec)
        names = [f for _, _, fs in os.walk(spec.path) for f in fs]
        assert any(f.endswith(".parquet") for f in names)
        assert any(f.endswith(".crc") for f in names) == (grain == "month")
        assert read_table(spark, spec).exceptAll(known.unionByName(known)).isEmpty()
        assert read_table(spark, spec).count() == 2 * known.count()
