import datetime as dt
import os

import pytest

from meterlake import schemas as S
from meterlake.plans.ingest import ingest_day, load_day, store_batch, stored_rows
from meterlake.scratch import checkpoint_dir
from meterlake.sources import TableSpec, create_table, read_device, read_table, table_exists
from tests.feeds import write_day

D1, D2 = "2024-03-01", "2024-03-02"


def key_bag(df):
    return sorted(((r.device_id, r.timestamp, r.event_id, r.fhz) for r in df.collect()), key=repr)


@pytest.fixture()
def inputs(tmp_dir):
    in_dir = os.path.join(tmp_dir, "in")
    # day 1: devices 1, 2 registered; 3 is not; one null device; a duplicate
    # row; a null-time row; an event at the time of a periodic row
    write_day(
        in_dir,
        D1,
        devices=[1, 2, 2, 9],
        periodic_rows=[
            (1, 1, "2024-03-01 00:10:00", 1),
            (2, 1, "2024-03-01 00:20:00", 2),
            (3, 1, "2024-03-01 00:20:00", 2),
            (4, 2, "2024-03-01 00:10:00", 3),
            (5, 3, "2024-03-01 00:10:00", 4),
            (6, None, "2024-03-01 00:10:00", 5),
            (7, 2, "not a time", 6),
        ],
        event_rows=[(1, 500, "2024-03-01 00:10:00", 7)],
    )
    # day 2: re-delivers part of day 1 (with other measures) plus new rows
    write_day(
        in_dir,
        D2,
        devices=[1, 2, 9],
        periodic_rows=[
            (1, 1, "2024-03-01 00:10:00", 8),
            (8, 1, "2024-03-02 00:10:00", 9),
            (9, 2, "2024-03-02 00:10:00", 10),
        ],
        event_rows=[(1, 500, "2024-03-01 00:10:00", 11), (2, 501, "2024-03-02 00:00:00", 12)],
    )
    return in_dir


@pytest.mark.parametrize("partition_by", ["month", "day", "bucket", "device", None])
def test_ingest_twice_equals_once(spark, tmp_dir, inputs, partition_by):
    spec = TableSpec(os.path.join(tmp_dir, "t"), partition_by=partition_by)
    rep1 = {r.device_id: r.rows_stored for r in ingest_day(spark, D1, inputs, spec).collect()}
    assert rep1 == {1: 4, 2: 2, 9: 0}  # batch rows per registry device, once per id
    once = key_bag(stored_rows(spark, spec))
    assert len(once) == 6 and {k[0] for k in once} == {1, 2}  # no unknown or null device
    assert [k for k in once if k[1] is None] == [(2, None, None, 6.003)]
    ingest_day(spark, D1, inputs, spec)
    twice = key_bag(stored_rows(spark, spec))
    # keyed rows are not duplicated; the null-time row is inserted again
    assert sorted(set(twice), key=repr) == sorted(set(once), key=repr)
    assert len(twice) == 7
    assert stored_rows(spark, spec).schema == S.CANONICAL


def test_redelivery_first_write_wins_and_new_rows_added(spark, tmp_dir, inputs):
    spec = TableSpec(os.path.join(tmp_dir, "t"))
    ingest_day(spark, D1, inputs, spec)
    rep = ingest_day(spark, D2, inputs, spec, with_row_totals=True)
    got = {r.device_id: (r.rows_stored, r.rows_total) for r in rep.collect()}
    assert got == {1: (3, 5), 2: (2, 4), 9: (0, None)}
    rows = key_bag(stored_rows(spark, spec))
    first = [k for k in rows if k[0] == 1 and k[1] == dt.datetime(2024, 3, 1, 0, 10) and k[2] is None]
    assert first == [(1, dt.datetime(2024, 3, 1, 0, 10), None, 1.003)]  # measures of day 1 kept


def test_day_order_does_not_matter(spark, tmp_dir, inputs):
    a = TableSpec(os.path.join(tmp_dir, "a"))
    b = TableSpec(os.path.join(tmp_dir, "b"))
    ingest_day(spark, D1, inputs, a)
    ingest_day(spark, D2, inputs, a)
    ingest_day(spark, D2, inputs, b)
    ingest_day(spark, D1, inputs, b)
    # keys equal; the re-delivered key keeps whichever measures came first
    strip = lambda rows: sorted(((d, ts, e) for d, ts, e, _ in rows), key=repr)
    assert strip(key_bag(stored_rows(spark, a))) == strip(key_bag(stored_rows(spark, b)))


def test_periodic_row_sorts_before_events(spark, tmp_dir, inputs):
    spec = TableSpec(os.path.join(tmp_dir, "t"))
    ingest_day(spark, D1, inputs, spec)
    rows = read_device(spark, spec, 1, ordered=True).collect()
    assert [(r.timestamp.minute, r.event_id) for r in rows] == [(10, None), (10, 500), (20, None), (20, None)]


def test_wrong_arity_event_file_means_periodic_only(spark, tmp_dir):
    in_dir = os.path.join(tmp_dir, "in")
    write_day(in_dir, D1, [1], [(1, 1, "2024-03-01 00:10:00", 1)], event_lines=['{"error":"none","code":404}'])
    spec = TableSpec(os.path.join(tmp_dir, "t"))
    ingest_day(spark, D1, in_dir, spec)
    assert [r.event_id for r in stored_rows(spark, spec).collect()] == [None]


def test_missing_event_file_raises(spark, tmp_dir):
    in_dir = os.path.join(tmp_dir, "in")
    write_day(in_dir, D1, [1], [(1, 1, "2024-03-01 00:10:00", 1)])
    os.remove(os.path.join(in_dir, f"{D1}_event_data.csv"))
    with pytest.raises(Exception):
        ingest_day(spark, D1, in_dir, TableSpec(os.path.join(tmp_dir, "t")))


def test_table_probe_and_create(spark, tmp_dir, inputs):
    path = os.path.join(tmp_dir, "t")
    assert not table_exists(spark, path)
    os.makedirs(path)
    assert not table_exists(spark, path)  # empty folder = new table
    spec = TableSpec(path)
    assert read_table(spark, spec).count() == 0
    empty = TableSpec(os.path.join(tmp_dir, "e"))
    os.makedirs(empty.path)
    create_table(read_table(spark, spec).limit(0).unionByName(read_table(spark, spec)), empty)  # the same rule
    ingest_day(spark, D1, inputs, spec)
    assert table_exists(spark, path)
    with pytest.raises(Exception):
        create_table(stored_rows(spark, spec), spec)  # never overwrites


def test_one_load_per_device_stores_the_same_rows(spark, tmp_dir, inputs):
    spec, single = TableSpec(os.path.join(tmp_dir, "set")), TableSpec(os.path.join(tmp_dir, "single"))
    for d in (D1, D2):
        ingest_day(spark, d, inputs, spec)
        ids, rows = load_day(spark, d, inputs, single)
        for device in (1, 2, 9):
            store_batch(rows, ids.where(f"device_id = {device}"), single)
    assert key_bag(stored_rows(spark, single)) == key_bag(stored_rows(spark, spec))


ODD = ["0001-01-01 00:00:00", "1582-10-10 12:00:00", "9999-12-31 23:59:59", "12024-03-01 00:00:00", "-0044-03-15 00:00:00", "not a time"]


@pytest.mark.parametrize("partition_by", ["month", "day", "bucket", "device", None])
def test_odd_times_load_again_and_again(spark, tmp_dir, partition_by):
    in_dir = os.path.join(tmp_dir, "in")
    write_day(in_dir, D1, [1, 2], [(i, 1 + i % 2, ts, i) for i, ts in enumerate(ODD)])
    spec = TableSpec(os.path.join(tmp_dir, "t"), partition_by=partition_by, buckets=2)
    texts = lambda: sorted(r.t for r in stored_rows(spark, spec).selectExpr("coalesce(cast(timestamp AS string), 'none') AS t").collect())
    ingest_day(spark, D1, in_dir, spec)
    once = texts()
    assert once == sorted(["0001-01-01 00:00:00", "1582-10-10 12:00:00", "9999-12-31 23:59:59", "+12024-03-01 00:00:00", "-0044-03-15 00:00:00", "none"])
    ingest_day(spark, D1, in_dir, spec)
    rep = ingest_day(spark, D1, in_dir, spec, with_row_totals=True)
    assert texts() == sorted([*once, "none", "none"])  # only the row without a time comes again
    assert sum(r.rows_total for r in rep.collect()) == 8


@pytest.mark.parametrize(
    "partition_by, limits",
    [
        ("month", dict(max_broadcast=1)),
        ("bucket", dict(max_broadcast=0, max_broadcast_keys=0)),
        ("device", dict(max_broadcast=1, max_broadcast_keys=0)),
        (None, dict(max_broadcast_keys=0)),
    ],
)
def test_every_join_branch_stores_the_same(spark, tmp_dir, inputs, partition_by, limits):
    want = {}
    for name, options in (("plain", {}), ("limited", limits)):
        spec = TableSpec(os.path.join(tmp_dir, name), partition_by=partition_by, buckets=2)
        reports = [ingest_day(spark, d, inputs, spec, with_row_totals=True, **options) for d in (D1, D2, D2)]
        got = (key_bag(stored_rows(spark, spec)), [sorted(map(tuple, r.collect())) for r in reports])
        assert want.setdefault("rows", got) == got
    assert len(want["rows"][0]) == 9 and [tuple(r) for r in want["rows"][1][0]] == [(1, 1, 4, 4), (2, 2, 2, 2), (9, 1, 0, None)]


def test_a_load_leaves_nothing_behind(spark, tmp_dir, inputs):
    base = checkpoint_dir(spark).removeprefix("file:")
    loads = lambda: {d for d in os.listdir(os.path.join(base, "meterlake"))} if os.path.isdir(os.path.join(base, "meterlake")) else set()
    before = loads()
    spec = TableSpec(os.path.join(tmp_dir, "t"))
    for _ in range(2):
        report = ingest_day(spark, D1, inputs, spec)
    assert loads() == before and report.count() == 3


def test_a_redelivery_writes_no_file(spark, tmp_dir, inputs):
    spec = TableSpec(os.path.join(tmp_dir, "t"))
    ids, rows = load_day(spark, D1, inputs, spec)
    timed = rows.where("timestamp IS NOT NULL")
    files = lambda: sorted(os.path.join(d, f) for d, _, names in os.walk(spec.path) for f in names)
    store_batch(timed, ids, spec)
    first = files()
    store_batch(timed, ids, spec)
    assert files() == first


def test_a_failing_probe_raises(spark, tmp_dir, inputs):
    spec = TableSpec("nosuchscheme://host/t")
    with pytest.raises(Exception, match="nosuchscheme"):
        table_exists(spark, spec.path)
    ids, rows = load_day(spark, D1, inputs, spec)
    with pytest.raises(Exception, match="nosuchscheme"):
        store_batch(rows, ids, spec)
    with pytest.raises(Exception, match="nosuchscheme"):
        create_table(rows, spec)


def test_arrival_stream_loads_each_date_once(spark, tmp_dir, inputs):
    from meterlake.streaming.arrivals import ingest_arrivals

    spec = TableSpec(os.path.join(tmp_dir, "t"))
    ckpt = os.path.join(tmp_dir, "stream-ckpt")
    q = ingest_arrivals(spark, inputs, spec, ckpt)
    q.awaitTermination(300)
    direct = TableSpec(os.path.join(tmp_dir, "direct"))
    for d in (D1, D2):
        ingest_day(spark, d, inputs, direct)
    assert key_bag(stored_rows(spark, spec)) == key_bag(stored_rows(spark, direct))
    # a second run finds no new registry file and stores nothing
    q2 = ingest_arrivals(spark, inputs, spec, ckpt)
    q2.awaitTermination(300)
    assert stored_rows(spark, spec).count() == stored_rows(spark, direct).count()


def test_ensure_schema(spark):
    from meterlake.sources import ensure_schema

    ensure_schema(spark, "meterlake_test_schema")
    ensure_schema(spark, "meterlake_test_schema")  # idempotent
    assert "meterlake_test_schema" in [d.name for d in spark.catalog.listDatabases()]
    with pytest.raises(ValueError):
        ensure_schema(spark, "bad name; drop")


def test_empty_delivery_reports_zeros(spark, tmp_dir):
    in_dir = os.path.join(tmp_dir, "in")
    write_day(in_dir, D1, devices=[1, 2], periodic_rows=[], event_lines=[])
    spec = TableSpec(os.path.join(tmp_dir, "t"))
    rep = {r.device_id: (r.rows_stored, r.rows_total) for r in ingest_day(spark, D1, in_dir, spec, with_row_totals=True).collect()}
    assert rep == {1: (0, None), 2: (0, None)}
    assert not table_exists(spark, spec.path) and stored_rows(spark, spec).count() == 0
    # a later real delivery still creates the table
    write_day(in_dir, D2, devices=[1], periodic_rows=[(1, 1, "2024-03-02 00:10:00", 1)])
    ingest_day(spark, D2, in_dir, spec)
    assert stored_rows(spark, spec).count() == 1
