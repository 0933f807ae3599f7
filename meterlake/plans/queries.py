"""Registered queries over the generated tables, and their SQL oracles.

Every query reads whole tables (or CSV files Spark writes from them) and
runs the library's operators; each oracle computes the same rows in plain
SQL. Column names are equal on both sides.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from meterlake.functions.columns import column
from meterlake.operators.conform import combine_feeds, conform
from meterlake.operators.merge import insert_missing
from meterlake.operators.report import batch_report, device_stats, listed_devices
from meterlake.operators.select import first_row_per_device, known_devices, registry_ids, with_position
from meterlake import schemas as S
from meterlake.plans import roles
from meterlake.plans.ingest import ingest_day, load_day, store_batch, stored_rows
from meterlake.scratch import delete_path, scratch_path
from meterlake.sources.csv import day_inputs, read_events, read_periodic, read_registry
from meterlake.sources.table import TableSpec, create_table, read_device, read_devices

NARROW = roles.NARROW


def _order():
    """(time, event, measures) ascending, nulls first: a total order of a device's rows."""
    return [column(n).asc_nulls_first() for n in NARROW.names if n != NARROW.device]


# Rows already stored / delivered in the merge queries, by a number made from
# the key (modulo 5): every row is on one side at least, two fifths of the keys
# are on both, and there the delivered measures differ from the stored ones.
EXISTING_PARTS = (0, 1, 2)
DELIVERED_PARTS = (1, 2, 3, 4)
REDELIVERED_BY = 1000.0


def _spec(spark: SparkSession, tag: str, partition_by: str | None = "month") -> TableSpec:
    # few buckets: the tables spread few rows over some 90 months
    return TableSpec(scratch_path(spark, tag), NARROW, partition_by=partition_by, buckets=4)


def q_registry_ids(spark, sf_dir):
    in_dir = scratch_path(spark, "in")
    roles.write_csv(roles.registry_csv_rows(spark, sf_dir), day_inputs(in_dir, "d").registry)
    return registry_ids(read_registry(spark, day_inputs(in_dir, "d").registry), NARROW)


def q_conform_periodic(spark, sf_dir):
    return roles.periodic_rows(spark, sf_dir)


def q_conform_event(spark, sf_dir):
    return roles.event_rows(spark, sf_dir)


def q_combine_feeds(spark, sf_dir):
    return roles.combined_rows(spark, sf_dir)


def q_known_devices(spark, sf_dir):
    return roles.known_rows(spark, sf_dir)


def q_one_device(spark, sf_dir):
    spec = _spec(spark, "one-device", "bucket")
    create_table(roles.known_rows(spark, sf_dir), spec)
    return with_position(read_device(spark, spec, roles.DEVICE_PROBE), _order())


def q_many_devices(spark, sf_dir):
    """The rows of an eighth of the suppliers, all of one bucket."""
    spec = _spec(spark, "many-devices", "bucket")
    create_table(roles.known_rows(spark, sf_dir), spec)
    ids = roles.supplier_ids(spark, sf_dir)
    return read_devices(spark, spec, ids.where(column(ids.columns[0]) % 8 == 3))


def q_create_table(spark, sf_dir):
    spec = _spec(spark, "create")
    create_table(roles.known_rows(spark, sf_dir), spec)
    return stored_rows(spark, spec)


def _part(rows):
    number = F.coalesce(column("event_id"), F.dayofmonth(column("timestamp")).cast("long"), F.lit(0))
    return F.pmod(column("device_id") + number, F.lit(5))


def _existing(spark, sf_dir):
    rows = roles.known_rows(spark, sf_dir)
    return rows.where(_part(rows).isin(*EXISTING_PARTS))


def _delivered(spark, sf_dir):
    rows = roles.known_rows(spark, sf_dir)
    rows = rows.where(_part(rows).isin(*DELIVERED_PARTS))
    return rows.withColumns({c: column(c) + F.lit(REDELIVERED_BY) for c in ("qty", "value")})


def q_insert_missing(spark, sf_dir):
    existing = _existing(spark, sf_dir)
    return existing.unionByName(insert_missing(_delivered(spark, sf_dir), existing, NARROW))


def q_insert_missing_stored(spark, sf_dir):
    spec = _spec(spark, "merge")
    create_table(_existing(spark, sf_dir), spec)
    ids = roles.supplier_ids(spark, sf_dir)
    for _ in range(2):  # a second delivery of the same rows adds nothing
        store_batch(_delivered(spark, sf_dir), ids, spec)
    return stored_rows(spark, spec)


def q_batch_report(spark, sf_dir):
    ids = roles.customer_ids(spark, sf_dir)
    known = known_devices(roles.combined_rows(spark, sf_dir), ids, NARROW)
    return batch_report(listed_devices(ids, NARROW), device_stats(known, NARROW), NARROW)


def _two_days(spark, sf_dir):
    in_dir = scratch_path(spark, "in")
    for day in (roles.DAY_A, roles.DAY_B):
        roles.write_day(spark, sf_dir, in_dir, day)
    return in_dir


def _second_report(spark, sf_dir, partition_by):
    in_dir = _two_days(spark, sf_dir)
    spec = _spec(spark, "report", partition_by)
    ingest_day(spark, roles.DAY_A[0], in_dir, spec, roles.NARROW_FEEDS)
    return ingest_day(spark, roles.DAY_B[0], in_dir, spec, roles.NARROW_FEEDS, with_row_totals=True)


def q_batch_report_totals(spark, sf_dir):
    return _second_report(spark, sf_dir, "bucket")


def q_batch_report_footers(spark, sf_dir):
    """A folder per device: totals from the files' footers."""
    return _second_report(spark, sf_dir, "device")


def q_event_gate(spark, sf_dir):
    in_dir = scratch_path(spark, "in")
    whole = ("a", (None, None), (None, None))
    wrong = ("b", (None, None), (None, None))
    roles.write_day(spark, sf_dir, in_dir, whole)
    # an event file of the wrong arity: the gate drops it, periodic rows stay
    roles.write_day(spark, sf_dir, in_dir, wrong, event_feed=roles.periodic_csv_rows(spark, sf_dir))
    out = []
    for date in ("a", "b"):
        _, rows = load_day(spark, date, in_dir, _spec(spark, "unused"), roles.NARROW_FEEDS)
        out.append(rows.select(F.lit(date).alias("batch"), *[column(n) for n in NARROW.names]))
    return out[0].unionByName(out[1])


def q_csv_scan(spark, sf_dir):
    in_dir = scratch_path(spark, "in")
    roles.write_day(spark, sf_dir, in_dir, ("d", (None, None), (None, None)))
    paths = day_inputs(in_dir, "d")
    feeds = roles.NARROW_FEEDS
    periodic = conform(read_periodic(spark, paths.periodic, feeds.periodic), feeds.periodic.mapping, NARROW)
    events = conform(read_events(spark, paths.events, feeds.events), feeds.events.mapping, NARROW)
    return combine_feeds(periodic, events)


def q_ingest_day(spark, sf_dir):
    in_dir = _two_days(spark, sf_dir)
    spec = _spec(spark, "ingest")
    for day in (roles.DAY_A, roles.DAY_B):
        ingest_day(spark, day[0], in_dir, spec, roles.NARROW_FEEDS)
    return stored_rows(spark, spec)


def _wall_clock(rows):
    """Instants as session wall-clock time, for comparison."""
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def q_canonical_feeds(spark, sf_dir):
    """Both feeds in their full shapes (244 / 31 fields, each with a value of
    its own) through CSV, the arity gate and the 244-column conform."""
    in_dir = scratch_path(spark, "in")
    roles.write_full_day(spark, sf_dir, in_dir, ("d", (None, None), (None, None)), roles.ZSTD_PACKED)
    _, rows = load_day(spark, "d", in_dir, TableSpec(scratch_path(spark, "unused")), S.CANONICAL_FEEDS)
    return _wall_clock(rows)


def q_ingest_canonical(spark, sf_dir):
    """Two overlapping delivery dates of the full feeds, stored in the default
    layout and read back."""
    spec = TableSpec(scratch_path(spark, "canonical"))
    for day in (roles.DAY_A, roles.DAY_B):
        in_dir = scratch_path(spark, "in")
        date = roles.write_full_day(spark, sf_dir, in_dir, day)
        # the files are deleted before the table is written
        ingest_day(spark, date, in_dir, spec, when_staged=partial(delete_path, spark, in_dir))
        delete_path(spark, in_dir)  # this date is stored
    return _wall_clock(stored_rows(spark, spec))


def q_ingest_odd_times(spark, sf_dir):
    """All rows, some with a null time or a time of the years 2 to 12024,
    stored twice; shown by year and the rest of the time."""
    spec = _spec(spark, "odd")
    ids, rows = roles.supplier_ids(spark, sf_dir), roles.odd_time_rows(spark, sf_dir)
    for _ in range(2):
        store_batch(rows, ids, spec)
    stored = stored_rows(spark, spec)
    time = column("timestamp")
    return stored.select(
        *[column(c) for c in stored.columns if c != "timestamp"],
        F.year(time).alias("year"),
        F.date_format(time, "MM-dd HH:mm:ss").alias("rest"),
    )


def _edge_load(spark, sf_dir):
    in_dir, spec = scratch_path(spark, "in"), _spec(spark, "edge")
    roles.write_edge_day(spark, sf_dir, in_dir)
    report = ingest_day(spark, roles.EDGE_DATE, in_dir, spec, roles.EDGE_FEEDS, with_row_totals=True)
    return spec, report


def q_ingest_edge_rows(spark, sf_dir):
    """Stored rows of a date with missing, malformed, short and long lines."""
    return stored_rows(spark, _edge_load(spark, sf_dir)[0])


def q_ingest_edge_report(spark, sf_dir):
    """Its report: devices as often as listed, null and malformed ids left out."""
    return _edge_load(spark, sf_dir)[1]


def q_first_row_per_device(spark, sf_dir):
    return first_row_per_device(roles.known_rows(spark, sf_dir), NARROW)


QUERIES = {
    "registry_ids": q_registry_ids,
    "conform_periodic": q_conform_periodic,
    "conform_event": q_conform_event,
    "combine_feeds": q_combine_feeds,
    "known_devices": q_known_devices,
    "one_device": q_one_device,
    "many_devices": q_many_devices,
    "create_table": q_create_table,
    "insert_missing": q_insert_missing,
    "insert_missing_stored": q_insert_missing_stored,
    "batch_report": q_batch_report,
    "batch_report_totals": q_batch_report_totals,
    "batch_report_footers": q_batch_report_footers,
    "event_gate": q_event_gate,
    "csv_scan": q_csv_scan,
    "ingest_day": q_ingest_day,
    "first_row_per_device": q_first_row_per_device,
    "canonical_feeds": q_canonical_feeds,
    "ingest_canonical": q_ingest_canonical,
    "ingest_odd_times": q_ingest_odd_times,
    "ingest_edge_rows": q_ingest_edge_rows,
    "ingest_edge_report": q_ingest_edge_report,
}


# ---------------------------------------------------------------------------
# SQL oracles (DuckDB dialect; the tables are views of the same parquet files)
# ---------------------------------------------------------------------------

COLS = '"device_id", "timestamp", "event_id", "qty", "price", "value", "status"'


def _periodic_sql(where: str = "") -> str:
    return (
        'SELECT l_suppkey AS "device_id", l_shipdate AS "timestamp", CAST(NULL AS BIGINT) AS "event_id", '
        'l_quantity AS "qty", l_extendedprice AS "price", CAST(NULL AS DOUBLE) AS "value", '
        f'l_linestatus AS "status" FROM lineitem {where}'
    )


def _event_sql(where: str = "") -> str:
    return (
        'SELECT user_id AS "device_id", ts AS "timestamp", event_id AS "event_id", '
        'CAST(NULL AS DOUBLE) AS "qty", CAST(NULL AS DOUBLE) AS "price", value AS "value", '
        f'event_type AS "status" FROM events {where}'
    )


def _combined_sql(p_where: str = "", e_where: str = "") -> str:
    return f"({_periodic_sql(p_where)} UNION ALL {_event_sql(e_where)})"


def _known_sql(p_where: str = "", e_where: str = "") -> str:
    return (
        f"SELECT {COLS} FROM {_combined_sql(p_where, e_where)} c "
        'WHERE EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = c."device_id")'
    )


def _ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


def _range_where(column_name: str, bounds) -> str:
    low, high = bounds
    parts = []
    if low is not None:
        parts.append(f"{column_name} >= {_ts(low)}")
    if high is not None:
        parts.append(f"{column_name} < {_ts(high)}")
    if low is None and parts:
        parts = [f"({parts[0]} OR {column_name} IS NULL)"]
    return ("WHERE " + " AND ".join(parts)) if parts else ""


_ORDER_SQL = ", ".join(f'"{n}" NULLS FIRST' for n in NARROW.names if n != NARROW.device)
_PART = '("device_id" + COALESCE("event_id", CAST(day("timestamp") AS BIGINT), 0)) % 5'
_EXISTING = f'SELECT * FROM ({_known_sql()}) k WHERE {_PART} IN (0, 1, 2)'
_DELIVERED = (
    'SELECT "device_id", "timestamp", "event_id", "qty" + 1000 AS "qty", "price", "value" + 1000 AS "value", "status" '
    f'FROM ({_known_sql()}) k WHERE {_PART} IN (1, 2, 3, 4)'
)
_MERGED = (
    f"SELECT {COLS} FROM ({_EXISTING}) e0 UNION ALL "
    f"SELECT {COLS} FROM ({_DELIVERED}) d WHERE NOT EXISTS (SELECT 1 FROM ({_EXISTING}) e "
    'WHERE e."device_id" = d."device_id" AND e."timestamp" = d."timestamp" '
    'AND e."event_id" IS NOT DISTINCT FROM d."event_id")'
)
_DAY_B_KNOWN = _known_sql(
    _range_where("l_shipdate", roles.DAY_B[1]), _range_where("ts", roles.DAY_B[2])
)

# Event fields and the canonical columns they fill, written out from the feed
# documents (not taken from ``schemas``, which this checks). FIXED VALUES.
EVENT_PAIRS = [
    ("UL1", "ul1v"), ("UL2", "ul2v"), ("UL3", "ul3v"),
    ("U12", "ul12v"), ("U23", "ul23v"), ("U31", "ul31v"),
    ("IL1", "il1a"), ("IL2", "il2a"), ("IL3", "il3a"), ("IN", "i_n"),
    ("TDUL1", "dl1"), ("TDUL2", "dl2"), ("TDUL3", "dl3"),
    ("TDIL1", "tdil1"), ("TDIL2", "tdil2"), ("TDIL3", "tdil3"),
    ("P1L1", "p1l1"), ("P1L2", "p1l2"), ("P1L3", "p1l3"),
    ("Q1L1", "q1l1"), ("Q1L2", "q1l2"), ("Q1L3", "q1l3"),
    ("DPFL1", "dpfl1"), ("DPFL2", "dpfl2"), ("DPFL3", "dpfl3"),
    ("freq", "fhz"), ("U2/U1", "u2u1"), ("U0/U1", "u0u1"),
]
_DUCK_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "int": "INTEGER", "string": "VARCHAR"}


def canonical_sql(known_only: bool, event_pairs=None) -> str:
    """The 244-column rows of both feeds, filled as in ``roles``: position i of
    the periodic feed carries quantity, line number or flag with 1000 i, field
    i of the event feed value + 1000 i (the first three fields are keys)."""
    position = {canon: i for i, (_, canon) in enumerate(event_pairs or EVENT_PAIRS, 3)}
    periodic = ['l_suppkey AS "device_id"', 'l_shipdate AS "timestamp"', 'CAST(NULL AS BIGINT) AS "event_id"']
    events = ['user_id AS "device_id"', 'ts AS "timestamp"', 'event_id AS "event_id"']
    for i, f in enumerate(S.CANONICAL.fields[3:], 3):
        kind = f.dataType.simpleString()
        value = {
            "double": f"l_quantity + {1000 * i}",
            "int": f"CAST(l_linenumber + {1000 * i} AS INTEGER)",
            "string": f"l_returnflag || '-{i}'",
        }[kind]
        periodic.append(f'{value} AS "{f.name}"')
        own = f"value + {1000 * position[f.name]}" if f.name in position else "NULL"
        events.append(f'CAST({own} AS {_DUCK_TYPES[kind]}) AS "{f.name}"')
    sides = [(periodic, "lineitem", "l_suppkey"), (events, "events", "user_id")]
    known = " WHERE {} IN (SELECT s_suppkey FROM supplier)" if known_only else ""
    return " UNION ALL ".join(f"SELECT {', '.join(cols)} FROM {t}{known.format(dev)}" for cols, t, dev in sides)


def _odd_sql() -> str:
    key = '("device_id" + CAST(floor(COALESCE("qty", "value", 0.0)) AS BIGINT)) % 13'
    key = f"(({key}) + 13) % 13"
    cases = " ".join(
        f'WHEN {k} THEN "timestamp" + INTERVAL ({years}) YEAR' for k, years in roles.ODD_SHIFTS.items() if years is not None
    )
    moved = f'SELECT *, CASE {key} WHEN 0 THEN NULL {cases} ELSE "timestamp" END AS t FROM ({_known_sql()}) k'
    cols = (
        '"device_id", "event_id", "qty", "price", "value", "status", CAST(year(t) AS INTEGER) AS "year", '
        "strftime(t, '%m-%d %H:%M:%S') AS \"rest\""
    )
    # a row with a null time is inserted by either load
    return f"WITH m AS ({moved}) SELECT {cols} FROM m UNION ALL SELECT {cols} FROM m WHERE t IS NULL"


_EDGE_ROWS = (
    'SELECT CASE k WHEN 1 THEN NULL ELSE l_suppkey END AS "device_id", '
    'CASE WHEN k IN (2, 3) THEN NULL ELSE l_shipdate END AS "timestamp", CAST(NULL AS BIGINT) AS "event_id", '
    'CASE WHEN k IN (4, 5) THEN NULL ELSE l_quantity END AS "qty", '
    'CASE WHEN k = 4 THEN NULL ELSE l_extendedprice END AS "price", CAST(NULL AS DOUBLE) AS "value", '
    'CASE WHEN k = 4 THEN NULL ELSE l_linestatus END AS "status" '
    "FROM (SELECT *, (l_orderkey + l_linenumber) % 8 AS k FROM lineitem) x"
)
_EDGE_STORED = (
    f"SELECT {COLS} FROM ({_EDGE_ROWS} UNION ALL {_event_sql()}) c "
    'WHERE "device_id" IN (SELECT s_suppkey FROM supplier)'
)


ORACLE_SQL = {
    "registry_ids": 'SELECT s_suppkey AS "device_id" FROM supplier WHERE s_suppkey IS NOT NULL',
    "conform_periodic": _periodic_sql(),
    "conform_event": _event_sql(),
    "combine_feeds": f"SELECT {COLS} FROM {_combined_sql()} c",
    "known_devices": _known_sql(),
    "one_device": (
        f"SELECT {COLS}, row_number() OVER (ORDER BY {_ORDER_SQL}) AS \"position\" "
        f'FROM ({_known_sql()}) k WHERE "device_id" = {roles.DEVICE_PROBE}'
    ),
    "many_devices": f'SELECT {COLS} FROM ({_known_sql()}) k WHERE "device_id" % 8 = 3',
    "create_table": _known_sql(),
    "insert_missing": _MERGED,
    "insert_missing_stored": _MERGED,
    "batch_report": (
        'SELECT r."device_id", r."listed", COALESCE(b.n, 0) AS "rows_stored" '
        'FROM (SELECT c_custkey AS "device_id", count(*) AS "listed" FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1) r '
        f'LEFT JOIN (SELECT "device_id", count(*) AS n FROM {_combined_sql()} c '
        'WHERE EXISTS (SELECT 1 FROM customer x WHERE x.c_custkey = c."device_id") GROUP BY 1) b '
        'ON b."device_id" = r."device_id"'
    ),
    "batch_report_totals": (
        'SELECT r."device_id", r."listed", COALESCE(b.n, 0) AS "rows_stored", '
        'CASE WHEN COALESCE(b.n, 0) > 0 THEN COALESCE(t.n, 0) END AS "rows_total" '
        'FROM (SELECT s_suppkey AS "device_id", count(*) AS "listed" FROM supplier WHERE s_suppkey IS NOT NULL GROUP BY 1) r '
        f'LEFT JOIN (SELECT "device_id", count(*) AS n FROM ({_DAY_B_KNOWN}) k GROUP BY 1) b '
        'ON b."device_id" = r."device_id" '
        f'LEFT JOIN (SELECT "device_id", count(*) AS n FROM ({_known_sql()}) k GROUP BY 1) t '
        'ON t."device_id" = r."device_id"'
    ),
    "event_gate": (
        f"SELECT 'a' AS \"batch\", {COLS} FROM {_combined_sql()} c UNION ALL "
        f"SELECT 'b' AS \"batch\", {COLS} FROM ({_periodic_sql()}) p"
    ),
    "csv_scan": f"SELECT {COLS} FROM {_combined_sql()} c",
    "ingest_day": _known_sql(),
    "first_row_per_device": (
        f"SELECT {COLS} FROM (SELECT *, row_number() OVER (PARTITION BY \"device_id\" "
        f"ORDER BY {_ORDER_SQL}) AS rn FROM ({_known_sql()}) k) r WHERE rn = 1"
    ),
    "canonical_feeds": canonical_sql(known_only=False),
    "ingest_canonical": canonical_sql(known_only=True),
    "ingest_odd_times": _odd_sql(),
    "ingest_edge_rows": _EDGE_STORED,
    "ingest_edge_report": (
        'SELECT r."device_id", r."listed", COALESCE(b.n, 0) AS "rows_stored", b.n AS "rows_total" '
        'FROM (SELECT s_suppkey AS "device_id", CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS "listed" FROM supplier) r '
        f'LEFT JOIN (SELECT "device_id", count(*) AS n FROM ({_EDGE_STORED}) k GROUP BY 1) b '
        'ON b."device_id" = r."device_id"'
    ),
}
ORACLE_SQL["batch_report_footers"] = ORACLE_SQL["batch_report_totals"]
