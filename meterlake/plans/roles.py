"""The generated test tables in the roles of the metering feeds.

``supplier`` (or ``customer``) is the device registry, ``lineitem`` the
periodic feed (device = supplier, time = ship date) and ``events`` the event
feed (device = user). They run through the same operators as the 244-column
feed, in a narrow layout. Two delivery dates are cut from the feeds by time,
overlapping, so that a re-delivered key is seen twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.columns import column
from meterlake.operators.conform import combine_feeds, conform
from meterlake.operators.select import known_devices, registry_ids
from meterlake.schemas import (
    DOUBLE,
    EVENT,
    LONG,
    PERIODIC,
    REGISTRY_FEED,
    STRING,
    TIMESTAMP_NTZ,
    DayFeeds,
    Feed,
    Layout,
    _struct,
)
from meterlake.sources.csv import ZSTD, day_inputs

NARROW = Layout(
    _struct([
        ("device_id", LONG, True),
        ("timestamp", TIMESTAMP_NTZ, True),
        ("event_id", LONG, True),
        ("qty", DOUBLE, True),
        ("price", DOUBLE, True),
        ("value", DOUBLE, True),
        ("status", STRING, True),
    ])
)

# table column -> layout column
LINEITEM_MAP = {
    "device_id": "l_suppkey",
    "timestamp": "l_shipdate",
    "qty": "l_quantity",
    "price": "l_extendedprice",
    "status": "l_linestatus",
}
EVENTS_MAP = {
    "device_id": "user_id",
    "timestamp": "ts",
    "event_id": "event_id",
    "value": "value",
    "status": "event_type",
}

# CSV shapes of the two narrow feeds; micro-second text keeps NTZ times whole.
_CSV_TIME = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
NARROW_PERIODIC_FEED = Feed(
    _struct([
        ("id", LONG, True),
        ("meter", LONG, True),
        ("timestamp", TIMESTAMP_NTZ, True),
        ("qty", DOUBLE, True),
        ("price", DOUBLE, True),
        ("status", STRING, True),
    ]),
    {"device_id": "meter", "timestamp": "timestamp", "qty": "qty", "price": "price", "status": "status"},
    _CSV_TIME,
)
NARROW_EVENT_FEED = Feed(
    _struct([
        ("meter", LONG, True),
        ("event_id", LONG, True),
        ("timestamp", TIMESTAMP_NTZ, True),
        ("value", DOUBLE, True),
        ("status", STRING, True),
    ]),
    {"device_id": "meter", "timestamp": "timestamp", "event_id": "event_id", "value": "value", "status": "status"},
    _CSV_TIME,
)
NARROW_FEEDS = DayFeeds(registry=REGISTRY_FEED, periodic=NARROW_PERIODIC_FEED, events=NARROW_EVENT_FEED)

# Two delivery dates cut by time, overlapping: (date, periodic [from, to), event [from, to)).
# Bounds are wall-clock text, compared as timestamp_ntz (no time zone involved).
DAY_A = ("2024-01-29", (None, "1999-01-01 00:00:00"), (None, "2024-01-20 00:00:00"))
DAY_B = ("2024-01-30", ("1998-01-01 00:00:00", None), ("2024-01-10 00:00:00", None))
DEVICE_PROBE = 7  # device read by the single-device query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def periodic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "lineitem"), LINEITEM_MAP, NARROW)


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "events"), EVENTS_MAP, NARROW)


def combined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_feeds(periodic_rows(spark, sf_dir), event_rows(spark, sf_dir))


def supplier_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry_ids(table(spark, sf_dir, "supplier"), NARROW, "s_suppkey")


def customer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry_ids(table(spark, sf_dir, "customer"), NARROW, "c_custkey")


def known_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_devices(combined_rows(spark, sf_dir), supplier_ids(spark, sf_dir), NARROW)


def registry_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` in the registry's six-field shape."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("serial number"),
        F.col("s_nationkey").cast("string").alias("location"),
        F.col("s_nationkey").alias("reading"),
        F.col("s_acctbal").alias("current factor"),
        F.col("s_acctbal").alias("voltage factor"),
    )


def periodic_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_suppkey").alias("meter"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_linestatus").alias("status"),
    )


def event_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("meter"),
        F.col("event_id"),
        F.col("ts").alias("timestamp"),
        F.col("value"),
        F.col("event_type").alias("status"),
    )


def _in_range(df: DataFrame, time: str, bounds) -> DataFrame:
    """Rows of a delivery; those without a time come with the first one (no
    lower bound)."""
    low, high = bounds
    cond = F.lit(True)
    if low is not None:
        cond = cond & (column(time) >= F.lit(low).cast("timestamp_ntz"))
    if high is not None:
        cond = cond & (column(time) < F.lit(high).cast("timestamp_ntz"))
    return df.where(cond if low is not None else cond | column(time).isNull())


# Options of the wide feeds' files: a line of 244 fields takes some
# 2 KB, of which gzip leaves a sixth or less; a file of that many lines is small
# enough for one task, as a gzip file is not split
_PACKED = {"compression": "gzip", "maxRecordsPerFile": 100_000}
# zstd looks back over some MB of lines (gzip: 32 KB, 16 lines) and takes less time
ZSTD_PACKED = {**_PACKED, "compression": ZSTD, "parquet.compression.codec.zstd.level": 9}


def write_csv(df: DataFrame, path: str, **options) -> None:
    df.write.mode("errorifexists").options(header=True, sep=",", **_CSV_TIME, **options).csv(path)


def write_day(spark: SparkSession, sf_dir: str, in_dir: str, day=DAY_A, event_feed: DataFrame | None = None) -> str:
    """Write the three files of one delivery date (each a folder of CSV
    parts) cut from the tables; ``event_feed`` replaces the event file
    (e.g. a file of another arity). Returns the date."""
    date, periodic_range, event_range = day
    paths = day_inputs(in_dir, date)
    write_csv(registry_csv_rows(spark, sf_dir), paths.registry)
    write_csv(_in_range(periodic_csv_rows(spark, sf_dir), "timestamp", periodic_range), paths.periodic)
    events = event_feed if event_feed is not None else _in_range(event_csv_rows(spark, sf_dir), "timestamp", event_range)
    write_csv(events, paths.events)
    return date


# The generated tables in the full feed shapes (244 and 31 fields). The key
# fields come from the tables; every other field of position i carries a value
# of its own, made from one column of its type and i.
PERIODIC_KEYS = {"id": "l_orderkey", "meter": "l_suppkey", "timestamp": "l_shipdate"}
EVENT_KEYS = {"meter": "user_id", "event_id": "event_id", "timestamp": "ts"}
PERIODIC_SOURCES = {"double": "l_quantity", "int": "l_linenumber", "string": "l_returnflag"}
EVENT_SOURCES = {"double": "value"}
STEP = 1000  # distance between the values of neighbouring positions
_TEXT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def feed_shaped_rows(src: DataFrame, schema, keys: dict, sources: dict) -> DataFrame:
    """A table in a feed's positional shape; times as wall-clock text, the
    way the feed delivers them (parsed in the session time zone on read)."""
    cols = []
    for i, f in enumerate(schema.fields):
        kind = f.dataType.simpleString()
        if f.name == "timestamp":
            value = F.date_format(F.col(keys[f.name]), _TEXT_TIME)
        elif f.name in keys:
            value = F.col(keys[f.name]).cast(f.dataType)
        elif kind == "string":
            value = F.concat(F.col(sources[kind]), F.lit(f"-{i}"))
        else:
            value = (F.col(sources[kind]) + F.lit(STEP * i)).cast(f.dataType)
        cols.append(value.alias(f.name))
    return src.select(*cols)


def full_periodic_rows(src: DataFrame) -> DataFrame:
    return feed_shaped_rows(src, PERIODIC, PERIODIC_KEYS, PERIODIC_SOURCES)


def full_event_rows(src: DataFrame) -> DataFrame:
    return feed_shaped_rows(src, EVENT, EVENT_KEYS, EVENT_SOURCES)


def write_full_day(spark: SparkSession, sf_dir: str, in_dir: str, day, packed: dict = _PACKED) -> str:
    """The three files of one delivery date in the full feed shapes;
    ``packed``: writer options of the two wide files."""
    date, periodic_range, event_range = day
    paths = day_inputs(in_dir, date)
    write_csv(registry_csv_rows(spark, sf_dir), paths.registry)
    periodic = _in_range(table(spark, sf_dir, "lineitem"), "l_shipdate", periodic_range)
    events = _in_range(table(spark, sf_dir, "events"), "ts", event_range)
    write_csv(full_periodic_rows(periodic), paths.periodic, **packed)
    write_csv(full_event_rows(events), paths.events, **packed)
    return date


# Odd times: by a number made from device and measure, some rows lose their
# time or move by many years (Spark holds years beyond four digits).
ODD_SHIFTS = {0: None, 1: 10_000, 2: 7_900, 3: -410, 4: -1_990}  # key % 13 -> years


def odd_key(device: Column, measure: Column) -> Column:
    return F.pmod(device + F.floor(F.coalesce(measure, F.lit(0.0))).cast("long"), F.lit(13))


def odd_time_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All combined rows, some with a null time or one far off."""
    rows = combined_rows(spark, sf_dir)
    key = odd_key(column("device_id"), F.coalesce(column("qty"), column("value")))
    time = column("timestamp")
    moved = F.when(key == 0, F.lit(None).cast("timestamp_ntz"))
    for k, years in ODD_SHIFTS.items():
        if years is not None:
            moved = moved.when(key == k, time + F.make_ym_interval(F.lit(years), F.lit(0)))
    return rows.withColumn("timestamp", moved.otherwise(time))


# Edge rows: CSV lines as a feed may deliver them, by line number modulo 8.
EDGE_FEEDS = DayFeeds(
    registry=Feed(REGISTRY_FEED.schema, REGISTRY_FEED.mapping, {"header": "false"}),
    periodic=Feed(NARROW_PERIODIC_FEED.schema, NARROW_PERIODIC_FEED.mapping, {**_CSV_TIME, "header": "false"}),
    events=NARROW_EVENT_FEED,
)
EDGE_DATE = "2024-01-31"


def edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as CSV lines (id, meter, time, qty, price, status): 1: no
    meter, 2: no time, 3: a time that is none, 4: only three cells, 5: a
    quantity that is no number, 6: one cell too many, else sound."""
    k = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(8))
    time = F.date_format("l_shipdate", _TEXT_TIME)
    meter = F.when(k == 1, F.lit("")).otherwise(F.col("l_suppkey").cast("string"))
    time = F.when(k == 2, F.lit("")).when(k == 3, F.lit("no time")).otherwise(time)
    qty = F.when(k == 5, F.lit("x1")).otherwise(F.col("l_quantity").cast("string"))
    head = F.concat_ws(",", F.col("l_orderkey").cast("string"), meter, time)
    whole = F.concat_ws(",", head, qty, F.col("l_extendedprice").cast("string"), "l_linestatus")
    line = F.when(k == 4, head).when(k == 6, F.concat(whole, F.lit(",extra"))).otherwise(whole)
    return table(spark, sf_dir, "lineitem").select(line.alias("value"))


def edge_registry_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` as CSV lines: every third id twice, one in seven with an
    empty id line after it, one in five with a malformed one."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    rest = F.lit(",SN,site,1,1.5,2.5")
    sound = F.concat(F.col("s_suppkey").cast("string"), rest)
    lines = F.array(
        sound,
        F.when(F.col("s_suppkey") % 3 == 0, sound),
        F.when(F.col("s_suppkey") % 7 == 0, rest),
        F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("id"), sound)),
    )
    return s.select(F.explode(lines).alias("value")).where("value IS NOT NULL")


def write_edge_day(spark: SparkSession, sf_dir: str, in_dir: str) -> str:
    paths = day_inputs(in_dir, EDGE_DATE)
    edge_registry_lines(spark, sf_dir).write.text(paths.registry)
    edge_lines(spark, sf_dir).write.text(paths.periodic)
    write_csv(event_csv_rows(spark, sf_dir), paths.events)
    return EDGE_DATE
