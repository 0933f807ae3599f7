"""Fixed input schemas of the metering feeds and the canonical row layout.

The three CSV feeds bind by position, so names, order and types below must
stay exactly as they are: they are the feed contract, not a design choice.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LONG = T.LongType()
DOUBLE = T.DoubleType()
INT = T.IntegerType()
STRING = T.StringType()
TIMESTAMP = T.TimestampType()
TIMESTAMP_NTZ = T.TimestampNTZType()

# ---------------------------------------------------------------------------
# FIXED VALUES — feed contract of the metering API (names, order and types
# must equal the delivered CSV files).
# ---------------------------------------------------------------------------

# Device registry, one per date: (name, type, declared nullable).
REGISTRY_FIELDS = [
    ("id", LONG, False),
    ("serial number", STRING, False),
    ("location", STRING, False),
    ("reading", INT, True),
    ("current factor", DOUBLE, False),
    ("voltage factor", DOUBLE, False),
]

# Periodic feed: leading fields, then measures. Every measure is a double
# unless listed in PERIODIC_INT / PERIODIC_STRING.
PERIODIC_HEAD = [("id", LONG, False), ("meter", LONG, False), ("timestamp", TIMESTAMP, False)]
PERIODIC_BEFORE_HARMONICS = [
    "fhz", "pw", "qfryzevar", "q1var", "pl1w", "pl2w", "pl3w", "p1l1", "p1l2", "p1l3", "qfryzel1var",
    "qfryzel2var", "qfryzel3var", "q1l1", "q1l2", "q1l3", "sva", "sl1va", "sl2va", "sl3va", "s1l1", "s1l2",
    "s1l3", "ul1v", "ul2v", "ul3v", "ul12v", "ul23v", "ul31v", "il1a", "il2a", "il3a", "i_n", "tdil1",
    "tdil2", "tdil3",
]
# Harmonic columns follow the rule <quantity><odd order>l<phase>, quantity
# u then i, phase-major, odd orders 1..39 (see harmonic_names()).
HARMONIC_QUANTITIES = ("u", "i")
HARMONIC_PHASES = (1, 2, 3)
HARMONIC_MAX_ORDER = 39
PERIODIC_AFTER_HARMONICS = [
    "u2u1", "u0u1", "udcl1", "udcl2", "udcl3", "idcl1", "idcl2", "idcl3", "idcn", "t1", "t2", "t3", "t4",
    "udcl12", "udcl23", "udcl31", "pfl1", "pfl2", "pfl3", "dpfl1", "dpfl2", "dpfl3", "udevl1", "udevl2",
    "udevl3", "odevl1", "odevl2", "odevl3", "umaxl12", "umaxl23", "umaxl31", "umaxl1v", "umaxl2v",
    "umaxl3v", "imaxl1a", "imaxl2a", "imaxl3a", "imaxn", "dmax", "tdimax", "u2u1max", "u0u1max", "uminl1v",
    "uminl2v", "uminl3v", "iminl1a", "iminl2a", "iminl3a", "uminl12", "uminl23", "uminl31", "pfmin",
    "dpfmin", "pstl1", "pstl2", "pstl3", "jd", "js", "jus", "rec_source", "io", "flagged", "periods",
    "samples", "calc_t", "m0peak_t", "crc_status", "io1", "io2", "io3", "io4", "io5", "io6", "io7", "io8",
    "ep10wh", "ep_10wh", "eq10varh", "eq_10varh", "eq1_pos", "eq1_neg", "rec_no", "dl1", "dl2", "dl3",
]
PERIODIC_INT = [
    "jd", "js", "jus", "periods", "samples", "calc_t", "m0peak_t", "io1", "io2", "io3", "io4", "io5", "io6",
    "io7", "io8", "rec_no",
]
PERIODIC_STRING = [
    "rec_source", "io", "flagged", "crc_status",
]

# Event feed: leading fields, then 28 double measures.
EVENT_HEAD = [("meter", LONG, False), ("event_id", LONG, False), ("timestamp", TIMESTAMP, False)]
EVENT_MEASURES = [
    "UL1", "UL2", "UL3", "U12", "U23", "U31", "IL1", "IL2", "IL3", "IN", "TDUL1", "TDUL2", "TDUL3", "TDIL1",
    "TDIL2", "TDIL3", "P1L1", "P1L2", "P1L3", "Q1L1", "Q1L2", "Q1L3", "DPFL1", "DPFL2", "DPFL3", "freq",
    "U2/U1", "U0/U1",
]

# Event measure -> canonical column; every other canonical measure is a
# typed null on event rows.
EVENT_TO_CANONICAL = {
    "freq": "fhz",
    "P1L1": "p1l1", "P1L2": "p1l2", "P1L3": "p1l3",
    "Q1L1": "q1l1", "Q1L2": "q1l2", "Q1L3": "q1l3",
    "UL1": "ul1v", "UL2": "ul2v", "UL3": "ul3v",
    "U12": "ul12v", "U23": "ul23v", "U31": "ul31v",
    "IL1": "il1a", "IL2": "il2a", "IL3": "il3a", "IN": "i_n",
    "TDIL1": "tdil1", "TDIL2": "tdil2", "TDIL3": "tdil3",
    "U2/U1": "u2u1", "U0/U1": "u0u1",
    "DPFL1": "dpfl1", "DPFL2": "dpfl2", "DPFL3": "dpfl3",
    "TDUL1": "dl1", "TDUL2": "dl2", "TDUL3": "dl3",
}

# File names of one delivery date inside the input folder.
REGISTRY_FILE = "{date}_devices.csv"
PERIODIC_FILE = "{date}_data.csv"
EVENT_FILE = "{date}_event_data.csv"

# Key of a stored row.
DEVICE_COL, TIME_COL, EVENT_COL = "device_id", "timestamp", "event_id"

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------


def harmonic_names() -> list[str]:
    """Flat harmonic column names in feed order (120 names)."""
    orders = range(1, HARMONIC_MAX_ORDER + 1, 2)
    return [f"{q}{h}l{p}" for q in HARMONIC_QUANTITIES for p in HARMONIC_PHASES for h in orders]


def periodic_measure_names() -> list[str]:
    return PERIODIC_BEFORE_HARMONICS + harmonic_names() + PERIODIC_AFTER_HARMONICS


def _measure_type(name: str) -> T.DataType:
    if name in PERIODIC_INT:
        return INT
    if name in PERIODIC_STRING:
        return STRING
    return DOUBLE


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


REGISTRY = _struct(REGISTRY_FIELDS)
PERIODIC = _struct(PERIODIC_HEAD + [(n, _measure_type(n), True) for n in periodic_measure_names()])
EVENT = _struct(EVENT_HEAD + [(n, DOUBLE, True) for n in EVENT_MEASURES])

# Canonical stored row: key first, then every periodic measure in feed order.
# CSV reads never enforce non-null, so every canonical column is nullable.
CANONICAL = _struct(
    [(DEVICE_COL, LONG, True), (TIME_COL, TIMESTAMP, True), (EVENT_COL, LONG, True)]
    + [(n, _measure_type(n), True) for n in periodic_measure_names()]
)

# canonical column -> feed column (absent = typed null)
PERIODIC_MAP = {DEVICE_COL: "meter", TIME_COL: "timestamp", **{n: n for n in periodic_measure_names()}}
EVENT_MAP = {
    DEVICE_COL: "meter",
    TIME_COL: "timestamp",
    EVENT_COL: "event_id",
    **{canon: src for src, canon in EVENT_TO_CANONICAL.items()},
}


@dataclass(frozen=True)
class Layout:
    """A stored row layout: the column schema plus the names of the key.

    The key is (device, time, event); the event part compares null-safe.
    """

    schema: T.StructType
    device: str = DEVICE_COL
    time: str = TIME_COL
    event: str = EVENT_COL

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def key(self) -> tuple[str, str, str]:
        return (self.device, self.time, self.event)

    def type_of(self, name: str) -> T.DataType:
        return self.schema[name].dataType


@dataclass(frozen=True)
class Feed:
    """One delivered CSV feed: its positional schema, how its columns map to
    a layout (layout column -> feed column) and extra CSV reader options."""

    schema: T.StructType
    mapping: dict = field(default_factory=dict)
    options: dict = field(default_factory=dict)


CANONICAL_LAYOUT = Layout(CANONICAL)
PERIODIC_FEED = Feed(PERIODIC, PERIODIC_MAP)
EVENT_FEED = Feed(EVENT, EVENT_MAP)
REGISTRY_FEED = Feed(REGISTRY, {DEVICE_COL: "id"})


@dataclass(frozen=True)
class DayFeeds:
    """The three feeds of one delivery date."""

    registry: Feed = REGISTRY_FEED
    periodic: Feed = PERIODIC_FEED
    events: Feed = EVENT_FEED

    @property
    def registry_id(self) -> str:
        return self.registry.mapping[DEVICE_COL]


CANONICAL_FEEDS = DayFeeds()
