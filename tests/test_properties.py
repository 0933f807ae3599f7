"""Properties of the insert-if-absent merge against a plain-Python model."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterlake.operators import insert_missing
from meterlake.schemas import DOUBLE, LONG, TIMESTAMP, Layout, _struct

MINI = Layout(_struct([("device_id", LONG, True), ("timestamp", TIMESTAMP, True), ("event_id", LONG, True), ("v", DOUBLE, True)]))
BASE = dt.datetime(2024, 1, 1)

row = st.tuples(
    st.one_of(st.none(), st.integers(1, 2)),
    st.one_of(st.none(), st.integers(0, 2).map(lambda s: BASE + dt.timedelta(seconds=s))),
    st.one_of(st.none(), st.integers(0, 1)),
    st.sampled_from([0.5, 1.5]),
)


def model(batch, target):
    """device =, time = (null never equal), event null-safe =."""
    keys = {(d, t, e) for d, t, e, _ in target if d is not None and t is not None}
    return [r for r in batch if r[0] is None or r[1] is None or (r[0], r[1], r[2]) not in keys]


def bag(rows):
    return sorted(rows, key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=st.lists(row, max_size=8), target=st.lists(row, max_size=8))
def test_insert_missing_matches_model(spark, batch, target):
    b = spark.createDataFrame(batch, MINI.schema)
    t = spark.createDataFrame(target, MINI.schema)
    got = [tuple(r) for r in insert_missing(b, t, MINI).collect()]
    assert bag(got) == bag(model(batch, target))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=st.lists(row, max_size=8))
def test_second_load_adds_only_untimed_rows(spark, batch):
    """Loading a batch onto a table that already holds it adds exactly the
    rows that can never match (null device or null time)."""
    b = spark.createDataFrame(batch, MINI.schema)
    again = [tuple(r) for r in insert_missing(b, b, MINI).collect()]
    assert bag(again) == bag([r for r in batch if r[0] is None or r[1] is None])
