"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from meterlake.plans.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, float, np.integer, np.floating)):
        return round(float(v), 6)
    if hasattr(v, "year"):
        return str(pd.Timestamp(v))
    return str(v)


def _bag(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(_cell(v) for v in row) for row in pdf.itertuples(index=False)), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLE_SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    assert _bag(got) == _bag(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["device_id", "timestamp", "event_id", "qty", "price", "value", "status"]


def test_swapped_fields_do_not_pass(spark, duck):
    """Negative control: the hand-written event pairs with two of them swapped
    give other rows."""
    from meterlake.plans.queries import EVENT_PAIRS, canonical_sql

    pairs = list(EVENT_PAIRS)
    (a, x), (b, y) = pairs[3], pairs[4]
    pairs[3], pairs[4] = (a, y), (b, x)
    sound, wrong = (duck.execute(canonical_sql(True, p)).fetchdf() for p in (None, pairs))
    got = QUERIES["ingest_canonical"](spark, SF_SMALL).toPandas()
    assert _bag(got) == _bag(sound) != _bag(wrong)
    assert got.notna().any().all()  # every canonical column carries values


def test_every_row_is_on_a_side_of_the_merge(spark):
    from meterlake.plans import queries, roles

    rows = roles.known_rows(spark, SF_SMALL)
    sides = queries._existing(spark, SF_SMALL).unionByName(queries._delivered(spark, SF_SMALL))
    keys = list(roles.NARROW.key)
    assert rows.join(sides, [rows[k].eqNullSafe(sides[k]) for k in keys], "left_anti").isEmpty()
