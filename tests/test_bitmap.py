"""Bitmaps of ids and key hashes, and the merge beyond the broadcast limits."""

import os

import pytest
from pyspark.sql import functions as F

from meterlake.operators import bit_words, in_words, insert_missing, insert_missing_salted, known_devices
from meterlake.plans import ingest, roles
from meterlake.plans.ingest import possible_matches
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _bag(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_words_hold_exactly_their_numbers(spark):
    numbers = [0, 1, 63, 64, 127, 128, -1, -64, -65, 2**62, 2**63 - 1, -(2**63), 5, 5]
    words = bit_words(spark.createDataFrame([(n,) for n in [*numbers, None]], "n long"), F.col("n"))
    near = {m for n in numbers for m in range(n - 2, n + 3) if -(2**63) <= m < 2**63} | {None}
    rows = spark.createDataFrame([(m,) for m in near], "m long")
    assert {r.m for r in in_words(rows, F.col("m"), words).collect()} == set(numbers)
    assert words.count() == len({n >> 6 for n in numbers})


def test_a_registry_over_the_limit_is_a_broadcast_bitmap(spark):
    rows = roles.combined_rows(spark, SF_SMALL)
    ids = roles.customer_ids(spark, SF_SMALL)  # 150 ids in 3 words
    kept = known_devices(rows, ids, roles.NARROW, max_broadcast=20)
    plan = _plan(kept)
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "hashpartitioning" not in plan.split("BroadcastExchange")[0]
    assert _bag(kept) == _bag(rows.join(ids, "device_id", "left_semi"))


@pytest.mark.parametrize("bits", [1 << 26, 64])
def test_matches_hold_every_shared_key(spark, bits):
    """With 64 bits every bit is set: nothing is filtered, rows are the same."""
    rows = roles.combined_rows(spark, SF_SMALL)
    keys = rows.select("device_id", "timestamp", "event_id")
    batch, target = rows.where("device_id % 3 != 0"), keys.where("device_id % 2 = 0")
    found = possible_matches(target, batch, roles.NARROW, bits)
    shared = target.where("device_id % 3 != 0 AND timestamp IS NOT NULL").count()
    assert found.count() == (shared if bits > 64 else target.count())
    assert _bag(insert_missing(batch, found, roles.NARROW, "broadcast")) == _bag(insert_missing(batch, target, roles.NARROW))


def test_the_bitmap_is_below_the_first_shuffle_of_keys(spark):
    rows = roles.combined_rows(spark, SF_SMALL)
    keys = rows.select("device_id", "timestamp", "event_id")
    plan = _plan(possible_matches(keys, rows, roles.NARROW).distinct())
    assert plan.index("Exchange hashpartitioning(device_id") < plan.index("BroadcastHashJoin")


def test_salted_merge_spreads_a_hot_key_and_null_times(spark):
    """A third of the rows on one key, a third without a time, no broadcast."""
    n = 3000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("long").alias("device_id"),
        F.when(F.col("id") % 3 != 1, F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, CASE WHEN id % 3 = 0 THEN 0 ELSE id END)")).alias("timestamp"),
        F.lit(None).cast("long").alias("event_id"),
        F.col("id").cast("double").alias("qty"),
    )
    target = rows.where("qty % 2 = 0 AND qty != 6")
    want = _bag(insert_missing(rows, target, roles.NARROW, "merge"))
    for missing in (target, target.where("device_id != 7 OR timestamp > timestamp_ntz'2024-01-01'")):
        got = insert_missing_salted(rows, missing, roles.NARROW, n, salt_rows=50)
        assert _bag(got) == _bag(insert_missing(rows, missing, roles.NARROW, "merge"))
        assert got.columns == rows.columns
    assert len(want) > n / 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = insert_missing_salted(rows, target, roles.NARROW, n, salt_rows=50)
        plan = _plan(got)
        assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Union" in plan
        # the hot key's rows that stay (none of the target has its key here) are in many partitions
        kept = insert_missing_salted(rows, target.where("device_id != 7"), roles.NARROW, n, salt_rows=50)
        parts = kept.where("device_id = 7 AND timestamp = timestamp_ntz'2024-01-01'").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 4 and max(r["count"] for r in parts) < 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_keys_are_counted_by_place_first(spark, monkeypatch):
    """The hot keys are those of a plain count, and the keys of other places
    are not shuffled; also where all keys share a few places."""
    from meterlake.operators import merge

    keyed = spark.range(4000).selectExpr("CASE WHEN id % 4 = 0 THEN id % 8 ELSE id END AS device_id", "id % 4 = 0 AS none")
    want = {(r.device_id, r["count"]) for r in keyed.groupBy("device_id", "none").count().where("count > 50").collect()}
    for places in (merge.HOT_PLACES, 3):
        monkeypatch.setattr(merge, "HOT_PLACES", places)
        hot = merge.hot_keys(keyed, ["device_id", "none"], 50)
        assert {(r.device_id, r._n) for r in hot.collect()} == want and len(want) == 2
    plan = _plan(hot)
    assert plan.index("hashpartitioning(device_id") < plan.index("LeftSemi") < plan.index("hashpartitioning(_place")


def test_a_load_joins_without_a_sort_while_a_task_can_hold_its_keys(spark, monkeypatch):
    rows = roles.known_rows(spark, SF_SMALL)
    target = rows.where("qty % 2 = 0 OR event_id % 2 = 0")
    want = _bag(insert_missing(rows, target, roles.NARROW, "merge"))
    n = rows.count()
    for held, op in ((ingest.TASK_KEYS, "ShuffledHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(ingest, "TASK_KEYS", held)
        new = ingest.new_rows(rows, target, n, n, roles.NARROW, 10)
        anti = [line for line in _plan(new).splitlines() if "LeftAnti" in line]
        assert anti and all(op in line for line in anti)
        assert _bag(new) == want


def test_a_load_over_the_key_limit_is_salted(spark, tmp_dir, monkeypatch):
    from meterlake.sources import TableSpec

    spec = TableSpec(os.path.join(tmp_dir, "t"), roles.NARROW)
    rows = roles.known_rows(spark, SF_SMALL)
    ids = roles.supplier_ids(spark, SF_SMALL)
    used = []
    before = ingest.insert_missing_salted
    monkeypatch.setattr(ingest, "insert_missing_salted", lambda *a, **b: used.append(1) or before(*a, **b))
    ingest.store_batch(rows.where("qty % 2 = 0"), ids, spec)
    ingest.store_batch(rows, ids, spec, max_broadcast_keys=10)
    half = rows.where("qty % 2 = 0")
    want = half.unionByName(insert_missing(rows, half, roles.NARROW))
    assert used and _bag(ingest.stored_rows(spark, spec)) == _bag(want)
