import random

import numpy as np
import pytest

from meterlake.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, anchor int, score string, planes string"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", None) for r in rows], SCHEMA)


def slow(rows, every=100, relabel=7):
    taken = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % relabel == 0:
            label = (label + 1) % 10
        taken.append((vec_id, label, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    out = []
    for i, (a, la, va) in enumerate(taken):
        if a is None or a % every:
            continue
        scored = [(v, sum(x * y for x, y in zip(va, vec)), lab) for j, (v, lab, vec) in enumerate(taken) if j != i]
        for p in sorted([s for s in scored if s[2] == la], key=order)[:5]:
            good = [s for s in scored if s[2] != la and 80 * p[1] <= 100 * s[1] <= 100 * p[1]]
            out += [(a, p[0], k + 1, n[0], p[1], n[1]) for k, n in enumerate(sorted(good, key=order)[:5])]
    return sorted(map(repr, out))


def test_scores_by_lookup_are_inner_products():
    draw = np.random.default_rng(1)
    for dims, size in ((1, 3), (8, 100), (13, 5000), (64, 1 << 25)):
        a, c = draw.integers(-size, size, (5, dims)), draw.integers(-size, size, (9, dims))
        planes = int(max(c.max(), -c.min() - 1)).bit_length() + 1
        dtype = np.int64
        got = H.lookup_scores(H.subset_sums(a, dtype), H.pack_planes(c, planes))
        assert (got == c @ a.T).all()


@pytest.mark.parametrize("wave", [H.WAVE, 2])
def test_triples_equal_brute_force(spark, wave):
    draw = random.Random(5)
    base = [[draw.gauss(0, 0.2) for _ in range(12)] for _ in range(6)]
    rows = [(i * 10, [x + draw.gauss(0, 0.03) for x in base[i % 6]], draw.randrange(4)) for i in range(150)]
    rows += [(7, base[0], 1), (7, base[0], 1), (200, base[1], 2), (200, base[1], 2), (None, base[2], 1), (None, base[2], 3)]  # repeats, null ids
    rows += [(300, None, 1), (1000, base[0], None), (400, [float("nan")] * 12, 1), (500, [None] * 12, 0), (600, [float("inf")] * 12, 1)]
    rows += [(700, [], 2), (900, base[3][:5], 2)]  # shorter vectors: padded with zeros
    got = H.mine(rows_of(spark, rows).repartition(3), wave=wave).collect()
    padded = [(i, v if v is None or len(v) == 12 else list(v) + [0.0] * (12 - len(v)), lab) for i, v, lab in rows]
    assert sorted(repr(tuple(r)) for r in got) == slow(padded)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(100, [1.0], 1)] + [(i, [1.0], 1) for i in range(1, 9)] + [(i, [1.0], 5) for i in range(20, 30)]
    got = H.mine(rows_of(spark, rows), relabel_every=0).orderBy("positive_id", "rank").collect()
    assert [r.positive_id for r in got[::5]] == [1, 2, 3, 4, 5]
    assert [r.negative_id for r in got[:5]] == [20, 21, 22, 23, 24]


def test_negative_positives_have_no_negatives(spark):
    rows = [(100, [1.0], 1), (1, [-1.0], 1), (2, [-1.0], 2), (3, [-0.9], 2)]
    assert H.mine(rows_of(spark, rows), relabel_every=0).count() == 0


def test_empty_tables_and_too_large_components(spark):
    assert H.mine(rows_of(spark, [])).count() == 0
    assert H.mine(rows_of(spark, [(1, [0.5], 1), (2, [], 1)])).count() == 0
    with pytest.raises(ValueError):
        H.mine(rows_of(spark, [(100, [1e30], 1)]))


def test_waves_cover_every_anchor_once(spark):
    rows = spark.range(0, 1000, 1, 3).selectExpr("monotonically_increasing_id() AS row")
    for wave in (1000, 400, 7):
        cuts = H._cuts(rows, wave)
        held = [rows.where(f"row BETWEEN {a} AND {b}").count() for a, b in cuts]
        assert sum(held) == 1000 and max(held) <= wave
