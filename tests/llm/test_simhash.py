import re

import numpy as np
import pytest
import xxhash

from meterlake.llm import simhash as S
from meterlake.llm.components import connected_components
from tests.llm.helpers import ODD_TEXTS, bag, docs, empty, read


def slow_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_equals_the_plain_form(monkeypatch):
    texts = [*ODD_TEXTS, "A B c d E", "a b", "Ünï Ä ö a b c a b c"]
    plain = [slow_print(t) for t in texts]
    unsigned = lambda t: S.fingerprint(None if t is None else t.encode()) % 2**64
    assert [unsigned(t) for t in texts] == plain
    monkeypatch.setattr(S, "BLOCK", 7)  # blocks lose and double no shingle
    assert [unsigned(t) for t in texts if t is None or len(t) < 1000] == [p for t, p in zip(texts, plain, strict=True) if t is None or len(t) < 1000]


def test_golay_code_is_perfect_and_near_is_complete():
    golay = S.GolayDecoder()
    code = golay.code
    assert np.bitwise_count(code[code > 0]).min() == 7 and len(np.unique(code)) == 4096
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 300, dtype=np.uint32)
    index, valid = golay.near(words)
    for w, i, v in zip(words, index, valid, strict=True):
        assert set(i[v].tolist()) == set(np.flatnonzero(np.bitwise_count(code ^ w) <= 4).tolist())
        assert np.bitwise_count(code[i[0]] ^ w) <= 3


def test_fingerprints_within_three_bits_always_share_a_key():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    other = base.copy()
    for k in range(3):
        other ^= np.uint64(1) << rng.integers(0, 64, len(base)).astype(np.uint64)
    left, _ = S.golay_keys(base.view(np.int64))
    _, right = S.golay_keys(other.view(np.int64))
    assert all(np.intersect1d(a, b).size for a, b in zip(left, right, strict=True))


def components(prints):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def expected(rows):
    prints = [slow_print(t) for _, t in rows]
    root = components(set(prints))
    best = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            best[root[p]] = min(best.get(root[p], i), i)
    return [(i, p, best.get(root[p])) for (i, _), p in zip(rows, prints, strict=True)]


WORDS = [f"w{i}" for i in range(400)]
NEAR = [" ".join(WORDS[:k] + ["other"] + WORDS[k + 1 :]) for k in range(0, 400, 10)]


@pytest.mark.parametrize("case", ["odd", "near", "ties"])
def test_components_equal_brute_force(spark, case):
    rows = {
        "odd": list(enumerate(ODD_TEXTS)),
        "near": list(enumerate([*NEAR, *NEAR[:5], "alone in the dark", ""], 10)),
        "ties": [(4, NEAR[0])] * 3 + [(4, NEAR[1]), (None, NEAR[2]), (None, "null ids only here"), (None, None), (3, "short")],
    }[case]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows], extra=True).repartition(3)
    got = S.near_groups(df)
    assert bag((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got.collect()) == bag(expected(rows))


def test_whole_table_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, "documents").collect()]
    got = S.near_groups(read(spark, "documents"))
    assert bag((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got.collect()) == bag(expected(rows))


def test_one_row_of_each_component_stays(spark):
    rows = [(4, NEAR[0])] * 3 + [(4, NEAR[1]), (None, NEAR[2]), (None, "null ids only here"), (3, "short")]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows], extra=True)
    got = S.drop_near_copies(df)
    assert got.columns == df.columns
    wanted = {c: None for _, _, c in expected(rows)}
    assert len({slow_print(t) for t in NEAR[:3]}) > 0
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == sorted((c is None, c or 0) for c in wanted)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(50)] + [(200, i) for i in range(300, 340)] + [(7, 7), (None, 3)]
    got = connected_components(spark.createDataFrame(chain, "a long, b long"), "a", "b")
    want = [(i, 0) for i in range(51)] + [(200, 200)] + [(i, 200) for i in range(300, 340)]
    assert bag(map(tuple, got.collect())) == bag(want)


def test_links_are_only_found_up_to_three_bits(spark):
    with pytest.raises(ValueError):
        S.links(empty(spark, "fingerprint long"), max_bits=4)


def test_empty(spark):
    assert S.near_groups(empty(spark)).count() == 0
    assert S.drop_near_copies(empty(spark)).count() == 0


def test_hubs_meet_their_smallest_neighbour_without_a_shuffle(spark):
    """Stars, a chain and pairs; one node holds most of the links."""
    import collections

    from meterlake.llm import components as C

    links = [(5000, i) for i in range(1000, 2200)] + [(i, i + 1) for i in range(3000, 3040)] + [(7000 + 2 * i, 7001 + 2 * i) for i in range(50)]
    links += [(2199, 3000), (9000, 5000), (1, 9000)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in C.connected_components(df, "a", "b").collect()}
    above = {x: x for pair in links for x in pair}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        above[b] = a
    assert got == {x: top(x) for x in above}
    assert collections.Counter(got.values())[1] > 1200
    smallest = C._smallest(df.selectExpr("a AS u", "b AS v"), len(links))
    assert "BroadcastHashJoin" in smallest._jdf.queryExecution().executedPlan().toString()
