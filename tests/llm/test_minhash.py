import random
import re

import numpy as np
import pytest

from meterlake.llm import minhash as M
from tests.llm.helpers import ODD_TEXTS, docs, empty, read


def slow(rows):
    """Components over all pairs, on sets of shingles."""
    sets = []
    for _, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(words[i : i + 4]) for i in range(len(words) - 3)} or ({tuple(words)} if words else set()))
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if part[i] != part[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) > 0:
                part = [part[j] if p == part[i] else p for p in part]
    least = {}
    for k, p in enumerate(part):
        ids = [rows[m][0] for m in range(len(rows)) if part[m] == p and rows[m][0] is not None]
        least[k] = min(ids) if ids else None
    return sorted((repr(rows[k][0]), len(sets[k]), repr(least[k])) for k in range(len(rows)))


def found(df):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in df.collect())


def variants(n, length, changes, seed=0):
    """Texts that differ from one base in a few words: many pairs under, and
    some over, the threshold."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(draw.randrange(changes + 1)):
            words[draw.randrange(length)] = f"v{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


TEXTS = variants(60, 60, 4) + variants(40, 25, 2, 1) + ["a b c", "A  b\tC", "a b c d", "a b c d e", *ODD_TEXTS, *ODD_TEXTS]


@pytest.mark.parametrize("block", [M.BLOCK_CLASSES, 8])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK_CLASSES", block)
    rows = list(zip(random.Random(2).sample(range(1000), len(TEXTS)), TEXTS, strict=True))
    ids, texts = zip(*rows, strict=True)
    got = M.near_groups(docs(spark, list(texts), ids=list(ids), extra=True).repartition(5))
    assert found(got) == slow(rows)


def test_components_of_a_table(spark):
    rows = [tuple(r) for r in read(spark, "documents").select("doc_id", "text").collect()]
    assert found(M.near_groups(read(spark, "documents"))) == slow(rows)


def test_the_threshold_is_exact(spark):
    words = [f"w{i}" for i in range(30)]
    # 9 shingles of 4 words; without the last two words 7: 7 / 9 < 0.8; without one 8 / 9
    texts = [" ".join(words[:12]), " ".join(words[:10]), " ".join(words[:11])]
    assert found(M.near_groups(docs(spark, texts[:2]))) == [("0", 9, "0"), ("1", 7, "1")]
    assert found(M.near_groups(docs(spark, texts))) == [("0", 9, "0"), ("1", 7, "0"), ("2", 8, "0")]
    # 4 / 5 is just enough
    assert found(M.near_groups(docs(spark, [" ".join(words[:8]), " ".join(words[:7])]))) == [("0", 5, "0"), ("1", 4, "0")]


def test_null_ids_and_repeated_rows(spark):
    got = M.near_groups(docs(spark, ["a b c d e", "a b c d e", "a b c d e", None, None, "x", "x"], ids=[None, 5, 5, None, 7, None, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, -1), (-1, -1), (-1, 5), (5, 5), (5, 5), (7, 7)]
    # one row stays of each component
    assert sum(r.first for r in got) == 4


def test_empty_table(spark):
    assert M.near_groups(empty(spark)).count() == 0
    assert found(M.near_groups(docs(spark, ["", None, " \n"]))) == [("0", 0, "0"), ("1", 0, "1"), ("2", 0, "2")]


def test_signatures_estimate_the_similarity():
    shingler = M.Shingler()
    one = shingler.shingles(" ".join(f"a{i}" for i in range(3000)).encode())
    two = np.r_[one[:2400], shingler.shingles(" ".join(f"b{i}" for i in range(600)).encode())]
    share = (shingler.signature(one) == shingler.signature(two)).mean()
    assert abs(share - len(np.intersect1d(one, two)) / len(np.union1d(one, two))) < 0.15
    assert len(set(shingler.band_keys(shingler.signature(one)).tolist())) == M.BANDS
    assert (shingler.band_keys(shingler.signature(one)) >> M.BAND_SHIFT).tolist() == list(range(M.BANDS))
