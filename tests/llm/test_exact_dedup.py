import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from meterlake.llm import exact_dedup as X
from tests.llm.helpers import ODD_TEXTS, bag, docs, empty


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out, kept = [], set()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            one = i == keep and text not in kept
            if one:
                kept.add(text)
            out.append((i, keep, len(ids), one, hashlib.sha256(text.encode()).hexdigest()))
    return out


CASES = {
    "copies": [(3, "a  b"), (1, "a\tb"), (2, "a b "), (9, "a\n b"), (4, "A b")],
    "odd": list(enumerate(ODD_TEXTS)) + list(enumerate(ODD_TEXTS, 100)),
    "ties": [(5, "x")] * 4 + [(5, "y")] * 3 + [(None, "x"), (None, "z"), (None, "z"), (None, None), (7, "")],
    "hot": [(i, "same text here" if i % 3 else f"text {i}") for i in range(600)],
}


@pytest.mark.parametrize("case", CASES)
def test_groups_equal_brute_force(spark, case):
    rows = CASES[case]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows], extra=case == "ties").repartition(5)
    got = X.exact_groups(df, salts=3).select("doc_id", "keep_id", "group_size", "kept", "_sha")
    assert bag(map(tuple, got.collect())) == bag(brute(rows))


def test_texts_behind_one_digest_stay_apart(spark):
    rows = [(i, f"text {i % 7}") for i in range(60)] + [(99, None)]
    weak = lambda t: [F.substring(F.sha2(t, 256), 1, 1).alias("_sha"), F.length(t).alias("_len")]
    got = X.exact_groups(docs(spark, [t for _, t in rows], [i for i, _ in rows]), digests=weak)
    assert bag((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == bag(x[:4] for x in brute(rows))


def test_drop_copies_keeps_one_row_and_all_columns(spark):
    rows = CASES["ties"] + [(8, "a  b"), (6, "a b")]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows], extra=True)
    got = X.drop_copies(df)
    assert got.columns == df.columns
    assert bag((r.doc_id, r.text, r["a.b"]) for r in got.collect()) == bag(
        [(5, "x", "mine"), (5, "y", "mine"), (None, "z", "mine"), (6, "a b", "mine"), (7, "", "mine")]
    )


def test_empty(spark):
    assert X.exact_groups(empty(spark)).count() == 0
    assert X.drop_copies(empty(spark)).count() == 0
