import re

import pytest

from meterlake.llm import decontaminate as D
from tests.llm.helpers import ODD_TEXTS, bag, docs, empty, read


def cut(text, size=5):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()


def brute(documents, items):
    out = {}
    for i, item in items:
        size = min(5, len(re.findall(r"[^\W_]+", (item or "").lower())))
        of = cut(item, size)
        for d, text in documents:
            own = cut(text, size)
            if i is not None and of and len(own & of) >= 0.8 * len(of) - 1e-9:
                out[d, i] = max(out.get((d, i), 0), len(own & of) / len(of))
    return [(d, i, c) for (d, i), c in out.items()]


def found(df, items, **options):
    rows = D.contained_items(df, items, **options).groupBy("doc_id", "item_id").agg({"containment": "max"}).collect()
    return [tuple(r) for r in rows]


LONG = [f"word{i}" for i in range(30_000)]
ITEM = [f"item{i}" for i in range(25)]


def fixture(spark):
    few = " ".join(ITEM)
    near = ITEM[:3] + ["changed"] + ITEM[4:]  # 4 of 21 shingles gone: 0.81
    far = ITEM[:10] + ["changed"] + ITEM[11:]  # 5 of 21 gone: 0.76
    scattered = ITEM[:13] + LONG[:500] + ITEM[9:]  # in two places, all shingles
    rows = list(enumerate([
        few, few.upper() + "!", " ".join(LONG + ITEM + LONG), " ".join(LONG + near), " ".join(far), " ".join(scattered),
        "three word text", "Three, word: TEXT", "a three word text", *ODD_TEXTS,
    ]))
    rows += [(0, few), (0, "other"), (None, few)]
    items = [(1, few), (2, "three word text"), (3, None), (4, ""), (None, few), (5, " ".join(LONG[100:160])), (5, "one more item of five"), (1, few)]
    # items of one to four words, found inside long texts and at their ends
    rows += [(50, " ".join(LONG[:20_000]) + " lone, wolf! " + " ".join(LONG)), (51, "the end is Lone Wolf"), (52, "wolf lone"), (53, "lone")]
    items += [(10, "lone wolf"), (11, "Lone"), (12, "word7 word8 word9 word10"), (13, "word7 word9 word10"), (14, "a three word text")]
    return rows, items


@pytest.mark.parametrize("few_broadcast", [True, False])
def test_pairs_equal_brute_force(spark, few_broadcast):
    rows, items = fixture(spark)
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows], extra=True).repartition(4)
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = found(df, frame, max_broadcast=100 if few_broadcast else 0)
    assert bag(got) == bag(brute(rows, items)) and len(got) > 8


def test_a_saturated_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(D, "FILTER_BITS", D.SECTION)
    items = [(i, " ".join(f"t{i}x{k}" for k in range(6 + i % 40))) for i in range(1500)]
    rows = [(i, f"start {t} end") for i, t in items[::3]]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = found(docs(spark, [t for _, t in rows], [i for i, _ in rows]), frame)
    assert sorted(got) == [(i, i, 1.0) for i, _ in rows]


def test_blocks_lose_no_shingle(monkeypatch):
    text = " ".join(LONG[:5000])
    whole = set(D.shingle_hashes(D.words_of(text)).tolist())
    monkeypatch.setattr(D, "BLOCK", 100)
    blocks = list(D._blocks(text, 5))
    assert len(blocks) > 100
    assert set().union(*(D.shingle_hashes(b).tolist() for b in blocks)) == whole


def test_table_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, "documents").collect()]
    items = [(r.item_id, r.text) for r in read(spark, "benchmark").collect()]
    got = found(read(spark, "documents"), read(spark, "benchmark"))
    assert bag(got) == bag(brute(rows, items)) and got


@pytest.mark.parametrize("limit", [100, 0])
def test_drop(spark, limit):
    rows, items = fixture(spark)
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows], extra=True)
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = D.drop_contaminated(df, frame, max_broadcast=limit)
    assert got.columns == df.columns
    want = [(i, t) for i, t in rows if not brute([(i, t)], items)]
    assert bag((r.doc_id, r.text) for r in got.collect()) == bag(want)


def test_empty(spark):
    items = read(spark, "benchmark")
    assert D.contained_items(empty(spark), items).count() == 0
    none = empty(spark, "item_id long, text string")
    assert D.contained_items(docs(spark, ["a b c"]), none).count() == 0
    assert D.drop_contaminated(docs(spark, ["a b c", None]), none).count() == 2
