import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from meterlake.llm import pieces as P
from tests.llm.helpers import ODD_TEXTS, docs, empty, read, tokenizer

PATH = tokenizer("piece_bpe_32k.model")
ODD = [*ODD_TEXTS, "   a   b", "<0x0A> <s> </s>", "\0a\0", " " * 300 + "x", "x" + " " * 300, "the cat sat", "▁▁a▁b", "ab" * 3000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def own(texts):
    return P.encode_array(P.Encoder(P.load_model(PATH)), pa.array(texts, pa.string())).to_pylist()


def test_ids_equal_the_library_on_odd_and_random_texts(library):
    rng = random.Random(3)
    model = P.load_model(PATH)
    chars = "abc XYZ\n\t012é中文梦😀'\",.!<>x9▁"
    texts = [t or "" for t in ODD]
    texts += ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += ["".join(model.text[rng.choice(model.normal)] for _ in range(rng.randint(1, 9))) for _ in range(500)]
    assert own(texts) == library.encode(texts)
    assert [P._decode(model, np.array(x)) for x in own(texts)] == library.decode(library.encode(texts))


def test_blocks_and_forgetting_do_not_matter(library, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_CHARS", 50)
    monkeypatch.setattr(P, "BATCH_CHARS", 80)
    monkeypatch.setattr(P, "KNOWN_WORDS", 10)
    monkeypatch.setattr(P, "LONG_WORD", 12)
    texts = ["the quick brown fox jumps over the lazy dog", "", "internationalisation of 中文 texts", "   spaced   out"] * 3
    assert own(texts) == library.encode(texts)


def test_whole_table_round_trip(spark, library):
    df = read(spark, "documents")
    got = P.decode(P.encode(df, PATH), PATH)
    assert got.columns == [*df.columns, "ids", "decoded"]
    rows = got.collect()
    assert len(rows) == 200
    for r in rows:
        assert r.ids == library.encode(r.text) and r.decoded == r.text


def test_suffix_array_and_ranges():
    model = P.load_model(PATH)
    text = np.frombuffer("▁the\0▁then\0the".encode("utf-32-le"), dtype=np.int32)
    order = P.suffix_array(text, model.longest)
    shown = text.tolist()
    assert [shown[i:] for i in order] == sorted(shown[i:] for i in range(len(shown)))
    low, high = P.occurrence_ranges(model, text, order)
    at = model.piece_ids.tolist().index(model.id["the"])
    assert sorted(order[low[at] : high[at]].tolist()) == [1, 6, 11]


def test_nulls_extra_columns_and_empty(spark):
    df = docs(spark, [None, "a b", "a b"], [None, 1, 1], extra=True)
    rows = P.decode(P.encode(df, PATH), PATH).collect()
    assert [(r.doc_id, r.decoded, r["a.b"]) for r in rows] == [(None, "", "mine"), (1, "a b", "mine"), (1, "a b", "mine")]
    assert rows[0].ids == [] and rows[1].ids == rows[2].ids
    assert P.decode(P.encode(empty(spark), PATH), PATH).count() == 0
