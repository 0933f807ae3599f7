import pytest

from meterlake.llm import token_counts as C
from tests.llm.helpers import ODD_TEXTS, bag, docs, empty, read, tokenizer

PATH = tokenizer("byte_bpe_50k.json")
MIXED = [*ODD_TEXTS, "a  b   c", "a<|endoftext|> b <|endoftext|>", " lead", "trail ", "it's we'll 12 345,6", "x᠎  y", "x​  y", "a \n b", "...  ...!!  ??", "\x1c \x1d  a"]


def library(texts):
    from tokenizers import Tokenizer

    return [len(Tokenizer.from_file(PATH).encode(t or "", add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("extra", [False, True])
def test_counts_equal_the_library(spark, extra):
    texts = [*MIXED, *MIXED]
    got = C.token_counts(docs(spark, texts, [None, *range(1, len(texts))], extra), PATH)
    want = [(None if i == 0 else i, len((t or "").encode()), n, n > 512) for i, (t, n) in enumerate(zip(texts, library(texts), strict=True))]
    assert bag(map(tuple, got.collect())) == bag(want)


def test_table_equals_the_library(spark):
    df = read(spark, "documents")
    rows = df.collect()
    want = dict(zip([r.doc_id for r in rows], library([r.text for r in rows]), strict=True))
    assert {r.doc_id: r.n_tokens for r in C.token_counts(df, PATH).collect()} == want


def test_pieces_and_parts_join_to_the_text(monkeypatch):
    for t in MIXED:
        if t:
            assert "".join(C.safe_pieces(t)) == t
            assert "".join(C.long_parts(t, 5)) == t
    monkeypatch.setattr(C, "GROUP_BYTES", 40)
    counter = C._Counter(C._tokenizer(PATH))
    texts = ["one two three " * 20, "no" * 60 + " end"]
    assert [counter([t])[0] for t in texts] == library(texts)


def test_empty(spark):
    assert C.token_counts(empty(spark), PATH).count() == 0
