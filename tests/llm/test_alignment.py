import collections
import hashlib
import itertools

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from meterlake.llm import alignment as A
from tests.llm.helpers import ODD_TEXTS, docs, empty, read, tokenizer

PATHS = ("byte_bpe_50k.json", "piece_bpe_32k.model")
MORE = ["a  b", "a\0b c", "<|endoftext|> y<s> </s>", "  lead", "trail  ", "a " * 500, "é😀 ퟿ ​ x", "你好世界" * 50, "a", " "]


def slow(texts):
    """Per text by whole-text encoding and a scan over token spans."""
    t = Tokenizer.from_file(tokenizer(PATHS[0]))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer(PATHS[1]))
    symbols = A.byte_symbols()

    def spelled(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    found, count = [], collections.Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a, b = t.encode(" " + (text or ""), add_special_tokens=False).ids, sp.encode(text or "")
        of_a, of_b = [bytes(symbols[c] for c in t.id_to_token(i)) for i in a], [spelled(i) for i in b]
        if not text or b"".join(of_a) != whole or b"".join(of_b) != whole:
            found.append(None)
            continue
        ends_a, ends_b = (list(itertools.accumulate(map(len, x))) for x in (of_a, of_b))
        links, j = [], 0
        for i, end in enumerate(ends_a):
            while ends_b[j] <= end - len(of_a[i]):
                j += 1
            k = j
            while k < len(b) and ends_b[k] - len(of_b[k]) < end:
                links.append((a[i], b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        count.update(links)
        found.append((len(a), len(b), links, groups))
    top = collections.Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = f
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((n_a, n_b, len(groups), len(links), sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links), digest))
    return out


@pytest.mark.parametrize("limit", [A.BROADCAST_PAIRS, 300, 0])
def test_alignment_equals_brute_force(spark, limit):
    texts = [r.text for r in read(spark, "documents").select("text").orderBy("doc_id").limit(60).collect()] + ODD_TEXTS + MORE
    got = A.align(docs(spark, texts, extra=True), *map(tokenizer, PATHS), limit=limit).collect()
    want = slow(texts)
    assert {r.doc_id: tuple(r)[1:8] for r in got} == dict(enumerate(want))


def test_products_equal_dense_ones():
    draw = np.random.default_rng(3)
    for _ in range(20):
        dense = [draw.integers(0, 2, size) for size in ((6, 5), (7, 5))]
        rows = [A.Rows(np.r_[0, np.cumsum(d.sum(axis=1))], np.nonzero(d)[1], 5) for d in dense]
        r, c, v = rows[0].times(rows[1].transposed())
        product = np.zeros((6, 7), int)
        product[r, c] = v
        assert (product == dense[0] @ dense[1].T).all()


def test_links_and_groups_of_one_text():
    a, b = np.array([1, 3, 2]), np.array([2, 2, 2])
    assert [tuple(map(int, x)) for x in zip(*A.overlap_links(a, b), strict=True)] == [(0, 0, 1), (1, 0, 1), (1, 1, 2), (2, 2, 2)]
    # both end at bytes 4 and 6
    assert [tuple(map(int, x)) for x in zip(*A.group_links(a, b), strict=True)] == [(0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 1, 1), (2, 2, 1)]
    row = A.Aligner(A.Tokenizers(*map(tokenizer, PATHS))).block(["some words here"])[0]
    assert row[4] >= row[2] and row[5].count(";") == row[2] - 1


def test_forgotten_pieces_change_nothing(monkeypatch):
    texts = [f"word{i % 7} other{i} and {'x' * (i % 90)}" for i in range(200)]
    tokenizers = A.Tokenizers(*map(tokenizer, PATHS))
    whole = A.Aligner(tokenizers).block(texts)
    monkeypatch.setattr(A, "KNOWN_PIECES", 5)
    few = A.Aligner(tokenizers)
    parts = [few.block([t])[0] for t in texts]
    assert [x[:6] for x in whole] == [x[:6] for x in parts]


def test_new_pieces_are_encoded_put_together(monkeypatch):
    """Runs of pieces in one text, the odd ones alone; the same ids."""
    texts = [" ".join(f"{w}{i}é{i % 13}" for i in range(400)) + tail for w, tail in (("x", ""), ("日", " tail  "), ("q", "\n"))]
    for more, most in (([], 100), (ODD_TEXTS + MORE, 10_000)):
        found = []
        for size in (A.RUN_PIECES, 1):
            monkeypatch.setattr(A, "RUN_PIECES", size)
            aligner, seen = A.Aligner(A.Tokenizers(*map(tokenizer, PATHS))), []
            encode = aligner.tokenizers.encode
            aligner.tokenizers.encode = lambda pieces, seen=seen, encode=encode: seen.extend(pieces) or encode(pieces)
            found.append([x[:6] for x in aligner.block(texts + more)])
            assert (len(seen) <= most) if size > 1 else (len(seen) >= 1200)
            monkeypatch.undo()
        assert found[0] == found[1] and all(x[0] for x in found[0][:3])


def test_a_worker_keeps_its_aligner():
    paths = tuple(map(tokenizer, PATHS))
    assert A.worker_aligner(*paths) is A.worker_aligner(*paths)


def test_null_ids_repeats_and_empty_tables(spark):
    got = A.align(docs(spark, ["a b", "a b", None], ids=[None, 1, 1]), *map(tokenizer, PATHS)).collect()
    assert sorted((r.doc_id is None, r.n_a) for r in got) == [(False, 0), (False, 2), (True, 2)]
    assert A.align(empty(spark), *map(tokenizer, PATHS)).count() == 0
