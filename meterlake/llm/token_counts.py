"""Token counts of whole texts with a byte-level BPE of ``tokenizers``.

An Arrow function encodes in batches and returns lengths only. Texts are cut
at safe boundaries into pieces, and the distinct pieces of a byte-balanced
group of texts are encoded in one library call; a text's count is the sum over
its pieces. So neither a long text nor a long batch is ever encoded in one go.

A boundary is safe before a space that follows a character that is no white
space: the pre-tokenizer's pattern lets no token go from such a character on
into white space, and what it does after the boundary does not depend on what
stands before it. Special strings (``<|endoftext|>``) hold no space, so no
boundary falls into one, and they are handled as the library does by default.

Defined results: null text counts as empty (0 bytes, 0 tokens). Repeated rows
and null ids each give a row. Empty input gives no rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# characters whose white-space class differs between regex libraries also
# count as unsafe, so that no cut depends on the library's version
_SAFE_CUT = re.compile(r"(?<=[^\s\u180e\u200b-\u200f\u2028-\u202f\u205f-\u206f\ufeff]) ")
GROUP_BYTES = 1 << 20
KNOWN_PIECES = 200_000

_LOADED: dict = {}


def _tokenizer(path: str):
    """The library's tokenizer, loaded once per worker, on one thread."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
        _LOADED[path].no_truncation()
        _LOADED[path].no_padding()
    return _LOADED[path]


def safe_pieces(text: str) -> list[str]:
    """The text cut at all safe boundaries; joined, the pieces are the text."""
    first, *rest = _SAFE_CUT.split(text)
    return [first, *(" " + p for p in rest)]


def long_parts(text: str, limit: int = GROUP_BYTES) -> Iterator[str]:
    """A text of over ``limit`` characters in parts of about that length, cut
    at safe boundaries (a part without any stays whole)."""
    start = 0
    while len(text) - start > limit and (cut := _SAFE_CUT.search(text, start + limit)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _groups(texts, limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``limit`` characters."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class _Counter:
    """Counts with a bounded memory of pieces seen."""

    def __init__(self, tokenizer):
        self.tokenizer, self.known = tokenizer, {}

    def __call__(self, texts: list[str]) -> list[int]:
        if len(texts) == 1 and len(texts[0]) > GROUP_BYTES:
            return [sum(self._count([part])[0] for part in long_parts(texts[0], GROUP_BYTES // 2))]
        return self._count(texts)

    def _count(self, texts: list[str]) -> list[int]:
        cut = [safe_pieces(t) if t else [] for t in texts]
        if len(self.known) > KNOWN_PIECES:
            self.known = {}
        new = list({p for pieces in cut for p in pieces if p not in self.known})
        for a, b in _groups(new, GROUP_BYTES):
            found = self.tokenizer.encode_batch_fast(new[a:b], add_special_tokens=False)
            self.known.update(zip(new[a:b], map(len, found), strict=True))
        known = self.known
        return [sum([known[p] for p in pieces]) for pieces in cut]


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(_tokenizer(tokenizer_path))
        for batch in batches:
            texts = batch.column("text")
            counts: list[int] = []
            sizes = pa.compute.binary_length(texts).to_pylist()
            for a, b in _byte_groups(sizes, GROUP_BYTES):
                counts += counter(texts.slice(a, b - a).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    counted = rows.mapInArrow(count, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def _byte_groups(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)
