"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprint: texts lower-cased in A-Z, words ``[^\\x20\\x09-\\x0D]+``,
shingles of ``words`` words joined by a space (repeats count; a shorter text
is one shingle; no word at all: fingerprint 0). A bit of the 64 is 1 if it is
set in over half of the shingles' XXH64 (seed 42). Two fingerprints link at
``max_bits`` (3) or fewer differing bits.

Candidates. The 64 bits are cut into three segments (22, 21, 21 bits), each a
word of the perfect binary Golay code [23, 12]. If two fingerprints differ in
at most three bits, two of the three segments differ in at most one bit each:
were that false, two segments would hold two errors each. For two words x, y
at distance <= 1 the codeword nearest to x (distance <= 3) lies within 4 of y.
So each segment is decoded to the index of its nearest codeword and to the
indices of all codewords within 4 (one, or six for 86 % of words), and for
every pair of segments (a, b)

* the "left" keys of x are (nearest(a), each index of b),
* the "right" keys of y are (each index of a, nearest(b)).

Any two fingerprints within three bits meet in the equi-join of left and right
keys, and a pair meets at most once per segment pair. The join verifies the
bit distance as part of its condition, so only true links leave it. Nothing is
capped: the keys of a hot bucket are split by AQE's skew join.

Only distinct fingerprints are joined; documents reach their component over
the fingerprint, so exact copies cost no links.

Defined results: null text counts as empty. Component: smallest non-null id
reachable (null if all are null). Rows with equal ids keep their own
fingerprints. Empty input gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.components import connected_components
from meterlake.llm.names import keep_listed, own_columns, unused
from meterlake.llm.tables import files_for, release_memory
from meterlake.scratch import checkpoint_dir

WORDS = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
SEGMENT_PAIRS = ((0, 1), (0, 2), (1, 2))
BLOCK = 1 << 20

# FIXED VALUE: generator polynomial of the binary Golay code,
# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY_GENERATOR = 0b110001110101

_WHITE = re.compile(rb"[ \t-\r]")


# ------------------------------------------------------------- fingerprints


def _blocks(text: bytes, keep: int) -> Iterator[list[bytes]]:
    """The words in blocks of about BLOCK bytes; each repeats the ``keep``
    last words of the one before, so that no shingle is lost or doubled."""
    start, tail = 0, []
    while start < len(text):
        cut = _WHITE.search(text, start + BLOCK) if len(text) - start > BLOCK else None
        end = cut.start() if cut else len(text)
        found = tail + text[start:end].split()
        if found:
            yield found
            tail = found[-keep:] if keep else []
        start = end


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """64-bit SimHash of one UTF-8 text, as a signed integer."""
    from xxhash import xxh64_intdigest

    counts, total, short = np.zeros(64, dtype=np.int64), 0, []
    # bytes.lower and bytes.split know ASCII only: A-Z and \x20\x09-\x0D
    for block in _blocks((text or b"").lower(), words - 1):
        if len(block) < words:
            short = block
            continue
        short = []
        shingles = map(b" ".join, zip(*(block[i:] for i in range(words)), strict=False))
        hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    if not total:
        if not short:
            return 0
        return int(np.array([xxh64_intdigest(b" ".join(short), SEED)], dtype="<u8").view("<i8")[0])
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fingerprint) per row; the hash tells apart rows
    that share an id."""

    @F.pandas_udf("bigint")
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, words) for t in batch], dtype="int64")
        release_memory()

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        simhash(text.cast("binary")).alias("fingerprint"),
    )


# --------------------------------------------------------------- Golay code


def _codewords() -> np.ndarray:
    """The 4,096 codewords, by the 12 data bits that stand in their top bits."""
    data = np.arange(4096, dtype=np.uint32)
    rest = data << 11
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ np.uint32(GOLAY_GENERATOR << (bit - 11)), rest)
    return (data << 11 | rest).astype(np.uint32)


class GolayDecoder:
    """Indices of the codewords near 23-bit words."""

    def __init__(self):
        code = _codewords()
        one = (1 << np.arange(23)).astype(np.uint32)
        errors = [np.zeros(1, np.uint32), one]
        two = np.unique((one[:, None] | one)[~np.eye(23, dtype=bool)])
        three = np.unique(two[:, None] | one)
        errors += [two, three[np.bitwise_count(three) == 3]]
        # perfect code: each word is one codeword plus one error of weight <= 3
        self.nearest_index = np.empty(1 << 23, dtype=np.uint16)
        for e in np.concatenate(errors):
            self.nearest_index[code ^ e] = code >> 11
        self.code = code
        # from an error of weight 3 to the five codewords of weight 7 over it:
        # these are at distance 4 from the word
        heavy = code[np.bitwise_count(code) == 7]
        self.three = errors[3]
        self.over = np.array([heavy[heavy & e == e] for e in self.three], dtype=np.uint32)

    def nearest(self, words: np.ndarray) -> np.ndarray:
        return self.nearest_index[words].astype(np.int64)

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n, 6) indices of the codewords within 4, and which of them hold."""
        first = self.nearest(words)
        error = words ^ self.code[first]
        hard = np.bitwise_count(error) == 3
        out = np.repeat(first[:, None], 6, axis=1)
        at = np.searchsorted(self.three, error[hard])
        out[hard, 1:] = (self.code[first[hard]][:, None] ^ self.over[at]) >> 11
        valid = np.ones(out.shape, dtype=bool)
        valid[~hard, 1:] = False
        return out, valid


_DECODER: list[GolayDecoder] = []


def golay_keys(prints: np.ndarray) -> tuple[list, list]:
    """Left and right join keys of each signed 64-bit fingerprint."""
    if not _DECODER:
        _DECODER.append(GolayDecoder())
    golay = _DECODER[0]
    bits = prints.astype(np.int64).view(np.uint64)
    parts = [(bits >> np.uint64(s) & np.uint64((1 << n) - 1)).astype(np.uint32) for s, n in SEGMENTS]
    nearest = [golay.nearest(p) for p in parts]
    near = [golay.near(p) for p in parts]
    left, right, held_left, held_right = [], [], [], []
    for k, (a, b) in enumerate(SEGMENT_PAIRS):
        left.append((k << 24) + (nearest[a][:, None] << 12) + near[b][0])
        right.append((k << 24) + (near[a][0] << 12) + nearest[b][:, None])
        held_left.append(near[b][1])
        held_right.append(near[a][1])

    def rows(keys, held):
        keys, held = np.hstack(keys), np.hstack(held)
        return np.split(keys[held], np.cumsum(held.sum(axis=1))[:-1])

    if not len(prints):
        return [], []
    return rows(left, held_left), rows(right, held_right)


# --------------------------------------------------------------- components


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a < b) of distinct fingerprints that differ in at most
    ``max_bits`` (at most 3) bits; a pair may come up to three times."""
    if max_bits > 3:
        raise ValueError("the segment pairs cover at most three differing bits")

    @F.pandas_udf("struct<lefts: array<bigint>, rights: array<bigint>>")
    def keys(values: pd.Series) -> pd.DataFrame:
        lefts, rights = golay_keys(values.to_numpy())
        return pd.DataFrame({"lefts": lefts, "rights": rights})

    # one evaluation serves both sides of the join
    keyed = prints.select("fingerprint", keys("fingerprint").alias("k")).select("fingerprint", "k.*").checkpoint()
    left = keyed.select(F.col("fingerprint").alias("a"), F.explode("lefts").alias("key"))
    right = keyed.select(F.col("fingerprint").alias("b"), F.explode("rights").alias("key"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return left.hint("merge").join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & close).select("a", "b")


def near_groups(
    docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, text_hash, fingerprint (bigint), component_id and
    ``first`` — whether the row is the one of its component to keep."""
    checkpoint_dir(docs.sparkSession)
    files = files_for(docs.sparkSession, docs.count())
    prints = fingerprints(docs, words, id_col, text_col).coalesce(files).checkpoint()
    # a null id loses against any id; equal ids are told apart by the text
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = prints.groupBy("fingerprint").agg(F.min(order).alias("best")).coalesce(files).checkpoint()
    linked = connected_components(links(classes.select("fingerprint"), max_bits), "a", "b", files)
    linked = classes.join(linked, classes["fingerprint"] == linked["node"]).select("fingerprint", "component", "best")
    least = linked.groupBy("component").agg(F.min("best").alias("least"))
    ties = linked.join(least, "component").select("fingerprint", "least")
    # a table of its own: both sides of the last join are then plain shuffles,
    # which AQE splits where one fingerprint has very many rows
    whole = classes.join(ties, "fingerprint", "left").select("fingerprint", F.coalesce("least", "best").alias("least"))
    whole = whole.coalesce(files).checkpoint()
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    return prints.join(whole, "fingerprint").select(
        "doc_id",
        "text_hash",
        "fingerprint",
        F.col("least.doc_id").alias("component_id"),
        own.eqNullSafe(F.col("least")).alias("first"),
    )


def drop_near_copies(
    docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component (smallest id), all its columns."""
    groups = near_groups(docs, words, max_bits, id_col, text_col)
    keep = groups.where("first").select("doc_id", "text_hash")
    own = unused(docs, "_own")
    rows = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return keep_listed(rows, [id_col, own], keep).select(*own_columns(docs))
