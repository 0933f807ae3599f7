"""Cross-tokenizer alignment by sparse products of token-byte incidences.

Tokenizer A is a byte-level BPE of ``tokenizers``, tokenizer B a byte-pair
model of ``sentencepiece``; both spell out space+text. A token's row in the
incidence matrix has a one in the column of each byte that it covers. The
matrices are kept in compressed sparse rows, built by hand, and multiplied
row by row (Gustavson): row i of A·Bᵀ adds up the rows of Bᵀ that row i of A
names, so its entries are the overlap links of token i with their shared
bytes. Byte offsets where tokens of both end cut the tokens into groups;
products of the token-group incidences give the links of tokens that share a
group.

Texts are cut at safe boundaries (before a space after a character that is no
white space: no token of either tokenizer goes over one, so tokens of both end
there), and the distinct pieces of a block of texts are encoded once. The texts
of a block are multiplied together, as one block-diagonal product.

``align`` counts every id pair's links over the corpus. Pairs of the highest
counts, at most ``BROADCAST_PAIRS`` of them, are broadcast; links of the others
are counted by a join, so nothing depends on how many pairs there are.

Defined results: a null or empty text, and a text that either tokenizer does
not spell out byte for byte, has no tokens: zeros and ''. Rows that repeat,
and null ids, each give a row. Empty input gives no rows. Special strings in
texts are plain text. A text without any boundary is aligned as one piece: its
worker holds some 200 bytes per byte of that piece.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.token_counts import _SAFE_CUT as SAFE_CUT
from meterlake.llm.token_counts import safe_pieces
from meterlake.scratch import checkpoint_dir

SPACE = "▁"
GROUP_CHARS = 1 << 18  # characters of texts aligned together
KNOWN_PIECES = 400_000  # pieces that a worker remembers
RUN_PIECES = 256  # new pieces that are encoded as one text
KNOWN_LENGTH = 64  # longer pieces are not remembered
BROADCAST_PAIRS = 1 << 18
PAIR_BITS = 32  # an id pair as one number: A's id above B's


# ------------------------------------------------------------ sparse products


class Rows:
    """A zero-one matrix in compressed sparse rows."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, width: int):
        self.starts, self.columns, self.width = starts, columns, width

    @classmethod
    def spans(cls, lengths: np.ndarray) -> Rows:
        """Row i covers the next ``lengths[i]`` columns."""
        starts = np.r_[0, np.cumsum(lengths)]
        return cls(starts, np.arange(starts[-1]), int(starts[-1]))

    def transposed(self) -> Rows:
        owner = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        starts = np.r_[0, np.cumsum(np.bincount(self.columns, minlength=self.width))]
        return Rows(starts, owner[order], len(self.starts) - 1)

    def times(self, other: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, value) of the product's entries, by row and column.
        Gustavson: the rows of ``other`` that a row names are put together and
        equal columns added up; here for all rows in one pass."""
        sizes = np.diff(other.starts)[self.columns]
        row = np.repeat(np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts)), sizes)
        within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        column = other.columns[np.repeat(other.starts[self.columns], sizes) + within]
        cell = row * max(other.width, 1) + column
        if len(cell) and (np.diff(cell) < 0).any():
            cell = np.sort(cell)
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
        value = np.diff(np.r_[first, len(cell)])
        return cell[first] // max(other.width, 1), cell[first] % max(other.width, 1), value


def overlap_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, shared bytes) by token byte lengths."""
    return Rows.spans(a).times(Rows.spans(b).transposed())


def token_groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B: groups end where both end."""
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    at = np.searchsorted(ends_b, ends_a)
    both = ends_a[ends_b[np.minimum(at, len(b) - 1)] == ends_a] if len(b) else ends_a[:0]
    return np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)


def group_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, 1) for tokens of one group."""
    in_a, in_b = token_groups(a, b)
    n = int(in_a[-1]) + 1 if len(in_a) else 0
    one = Rows(np.arange(len(in_a) + 1), in_a, n)
    return one.times(Rows(np.arange(len(in_b) + 1), in_b, n).transposed())


# ---------------------------------------------------------------- tokenizers


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable bytes for themselves, the others by 256, 257, ..."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both libraries and what their ids spell out."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        symbols = byte_symbols()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            if all(c in symbols for c in token):
                self.bytes_a[i] = bytes(symbols[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.space = self.b.piece_to_id(SPACE)
        self.bytes_b = [self._spelled(i) for i in range(self.b.get_piece_size())]

    def _spelled(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        return self.b.id_to_piece(i).replace(SPACE, " ").encode("utf-8")

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B of pieces that start with a space (B adds its own)."""
        a = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        b = self.b.encode([p[1:] for p in pieces], num_threads=1)
        # the library leaves an empty text without its space
        return a, [x if x or p != " " else [self.space] for p, x in zip(pieces, b, strict=True)]


_ALIGNERS: dict = {}


def worker_aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner, kept with the pieces it knows from task to task."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(Tokenizers(path_a, path_b))
    return _ALIGNERS[path_a, path_b]


class Aligner:
    """Alignments of texts, with a bounded memory of pieces seen."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers, self.known = tokenizers, ({}, {})
        self.bad: set[str] = set()  # pieces that a tokenizer does not spell out
        sizes = (tokenizers.bytes_a, tokenizers.bytes_b)
        self.long_a, self.long_b = (np.array([len(x) for x in t], dtype=np.int64) for t in sizes)
        # what an id adds to the group text: inside its run, and at its end
        self.written = np.array(
            [f"{i}{mark}" for t, marks in zip(sizes, (",|", ",;"), strict=True) for mark in marks for i in range(len(t))], dtype=object
        )

    def _learn(self, pieces: list[str]) -> None:
        """Remembers the ids of A and of B of new pieces, as packed integers.
        Pieces are encoded put together, as in a text; those of a text that is
        not spelled out in shorter ones, at last each on their own."""
        # pieces that end in white space cannot be followed by another one
        ends = [SAFE_CUT.match(p + " ", len(p)) is not None for p in pieces]
        alone = [p for p, safe in zip(pieces, ends, strict=True) if not safe]
        rest = [p for p, safe in zip(pieces, ends, strict=True) if safe]
        for size in (RUN_PIECES, RUN_PIECES // 16):
            runs = [rest[i : i + size] for i in range(0, len(rest), size)] if size > 1 else []
            rest = [] if runs else rest
            texts = ["".join(run) for run in runs]
            for run, text, a, b in zip(runs, texts, *self.tokenizers.encode(texts), strict=True):
                cut = self._cut(run, text, a, b)
                if cut is None:
                    rest += run
                    continue
                for known, packed in zip(self.known, cut, strict=True):
                    known.update(zip(run, packed, strict=True))
        if alone or rest:
            self._learn_alone(alone + rest)

    def _cut(self, run: list[str], text: str, *ids: list[int]) -> list[list[bytes]] | None:
        """The packed ids of each piece of a run; None if a tokenizer does not
        spell it out or a token goes over a piece's end."""
        spelled = text.encode("utf-8")
        # in bytes, also of pieces that are not ASCII
        ends = np.cumsum([len(p) if p.isascii() else len(p.encode("utf-8")) for p in run])
        out = []
        for x, table, lengths in zip(ids, (self.tokenizers.bytes_a, self.tokenizers.bytes_b), (self.long_a, self.long_b), strict=True):
            if b"".join([table[i] for i in x]) != spelled:
                return None
            flat = np.array(x, dtype=np.uint32)
            long = np.cumsum(lengths[flat])
            # after the last token that ends there: some tokens may have no bytes
            at = np.searchsorted(long, ends, side="right")
            if (long[at - 1] != ends).any():
                return None
            packed, at = flat.tobytes(), [0, *(4 * at).tolist()]
            out.append([packed[y:z] for y, z in zip(at, at[1:], strict=False)])
        return out

    def _learn_alone(self, pieces: list[str]) -> None:
        """The same, piece by piece."""
        spelled = [p.encode("utf-8") for p in pieces]
        sizes = np.array([len(x) for x in spelled])
        good = np.ones(len(pieces), dtype=bool)
        for ids, known, table, lengths in zip(
            self.tokenizers.encode(pieces), self.known, (self.tokenizers.bytes_a, self.tokenizers.bytes_b), (self.long_a, self.long_b), strict=True
        ):
            flat = np.fromiter(chain.from_iterable(ids), dtype=np.uint32)
            ends = np.cumsum([len(x) for x in ids])
            long = np.r_[0, np.cumsum(lengths[flat])]
            held = np.diff(long[np.r_[0, ends]]) == sizes
            if not held.all() or b"".join([table[i] for i in flat.tolist()]) != b"".join(spelled):
                # some piece is not spelled out: which ones
                held = np.array([b"".join([table[i] for i in x]) == y for x, y in zip(ids, spelled, strict=True)])
            good &= held
            packed, at = flat.tobytes(), (4 * np.r_[0, ends]).tolist()
            known.update(zip(pieces, [packed[x:y] for x, y in zip(at, at[1:], strict=False)], strict=True))
        self.bad.update(p for p, fine in zip(pieces, good.tolist(), strict=True) if not fine)

    def _encoded(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
        """The ids of A and of B of all texts, and where each text ends."""
        cut = [safe_pieces(" " + t) if t else [] for t in texts]
        if len(self.known[0]) > KNOWN_PIECES:
            self.known, self.bad = ({}, {}), set()
        of_a, of_b = self.known
        new = list(set().union(*cut) - of_a.keys())
        if new:
            self._learn(new)
        a, b, ends_a, ends_b = [], [], [0], [0]
        for pieces in cut:
            if self.bad and not self.bad.isdisjoint(pieces):
                pieces = []
            one, two = b"".join(map(of_a.__getitem__, pieces)), b"".join(map(of_b.__getitem__, pieces))
            a.append(one)
            b.append(two)
            ends_a.append(ends_a[-1] + len(one) // 4)
            ends_b.append(ends_b[-1] + len(two) // 4)
        for p in new:
            if len(p) > KNOWN_LENGTH:
                del of_a[p], of_b[p]
                self.bad.discard(p)
        flat = [np.frombuffer(b"".join(x), dtype=np.uint32).astype(np.int64) for x in (a, b)]
        return flat[0], flat[1], ends_a[1:], ends_b[1:]

    def _group_texts(self, a, b, in_a, in_b, size_a, size_b) -> np.ndarray:
        """The group texts' parts, one per token, in order."""
        ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
        n_a, n_b = len(self.long_a), len(self.long_b)
        last_a = np.arange(len(a)) == ends_a[in_a] - 1
        last_b = np.arange(len(b)) == ends_b[in_b] - 1
        at = np.empty(len(a) + len(b), dtype=np.int64)
        # before a token: all of its own kind, and the other kind's whole groups
        at[np.arange(len(a)) + (ends_b - size_b)[in_a]] = a + n_a * last_a
        at[np.arange(len(b)) + ends_a[in_b]] = 2 * n_a + b + n_b * last_b
        return self.written[at]

    def block(self, texts: list[str | None]) -> list[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, n_shared, groups (None: no
        tokens), distinct pairs and how often each is linked; all texts by one
        block-diagonal product."""
        a, b, ends_a, ends_b = self._encoded(texts)
        long_a, long_b = self.long_a[a], self.long_b[b]
        left, right, _ = overlap_links(long_a, long_b)
        pair = a[left] << PAIR_BITS | b[right]
        in_a, in_b = token_groups(long_a, long_b)
        n_groups = int(in_a[-1]) + 1 if len(in_a) else 0
        size_a, size_b = np.bincount(in_a, minlength=n_groups), np.bincount(in_b, minlength=n_groups)
        # row sums of the group product: its entries are not listed, a long group has many
        shared = np.r_[0, np.cumsum(size_b[in_a])].tolist()
        group = np.r_[in_a, n_groups].tolist()
        parts = self._group_texts(a, b, in_a, in_b, size_a, size_b)
        link = np.searchsorted(left, np.r_[0, ends_a]).tolist()
        out, start_a, start_b, none = [], 0, 0, np.zeros(0, np.int64)
        for k, (end_a, end_b) in enumerate(zip(ends_a, ends_b, strict=True)):
            if end_a == start_a:
                out.append((0, 0, 0, 0, 0, None, none, none))
                continue
            groups = "".join(parts[start_a + start_b : end_a + end_b].tolist())[:-1]
            pairs, counts = np.unique(pair[link[k] : link[k + 1]], return_counts=True)
            sums = (group[end_a] - group[start_a], link[k + 1] - link[k], shared[end_a] - shared[start_a])
            out.append((end_a - start_a, end_b - start_b, *sums, groups, pairs, counts))
            start_a, start_b = end_a, end_b
        return out


def text_blocks(texts: list[str | None], limit: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``limit`` characters."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


# -------------------------------------------------------------------- stages

_COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]


def aligned_texts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_shared
    (links of tokens that share a group), groups_sha256, pairs and their
    links (two arrays)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_aligner(path_a, path_b)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, end in text_blocks(texts):
                found = aligner.block(texts[start:end])
                columns = [batch.column("doc_id").slice(start, end - start)]
                columns += [pa.array([x[k] for x in found], pa.int64()) for k in range(5)]
                columns.append(pa.array([hashlib.sha256(x[5].encode()).hexdigest() if x[5] is not None else "" for x in found], pa.string()))
                starts = pa.array(np.r_[0, np.cumsum([len(x[6]) for x in found])], pa.int32())
                columns += [pa.ListArray.from_arrays(starts, pa.array(np.concatenate([x[k] for x in found]), pa.int64())) for k in (6, 7)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *_COUNTS, "groups_sha256", "pairs", "links"])

    schema = f"doc_id {id_type}, {', '.join(f'{c} bigint' for c in _COUNTS)}, groups_sha256 string, pairs array<bigint>, links array<bigint>"
    return rows.mapInArrow(work, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): every linked id pair's links over the corpus, and
    whether no pair of the same id of B has more."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # summed by batch; the shuffle's map side adds up the batches
        for batch in batches:
            pairs = batch.column("pairs").flatten().to_numpy()
            links = batch.column("links").flatten().to_numpy()
            distinct, at = np.unique(pairs, return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, at, links)
            yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(total)], names=["pair", "n"])

    counted = aligned.select("pairs", "links").mapInArrow(add, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = counted.checkpoint()
    to = F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1)
    highest = counted.groupBy(to.alias("to")).agg(F.max("n").alias("highest"))
    return counted.join(highest, to == F.col("to")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def frequent(pairs: DataFrame, limit: int) -> int:
    """The least count of the pairs to broadcast: at most ``limit`` pairs have
    it or a higher one. Counts are taken by power of two."""
    size = F.floor(F.log2("n")).cast("int")
    held, least = 0, None
    for power, n in sorted(pairs.groupBy(size.alias("size")).count().collect(), reverse=True):  # at most 64 rows
        held += n
        if held > limit:
            break
        least = 1 << power
    return least if least is not None else np.iinfo(np.int64).max


def align(docs: DataFrame, path_a: str, path_b: str, limit: int = BROADCAST_PAIRS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256, n_shared."""
    sc = docs.sparkSession.sparkContext
    checkpoint_dir(docs.sparkSession)
    aligned = aligned_texts(docs, path_a, path_b, id_col, text_col)
    aligned = aligned.withColumn("row", F.monotonically_increasing_id()).checkpoint()
    pairs = pair_counts(aligned).checkpoint()
    least = frequent(pairs, limit)
    top = pairs.where(F.col("n") >= least).toArrow().sort_by("pair")  # at most ``limit`` rows
    shared = sc.broadcast((top.column("pair").to_numpy(), top.column("n").to_numpy(), top.column("best").to_numpy()))
    own = ["doc_id", *_COUNTS, "groups_sha256", "row"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            code, links = lists.flatten().to_numpy(), batch.column("links").flatten().to_numpy()
            of = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy())
            at = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
            hit = known[at] == code if len(known) else np.zeros(len(code), bool)
            total, good = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, of[hit], links[hit] * count[at[hit]])
            np.add.at(good, of[hit], links[hit] * best[at[hit]])
            starts = pa.array(np.r_[0, np.cumsum(np.bincount(of[~hit], minlength=batch.num_rows))], pa.int32())
            columns = [batch.column(c) for c in own] + [pa.array(good), pa.array(total)]
            columns += [pa.ListArray.from_arrays(starts, pa.array(x[~hit])) for x in (code, links)]
            yield pa.RecordBatch.from_arrays(columns, names=[*own, "n_best", "count_sum", "pairs", "links"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.select(*own).schema)
    looked = aligned.mapInArrow(look_up, f"{schema}, n_best bigint, count_sum bigint, pairs array<bigint>, links array<bigint>")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"]
    rare = pairs.where(F.col("n") < least)
    if rare.isEmpty():
        return looked.select(*columns)
    # a rare pair has few links by its count: no key of this join is hot
    each = looked.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("row", "x.pairs", "x.links")
    more = each.join(rare, each["pairs"] == rare["pair"]).groupBy("row").agg(
        F.sum(F.col("links") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum")
    )
    return looked.join(more, "row", "left").select(
        *[
            (F.col(c) + F.coalesce(extra, F.lit(0))).alias(c) if (extra := {"n_best": F.col("more_best"), "count_sum": F.col("more_sum")}.get(c)) is not None else F.col(c)
            for c in columns
        ]
    )
