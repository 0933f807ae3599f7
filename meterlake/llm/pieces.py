"""SentencePiece encoding and decoding by suffix-array matching.

Ids equal those of the ``sentencepiece`` library for byte-pair models with
identity normalisation, dummy prefix and byte fallback. Only the model file's
vocabulary is read; matching, merging and decoding are done here, per Arrow
batch:

1. spaces become ``▁``, one is put in front, and texts are cut before each
   ``▁`` that follows another character. No piece has a ``▁`` after another
   character (checked when a model is loaded), so no piece crosses a cut;
2. the distinct words of a block are concatenated and indexed by a suffix
   array (prefix doubling up to the longest piece);
3. every piece is looked up by binary search; its range in the suffix array
   holds all its occurrences. Each is an edge (start, end, piece);
4. edges are sorted by position and relaxed from left to right. A prefix of a
   word has exactly one merge-ordered encoding; its last piece p is found by
   the edge whose predecessor (the last piece q of the prefix that it leaves)
   makes (q, p) a stable pair: undoing the merges of q and p from the last to
   the first never meets a merge across their border that would have come
   earlier. All words of a block are relaxed together, one offset at a time;
5. ids are read off backwards.

Characters without a piece become UTF-8 byte pieces. Some pieces have no
merge order of their own (equal scores, or a part that merges later than the
whole, such as runs of ``▁``); words where such a piece occurs are merged
pair by pair with a heap instead, as are words longer than ``LONG_WORD``.

Defined results: a null or empty text has no ids and decodes to ''. The
characters ``▁`` and space are one in this encoding, so a text holding ``▁``
decodes to one with spaces. Rows that repeat, null ids and other columns pass
through. Empty input gives no rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.tables import release_memory

SPACE = "▁"
BLOCK_CHARS = 1 << 18  # characters of distinct words in one index
KNOWN_WORDS = 200_000
BATCH_CHARS = 1 << 19  # characters of texts taken together
LONG_WORD = 1 << 12
PACK, CODE_BITS = 3, 21  # code points in one search key, bits of each
NONE = np.iinfo(np.int64).max

# FIXED VALUES: piece types of the model format
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

_CUT = re.compile(f"(?<=[^{SPACE}])(?={SPACE})")
_MODELS: dict = {}
_ENCODERS: dict = {}


def _pack(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Three code points as one sortable number."""
    return (a << 2 * CODE_BITS) | (b << CODE_BITS) | c


class PieceModel:
    """Vocabulary and merge order of a byte-pair model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, kinds = proto.normalizer_spec, {p.type for p in proto.pieces}
        if (
            proto.trainer_spec.model_type != 2
            or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not (norm.add_dummy_prefix and norm.escape_whitespaces)
            or proto.trainer_spec.treat_whitespace_as_suffix
        ):
            raise ValueError("only byte-pair models with identity normalisation and a dummy prefix are known here")
        self.size = len(proto.pieces)
        self.text = [p.piece for p in proto.pieces]
        self.normal = [i for i, p in enumerate(proto.pieces) if p.type == NORMAL]
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.id) or len(self.bytes) != 256:
            raise ValueError("a piece goes over a word border, or byte pieces are missing")
        self.longest = max(map(len, self.id))
        # what an id decodes to, as UTF-8
        self.plain = [b""] * self.size
        for i in self.normal:
            self.plain[i] = self.text[i].replace(SPACE, " ").encode("utf-8")
        for value, i in self.bytes.items():
            self.plain[i] = bytes([value])
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.plain[self.unknown] = proto.trainer_spec.unk_surface.encode("utf-8")
        self._merge_order()
        self._search_rows()

    def _merge_order(self) -> None:
        """Per piece its rank (order of merging), last merge and regularity."""
        scores = sorted(set(self.score.values()), reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        times: dict[float, int] = {}
        for p in self.score:
            if len(p) > 1:
                times[self.score[p]] = times.get(self.score[p], 0) + 1
        self.rank = np.full(self.size + 1, -1, dtype=np.int64)  # -1: a single character
        self.left = np.arange(self.size + 1)
        self.right = np.arange(self.size + 1)
        self.odd = np.zeros(self.size + 1, dtype=bool)
        pairs = {}
        for p, i in self.id.items():
            if len(p) == 1:
                continue
            self.rank[i] = rank_of[self.score[p]]
            for k in range(1, len(p)):
                a, b = self.id.get(p[:k]), self.id.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * (self.size + 1) + b] = self.rank[i]
            parts = self.merged(p, keep_last=True)
            known = [self.id.get(x) for x in parts]
            if len(parts) != 2 or None in known or times[self.score[p]] > 1 or any(c not in self.id for c in p):
                self.odd[i] = True
                continue
            self.left[i], self.right[i] = known
        for p, i in sorted(self.id.items(), key=lambda x: len(x[0])):
            if len(p) > 1 and not self.odd[i]:
                a, b = self.left[i], self.right[i]
                self.odd[i] = self.odd[a] or self.odd[b] or max(self.rank[a], self.rank[b]) >= self.rank[i]
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_keys, self.pair_ranks = keys, np.array([pairs[k] for k in keys.tolist()], dtype=np.int64)

    def merged(self, word: str, keep_last: bool = False) -> list[str]:
        """The word merged pair by pair, best score first, leftmost of equals.
        ``keep_last``: stop before the merge that would make it whole."""
        parts: list = list(word)
        after = list(range(1, len(parts))) + [-1]
        before = [-1, *range(len(parts) - 1)]
        heap: list = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (s := self.score.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-s, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if parts[i] != a or after[i] < 0 or parts[after[i]] != b:
                continue
            if keep_last and len(a) + len(b) == len(word):
                break
            j = after[i]
            parts[i], parts[j] = a + b, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p is not None]

    def _search_rows(self) -> None:
        """The pieces as keys of three code points each, for the binary search."""
        self.piece_ids = np.array(self.normal, dtype=np.int32)
        self.piece_len = np.array([len(self.text[i]) for i in self.normal], dtype=np.int32)
        self.byte_ids = np.array([self.bytes[b] for b in range(256)], dtype=np.int32)
        width = -(-self.longest // PACK) * PACK
        rows = np.zeros((len(self.normal), width), dtype=np.int64)
        inside = np.arange(width) < self.piece_len[:, None]
        for r, i in enumerate(self.normal):
            rows[r, : len(self.text[i])] = [ord(c) for c in self.text[i]]
        # per three code points the smallest and the largest key of a suffix
        # that starts with the piece
        full = np.where(inside, rows, (1 << CODE_BITS) - 1)
        self.first_keys = [_pack(*rows[:, k : k + PACK].T) for k in range(0, width, PACK)]
        self.last_keys = [_pack(*full[:, k : k + PACK].T) for k in range(0, width, PACK)]
        self.single = np.sort(np.array([ord(p) for p in self.id if len(p) == 1], dtype=np.int32))

    def ids(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for p in parts:
            if p in self.id:
                out.append(self.id[p])
            else:
                out += [self.bytes[b] for b in p.encode("utf-8")]
        return out

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * (self.size + 1) + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece b after piece a stays apart from it (see module)."""
        key, back = np.unique(a * (self.size + 1) + b, return_inverse=True)
        a, b = key // (self.size + 1), key % (self.size + 1)
        good = np.ones(len(a), dtype=bool)
        limit = np.full(len(a), NONE)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            # a merge across the border that comes before the one last undone
            crossed = self.pair_rank(x, y) < limit[live]
            good[live[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            done = crossed | ((rx < 0) & (ry < 0))
            undo_left = rx > ry  # of equal ranks the right one was merged later
            limit[live] = np.where(undo_left, rx, ry + 1)
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
            live = live[~done]
        return good[back]


def load_model(path: str) -> PieceModel:
    """The model, read once per worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _encoder(path: str) -> Encoder:
    """The worker's encoder: words seen by one task help the next."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(load_model(path))
    return _ENCODERS[path]


# ------------------------------------------------------------- suffix array


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the first ``depth`` (or more) code points."""
    # code points have 21 bits: two of them in one sort key to begin with
    rank = text.astype(np.int64)
    width, order = 1, None
    while width < depth:
        follow = np.zeros_like(rank)
        follow[:-width] = rank[width:]
        key = (rank << 32) + follow
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate(([1], 1 + np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty_like(rank)
        rank[order] = new
        if new[-1] == len(text):
            break
        width *= 2
    return order


def _search(keys: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of each wanted value in its own sorted stretch of keys."""
    low, high = low.copy(), high.copy()
    while (live := np.flatnonzero(low < high)).size:
        mid = (low[live] + high[live]) >> 1
        right = keys[mid] <= wanted[live] if after else keys[mid] < wanted[live]
        low[live[right]] = mid[right] + 1
        high[live[~right]] = mid[~right]
    return low


def occurrence_ranges(model: PieceModel, text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per piece the range of the suffix array whose suffixes start with it:
    binary search of the first three code points, then within what that
    leaves of the next three, and so on."""
    padded = np.concatenate([text.astype(np.int64), np.zeros(model.longest + PACK, np.int64)])
    packed = _pack(padded[:-2], padded[1:-1], padded[2:])
    low = np.zeros(len(model.piece_ids), dtype=np.int64)
    high = np.full(len(model.piece_ids), len(order), dtype=np.int64)
    for step, (first, last) in enumerate(zip(model.first_keys, model.last_keys, strict=True)):
        live = np.flatnonzero((model.piece_len > PACK * step) & (low < high))
        keys = packed[order + PACK * step]
        if step == 0:
            low, high = np.searchsorted(keys, first, "left"), np.searchsorted(keys, last, "right")
            continue
        low[live], high[live] = (
            _search(keys, low[live], high[live], first[live], False),
            _search(keys, low[live], high[live], last[live], True),
        )
    return low, high


# ------------------------------------------------------------------ encode


def _edges(model: PieceModel, words: list[str]):
    """All edges of the words: code points, word starts, and per edge its
    start, length, piece and word."""
    text = np.frombuffer("\0".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.int32)
    start_of = np.concatenate(([0], np.flatnonzero(text == 0) + 1)).astype(np.int32)
    order = suffix_array(text, model.longest).astype(np.int32)
    low, high = occurrence_ranges(model, text, order)
    times = high - low
    which = np.repeat(np.arange(len(times), dtype=np.int32), times)
    start = order[np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())]
    # characters without a piece: an edge of their own, to the "piece" after the last id
    lone = np.flatnonzero(~_among(text, model.single) & (text != 0)).astype(np.int32)
    piece = np.concatenate([model.piece_ids[which], np.full(len(lone), model.size, np.int32)])
    length = np.concatenate([model.piece_len[which], np.ones(len(lone), np.int32)])
    start = np.concatenate([start, lone])
    word_of = np.cumsum(text == 0, dtype=np.int32)
    return text, start_of, start, length, piece, word_of[start]


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _encode_block(model: PieceModel, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct non-empty words without \\0 through one index: all ids
    in the order of the words, and how many each word has."""
    text, start_of, start, length, piece, word = _edges(model, words)
    odd = np.zeros(len(words), dtype=bool)
    odd[word[model.odd[piece]]] = True
    # sorted by offset in the word, so that all words advance together
    offset = start - start_of[word]
    by = np.argsort(offset.astype(np.uint16), kind="stable")  # words are at most LONG_WORD long
    by = by[~odd[word[by]]]
    start, piece, length, offset = start[by], piece[by], length[by], offset[by]
    last = np.full(len(text) + 1, -1, dtype=np.int32)  # last piece of the prefix that ends here
    size = np.zeros(len(text) + 1, dtype=np.int32)
    bounds = np.searchsorted(offset, np.arange(int(offset[-1]) + 2 if len(offset) else 1))
    for k in range(len(bounds) - 1):
        s, p, n = (x[bounds[k] : bounds[k + 1]] for x in (start, piece, length))
        if k:
            came = last[s]
            reached = np.flatnonzero(came >= 0)
            fits = reached[model.stable(came[reached].astype(np.int64), p[reached].astype(np.int64))]
            s, p, n = s[fits], p[fits], n[fits]
        last[s + n] = p
        size[s + n] = n

    # read the pieces off, all words together, from their ends
    at = np.append(start_of[1:] - 1, len(text)).astype(np.int64)
    used = np.zeros(len(text) + 1, dtype=bool)
    live = np.flatnonzero(~odd)
    while len(live):
        used[at[live]] = True
        at[live] -= size[at[live]]
        live = live[at[live] > start_of[live]]
    ends = np.flatnonzero(used)
    found = last[ends]
    owner = np.searchsorted(start_of, ends, side="left") - 1
    lone = found == model.size
    if lone.any():  # UTF-8 bytes of the characters without a piece
        raw = [chr(c).encode("utf-8") for c in text[ends[lone] - 1].tolist()]
        times = np.ones(len(found), dtype=np.int64)
        times[lone] = [len(x) for x in raw]
        found, owner, lone = np.repeat(found, times), np.repeat(owner, times), np.repeat(lone, times)
        found[lone] = model.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    count = np.bincount(owner, minlength=len(words))
    if odd.any():
        rest = {w: np.array(model.ids(model.merged(words[w])), dtype=np.int32) for w in np.flatnonzero(odd).tolist()}
        before = np.cumsum(count) - count
        found = np.insert(found, np.repeat(before[list(rest)], list(map(len, rest.values()))), np.concatenate([*rest.values()]))
        count[list(rest)] = list(map(len, rest.values()))
    return found.astype(np.int32), count


class Encoder:
    """Encodes texts; holds the ids of up to ``KNOWN_WORDS`` words seen, and
    of those of the last texts when that is reached."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.number: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.count = np.empty(0, np.int64)

    def keep(self, words: list[str]) -> None:
        """Forget all words but these."""
        at = np.array([self.number[w] for w in words], dtype=np.int64)
        self.ids, self.count = self._gather(at)
        self.number = {w: i for i, w in enumerate(words)}

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered words, one after the other, and their counts."""
        count = self.count[at]
        begin = (np.cumsum(self.count) - self.count)[at]
        return self.ids[np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())], count

    def learn(self, words: list[str]) -> None:
        found, counts = [self.ids], [self.count]
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        odd = [w for w in words if len(w) > LONG_WORD or "\0" in w] if self._has_odd(words, sizes) else []
        for w in odd:
            ids = self.model.ids(self.model.merged(w))
            found.append(np.array(ids, dtype=np.int32))
            counts.append(np.array([len(ids)]))
        if odd:
            skip = set(odd)
            words = [w for w in words if w not in skip]
            sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        block_of = np.cumsum(sizes + 1) // BLOCK_CHARS
        bounds = np.searchsorted(block_of, np.arange(block_of[-1] + 2)) if words else [0]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b > a:
                ids, count = _encode_block(self.model, words[a:b])
                found.append(ids)
                counts.append(count)
        self.number.update(zip([*odd, *words], range(len(self.number), len(self.number) + len(odd) + len(words)), strict=True))
        self.ids, self.count = np.concatenate(found), np.concatenate(counts)

    @staticmethod
    def _has_odd(words: list[str], sizes: np.ndarray) -> bool:
        return bool((sizes > LONG_WORD).any()) or "\0" in "".join(words)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in the order of the texts, and how many each text has."""
        cut = [_CUT.split(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        words = [w for c in cut for w in c]
        if new := [w for w in dict.fromkeys(words) if w not in self.number]:
            self.learn(new)
        at = np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))
        ids, count = self._gather(at)
        if len(self.number) > KNOWN_WORDS:
            self.keep(list(dict.fromkeys(words)))
        per_text = np.add.reduceat(np.append(count, 0), np.cumsum([0, *map(len, cut)])[:-1]) if texts else count
        per_text[[not c for c in cut]] = 0
        return ids, per_text


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in lists of about BATCH_CHARS; null as empty."""
    start = held = 0
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
    for i, n in enumerate([*sizes, BATCH_CHARS]):
        if i == len(texts) or held + n > BATCH_CHARS and held:
            if i > start:
                yield ["" if t is None else t for t in texts.slice(start, i - start).to_pylist()]
            start, held = i, 0
        held += n


def encode_array(encoder: Encoder, texts: pa.Array) -> pa.Array:
    """Lists of ids. Until all are known they are held in two bytes each where
    the vocabulary allows it."""
    small = np.uint16 if encoder.model.size <= 1 << 16 else np.int32
    ids, counts = [np.empty(0, small)], [np.zeros(1, np.int64)]
    for group in _slices(texts):
        found, count = encoder(group)
        ids.append(found.astype(small))
        counts.append(count)
    ends = np.cumsum(np.concatenate(counts))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids, dtype=np.int32)))


def _decode(model: PieceModel, ids: np.ndarray) -> str:
    raw = b"".join([model.plain[i] for i in ids.tolist()])
    text = raw.decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, model_path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text (array of int); a column that
    is called ``out_col`` already is replaced."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(model_path)
        for texts in batches:
            yield encode_array(encoder, texts)
        release_memory()

    return docs.withColumn(out_col, ids(F.col(text_col)))


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of each array of ids, null for null; a column
    that is called ``out_col`` already is replaced."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model(model_path)
        for ids in batches:
            yield pd.Series([None if x is None else _decode(model, x) for x in ids], dtype=object)
        release_memory()

    return docs.withColumn(out_col, text(F.col(ids_col)))
