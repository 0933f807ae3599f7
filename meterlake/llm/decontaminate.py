"""Benchmark decontamination: size-partitioned MinHash containment search.

Words are the runs of letters and digits of the lower-cased text; shingles
are five words. An item of one to four words has one shingle, all its words in
order, and documents are cut into shingles of those lengths too, for the
lengths that occur among the items. A text without words has no shingle. A
document contains an item when it holds at least ``threshold`` of the item's
distinct shingles, wherever they stand in the document.

Search. Items are partitioned by size (class = log2 of the number of
shingles). An item of n shingles is sketched by its m smallest shingle
hashes, m = floor((1 - threshold) * n) + 1. A document that lacks at most
floor((1 - threshold) * n) of the shingles holds at least one of any m of
them, so no contained item is missed, however long the document is — unlike
banded signatures of whole documents, whose Jaccard similarity with a short
item goes to zero. Per size class a document's sketch is its hashes up to the
largest sketch value of the class (small when items are long) that also pass a
bitmap of the class's sketch values; the bitmap has a fixed size, lets every
true value through and is all that is broadcast. Sketches meet in an equi-join
on (class, hash).

Verification. Candidate documents are read again and the exact shingles — as
text, not as hashes — are counted per candidate pair. Documents are broadcast
by id only when counted to be few, else joined.

Defined results: null texts count as empty; documents and items that repeat an
id are searched as they are (the largest containment counts); items with a
null id are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.names import own_columns, unused
from meterlake.llm.tables import files_for, release_memory
from meterlake.scratch import checkpoint_dir

WORDS = 5
THRESHOLD = 0.8
FILTER_BITS = 1 << 20  # bits of a size class's bitmap: 128 KB, whatever the number of items
MAX_BROADCAST = 100_000  # candidate documents (two longs each)
KNOWN_WORDS = 100_000
BLOCK = 1 << 20
SECTION = 1 << 15  # bits of one row of bitmap_construct_agg

_WORD = re.compile(r"[^\W_]+")
_KNOWN: dict[str, int] = {}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _word_hashes(words: list[str]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    if len(_KNOWN) > KNOWN_WORDS:
        _KNOWN.clear()
    for w in set(words).difference(_KNOWN):
        _KNOWN[w] = xxh64_intdigest(w.encode("utf-8"))
    return np.fromiter(map(_KNOWN.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_hashes(words: list[str], size: int = WORDS) -> np.ndarray:
    """A 63-bit hash of each shingle of ``size`` words, in order; equal
    shingles hash equally, and the size counts."""
    if len(words) < size or not size:
        return np.empty(0, dtype=np.int64)
    own = _word_hashes(words)
    mixed = np.full(len(own) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + own[i : i + len(mixed)]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return (mixed >> np.uint64(1)).astype(np.int64)


def _blocks(text: str | None, size: int) -> Iterator[list[str]]:
    """The words in blocks; each repeats the last ``size - 1`` words of the
    one before. A short text is one block."""
    text = (text or "").lower()
    if len(text) <= BLOCK:
        yield _WORD.findall(text)
        return
    held: list[str] = []
    fresh = 0
    for m in _WORD.finditer(text):
        held.append(m.group())
        fresh += 1
        if fresh >= BLOCK // 8:
            yield held
            held, fresh = held[-(size - 1) :], 0
    if fresh:
        yield held


def _cuts(text: str | None, sizes: list[int]) -> Iterator[tuple[list[str], int]]:
    """The word blocks, each with every shingle length."""
    for block in _blocks(text, max(sizes)):
        for size in sizes:
            yield block, size


def _shingle_texts(words: list[str], size: int) -> list[str]:
    return [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if size else []


def item_shingles(items: DataFrame, size: int = WORDS, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, no, hash, shingle, n, words): the distinct shingles of each
    item row, ``no`` their rank by hash, ``n`` their number and ``words`` their
    length."""

    @F.pandas_udf("array<struct<no: int, hash: bigint, shingle: string, n: int, words: int>>")
    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            words = words_of(text)
            k = min(size, len(words))
            found = sorted(set(zip(shingle_hashes(words, k).tolist(), _shingle_texts(words, k), strict=True)))
            out.append([{"no": i, "hash": h, "shingle": s, "n": len(found), "words": k} for i, (h, s) in enumerate(found)])
        return pd.Series(out, dtype=object)

    rows = items.where(F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("item_id"), F.xxhash64(text_col).alias("item_row"), F.explode(cut(text_col)).alias("s"))
    return rows.select("item_id", "item_row", "s.*").distinct()


def size_class(n):
    return F.floor(F.log2(n)).cast("int")


def _filters(sketch: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Per size class the largest sketch value and the bitmap of the values: at
    most FILTER_BITS bits for each of the few classes, gathered in sections."""
    slot = F.pmod("hash", F.lit(FILTER_BITS)) + 1  # bitmap positions count from 1
    rows = sketch.groupBy("class", F.bitmap_bucket_number(slot).alias("section")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"), F.max("hash").alias("top")
    )
    out: dict[int, tuple[int, np.ndarray]] = {}
    for r in rows.collect():
        top, held = out.get(r["class"], (0, np.zeros(FILTER_BITS, dtype=bool)))
        at = (r["section"] - 1) * SECTION
        held[at : at + SECTION] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        out[r["class"]] = (max(top, r["top"]), held)
    return out


def _document_sketch(docs: DataFrame, filters: dict, sizes: list[int]) -> DataFrame:
    """(doc_id, text_hash, class, hash): what of each document may match."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast({c: (top, np.packbits(held)) for c, (top, held) in filters.items()})

    @F.pandas_udf("array<struct<class: int, hash: bigint>>")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = {c: (top, np.unpackbits(held).view(bool)) for c, (top, held) in shared.value.items()}
        for texts in batches:
            out = []
            for text in texts:
                found: set = set()
                for block, size in _cuts(text, sizes):
                    hashes = shingle_hashes(block, size)
                    slots = hashes & (FILTER_BITS - 1)
                    for c, (top, held) in own.items():
                        found.update((c, h) for h in hashes[held[slots] & (hashes <= top)].tolist())
                out.append([{"class": c, "hash": h} for c, h in sorted(found)])
            yield pd.Series(out, dtype=object)
        _KNOWN.clear()  # a worker outlives its task
        release_memory()

    return docs.withColumn("s", F.explode(sketch("text"))).select("doc_id", "text_hash", "s.*")


def _candidate_shingles(docs: DataFrame, filters: dict, sizes: list[int]) -> DataFrame:
    """(doc_id, text_hash, hash, shingle): distinct shingles of the candidate
    documents that some item may hold."""
    sc = docs.sparkSession.sparkContext
    held = np.zeros(FILTER_BITS, dtype=bool)
    for _, bits in filters.values():
        held |= bits
    shared = sc.broadcast(np.packbits(held))

    @F.pandas_udf("array<struct<hash: bigint, shingle: string>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = np.unpackbits(shared.value).view(bool)
        for texts in batches:
            out = []
            for text in texts:
                found: set = set()
                for block, size in _cuts(text, sizes):
                    hashes = shingle_hashes(block, size)
                    for i in np.flatnonzero(own[hashes & (FILTER_BITS - 1)]).tolist():
                        found.add((int(hashes[i]), " ".join(block[i : i + size])))
                out.append([{"hash": h, "shingle": s} for h, s in sorted(found)])
            yield pd.Series(out, dtype=object)
        _KNOWN.clear()
        release_memory()

    return docs.withColumn("s", F.explode(cut("text"))).select("doc_id", "text_hash", "s.*")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    size: int = WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """Pairs of a document and an item it contains: doc_id, text_hash (of the
    document's text), item_id, n_shared, n_shingles, containment."""
    checkpoint_dir(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash")
    )
    shingles = item_shingles(items, size).withColumn("class", size_class("n"))
    shingles = shingles.coalesce(files_for(docs.sparkSession, 50 * items.count())).checkpoint()
    # floor((1 - threshold) * n) shingles may be missing; one more cannot
    missing = F.floor(F.col("n") * (1 - threshold) + 1e-9)
    sketch = shingles.where(F.col("no") <= missing).select("class", "hash", "item_id", "item_row")
    filters = _filters(sketch)
    # one to ``size`` lengths
    sizes = sorted({size} | {r[0] for r in shingles.select("words").distinct().collect()})
    hits = _document_sketch(rows, filters, sizes).join(sketch, ["class", "hash"])
    pairs = hits.select("doc_id", "text_hash", "item_id", "item_row").distinct()
    pairs = pairs.coalesce(files_for(docs.sparkSession, docs.count())).checkpoint()

    wanted = pairs.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    if wanted.count() <= max_broadcast:
        wanted = F.broadcast(wanted)
    again = rows.join(wanted, (rows["text_hash"] == wanted["_hash"]) & rows["doc_id"].eqNullSafe(wanted["_id"]), "left_semi")
    found = _candidate_shingles(again, _filters(shingles), sizes).distinct()
    # the documents' shingles meet the items' by hash and by text ...
    shared = found.join(shingles, ["hash", "shingle"]).select("doc_id", "text_hash", "item_id", "item_row", "n", "hash", "shingle")
    counted = shared.groupBy("doc_id", "text_hash", "item_id", "item_row", "n").agg(F.count(F.lit(1)).alias("n_shared"))
    # ... and only pairs that the search found are judged
    p = pairs.select(*[F.col(c).alias(f"_{c}") for c in pairs.columns])
    on = counted["doc_id"].eqNullSafe(p["_doc_id"])
    for c in ("text_hash", "item_id", "item_row"):
        on = on & (counted[c] == p[f"_{c}"])
    judged = counted.join(p, on, "left_semi").where(F.col("n_shared") >= F.col("n") * threshold - 1e-9)
    best = F.max(F.struct(F.col("n_shared") / F.col("n"), "n_shared", F.col("n").alias("n_shingles"))).alias("best")
    return (
        judged.groupBy("doc_id", "text_hash", "item_id")
        .agg(best)
        .select("doc_id", "text_hash", "item_id", "best.n_shared", "best.n_shingles", (F.col("best.n_shared") / F.col("best.n_shingles")).alias("containment"))
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that contain an item, all their columns."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = contained_items(docs, items, **options)
    bad = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    bad = bad.coalesce(files_for(docs.sparkSession, docs.count())).checkpoint()
    own = unused(docs, "_own")
    rows = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    if bad.count() <= options.get("max_broadcast", MAX_BROADCAST):
        bad = F.broadcast(bad)
    on = (rows[own] == bad["_hash"]) & rows[id_col].eqNullSafe(bad["_id"])
    return rows.join(bad, on, "left_anti").select(*own_columns(docs))
