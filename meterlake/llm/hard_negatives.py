"""Hard-negative mining with exact scores by the Four-Russians method.

A row's score with an anchor is the inner product of their vectors after each
component x became floor(256 * x). Scores come from table lookups:

* an anchor's dimensions are taken in groups of eight; for every group a table
  of 256 entries holds the sums of all subsets of its eight components;
* a candidate's components are packed, bit plane by bit plane, into one byte
  per group (two's complement, as many planes as the largest component asks
  for): the byte of a plane and a group is an index into the group's table;
* the lookups of one plane, added over the groups, are the anchor's product
  with that plane; the planes are joined from the top by shift and add, the
  sign plane counting negative. Every score is whole and exact.

Anchors are rows of ids divisible by ``anchor_every``. They are taken in waves
of at most ``WAVE`` rows, the bound of what is collected and broadcast at
once; candidates stay where they are and every one is scored with every
anchor, in blocks. Tasks keep the first ``positives`` (``negatives``) rows per
anchor (per anchor and positive), and those few meet by window. A wave goes
through the candidates twice: the windows of the negatives are known after the
positives.

Order everywhere: higher score, then smaller id, null ids last. Defined
results: rows with a null label, a null vector, or a null or non-finite
component take no part. A row is another row than the anchor even if it
repeats the anchor's id or vector; repeated rows are returned as often as they
come. Shorter vectors count as padded with zeros. A null id is never an
anchor and keeps its label. Components of 2^26 or more in size after scaling
raise an error (sums could leave 64 bits). Empty input, or no anchors, gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.scratch import checkpoint_dir

GROUP = 8  # dimensions that share a table
WAVE = 4_096  # anchors broadcast at once
TABLE_ANCHORS = 128  # anchors whose tables are used together
CELLS = 1 << 18  # scores held at once
LARGEST = 1 << 26


# ------------------------------------------------------------------- scores


def pack_planes(vectors: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes of (rows, dimensions) integers."""
    n, dims = vectors.shape
    held = np.zeros((n, -(-dims // GROUP) * GROUP), dtype=np.int64)
    held[:, :dims] = vectors
    out = [np.packbits((held >> b & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(planes)]
    return np.stack(out, axis=1) if out else np.zeros((n, 0, held.shape[1] // GROUP), np.uint8)


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """(groups, 256, anchors): sums of every subset of a group's components."""
    n, dims = anchors.shape
    held = np.zeros((n, -(-dims // GROUP) * GROUP), dtype=dtype)
    held[:, :dims] = anchors
    tables = np.zeros((held.shape[1] // GROUP, 1 << GROUP, n), dtype=dtype)
    for g, table in enumerate(tables):
        for bit in range(GROUP):
            # subsets with this dimension: those without it, and its component
            table[1 << bit : 2 << bit] = table[: 1 << bit] + held[:, g * GROUP + bit]
    return tables


def lookup_scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, anchors) exact inner products."""
    total = np.zeros((len(planes), tables.shape[2]), dtype=tables.dtype)
    for b in reversed(range(planes.shape[1])):
        one = np.zeros_like(total)
        for g in range(len(tables)):
            one += tables[g].take(planes[:, b, g], axis=0)
        total = -one if b == planes.shape[1] - 1 else (total << 1) + one
    return total


class Anchors:
    """A wave's anchors with their tables, made once per task."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray, planes: int):
        self.rows, self.labels = rows, labels
        bound = vectors.shape[1] << 2 * max(planes - 1, 0)
        dtype = np.int32 if bound < 1 << 30 else np.int64
        self.blocks = [
            (a, subset_sums(vectors[a : a + TABLE_ANCHORS], dtype)) for a in range(0, len(vectors), TABLE_ANCHORS)
        ]

    def scored(self, planes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first row, first anchor, scores) over all rows and anchors."""
        step = max(1, CELLS // TABLE_ANCHORS)
        for i in range(0, len(planes), step):
            for a, tables in self.blocks:
                yield i, a, lookup_scores(tables, planes[i : i + step])


class Best:
    """The first ``keep`` entries of each slot, by score, id and row."""

    def __init__(self, slots: int, keep: int):
        self.keep = keep
        self.least = np.full(slots, np.iinfo(np.int64).min)  # score of a full slot's last entry
        self.held = [np.zeros(0, np.int64) for _ in range(5)]  # slot, score, no id, id, row

    def add(self, slot: np.ndarray, score: np.ndarray, none: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(slot):
            return
        cells = [np.concatenate(x) for x in zip(self.held, (slot, score, none, ids, rows), strict=True)]
        order = np.lexsort((cells[4], cells[3], cells[2], -cells[1], cells[0]))
        cells = [x[order] for x in cells]
        starts = np.flatnonzero(np.r_[True, cells[0][1:] != cells[0][:-1]])
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        self.held = [x[place < self.keep] for x in cells]
        last = cells[0][place == self.keep - 1]
        self.least[last] = cells[1][place == self.keep - 1]


# -------------------------------------------------------------------- stages


def _table(batch: pa.RecordBatch, planes: int, groups: int) -> tuple:
    """Columns of a batch of packed rows as arrays."""
    ids = batch.column("vec_id")
    bits = np.frombuffer(b"".join(batch.column("planes").to_pylist()), np.uint8).reshape(-1, planes, groups)
    return (
        ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
        ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
        batch.column("row").to_numpy(zero_copy_only=False),
        batch.column("label").to_numpy(zero_copy_only=False),
        bits,
    )


def packed_rows(
    vectors: DataFrame, relabel_every: int, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, int, int]:
    """((row, vec_id, label, vector, planes), planes, groups): the rows that
    take part, checkpointed, so that their row numbers stay."""
    checkpoint_dir(vectors.sparkSession)
    ids, label = F.col(id_col).cast("long"), F.col(label_col).cast("long")
    moved = F.when(ids % relabel_every == 0, (label + 1) % 10).otherwise(label) if relabel_every else label
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(label.isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        ids.alias("vec_id"),
        moved.alias("label"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * 256)).alias("vector"),
    )
    low, high, dims = rows.agg(F.min(F.array_min("vector")), F.max(F.array_max("vector")), F.max(F.size("vector"))).first()
    if low is not None and max(-low, high) >= LARGEST:
        raise ValueError("components are too large for 64-bit scores")
    dims = dims or 0
    groups = -(-dims // GROUP)
    planes = 0 if low is None else max(int(high), int(-low - 1)).bit_length() + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            flat = np.zeros((batch.num_rows, dims), np.int64)
            sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            bits = pack_planes(flat, planes)
            narrow = pa.array([x.tobytes() for x in bits], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), lists, narrow], names=["vec_id", "label", "vector", "planes"])

    packed = rows.mapInArrow(pack, "vec_id bigint, label bigint, vector array<bigint>, planes binary")
    packed = packed.select(F.monotonically_increasing_id().alias("row"), "*").checkpoint()
    return packed, planes, groups


def _collect(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """row, id, label and vector of a wave's anchors, by row."""
    table = rows.select("row", "vec_id", "label", "vector").toArrow().sort_by("row")
    vectors = np.zeros((table.num_rows, dims), np.int64)
    for i, v in enumerate(table.column("vector").to_pylist()):
        vectors[i, : len(v)] = v
    return (*(table.column(c).to_numpy() for c in ("row", "vec_id", "label")), vectors)


def _found(best: Best, positives: int) -> Iterator[pa.RecordBatch]:
    slot, score, none, ids, row = best.held
    names = ["anchor", "place", "vec_id", "row", "score"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(slot // positives), pa.array(slot % positives), pa.array(ids, mask=none.astype(bool)), pa.array(row), pa.array(score)], names=names
    )


_FOUND = "anchor bigint, place bigint, vec_id bigint, row bigint, score bigint"


def _first(found: DataFrame, keep: int) -> DataFrame:
    """The first rows of each anchor and place, numbered by ``rank``."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _wave(rows: DataFrame, anchors: DataFrame, planes: int, groups: int, positives: int, negatives: int, low: int, high: int, scale: int) -> DataFrame:
    """All triples of one wave of anchors (at most WAVE rows)."""
    sc = rows.sparkSession.sparkContext
    at, ids, labels, vectors = _collect(anchors, groups * GROUP)
    shared = sc.broadcast((at, labels, vectors))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave, best = Anchors(*shared.value, planes), Best(len(at), positives)
        for batch in batches:
            none, vec, row, label, bits = _table(batch, planes, groups)
            for i, a, scores in wave.scored(bits):
                to, n = slice(a, a + scores.shape[1]), slice(i, i + len(scores))
                good = (label[n, None] == wave.labels[to]) & (row[n, None] != wave.rows[to]) & (scores >= best.least[to])
                r, c = np.nonzero(good)
                best.add(a + c, scores[r, c].astype(np.int64), none[i + r], vec[i + r], row[i + r])
        yield from _found(best, 1)

    narrow = rows.select("row", "vec_id", "label", "planes")
    same = _first(narrow.mapInArrow(nearest, _FOUND), positives)
    # at most WAVE * positives rows
    top = same.select("anchor", (F.col("rank") - 1).alias("place"), "vec_id", "score").toArrow()
    slots = np.full((len(at), positives), np.iinfo(np.int64).min)
    slots[top.column("anchor").to_numpy(), top.column("place").to_numpy()] = top.column("score").to_numpy()
    shared_slots = sc.broadcast(slots)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave, best, bounds = Anchors(*shared.value, planes), Best(len(at) * positives, negatives), shared_slots.value
        none_held = bounds == np.iinfo(np.int64).min
        # integer bounds of low * p <= scale * n <= high * p
        least = np.where(none_held, 1, -(-low * np.where(none_held, 0, bounds) // scale))
        most = np.where(none_held, 0, high * np.where(none_held, 0, bounds) // scale)
        for batch in batches:
            none, vec, row, label, bits = _table(batch, planes, groups)
            for i, a, scores in wave.scored(bits):
                to, n = slice(a, a + scores.shape[1]), slice(i, i + len(scores))
                other = label[n, None] != wave.labels[to]
                for k in range(positives):
                    slot = np.arange(a, a + scores.shape[1]) * positives + k
                    floor = np.maximum(least[to, k], best.least[slot])
                    r, c = np.nonzero(other & (scores >= floor) & (scores <= most[to, k]))
                    best.add(slot[c], scores[r, c].astype(np.int64), none[i + r], vec[i + r], row[i + r])
        yield from _found(best, positives)

    other = _first(narrow.mapInArrow(between, _FOUND), negatives)
    named = rows.sparkSession.createDataFrame(
        pa.table({"anchor": pa.array(np.arange(len(at))), "anchor_id": pa.array(ids)})
    )
    pairs = rows.sparkSession.createDataFrame(top).withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"})
    known = F.broadcast(pairs.withColumn("place", F.col("place").cast("long")).join(F.broadcast(named), "anchor"))
    return other.join(known, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def mine(
    vectors: DataFrame,
    anchor_every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    most_percent: int = 100,
    relabel_every: int = 7,
    wave: int = WAVE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank (int), negative_id, positive_score,
    negative_score: for each anchor and positive its first negatives with
    ``least_percent`` to ``most_percent`` of the positive's score."""
    spark = vectors.sparkSession
    rows, planes, groups = packed_rows(vectors, relabel_every, id_col, vector_col, label_col)
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)
    # a wave is a range of anchor rows: cuts from one sorted pass over row numbers
    cuts = _cuts(anchors, wave)
    out: DataFrame | None = None
    for low, high in cuts:
        part = anchors.where(F.col("row").between(low, high))
        found = _wave(rows, part, planes, groups, positives, negatives, least_percent, most_percent, 100)
        found = found if len(cuts) == 1 else found.checkpoint()
        out = found if out is None else out.unionByName(found)
    if out is None:
        schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return spark.createDataFrame([], schema)
    return out


def _cuts(anchors: DataFrame, wave: int) -> list[tuple[int, int]]:
    """Row ranges of at most ``wave`` anchors. Row numbers are made of the
    partition and the place in it, so ranges are cut inside partitions: by
    anchors counted per partition and stretch of rows."""
    part = F.shiftright("row", 33)
    counted = anchors.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("low"), F.max("row").alias("high"))
    ranges: list[tuple[int, int]] = []
    held = 0
    for _, n, low, high in sorted(counted.collect()):  # one row per partition
        if n <= wave:
            if ranges and held + n <= wave:
                ranges[-1], held = (ranges[-1][0], high), held + n
            else:
                ranges.append((low, high))
                held = n
            continue
        numbers = Window.partitionBy("part").orderBy("row")
        each = anchors.where(part == low >> 33).select("row", part.alias("part")).withColumn("no", F.row_number().over(numbers) - 1)
        marks = each.where(F.col("no") % wave == 0).select("row").orderBy("row").collect()  # one row per wave
        starts = [m[0] for m in marks]
        ranges += list(zip(starts, [*(s - 1 for s in starts[1:]), high], strict=True))
        held = wave
    return ranges
