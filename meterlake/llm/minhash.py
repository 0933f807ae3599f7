"""MinHash near-dedup: many universal hash minima, banding, verification on
signatures and on full sets, components by alternating stars.

A text is lower-cased in A-Z, its words are ``[^\\x20\\x09-\\x0D]+``, its set
are the distinct shingles of ``words`` words (fewer words: the whole sequence
as one; none: empty, linked with nothing). Two texts link if
``100 * intersection >= percent * union``.

1. one pass makes per row the set's size, a 128-bit digest of the 64-bit
   hashes of its shingles, ``HASHES`` minima under universal hash functions
   (multiply-add), and a key for each of the ``BANDS`` bands of minima. Rows
   of equal digests are one class; only classes go on. Sets themselves are not
   stored: those that are verified are made again from their texts.
2. classes that share a band's key form a bucket. A link at exactly 0.8 is
   missed by all bands with probability (1 - 0.8^4)^32 = 5e-8. Of buckets with
   the same classes one is kept, that of the first band.
3. a bucket is compared in tasks of bounded size. Pairs of a task that share no
   earlier band and whose signatures agree in at least the share that is six
   standard deviations under the threshold are verified on their full sets; a
   pair whose components already met is not verified again. A task returns
   only the links that joined components, never all pairs.
   A bucket that fits a task is done by that. A larger one is compared in two
   rounds: first its blocks, each with the bucket's smallest and largest class
   as pivots, which joins nearly all near copies of a hot group; then all that
   is left outside the bucket's largest component, in blocks, against all of
   the bucket. So a group of a million near copies is not a million by a
   million pairs, and no pair of different components is left out.
4. components of the links by alternating large-star and small-star.

Defined results: null text counts as empty. Rows with equal ids are rows of
their own; a null id never wins over an id, and a component of null ids alone
has a null ``component_id``, its first row is kept. Empty input gives no rows.
Set sizes are exact; two shingles of one pair of texts with the same 64-bit
hash could change a comparison (for sets of 10^5 shingles about 10^-9).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.components import connected_components
from meterlake.llm.tables import files_for
from meterlake.scratch import checkpoint_dir, scratch_path

WORDS = 4
PERCENT = 80
HASHES, BANDS = 128, 32
SEED = 13
BLOCK_CLASSES = 2_048  # classes of one side of a task: with their sets at most 32 MB
CLASS_SHINGLES = 2_048  # a set of so many shingles counts as two classes
CHUNK = 2_048  # shingles hashed at once
CELLS = 1 << 21  # signature cells compared at once
BATCH_BYTES = 1 << 24
BROADCAST_CLASSES = 500_000  # numbers of classes broadcast at most
BAND_SHIFT = 58  # a key: the band's number above 58 bits of hash


# ------------------------------------------------------------- sets, minima


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets and signatures of texts; remembers the hashes of words."""

    KNOWN = 200_000

    def __init__(self, words: int = WORDS, hashes: int = HASHES, bands: int = BANDS):
        draw = np.random.default_rng(SEED)
        self.words, self.bands = words, bands
        self.factors = draw.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.offsets = draw.integers(0, 1 << 63, hashes, dtype=np.uint64)
        self.known: dict[bytes, int] = {}

    def _words(self, found: list[bytes]) -> np.ndarray:
        from xxhash import xxh64_intdigest

        if len(self.known) > self.KNOWN:
            self.known = {}
        known = self.known
        known.update((w, xxh64_intdigest(w)) for w in set(found) if w not in known)
        return np.fromiter((known[w] for w in found), dtype=np.uint64, count=len(found))

    def shingles(self, text: bytes | None) -> np.ndarray:
        """The sorted 64-bit hashes of the distinct shingles."""
        # bytes.lower and bytes.split know ASCII only: A-Z and \x20\x09-\x0D
        hashes = self._words((text or b"").lower().split())
        if not len(hashes):
            return hashes
        length = min(self.words, len(hashes))
        out = np.full(len(hashes) - length + 1, length, dtype=np.uint64)
        for k in range(length):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(out)])
        return np.unique(out)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The minima, as 32-bit numbers."""
        low = shingles & np.uint64(0xFFFFFFFF)
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, dtype=np.uint64)
        for start in range(0, len(low), CHUNK):
            product = np.multiply.outer(low[start : start + CHUNK], self.factors)
            product += self.offsets
            np.minimum(least, product.min(axis=0), out=least)
        return (least >> np.uint64(32)).astype(np.uint32)

    def band_keys(self, signature: np.ndarray) -> np.ndarray:
        parts = signature.reshape(self.bands, -1).astype(np.uint64)
        key = np.arange(self.bands, dtype=np.uint64)
        for k in range(parts.shape[1]):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
        band = np.arange(self.bands, dtype=np.uint64) << np.uint64(BAND_SHIFT)
        return (band | key >> np.uint64(64 - BAND_SHIFT)).view(np.int64)


def shingled(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, d1, d2 (the set's digest),
    signature, bands (keys); for empty sets the last two are null."""
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        shingler = Shingler(words)
        for batch in batches:
            held = []
            for text in batch.column("text"):
                found = shingler.shingles(text.as_py())
                digest = np.frombuffer(xxh3_128_digest(found.tobytes()), dtype="<i8")
                signature = shingler.signature(found) if len(found) else None
                bands = shingler.band_keys(signature) if len(found) else None
                held.append((len(found), *digest.tolist(), signature, bands))
            columns = [batch.column("doc_id"), batch.column("text_hash"), *(pa.array([x[k] for x in held], pa.int64()) for k in range(3))]
            columns.append(pa.array([None if x[3] is None else x[3].tobytes() for x in held], pa.binary()))
            columns.append(pa.array([x[4] for x in held], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_shingles", "d1", "d2", "signature", "bands"])

    schema = f"doc_id {id_type}, text_hash bigint, n_shingles bigint, d1 bigint, d2 bigint, signature binary, bands array<bigint>"
    return rows.mapInArrow(work, schema)


def full_sets(docs: DataFrame, needed: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(class, shingles) of the classes listed in ``needed`` (class, doc_id,
    text_hash): made from a row of the class."""
    if needed.count() <= BROADCAST_CLASSES:
        needed = F.broadcast(needed)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("own_id"), F.xxhash64(text).alias("own_hash"), text.cast("binary").alias("text"))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
    # rows that repeat id and text are one class's
    one = rows.join(needed, same).select("class", "text").dropDuplicates(["class"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            held, start, size = [], 0, 0
            for k, text in enumerate(batch.column("text")):
                held.append(shingler.shingles(text.as_py()).tobytes())
                size += len(held[-1])
                if size > BATCH_BYTES or k == batch.num_rows - 1:
                    names = batch.column("class").slice(start, len(held))
                    yield pa.RecordBatch.from_arrays([names, pa.array(held, pa.binary())], names=["class", "shingles"])
                    start, held, size = k + 1, [], 0

    return one.mapInArrow(work, "class bigint, shingles binary")


# ------------------------------------------------------------------- buckets


def buckets(classes: DataFrame) -> DataFrame:
    """(key, class, blocks, low, high) for classes of one bucket: a band's key
    that several classes have. Buckets of the same classes count once, for
    their first band."""
    keys = classes.select("class", "n_shingles", F.explode("bands").alias("key"))
    # most keys have one class: they go before anything else is gathered
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key").checkpoint()
    if shared.count() <= BROADCAST_CLASSES:
        shared = F.broadcast(shared)
    member = keys.join(shared, "key", "left_semi").checkpoint()
    made = member.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.lit(1.0) + F.col("n_shingles") / CLASS_SHINGLES).alias("weight"),
        F.min("class").alias("low"),
        F.max("class").alias("high"),
        # together a hash of the set of classes
        F.bit_xor(F.xxhash64("class")).alias("x"),
        F.bit_xor(F.xxhash64("class", F.lit(1))).alias("y"),
    )
    first = made.groupBy("n", "low", "high", "x", "y").agg(F.min("key").alias("key"), F.max("weight").alias("weight"))
    blocks = F.ceil(F.col("weight") / BLOCK_CLASSES).cast("int")
    return member.join(first.select("key", blocks.alias("blocks"), "low", "high"), "key").drop("n_shingles")


def _block(n: Column) -> Column:
    """A class's block, evenly and independently of its number's order."""
    return F.pmod(F.xxhash64("class", F.lit(2)), n).cast("int")


def first_tasks(member: DataFrame) -> DataFrame:
    """(key, i, j, side, class): each block of a bucket, and with it the
    pivots of buckets of several blocks."""
    own = member.select("key", _block(F.col("blocks")).alias("i"), "class")
    several = member.where("blocks > 1").groupBy("key").agg(F.first("blocks").alias("blocks"), F.first("low").alias("low"), F.first("high").alias("high"))
    each = several.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pivots = each.withColumn("class", F.explode(F.array("low", "high"))).select("key", "i", "class")
    # a pivot in its own block would come twice
    tasks = own.unionByName(pivots).distinct()
    return tasks.select("key", "i", F.col("i").alias("j"), F.lit(0).alias("side"), "class")


def second_tasks(member: DataFrame, parts: DataFrame) -> DataFrame:
    """Tasks of the buckets of several blocks that still have several
    components: what is outside the largest one against all."""
    large = member.where("blocks > 1").join(parts, "class", "left").withColumn("part", F.coalesce("part", "class"))
    sizes = large.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"), F.first("blocks").alias("blocks"))
    core = sizes.groupBy("key").agg(
        F.max(F.struct("n", "part")).alias("core"), F.sum("n").alias("all"), F.first("blocks").alias("blocks")
    )
    core = core.where("core.n < all").select(
        "key",
        F.col("core.part").alias("core"),
        F.ceil(F.col("blocks") * F.col("core.n") / F.col("all")).cast("int").alias("in_core"),
        F.ceil(F.col("blocks") * (F.col("all") - F.col("core.n")) / F.col("all")).cast("int").alias("outside"),
    )
    rows = large.select("key", "class", "part").join(core, "key")
    inside = rows.where("part = core").withColumn("j", _block(F.col("in_core")))
    inside = inside.select("key", F.explode(F.sequence(F.lit(0), F.col("outside") - 1)).alias("i"), "j", F.lit(1).alias("side"), "class")
    # blocks outside are numbered after those of the core
    rest = rows.where("part != core").withColumn("i", _block(F.col("outside")))
    left = rest.select("key", "i", F.explode(F.sequence(F.lit(0), F.col("in_core") + F.col("outside") - 1)).alias("j"), F.lit(0).alias("side"), "class", "in_core")
    left = left.where("j < in_core OR j - in_core >= i").drop("in_core")
    right = rest.where("i > 0").withColumn("j", F.col("in_core") + F.col("i"))
    right = right.select("key", F.explode(F.sequence(F.lit(0), F.col("i") - 1)).alias("i"), "j", F.lit(1).alias("side"), "class")
    return inside.unionByName(left).unionByName(right)


# -------------------------------------------------------------- verification


def agreeing(side: np.ndarray, part: np.ndarray, signatures: np.ndarray, sizes: np.ndarray, band: int, least: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a task to verify, those of the most agreeing minima first:
    of different components and sides (all on side 0: any two), with
    ``band`` as the first band that they share, and sizes that allow a link."""
    a = np.flatnonzero(side == 0)
    b = np.flatnonzero(side == 1) if side.any() else a
    per_band = signatures.shape[1] // BANDS
    one, two, agreed = [], [], []
    step = max(1, CELLS // max(1, len(b) * signatures.shape[1]))
    for start in range(0, len(a), step):
        rows = a[start : start + step]
        same = signatures[rows][:, None, :] == signatures[b][None, :, :]
        count = same.sum(axis=2)
        good = (count >= least) & (part[rows][:, None] != part[b][None, :])
        good &= 100 * np.minimum(sizes[rows][:, None], sizes[b]) >= percent * np.maximum(sizes[rows][:, None], sizes[b])
        if b is a:
            good &= rows[:, None] < b[None, :]
        r, c = np.nonzero(good)
        shared = same[r, c].reshape(len(r), BANDS, per_band).all(axis=2)
        first = shared.argmax(axis=1) == band
        r, c = r[first], c[first]
        one.append(rows[r])
        two.append(b[c])
        agreed.append(count[r, c])
    one, two, agreed = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (one, two, agreed))
    order = np.argsort(-agreed, kind="stable")
    return one[order], two[order]


class Joined:
    """Components within a task."""

    def __init__(self, parts: np.ndarray):
        self.up = dict.fromkeys(parts.tolist())

    def root(self, x: int) -> int:
        while (y := self.up[x]) is not None:
            if (z := self.up[y]) is not None:
                self.up[x] = z
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[x] = y
        return x != y


def verified(one: np.ndarray, two: np.ndarray, part: np.ndarray, sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """The pairs that link on their full sets and join components."""
    joined, index = Joined(part), {}
    part = part.tolist()
    vocabulary = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
    marks = np.zeros(len(vocabulary), dtype=bool)
    for a, b in zip(one.tolist(), two.tolist(), strict=True):
        if joined.root(part[a]) == joined.root(part[b]):
            continue
        for x in (a, b):
            if x not in index:
                index[x] = np.searchsorted(vocabulary, sets[x])
        marks[index[a]] = True
        shared = int(marks[index[b]].sum())
        marks[index[a]] = False
        if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            joined.join(part[a], part[b])
            yield a, b


def _least(percent: int) -> int:
    p = percent / 100
    return max(0, int(np.floor(HASHES * p - 6 * (HASHES * p * (1 - p)) ** 0.5)))


def _by_task(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each task, of batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = [batch.column(k).to_numpy() for k in keys]
        changed = np.any([x[1:] != x[:-1] for x in cells], axis=0)
        starts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            now = tuple(x[a] for x in cells)
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


_TASK = ["key", "i", "j"]


def compare(tasks: DataFrame, classes: DataFrame, parts: DataFrame | None, sets_of, percent: int) -> DataFrame:
    """Links (a, b) of classes that join components of a task. ``sets_of``
    gives the full sets of the classes that it gets."""
    least = _least(percent)
    rows = tasks.join(classes.select("class", "n_shingles", "signature"), "class")
    rows = rows.withColumn("part", F.col("class")) if parts is None else rows.join(parts, "class", "left").withColumn("part", F.coalesce("part", "class"))
    rows = rows.repartition(*_TASK).sortWithinPartitions(*_TASK)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in _by_task(batches, _TASK):
            cells = {c: task.column(c).to_numpy() for c in ("side", "class", "part", "n_shingles")}
            signatures = np.frombuffer(b"".join(task.column("signature").to_pylist()), np.uint32).reshape(task.num_rows, -1)
            key = task.column("key")[0].as_py()
            one, two = agreeing(cells["side"], cells["part"], signatures, cells["n_shingles"], key >> BAND_SHIFT, least, percent)
            if len(one):
                used, at = np.unique(np.r_[one, two], return_inverse=True)
                n = len(used)
                fixed = [pa.array(np.repeat(task.column(k)[0].as_py(), n)) for k in _TASK]
                # the pairs go with the task's first row
                lists = [pa.array([x.tolist(), *[None] * (n - 1)], pa.list_(pa.int32())) for x in np.split(at, 2)]
                columns = [pa.array(np.arange(n)), pa.array(cells["class"][used]), pa.array(cells["part"][used])]
                yield pa.RecordBatch.from_arrays([*fixed, *columns, *lists], names=[*_TASK, "no", "class", "part", "one", "two"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{k} {types[k]}" for k in _TASK)
    found = rows.select(*_TASK, "side", "class", "part", "n_shingles", "signature").mapInArrow(
        _typed(candidates, types), f"{schema}, no bigint, class bigint, part bigint, one array<int>, two array<int>"
    )
    found = found.checkpoint()
    # only sets of candidates are made and moved
    needed = classes.select("class", "doc_id", "text_hash").join(found.select("class").distinct(), "class", "left_semi")
    with_sets = found.join(sets_of(needed.checkpoint()), "class")
    with_sets = with_sets.repartition(*_TASK).sortWithinPartitions(*_TASK, "no")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in _by_task(batches, _TASK):
            sets = [np.frombuffer(x, np.uint64) for x in task.column("shingles").to_pylist()]
            one, two = (np.array(task.column(c)[0].as_py(), dtype=np.int64) for c in ("one", "two"))
            names = task.column("class").to_numpy()
            pairs = list(verified(one, two, task.column("part").to_numpy(), sets, percent))
            yield pa.RecordBatch.from_arrays([pa.array(names[[p[k] for p in pairs]] if pairs else [], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return with_sets.select(*_TASK, "class", "part", "one", "two", "shingles").mapInArrow(links, "a bigint, b bigint")


def _typed(work, types: dict):
    """The function with its task columns cast back to Spark's types."""
    arrow = {"int": pa.int32(), "bigint": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in work(batches):
            columns = [c.cast(arrow[types[n]]) if n in _TASK else c for n, c in zip(batch.schema.names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


# ---------------------------------------------------------------- components


def near_classes(classes: DataFrame, sets_of, percent: int = PERCENT) -> DataFrame:
    """(class, part) for classes with a link: the component's smallest class.
    ``classes``: class, doc_id, text_hash, n_shingles, signature, bands."""
    member = buckets(classes).checkpoint()
    links = compare(first_tasks(member), classes, None, sets_of, percent).distinct().checkpoint()
    parts = connected_components(links, "a", "b").withColumnsRenamed({"node": "class", "component": "part"})
    if member.where("blocks > 1").isEmpty():
        return parts
    parts = parts.checkpoint()
    more = compare(second_tasks(member, parts), classes, parts, sets_of, percent).distinct().checkpoint()
    whole = connected_components(links.unionByName(more), "a", "b")
    return whole.withColumnsRenamed({"node": "class", "component": "part"})


def near_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and ``first`` —
    whether the row is the one of its component to keep."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, "minhash-rows")
    shingled(docs, words, id_col, text_col).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    files = files_for(spark, rows.count())
    # a class has its first row's number; a null id loses against any id
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    ties = ["d1", "d2", "n_shingles"]
    narrow = rows.select("row", "doc_id", *ties)
    equal = narrow.where("n_shingles > 0").groupBy(*ties).agg(F.min("row").alias("class"), F.min(own).alias("best"))
    equal = equal.coalesce(files).checkpoint()
    classes = rows.withColumnRenamed("row", "class").join(equal.select("class"), "class", "left_semi")
    parts = near_classes(classes, lambda needed: full_sets(docs, needed, words, id_col, text_col), percent)
    linked = equal.join(parts, "class").select("class", "part", "best")
    least = linked.groupBy("part").agg(F.min("best").alias("least"))
    firsts = linked.join(least, "part").select("class", "least")
    whole = equal.join(firsts, "class", "left").select(*ties, F.coalesce("least", "best").alias("least"))
    whole = whole.coalesce(files).checkpoint()
    # a row of an empty set meets no class: it is its own component
    joined = narrow.join(whole, ties, "left").withColumn("least", F.coalesce("least", own))
    return joined.select(
        "doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"), (F.col("least.row") == F.col("row")).alias("first")
    )
