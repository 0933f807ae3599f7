"""Merkle fixity audit of WARC records.

Every record of a file is hashed; the hashes of the records whose offset falls
into one range of ``range_bytes``, in the order of their offsets, make a node,
``fanout`` neighbouring nodes make one of the next level, up to one root per
file. Two replicas are compared root by root; only the children of nodes that
differ are compared further, down to the records.

All of it is grouped SQL aggregation. What one group holds is bounded by the
range (records have a header) or the fanout. Records that repeat an offset
with equal content are counted before they are gathered. Levels shrink by the
fanout; the checkpointed record hashes are the only table as long as the input.

Defined results: a null payload or url counts as empty; null ids make records
of file ``crawl-none.warc``. An empty replica reports every record of the
other one; two empty ones report nothing. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.tables import files_for, small_files_for
from meterlake.scratch import checkpoint_dir

RECORDS_PER_FILE = 1000
RANGE_BYTES = 1 << 16
FANOUT = 16
CRLF = "\r\n"


def warc_record(record_id: Column, url: Column, payload: Column) -> Column:
    """The text of one response record."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.0{CRLF}WARC-Type: response{CRLF}WARC-Record-ID: <"),
        record_id,
        F.lit(f">{CRLF}WARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit(f"{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(CRLF * 2),
        body,
        F.lit(CRLF * 2),
    )


def lay_out(records: DataFrame, id_col: str = "page_id", per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """Adds ``offset``: where the record (column ``length``) stands in its file
    (column ``file``), in the order of ids and digests. Equal rows are counted
    first, so a row repeated very often is one row of its file's window."""
    from pyspark.sql import Window

    same = records.groupBy(*records.columns).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy(id_col, "digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = same.withColumn("_start", F.coalesce(F.sum(F.col("length") * F.col("_n")).over(before), F.lit(0)))
    copies = placed.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    return copies.withColumn("offset", F.col("_start") + F.col("_k") * F.col("length")).drop("_n", "_start", "_k")


def page_records(pages: DataFrame, per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """(page_id, record_id, file, length, digest, url, html) of pages as WARC records,
    ``per_file`` consecutive ids to a file."""
    number = F.floor(F.col("page_id") / per_file)
    name = F.concat(F.lit("crawl-"), F.coalesce(F.lpad(number.cast("string"), 8, "0"), F.lit("none")), F.lit(".warc"))
    rid = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")))
    record = warc_record(rid, F.col("url"), F.col("html"))
    return pages.select("page_id", rid.alias("record_id"), name.alias("file"), F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest"))


def _leaves(records: DataFrame) -> DataFrame:
    keys = ["file", "offset", "record_id", "length", "digest"]
    leaves = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return leaves.coalesce(files_for(records.sparkSession, 0)).checkpoint()


def _hash_in_order(parts: Column) -> Column:
    return F.sha2(F.array_join(F.transform(F.array_sort(parts), lambda x: x["text"]), "|"), 256)


def _ranges(leaves: DataFrame, range_bytes: int) -> DataFrame:
    text = F.concat_ws(":", "offset", "record_id", "length", "digest", "copies")
    node = F.floor(F.col("offset") / range_bytes).alias("node")
    return leaves.groupBy("file", node).agg(_hash_in_order(F.collect_list(F.struct("offset", text.alias("text")))).alias("hash"))


def _parents(level: DataFrame, fanout: int) -> DataFrame:
    text = F.concat_ws(":", "node", "hash")
    up = F.floor(F.col("node") / fanout).alias("node")
    return level.groupBy("file", up).agg(_hash_in_order(F.collect_list(F.struct("node", text.alias("text")))).alias("hash"))


def merkle_levels(leaves: DataFrame, range_bytes: int, fanout: int, height: int) -> list[DataFrame]:
    """Ranges first, roots last: (file, node, hash) each."""
    rows = leaves.count()  # a level has no more rows than the one below it
    levels = [_ranges(leaves, range_bytes).coalesce(small_files_for(rows)).checkpoint()]
    for _ in range(height):
        rows = levels[-1].count()
        levels.append(_parents(levels[-1], fanout).coalesce(small_files_for(rows)).checkpoint())
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    a = a.select("file", "node", F.col("hash").alias("_a"))
    b = b.select("file", "node", F.col("hash").alias("_b"))
    return a.join(b, ["file", "node"], "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).select("file", "node")


def audit(primary: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Records that differ: file, offset, record_id, status (``changed``,
    ``missing`` or ``extra`` in the replica), and both lengths and digests.

    Both inputs: record_id, file, offset, length, digest."""
    checkpoint_dir(primary.sparkSession)
    a, b = _leaves(primary), _leaves(replica)
    last = a.select("offset").unionByName(b.select("offset")).agg(F.max("offset")).first()[0] or 0
    height, nodes = 0, last // range_bytes + 1
    while nodes > 1:
        height, nodes = height + 1, -(-nodes // fanout)
    up_a, up_b = (merkle_levels(x, range_bytes, fanout, height) for x in (a, b))
    files = small_files_for(a.count() + b.count())
    differ = _differing(up_a[-1], up_b[-1])
    for own_a, own_b in zip(up_a[-2::-1], up_b[-2::-1], strict=True):
        differ = differ.withColumnRenamed("node", "_up").coalesce(files).checkpoint()
        below = [x.withColumn("_up", F.floor(F.col("node") / fanout)).join(differ, ["file", "_up"], "left_semi") for x in (own_a, own_b)]
        differ = _differing(*below)
    differ = differ.coalesce(files).checkpoint()

    def suspect(leaves: DataFrame, tag: str) -> DataFrame:
        rows = leaves.withColumn("node", F.floor(F.col("offset") / range_bytes)).join(differ, ["file", "node"], "left_semi")
        return rows.select("file", "offset", "record_id", F.col("length").alias(f"{tag}_length"), F.col("digest").alias(f"{tag}_digest"), F.col("copies").alias(f"_{tag}"))

    both = suspect(a, "primary").join(suspect(b, "replica"), ["file", "offset", "record_id"], "full")
    equal = F.col("primary_digest").eqNullSafe(F.col("replica_digest")) & F.col("_primary").eqNullSafe(F.col("_replica"))
    status = F.when(F.col("replica_digest").isNull(), "missing").when(F.col("primary_digest").isNull(), "extra").otherwise("changed")
    return both.where(~equal).withColumn("status", status).drop("_primary", "_replica")
