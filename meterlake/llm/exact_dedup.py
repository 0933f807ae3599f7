"""Exact dedup by skew-safe combining.

Texts are equal when identical after each run of white space
(``[\\x20\\x09-\\x0D]+``) became one space. Three combining steps, each keyed
by the digest *and the full normalised text*, so a digest clash never merges
different texts:

1. local: the map side of the first aggregate leaves one row per text and
   input partition;
2. salted: those rows meet per (digest, text, salt). Digests of very many rows
   have the input partition modulo ``salts`` as salt — a text that fills a
   third of the corpus is merged by ``salts`` tasks, from one row per input
   partition — others have one salt and are complete here;
3. global: the salt winners of hot digests (at most ``salts`` rows a text) meet.

Which digests are hot is counted first, on the digests alone: those of more
than one in ``HOT_DIGESTS`` rows, so there are at most that many, a bounded
broadcast. Texts are shuffled once.

What leaves the combining has no texts: digest columns, smallest id, group
size. Rows find their group again by the digest columns (SHA-256, XXH64 and
length). Should two different texts share all of those, the rows of such
digests are grouped by their text instead (``clashing``).

Defined results: null text counts as empty. A null id never wins over an id;
a group of null ids alone has a null ``keep_id``. Rows that repeat id and text
count towards ``group_size``; of several rows equal to the winner one is kept.
Empty input gives no rows. Other columns are ignored (``exact_groups``) or
passed through (``drop_copies``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.names import keep_listed, own_columns, unused
from meterlake.llm.tables import files_for
from meterlake.scratch import checkpoint_dir

WHITE_RUN = r"[\x20\x09-\x0D]+"
SALTS = 32
HOT_DIGESTS = 10_000  # at most so many digests are salted
HOT_ROWS = 64  # fewer rows than this are never hot


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_RUN, " ")


def digest_columns(text: Column) -> list[Column]:
    """What stands for a normalised text where the text itself is too wide."""
    return [
        F.sha2(text, 256).alias("_sha"),
        F.xxhash64(text).alias("_xx"),
        F.octet_length(text).alias("_len"),
    ]


def _merge(rows: DataFrame, by: list[str]) -> DataFrame:
    # the flag is aggregated, not grouped by: a filter on it then stays behind
    # the shuffle, and both kinds of groups read the same one
    return rows.groupBy(*by).agg(F.min("_keep").alias("_keep"), F.sum("_n").alias("_n"), F.max("_hot").alias("_hot"))


def _combine(rows: DataFrame, keyed: DataFrame, keys: list[str], salts: int) -> DataFrame:
    """One row per text: keys, _keep, _n (local, salted, global). ``keyed`` has
    the keys of the rows."""
    hot_rows = max(HOT_ROWS, keyed.count() // HOT_DIGESTS)
    hot = keyed.groupBy(*keys).count().where(F.col("count") > hot_rows).select(*keys, F.lit(True).alias("_hot"))
    marked = rows.join(F.broadcast(hot), keys, "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)))
    salted = marked.withColumn("_salt", F.when(F.col("_hot"), F.spark_partition_id() % salts).otherwise(0))
    winners = _merge(salted, [*keys, "_text", "_salt"])
    whole = _merge(winners.where("_hot"), [*keys, "_text"])
    columns = [*keys, "_text", "_keep", "_n"]
    return winners.where("NOT _hot").select(*columns).unionByName(whole.select(*columns))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digests: Callable[[Column], list[Column]] = digest_columns,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``,
    ``kept``, and the digest columns of the normalised text."""
    checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_keep"), normalised(F.col(text_col)).alias("_text"), F.lit(1).alias("_n"))
    rows = rows.select("*", *digests(F.col("_text")))
    keys = [c for c in rows.columns if c not in ("_keep", "_text", "_n")]
    files = files_for(docs.sparkSession, docs.count())
    keyed = rows.select("_keep", *keys).coalesce(files).checkpoint()
    # texts stop here: the groups are narrow and survive lost executors
    groups = _combine(rows, keyed, keys, salts).select(*keys, "_keep", "_n").coalesce(files).checkpoint()
    clashing = groups.groupBy(*keys).count().where("count > 1").select(*keys)
    if clashing.isEmpty():
        return _assign(keyed, groups, keys, keys)
    # different texts behind one digest: those rows are told apart by text
    odd = rows.join(clashing, keys, "left_semi")
    by_text = _combine(odd, odd, keys, salts)
    plain = _assign(keyed.join(clashing, keys, "left_anti"), groups.join(clashing, keys, "left_anti"), keys, keys)
    return plain.unionByName(_assign(odd, by_text, [*keys, "_text"], keys))


def _assign(rows: DataFrame, groups: DataFrame, on: list[str], keys: list[str]) -> DataFrame:
    """Rows with their group. Equal rows are counted before the join and
    numbered after it, so a row repeated very often crosses it once."""
    same = rows.groupBy(F.col("_keep").alias("_id"), *on).agg(F.count(F.lit(1)).alias("_rows"))
    # no digest column is ever null; the group's row is unique by ``on``
    joined = same.join(groups, on).withColumn("_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
    kept = F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_no") == 1)
    return joined.select(
        F.col("_id").alias("doc_id"),
        F.col("_keep").alias("keep_id"),
        F.col("_n").cast("long").alias("group_size"),
        kept.alias("kept"),
        *keys,
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns."""
    keys = ["_sha", "_xx", "_len"]
    winners = exact_groups(docs, id_col, text_col, salts).where("kept").select("doc_id", *keys)
    rows = docs.select("*", *[d.alias(unused(docs, k)) for d, k in zip(digest_columns(normalised(F.col(text_col))), keys, strict=True)])
    return keep_listed(rows, [id_col, *[unused(docs, k) for k in keys]], winners).select(*own_columns(docs))
