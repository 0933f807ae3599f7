"""Connected components of a link table, in Spark only.

Alternates two star steps until nothing changes: *large* stars tie every
larger neighbour of a node to the smallest node of its neighbourhood, *small*
stars do so for the smaller neighbours. The minimum of a neighbourhood is a
grouped ``min`` (partial on the map side), so a node with very many links
costs one record per task. The join that brings it back is by node; hubs, the
nodes of more than a thousandth of the links, are at most two thousand rows
and are broadcast, so their links stay where they are. Every round is a
reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.tables import small_files_for
from meterlake.scratch import checkpoint_dir


HUB_SHARE = 1000  # a hub has more than one in so many of the links
HUB_LEAST = 256  # and more than so many


def _smallest(pairs: DataFrame, n: int) -> DataFrame:
    """(u, v, m): each of about ``n`` pairs with the smallest of u and all its
    partners."""
    hub = F.col("_n") > max(HUB_LEAST, n // HUB_SHARE)
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
    hubs = F.broadcast(least.where(hub).drop("_n"))  # at most 2 * HUB_SHARE rows
    rest = pairs.join(hubs, "u", "left_anti").join(least.where(~hub).drop("_n"), "u")
    return pairs.join(hubs, "u").unionByName(rest).withColumn("m", F.least("u", "m"))


def _large_star(links: DataFrame, n: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _smallest(both, n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame, n: int) -> DataFrame:
    # every link goes from the larger to the smaller node
    down = _smallest(links, n)
    ties = down.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        down.select("u", F.col("m").alias("v"))
    )
    return ties.where("u != v").distinct()


def _state(links: DataFrame) -> tuple:
    mark = F.bit_xor(F.xxhash64("u", "v"))
    return tuple(links.agg(F.count(F.lit(1)), mark).first())


def connected_components(links: DataFrame, a: str, b: str, files: int | None = None) -> DataFrame:
    """(node, component) for every node with a link to another one; the
    component is its smallest node. Links may repeat, run either way and
    hold self-links (ignored); links with a null end are ignored. No links
    give no rows. ``files``: at most so many for the links' first checkpoint."""
    checkpoint_dir(links.sparkSession)
    complete = F.col(a).isNotNull() & F.col(b).isNotNull()
    pairs = links.where(complete).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = pairs.where("u != v").distinct()
    pairs = (pairs if files is None else pairs.coalesce(files)).checkpoint()
    before = _state(pairs)
    while before[0]:
        pairs = _small_star(_large_star(pairs, before[0]), before[0]).coalesce(small_files_for(before[0])).checkpoint()
        now = _state(pairs)
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
