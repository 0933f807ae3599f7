"""How many files a narrow intermediate table is written in.

A checkpoint writes one file per partition. Narrow tables (ids, digests,
links) come out of stages with as many partitions as their wide inputs or the
session's shuffles have, most of them next to empty; every file costs a round
trip to the store. ``files_for`` gives the number that their rows ask for,
never fewer than three waves of tasks; ``coalesce`` to it changes nothing
where there are fewer partitions anyway, as there are at full scale.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 20_000
BYTES_PER_FILE = 16 << 20
ROWS_PER_SMALL_FILE = 100_000


def files_for(spark: SparkSession, rows: int) -> int:
    return max(3 * spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_FILE))


def text_files_for(source: DataFrame, text_col: str) -> int:
    """For what is made from whole texts: by their bytes, so that a task's
    share does not grow with the length of the texts."""
    held = source.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(3 * source.sparkSession.sparkContext.defaultParallelism, -(-held // BYTES_PER_FILE))


def release_memory() -> None:
    """Called by a Python function at the end of its task: Arrow's unused
    memory goes back, as workers outlive their tasks."""
    pa.default_memory_pool().release_unused()


def small_files_for(rows: int) -> int:
    """For tables that no later stage works long on."""
    return max(1, -(-rows // ROWS_PER_SMALL_FILE))


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
DEFAULT_ROWS, TEXT_ROWS = "10000", "1000"


def batches_of_texts(spark: SparkSession) -> None:
    """Sessions with Spark's default of 10,000 rows to an Arrow batch get
    batches that suit rows of whole texts: every task holds some batches in
    the executor and in its Python worker. A session's own setting stays."""
    if spark.conf.get(ARROW_ROWS) == DEFAULT_ROWS:
        spark.conf.set(ARROW_ROWS, TEXT_ROWS)
