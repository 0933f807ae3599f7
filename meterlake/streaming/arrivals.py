"""Run the daily ingest when a delivery arrives (Structured Streaming).

The input folder receives, per date, ``<date>_devices.csv``,
``<date>_data.csv`` and ``<date>_event_data.csv``. A file stream over the
registry files notices new dates; each micro-batch runs the batch
``ingest_day`` for its dates. The stream's checkpoint records which files
were handled, and ``ingest_day`` is idempotent for keyed rows, so a
replayed micro-batch after a failure stores nothing twice (rows with a
null time excepted, as with any re-run).

The registry file must be written last (after the two measurement files),
as its arrival starts the load of the date.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake.plans.ingest import ingest_day
from meterlake.schemas import CANONICAL_FEEDS, REGISTRY_FILE, DayFeeds
from meterlake.sources.table import TableSpec

_SUFFIX = REGISTRY_FILE.format(date="")
_DATE_OF_PATH = r"([^/]+)" + re.escape(_SUFFIX) + "$"


def arrived_dates(batch: DataFrame) -> list[str]:
    """Dates of the registry files in one micro-batch (at most
    ``maxFilesPerTrigger`` names reach the driver; no data rows do)."""
    dates = batch.select(F.regexp_extract(F.col("path"), _DATE_OF_PATH, 1).alias("d")).distinct()
    return sorted(r.d for r in dates.collect())


def ingest_arrivals(
    spark: SparkSession,
    in_dir: str,
    spec: TableSpec,
    checkpoint_location: str,
    feeds: DayFeeds = CANONICAL_FEEDS,
    available_now: bool = True,
    max_files_per_trigger: int = 8,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it loads every date present
    and stops (a scheduled run), else it keeps watching the folder."""
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", f"*{_SUFFIX}")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(in_dir)
        .select("path")
    )

    def load(batch: DataFrame, _batch_id: int) -> None:
        for date in arrived_dates(batch):
            ingest_day(spark, date, in_dir, spec, feeds)

    writer = arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
