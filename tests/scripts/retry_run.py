"""Load a batch while tasks fail on their first attempt (run by test_retry)."""

import os
import sys

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from meterlake.plans import roles  # noqa: E402
from meterlake.plans.ingest import store_batch, stored_rows  # noqa: E402
from meterlake.sources import TableSpec  # noqa: E402

sf_dir, out_dir = sys.argv[2], sys.argv[3]
MARKS = f"{out_dir}/failed-attempts"
os.makedirs(MARKS, exist_ok=True)
spark = (
    SparkSession.builder.master("local[4,3]")  # up to 3 attempts per task
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.checkpoint.dir", out_dir + "/ckpt")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")


@F.udf(T.BooleanType())
def flaky(_):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        with open(f"{MARKS}/stage{ctx.stageId()}-part{ctx.partitionId()}", "w"):
            pass
        raise RuntimeError("injected task failure")
    return True


rows = roles.combined_rows(spark, sf_dir).where(flaky(F.col("device_id")))
ids = roles.supplier_ids(spark, sf_dir)
for limit in (10**6, 0):
    spec = TableSpec(f"{out_dir}/t-{limit}", roles.NARROW)
    store_batch(rows, ids, spec, max_broadcast_keys=limit)
    store_batch(rows, ids, spec, max_broadcast_keys=limit)  # a re-run adds nothing
    stored = stored_rows(spark, spec)
    print(f"RESULT limit={limit} stored={stored.count()} distinct={stored.distinct().count()}")
print(f"EXPECT {roles.known_rows(spark, sf_dir).count()} {roles.known_rows(spark, sf_dir).distinct().count()}")
