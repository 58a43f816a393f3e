"""Documents that arrive as files, judged as they come.

Every rule is local to a document, so a micro-batch of whole documents needs no state, watermark
or late data: each batch runs the batch operators and appends its rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def judge_arrivals(spark: SparkSession, schema: str, folder: str, judge: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Start a query over Parquet files of whole documents; `judge` is any function of the batch's words.

    A batch that is run again after a failure overwrites its own folder, so rows are written once."""

    def write(batch: DataFrame, number: int) -> None:
        judge(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    arrivals = spark.readStream.schema(schema).parquet(folder)
    return arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _batches(spark: SparkSession, out: str) -> list[str]:
    """Folders of the batches written so far."""
    top = spark._jvm.org.apache.hadoop.fs.Path(out)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(top)) if fs.exists(top) else []


def append_once(batch: DataFrame, number: int, out: str, key: list[str]) -> None:
    """Write the rows of a batch whose key no earlier batch has written, one row a key.

    Documents that are sent again, in another file or another batch, add nothing; a batch that runs again after a
    failure looks past its own folder and replaces it.  Null keys are equal to each other.  Keys of the earlier rows
    are read alone, and both sides meet by a shuffle on them."""
    spark = batch.sparkSession
    fresh = batch.dropDuplicates(key)
    earlier = [f"{out}/{b}" for b in _batches(spark, out) if b.startswith("batch=") and b != f"batch={number}"]
    if earlier:
        known = spark.read.schema(batch.schema).parquet(*earlier).select(*(F.col(c).alias(f"known_{c}") for c in key))
        same = [F.col(c).eqNullSafe(F.col(f"known_{c}")) for c in key]
        fresh = fresh.join(known, reduce(and_, same), "left_anti")
    fresh.write.mode("overwrite").parquet(f"{out}/batch={number}")


def queue_arrivals(
    spark: SparkSession, schema: str, folder: str, judge: Callable[[DataFrame], DataFrame], key: list[str], out: str, checkpoint: str, files: int = 1000
) -> StreamingQuery:
    """Start an append-only queue over Parquet files of whole documents: what `judge` makes of each arrival, once a key.
    A trigger takes up to `files` files."""
    arrivals = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)

    def write(batch: DataFrame, number: int) -> None:
        append_once(judge(batch), number, out, key)

    return arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
