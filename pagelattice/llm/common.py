"""Shared pieces of the training-data operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelattice.operators.components import checkpoint, delete, fresh, materialize, shared_path

__all__ = ["checkpoint", "crc_mod", "delete", "drop_table", "free_shuffles", "fresh", "materialize", "read_table", "row_key", "shared_path", "with_row_id", "word_count"]

#: A word of the white-space split: anything but ASCII space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, m: int) -> Column:
    """crc32 of the column as text, modulo m."""
    return F.crc32(F.col(column).cast("string")) % m


def word_count(text: Column) -> Column:
    """Number of white-space words; 0 for null and empty texts."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def drop_table(df: DataFrame) -> None:
    """Remove the folder of a table that materialize wrote and nothing will read again."""
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, file)


def row_key(doc_id: Column, *more: Column) -> list[Column]:
    """Two longs, never null, that are equal where doc_id and the other columns are."""
    doc_id = doc_id.cast("long")
    return [F.coalesce(doc_id, F.lit(-(1 << 63))), F.xxhash64(doc_id, *more)]


def with_row_id(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a row number that stays the same, written once; and its name, which no column has."""
    name = fresh(docs, "row_id")
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing refers to any more: they go when the
    driver collects its garbage, which in a job of many steps may be long after their last use."""
    gc.collect()
    spark._jvm.System.gc()
