"""What is sent through the driver is judged by its rows, not by how small its files are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pagelattice.operators import detect
from pagelattice.operators.components import UNFOLDED, materialize, size_by_rows
from pagelattice.plans.queries import Bridge


@pytest.fixture
def threshold(spark):
    """Two megabytes may be broadcast; the factor of the session is as Spark has it."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "2m", "spark.sql.sources.fileCompressionFactor": "1.0"}
    was = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def _plan(df) -> str:
    """The plan before anything has run."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_rows_in_a_small_file_are_not_broadcast(spark, tmp_path, threshold):
    Bridge(spark, str(tmp_path))
    codes = materialize(spark.range(400_000).select((F.col("id") / 100).cast("long").alias("doc_id"), F.concat(F.lit("AQ"), F.col("id") % 100).alias("token")), "codes")
    words = spark.range(2_000).select((F.col("id") % 50).alias("doc_id"), F.concat(F.lit("AQ"), F.col("id") % 200).alias("text"))
    own = detect.normed(words).join(codes, ["doc_id", "token"], "left_semi")
    assert "BroadcastExchange" not in _plan(own)
    assert own.count() == 1_000


def test_few_rows_are_still_broadcast(spark, tmp_path, threshold):
    Bridge(spark, str(tmp_path))
    few = materialize(spark.range(100).select("id"), "few")
    assert "BroadcastExchange" in _plan(spark.range(2_000_000).join(few, "id"))


def test_a_larger_factor_of_the_session_stays(spark, threshold):
    spark.conf.set("spark.sql.sources.fileCompressionFactor", str(2.0 * UNFOLDED))
    size_by_rows(spark)
    assert float(spark.conf.get("spark.sql.sources.fileCompressionFactor")) == 2 * UNFOLDED
