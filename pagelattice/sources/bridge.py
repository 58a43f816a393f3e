"""Layout bridge: words, rectangles, pages and documents derived from the star-schema tables.

The tables carry no geometry, so positions are integer arithmetic on their keys, the same in
any SQL engine.  A real corpus supplies the same columns from its own tables (documents).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAGE = (600.0, 800.0)
SPREAD = (1200.0, 800.0)
PAGES = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, word_no, x0, y0, x1, y1, text): one word a line item."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type", "p_name")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    kind, key = F.col("l_partkey") % 10, F.col("l_partkey")
    text = (
        F.when(kind < 3, F.concat(F.chr(65 + key % 6), F.lit("Q"), F.lpad((key % 97).cast("string"), 2, "0")))
        .when(kind < 6, F.concat(F.col("p_size").cast("string"), F.lit("x"), (F.col("p_size") * 2).cast("string")))
        .when(kind == 6, F.concat(F.chr(65 + key % 2), (10 + key % 80).cast("string")))
        .when(kind == 7, F.upper("p_type"))
        .otherwise(F.col("p_name"))
    )
    in_order = Window.partitionBy("l_suppkey", F.col("l_orderkey") % PAGES).orderBy("l_orderkey", "l_linenumber", "l_partkey")
    x0 = (key * 37) % 560
    y0 = (F.col("l_orderkey") * 53 + F.col("l_linenumber") * 11) % 780
    return lines.join(parts, F.col("p_partkey") == key).select(
        F.col("l_suppkey").cast("long").alias("doc_id"),
        (F.col("l_orderkey") % PAGES + 1).cast("long").alias("page_no"),
        (F.row_number().over(in_order) - 1).cast("long").alias("word_no"),
        x0.cast("double").alias("x0"),
        y0.cast("double").alias("y0"),
        (x0 + 20 + (key % 5) * 8).cast("double").alias("x1"),
        (y0 + 8 + F.col("l_linenumber") % 3).cast("double").alias("y1"),
        text.alias("text"),
    )


def rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, sw_idx, rid, x0, y0, x1, y1): one rectangle an order, numbered by y, x, id within its page."""
    n_docs = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").withColumn("n_docs", n_docs)
    key = F.col("o_orderkey")
    x0, y0 = (key * 71) % 520, (key * 29) % 700
    placed = orders.select(
        (key % F.col("n_docs")).cast("long").alias("doc_id"),
        (F.floor(key / F.col("n_docs")).cast("long") % PAGES + 1).alias("page_no"),
        key.alias("rid"),
        x0.cast("double").alias("x0"),
        y0.cast("double").alias("y0"),
        (x0 + 30 + F.col("o_custkey") % 60).cast("double").alias("x1"),
        (y0 + 20 + F.col("o_custkey") % 80).cast("double").alias("y1"),
    )
    numbered = Window.partitionBy("doc_id", "page_no").orderBy("y0", "x0", "rid")
    return placed.withColumn("sw_idx", (F.row_number().over(numbered) - 1).cast("long"))


def pages(words_: DataFrame, spread: bool = False) -> DataFrame:
    """(doc_id, page_no, width, height) of every page with a word."""
    w, h = SPREAD if spread else PAGE
    return words_.select("doc_id", "page_no").distinct().withColumn("width", F.lit(w)).withColumn("height", F.lit(h))


def spread_words(words_: DataFrame) -> DataFrame:
    """The words with every odd document on spreads: its words with an odd number stand on the right-hand page."""
    right = F.when((F.col("doc_id") % 2 == 1) & (F.col("word_no") % 2 == 1), F.lit(600.0)).otherwise(F.lit(0.0))
    return words_.withColumns({c: F.col(c) + right for c in ("x0", "x1")})


def spread_rects(rects_: DataFrame) -> DataFrame:
    """The rectangles for spread_words: odd ones of odd documents stand on the right-hand page."""
    right = F.when((F.col("doc_id") % 2 == 1) & (F.col("rid") % 2 == 1), F.lit(600.0)).otherwise(F.lit(0.0))
    return rects_.withColumns({c: F.col(c) + right for c in ("x0", "x1")})


def spread_pages(words_: DataFrame) -> DataFrame:
    """The pages of spread_words: wide ones have a fold."""
    wide = F.when(F.col("doc_id") % 2 == 1, F.lit(SPREAD[0])).otherwise(F.lit(PAGE[0]))
    return words_.select("doc_id", "page_no").distinct().withColumns({"width": wide, "height": F.lit(PAGE[1])})


def page_kind() -> Column:
    """Eight kinds of pages, one of each in a document of eight; see varied_words and varied_rects."""
    return (F.col("doc_id") + F.col("page_no")) % 8


def varied_words(words_: DataFrame) -> DataFrame:
    """The words with pages of kind 3 empty, of kind 4 with sizes only, of kind 5 with lower-case names only."""
    kind, text = page_kind(), F.col("text")
    keep = F.when(kind == 3, False).when(kind == 4, text.rlike("^[0-9]+x[0-9]+$")).when(kind == 5, text.rlike("^[a-z ]+$")).otherwise(True)
    return words_.where(keep)


def varied_rects(rects_: DataFrame) -> DataFrame:
    """The rectangles without those of pages of kind 6 and of every fifth document; on pages of kind 7 they are hairlines."""
    thin = page_kind() == 7
    kept = rects_.where((page_kind() != 6) & (F.col("doc_id") % 5 != 4))
    return kept.withColumns({"x1": F.when(thin, F.col("x0") + 2).otherwise(F.col("x1")), "y1": F.when(thin, F.col("y0") + 12).otherwise(F.col("y1"))})


def dense_code(text) -> F.Column:
    """A coarser code, so that merging finds large groups: three values where the plain one has ten."""
    return F.concat(F.substring(text, 1, 2), F.lit("0"), (F.substring(text, 4, 1).cast("int") % 3).cast("string"))
