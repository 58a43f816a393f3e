"""Nested product documents, crop boxes and the read model over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .detect import PAGE_KEY


def product_documents(variants: DataFrame, spec_rows: DataFrame, queue: DataFrame) -> DataFrame:
    """(doc_id, variants, spec_by_code, needs_review, skeleton): one row a document, nested and in a fixed order."""
    one = F.struct("cluster", "code", "color", "regime", "merged_from", "sizes")
    v = variants.groupBy("doc_id").agg(F.sort_array(F.collect_list(one)).alias("variants"))
    s = spec_rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("id", "code", "size", "surface", "price_band"))).alias("spec_by_code"))
    q = queue.groupBy("doc_id").agg(F.count(F.lit(1)).alias("needs_review"))
    out = v.join(s, "doc_id", "full_outer").join(q, "doc_id", "full_outer")
    return out.select(
        "doc_id",
        "variants",
        "spec_by_code",
        F.coalesce("needs_review", F.lit(0)).alias("needs_review"),
        F.col("variants").isNull().alias("skeleton"),
    )


def crop_boxes(bindings: DataFrame, queue: DataFrame, swatches: DataFrame, margin: float = 0.0) -> DataFrame:
    """(page key, name, x0, y0, x1, y1) of the crops to cut: v for bound swatches, q for queued ones, sk for the
    others; numbered within the document by page and swatch.  Cutting pixels is left to an image tool."""
    key = [*PAGE_KEY, "sw_idx"]
    bound = bindings.select(*key).distinct().withColumn("kind", F.lit("v"))
    held = queue.where("sw_idx is not null").select(*key).distinct().join(bound, key, "left_anti").withColumn("kind", F.lit("q"))
    kinds = bound.unionByName(held)
    joined = swatches.join(kinds, key, "left").withColumn("kind", F.coalesce("kind", F.lit("sk")))
    order = Window.partitionBy("doc_id", "kind").orderBy("page_no", "sw_idx")
    number = F.lpad((F.row_number().over(order) - 1).cast("string"), 3, "0")
    return joined.select(
        *key,
        F.concat(F.col("kind"), number, F.lit("_p"), F.col("page_no").cast("string")).alias("name"),
        *((F.col(c) + d * margin).alias(c) for c, d in (("x0", -1), ("y0", -1), ("x1", 1), ("y1", 1))),
    )


def read_model(judged: DataFrame, states: DataFrame) -> DataFrame:
    """(page key, state, codes, bound, reasons): what a viewer shows of each page."""
    ok = F.col("aligned") | F.col("blocked")
    reason = F.when(F.col("demoted"), "icon_demoted").when(F.col("sw_idx").isNull(), "orphan").when(~ok, "not_x_aligned")
    per = judged.groupBy(*PAGE_KEY).agg(
        F.array_join(F.sort_array(F.collect_set("token")), ",").alias("codes"),
        F.count_if(ok).alias("bound"),
        F.array_join(F.sort_array(F.collect_set(reason)), ",").alias("reasons"),
    )
    return states.join(per, PAGE_KEY, "left")


def flagged_pages(counts: DataFrame, gaps: DataFrame) -> DataFrame:
    """(page key) of suspicious pages: three or more codes, and over a fifth of them orphans or far, or over half of
    the swatches without a code, or no swatch at all.  gaps is (page key, n_sw, sw_no_code)."""
    joined = counts.join(gaps, PAGE_KEY, "left").withColumn("n_sw", F.coalesce("n_sw", F.lit(0)))
    astray = F.col("code_orphan") + F.col("code_far") > 0.2 * F.col("n_codes")
    bare = (F.col("n_sw") == 0) | (F.col("sw_no_code") > 0.5 * F.col("n_sw"))
    return joined.where((F.col("n_codes") >= 3) & (astray | bare)).select(*PAGE_KEY)
