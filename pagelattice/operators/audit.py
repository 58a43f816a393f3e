"""Reconciliation and audit queries over outputs: diffs, overlaps, families, lifecycle, inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import PRODUCTION, RuleConfig
from pagelattice.functions import geometry as G

BOX = ["x0", "y0", "x1", "y1"]


def golden_diff(now: DataFrame, frozen: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """(key, cell, was, now) for every cell that differs; rows on one side only have cell `missing` or `extra`."""
    a = frozen.select(*key, F.struct(*columns).alias("a"))
    b = now.select(*key, F.struct(*columns).alias("b"))
    joined = a.join(b, key, "full_outer")
    cells = F.array(
        *(
            F.when(
                ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")),
                F.struct(F.lit(c).alias("cell"), F.col(f"a.{c}").cast("string").alias("was"), F.col(f"b.{c}").cast("string").alias("now")),
            )
            for c in columns
        )
    )
    none = F.lit(None).cast("string")
    lone = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra")
    found = F.when(lone.isNotNull(), F.array(F.struct(lone.alias("cell"), none.alias("was"), none.alias("now")))).otherwise(F.array_compact(cells))
    return joined.select(*key, F.explode(found).alias("d")).select(*key, "d.cell", "d.was", "d.now")


def set_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of one side only, with change `gone` or `new`."""
    gone = before.subtract(after).withColumn("change", F.lit("gone"))
    return gone.unionByName(after.subtract(before).withColumn("change", F.lit("new")))


def tree_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Variants (doc_id, merged_from, code, color, pages) matched by their binding ids: (doc_id, ids, change), with
    change new, disappeared, cross_page_new, cross_page_gone or value."""
    ids = F.array_join(F.sort_array("merged_from"), ",").alias("ids")
    a = before.select("doc_id", ids, F.struct("code", "color").alias("va"), F.col("pages").alias("pa"))
    b = after.select("doc_id", ids, F.struct("code", "color").alias("vb"), F.col("pages").alias("pb"))
    joined = a.join(b, ["doc_id", "ids"], "full_outer")
    kinds = F.array_compact(
        F.array(
            F.when(F.col("va").isNull(), "new"),
            F.when(F.col("vb").isNull(), "disappeared"),
            F.when(F.col("va").isNull() & (F.col("pb") > 1), "cross_page_new"),
            F.when(F.col("vb").isNull() & (F.col("pa") > 1), "cross_page_gone"),
            F.when(F.col("va").isNotNull() & F.col("vb").isNotNull() & ~F.col("va").eqNullSafe(F.col("vb")), "value"),
        )
    )
    return joined.select("doc_id", "ids", F.explode(kinds).alias("change"))


def _pair(boxes: DataFrame, prefix: str, key: list[str], *more: str) -> DataFrame:
    return boxes.select(*key, *(F.col(c).alias(f"{prefix}{c}") for c in (*BOX, *more)))


def overlapping(boxes: DataFrame, key: list[str], id_col: str, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(key, a, b, iou) of box pairs of one page with an intersection over union of rules.iou or more."""
    a, b = _pair(boxes, "a_", key, id_col), _pair(boxes, "b_", key, id_col)
    return (
        a.join(b, key)
        .where((F.col(f"a_{id_col}") < F.col(f"b_{id_col}")) & (G.overlap_x("a_", "b_") > 0) & (G.overlap_y("a_", "b_") > 0))
        .withColumn("iou", G.iou("a_", "b_"))
        .where(F.col("iou") >= rules.iou)
        .select(*key, F.col(f"a_{id_col}").alias("a"), F.col(f"b_{id_col}").alias("b"), "iou")
    )


def covered_words(words: DataFrame, boxes: DataFrame, key: list[str], id_col: str, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(key, id, word_no): the first word of each box that the box covers by rules.cover or more."""
    w, b = _pair(words, "w_", key, "word_no"), _pair(boxes, "b_", key, id_col)
    return (
        w.join(b, key)
        .where(G.cover("w_", "b_") >= rules.cover)
        .groupBy(*key, F.col(f"b_{id_col}").alias(id_col))
        .agg(F.min("w_word_no").alias("word_no"))
    )


def unclaimed(boxes: DataFrame, claimed: DataFrame, key: list[str], id_col: str, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(key, id) of boxes of which no claimed box covers more than rules.orphan_overlap."""
    a, b = _pair(boxes, "a_", key, id_col), _pair(claimed, "b_", key)
    taken = a.join(b, key).where(G.cover("a_", "b_") > rules.orphan_overlap).select(*key, F.col(f"a_{id_col}").alias(id_col)).distinct()
    return boxes.select(*key, id_col).join(taken, [*key, id_col], "left_anti")


def sizes_near(boxes: DataFrame, sizes: DataFrame, key: list[str], id_col: str) -> DataFrame:
    """(key, id) of boxes with a size (s_x0..s_y1) about their lower edge."""
    b = _pair(boxes, "b_", key, id_col)
    h, w = G.height("b_"), F.greatest(F.lit(60.0), G.width("b_"))
    dy = G.cy("s_") - F.col("b_y1")
    near = (dy >= -0.3 * h) & (dy <= 1.2 * h) & (F.abs(G.cx("s_") - G.cx("b_")) <= w)
    return b.join(sizes, key).where(near).select(*key, F.col(f"b_{id_col}").alias(id_col)).distinct()


def scale_aliases(sizes: DataFrame) -> DataFrame:
    """(doc_id, small, large): sizes of a document that are each other times 10 or 100.  sizes is (doc_id, size, w, h)."""
    scaled = sizes.withColumn("k", F.explode(F.array(F.lit(10), F.lit(100))))
    a = scaled.select("doc_id", F.col("size").alias("small"), (F.col("w") * F.col("k")).alias("w"), (F.col("h") * F.col("k")).alias("h"))
    return a.join(sizes.withColumnRenamed("size", "large"), ["doc_id", "w", "h"]).select("doc_id", "small", "large").distinct()


def text_inside(words: DataFrame, boxes: DataFrame, key: list[str], id_col: str) -> DataFrame:
    """(key, id, raw): words whose centre is within a point of each box, in document order."""
    w, b = _pair(words, "w_", key, "word_no", "text"), _pair(boxes, "b_", key, id_col)
    inside = G.x_aligned("w_", "b_", 1.0) & G.y_aligned("w_", "b_", 1.0)
    listed = F.sort_array(F.collect_list(F.struct("w_word_no", "w_text")))
    return (
        w.join(b, key)
        .where(inside)
        .groupBy(*key, F.col(f"b_{id_col}").alias(id_col))
        .agg(F.array_join(F.transform(listed, lambda x: x["w_text"]), " ").alias("raw"))
    )


def lifecycle(detected: DataFrame, product: DataFrame, review: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, n_detected, vanished, phantom, stuck): codes neither in product nor queue, queued codes never
    detected, and whether nearly all codes are queued."""
    d = detected.select("doc_id", "token").distinct()
    p = product.select("doc_id", "token").distinct()
    r = review.select("doc_id", "token").distinct()

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name))

    gone = d.join(p, ["doc_id", "token"], "left_anti").join(r, ["doc_id", "token"], "left_anti")
    ghosts = r.join(d, ["doc_id", "token"], "left_anti")
    held = d.join(r, ["doc_id", "token"], "left_semi")
    out = count(d, "n_detected")
    for df, name in ((gone, "vanished"), (ghosts, "phantom"), (held, "held")):
        out = out.join(count(df, name), "doc_id", "left")
    out = out.na.fill(0)
    return out.select("doc_id", "n_detected", "vanished", "phantom", (F.col("held") >= rules.stuck * F.col("n_detected")).alias("stuck"))


def cross_version(rows: DataFrame) -> DataFrame:
    """(brand, code, n_docs, n_sizes, differs): codes of a brand in two or more documents.  rows is (brand, doc_id, code, size)."""
    return (
        rows.groupBy("brand", "code")
        .agg(F.count_distinct("doc_id").alias("n_docs"), F.count_distinct("size").alias("n_sizes"))
        .where("n_docs >= 2")
        .withColumn("differs", F.col("n_sizes") > 1)
    )


def duplicate_groups(items: DataFrame, hash_col: str, owner: str) -> DataFrame:
    """(hash, n, owners): equal hashes held by two or more owners."""
    return (
        items.groupBy(hash_col)
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct(owner).alias("owners"))
        .where("owners >= 2")
    )


def fan_out(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(side, item, n): distinct partners of each item, both ways, where there are two or more."""

    def one(k: str, other: str) -> DataFrame:
        return pairs.groupBy("doc_id", F.col(k).cast("string").alias("item")).agg(F.count_distinct(other).alias("n")).withColumn("side", F.lit(k))

    return one(a, b).unionByName(one(b, a)).where("n >= 2").select("doc_id", "side", "item", "n")


def cluster_kind(stats: DataFrame, rules: RuleConfig = PRODUCTION) -> Column:
    """collapse, overmerge, grey, unguarded or small, from a cluster's n, pages, conflict and area_pct."""
    many = F.col("n") >= rules.collapse
    return (
        F.when(many & (F.col("pages") >= 2) & F.col("conflict"), "collapse")
        .when(many & (F.col("pages") == 1) & (F.col("area_pct") >= rules.single_page_area), "overmerge")
        .when(many, "unguarded")
        .when(F.col("n") >= rules.borderline, "grey")
        .otherwise("small")
    )


def largest_gap(values: DataFrame, by: str, value: str) -> DataFrame:
    """(by, low, high, gap): the widest gap between neighbouring values of each group; the lower one on a tie."""
    order = Window.partitionBy(by).orderBy(value)
    gapped = values.select(by, F.col(value).alias("low"), F.lead(value).over(order).alias("high")).where("high is not null")
    best = F.max(F.struct((F.col("high") - F.col("low")).alias("gap"), (-F.col("low")).alias("first"), "high"))
    return gapped.groupBy(by).agg(best.alias("g")).select(by, (-F.col("g.first")).alias("low"), "g.high", "g.gap")


def first_unused(pool: DataFrame, used: DataFrame, by: str, hash_col: str, order: str) -> DataFrame:
    """The first document of each vendor whose hash is unused, with how many are left: (by, order, left).  Equal hashes
    of a vendor count once, in pool order."""
    fresh = pool.join(used.select(hash_col).distinct(), hash_col, "left_anti")
    once = Window.partitionBy(by, hash_col).orderBy(order)
    unique = fresh.withColumn("k", F.row_number().over(once)).where("k = 1").drop("k")
    return unique.groupBy(by).agg(F.min(order).alias(order), F.count(F.lit(1)).alias("left"))


def batches_left(left: DataFrame, by: str, count: str) -> DataFrame:
    """(need, batches): how many more batches can be built that take one document from each of `need` vendors or more, after
    the batch just built has taken one from every vendor.  Each batch lowers all remainders by one, so the last one that
    finds `need` vendors is the need-th largest remainder.  One row a vendor with a remainder."""
    rest = left.select(by, (F.col(count) - 1).alias("batches")).where("batches > 0")
    ranked = F.row_number().over(Window.orderBy(F.desc("batches"), by)).cast("long")  # vendors are few
    return rest.select(ranked.alias("need"), "batches")


def page_foot_tokens(words: DataFrame, pages: DataFrame, edge: float = 0.08, tolerance: float = 0.005, least: int = 5) -> DataFrame:
    """(doc_id, token): numbers in the edge band that run with the page number: clusters in x, one constant
    difference over `least` pages; a token counts if all its occurrences belong."""
    numbers = words.where(F.col("text").rlike("^[0-9]{1,4}$")).join(pages, ["doc_id", "page_no"])
    band = (G.cy() < edge * F.col("height")) | (G.cy() > (1 - edge) * F.col("height"))
    order = Window.partitionBy("doc_id").orderBy("x0", "page_no", "word_no")
    new = F.coalesce((F.col("x0") - F.lag("x0").over(order) > tolerance * F.col("width")).cast("int"), F.lit(1))
    clustered = (
        numbers.where(band)
        .withColumn("new", new)
        .withColumn("cluster", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("offset", F.col("text").cast("long") - F.col("page_no"))
    )
    family = clustered.groupBy("doc_id", "cluster", "offset").agg(F.count_distinct("page_no").alias("n")).where(F.col("n") >= least)
    inside = clustered.join(family, ["doc_id", "cluster", "offset"]).select("doc_id", "page_no", "word_no").withColumn("foot", F.lit(True))
    return (
        numbers.join(inside, ["doc_id", "page_no", "word_no"], "left")
        .groupBy("doc_id", F.col("text").alias("token"))
        .agg(F.bool_and(F.coalesce("foot", F.lit(False))).alias("all"))
        .where("all")
        .select("doc_id", "token")
    )


def score(bindings: DataFrame, truth: DataFrame, key: list[str]) -> DataFrame:
    """(key, hit): whether the one binding of a true (key, sw_idx) is right; several or none are no hit."""
    found = bindings.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("sw_idx").alias("got"))
    return truth.join(found, key, "left").select(*key, F.coalesce((F.col("n") == 1) & (F.col("got") == F.col("sw_idx")), F.lit(False)).alias("hit"))


def score_texts(texts: DataFrame, truth: DataFrame, key: list[str]) -> DataFrame:
    """(key, code_hit, full_hit): a true code is hit if exactly one swatch's text on its page holds it, and in full if that text
    also holds the first word of its name.  texts is (doc_id, page_no, sw_idx, text) of bound words, truth (key, code,
    name); both meet in an index of the texts' words."""
    on = ["doc_id", "page_no"]

    def bare(x: Column) -> Column:
        return F.upper(F.btrim(x, F.lit("*,;:()")))

    index = texts.select(*on, "sw_idx", F.explode(F.split("text", " ")).alias("t")).select(*on, "sw_idx", bare(F.col("t")).alias("token")).distinct()
    asked = truth.select(*key, F.upper("code").alias("token"), bare(F.element_at(F.split("name", " "), 1)).alias("name_token"))
    one = asked.join(index, [*on, "token"]).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("sw_idx").alias("sw_idx")).where("n = 1").drop("n")
    named = index.select(*on, "sw_idx", F.col("token").alias("name_token"), F.lit(True).alias("named"))
    met = asked.join(one, key, "left").join(named, [*on, "sw_idx", "name_token"], "left")
    return met.select(*key, F.col("sw_idx").isNotNull().alias("code_hit"), F.coalesce("named", F.lit(False)).alias("full_hit"))


def token_roles(rows: DataFrame) -> DataFrame:
    """(doc_id, token, roles): tokens that appear in more than one field.  rows is (doc_id, field, token)."""
    return (
        rows.where("token is not null")
        .groupBy("doc_id", "token")
        .agg(F.array_join(F.sort_array(F.collect_set("field")), ",").alias("roles"), F.count_distinct("field").alias("n"))
        .where("n > 1")
        .select("doc_id", "token", "roles")
    )
