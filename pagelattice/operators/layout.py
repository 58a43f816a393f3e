"""Swatch extraction and word-to-swatch assignment.

All joins carry (doc_id, page_no), so Spark plans an equi-join with the geometry as residual
predicate.  Words are (doc_id, page_no, word_no, x0, y0, x1, y1, text); rectangles are
(doc_id, page_no, sw_idx, x0, y0, x1, y1).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import PRODUCTION, RuleConfig
from pagelattice.functions import geometry as G

PAGE_KEY = ["doc_id", "page_no"]
BOX = ["x0", "y0", "x1", "y1"]


def candidate_rects(images: DataFrame, drawings: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """Raster rectangles within the area gates; filled drawings only on pages without any of those.

    images and drawings are (doc_id, page_no, rid, x0..y1), drawings with has_fill."""
    size, page = G.area(), F.col("width") * F.col("height")
    raster = (
        images.join(pages, PAGE_KEY)
        .where((size > rules.area_min) & (size < rules.raster_share * page) & (G.width() > 6) & (G.height() > 6))
        .select(*PAGE_KEY, "rid", *BOX)
    )
    vector = drawings.join(pages, PAGE_KEY).where(F.col("has_fill") & (size > rules.area_min) & (size < rules.vector_share * page))
    if rules.at(3):
        furniture = (G.height() >= rules.furniture_ratio * G.width()) & (G.height() >= rules.furniture_height * F.col("height"))
        vector = vector.where(~furniture)
    fallback = vector.select(*PAGE_KEY, "rid", *BOX).join(raster.select(*PAGE_KEY).distinct(), PAGE_KEY, "left_anti")
    return raster.withColumn("is_raster", F.lit(True)).unionByName(fallback.withColumn("is_raster", F.lit(False)))


def suppress_overlaps(rects: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """Greedy suppression in (y0, x0) order: a rectangle that covers more than half of itself or of a kept
    one (whichever is smaller) goes.  Numbers what stays (sw_idx).  One page's rectangles are one array."""

    def box_area(r: Column) -> Column:
        return (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])

    def clash(a: Column, b: Column) -> Column:
        w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
        h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
        return (w > 0) & (h > 0) & (w * h > rules.nms_overlap * F.least(box_area(a), box_area(b)))

    one = F.struct("y0", "x0", "rid", "x1", "y1")
    kept = F.aggregate(
        F.sort_array(F.collect_list(one)),
        F.array().cast("array<struct<y0:double,x0:double,rid:bigint,x1:double,y1:double>>"),
        lambda acc, r: F.when(F.exists(acc, lambda o: clash(o, r)), acc).otherwise(F.array_append(acc, r)),
    )
    return (
        rects.groupBy(*PAGE_KEY)
        .agg(kept.alias("kept"))
        .select(*PAGE_KEY, F.posexplode("kept").alias("sw_idx", "r"))
        .select(*PAGE_KEY, F.col("sw_idx").cast("long").alias("sw_idx"), *(f"r.{c}" for c in ("rid", *BOX)))
    )


def _placed(words: DataFrame, swatches: DataFrame, rules: RuleConfig) -> tuple[DataFrame, DataFrame]:
    """Words and swatches with what _tiers reads.  Centres and bounds are computed here, once a row and not once a pair:
    code for a pair that is too long is not compiled by the JVM."""
    s = rules.slack
    w = words.select(*PAGE_KEY, "word_no", F.col("x0").alias("w_x0"), F.col("x1").alias("w_x1"), G.cx().alias("w_cx"), G.cy().alias("w_cy"), (rules.caption_overlap * G.width()).alias("w_need"))
    r = swatches.select(
        *PAGE_KEY,
        F.col("sw_idx").alias("r_sw_idx"),
        *(F.col(c).alias(f"r_{c}") for c in BOX),
        G.cx().alias("r_cx"),
        F.greatest(rules.caption_reach * G.height(), F.lit(rules.caption_floor)).alias("r_reach"),
        *((F.col(c) - s).alias(f"r_{c}_less") for c in ("x0", "y0", "y1")),
        *((F.col(c) + s).alias(f"r_{c}_more") for c in ("x1", "y0", "y1")),
    )
    return w, r


def _tiers(rules: RuleConfig) -> list[tuple[str, Column, Column, Column]]:
    """(rule, predicate, sort key, distance) in the version's order, over the columns of _placed."""
    x, y = F.col("w_cx"), F.col("w_cy")
    mid = F.abs(F.col("r_cx") - x)
    zero = F.lit(0.0)
    below, above = y - F.col("r_y1"), F.col("r_y0") - y
    near = G.overlap_x("w_", "r_") > F.col("w_need")
    in_x, in_y = x.between(F.col("r_x0_less"), F.col("r_x1_more")), y.between(F.col("r_y0_less"), F.col("r_y1_more"))
    under = F.col("r_y0") <= y
    depth = y - F.col("r_y0")
    far = F.greatest(zero, below)
    rules_ = {
        "row_x": (in_y & in_x, mid, zero),
        "row": (in_y, mid, zero),
        "below": ((F.col("r_y1_less") <= y) & near & (below < F.col("r_reach")), below, below),
        "above": ((F.col("r_y0_more") >= y) & near & (above < F.col("r_reach")), above, above),
        "section_x": (under & in_x, depth, far),
        "section": (under, depth, far),
    }
    if rules.version >= 4:
        order = ["row_x", "below", "above", "section_x"]
    elif rules.version == 3:
        order = ["row_x", "below", "above", "section_x", "row", "section"]
    elif rules.version == 2:
        order = ["row", "below", "above", "section_x", "section"]
    else:
        order = ["row", "below", "section"]
    return [(k, *rules_[k]) for k in order]


def assign_words(words: DataFrame, swatches: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """Every word with its swatch: (doc_id, page_no, word_no, sw_idx, rule, d).

    The first rule of the version's order with any swatch wins; within it the smallest key,
    then the smallest index.  Words without a swatch have rule `orphan`, d -1 and no index.
    Two equi-joins on the page and two aggregations per word, none of which sorts the pairs.
    """
    tiers = _tiers(rules)
    w, r = _placed(words, swatches, rules)
    # Two passes over the pairs of a page, the best key of each rule and then who has it: plain numbers are aggregated in
    # a hash table, whereas the least struct would have all pairs sorted.
    anything = reduce(or_, (test for _, test, _, _ in tiers))
    keys = [F.min(F.when(test, key)).alias(f"k{i}") for i, (_, test, key, _) in enumerate(tiers)]
    best = w.join(r, PAGE_KEY).where(anything).groupBy(*w.columns).agg(*keys)
    won, d = F.lit(False), F.lit(None).cast("double")
    tier, open_ = F.lit(None).cast("int"), F.lit(True)
    for i, (_, test, key, distance) in enumerate(tiers):
        mine = open_ & F.col(f"k{i}").isNotNull()
        won, open_ = won | (mine & test & (key == F.col(f"k{i}"))), open_ & F.col(f"k{i}").isNull()
        d = F.when(F.col("tier") == i, distance).otherwise(d)
        tier = F.coalesce(tier, F.when(F.col(f"k{i}").isNotNull(), i))
    hit = (
        best.join(r, PAGE_KEY)
        .where(won)
        .withColumn("tier", tier)
        .withColumn("d", d)
        .groupBy(*PAGE_KEY, "word_no")
        .agg(F.min("tier").alias("tier"), F.min("r_sw_idx").alias("idx"), F.min_by("d", "r_sw_idx").alias("d"))
    )
    names = F.array(*(F.lit(k) for k, *_ in tiers))
    return (
        words.select(*PAGE_KEY, "word_no")
        .join(hit, [*PAGE_KEY, "word_no"], "left")
        .select(
            *PAGE_KEY,
            "word_no",
            F.col("idx").alias("sw_idx"),
            F.coalesce(F.get(names, F.col("tier")), F.lit("orphan")).alias("rule"),
            F.coalesce("d", F.lit(-1.0)).alias("d"),
        )
    )


def column_blocks(words: DataFrame, swatches: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """Left-column blocks: (doc_id, page_no, side, sw_idx, y0, y1, column_x1), an interval for each member.

    Members are small swatches at least three words high; a side of the fold is turned down
    unless they stand in one straight, left, uniform column with few words in its band."""
    folded = pages.withColumn("fold", G.fold(F.col("width"), F.col("height"), rules.fold_ratio))
    tall = words.groupBy(*PAGE_KEY).agg(G.upper_median(G.height()).alias("word_h"))
    side = F.coalesce(G.side(G.cx(), F.col("fold")), F.lit(True)).alias("side")
    members = (
        swatches.join(tall, PAGE_KEY)
        .join(folded, PAGE_KEY)
        .where((G.height() >= rules.block_height * F.col("word_h")) & (G.area() <= rules.block_area * F.col("width") * F.col("height")))
        .select(*PAGE_KEY, side, "sw_idx", *BOX, "width", "height", "fold")
    )
    key = [*PAGE_KEY, "side"]
    order = Window.partitionBy(*key).orderBy("y0", "sw_idx")
    pitched = members.withColumn("pitch", F.lead("y0").over(order) - F.col("y0"))
    origin = F.when(F.col("fold").isNotNull() & ~F.col("side"), F.col("fold")).otherwise(F.lit(0.0))
    half = F.coalesce("fold", F.col("width"))
    columns = (
        pitched.groupBy(*key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("x0").alias("x0"),
            F.max("x0").alias("x0_max"),
            F.max("x1").alias("x1"),
            F.max(G.height()).alias("h_max"),
            F.min(G.height()).alias("h_min"),
            F.min("y0").alias("first"),
            F.max("y0").alias("last"),
            G.upper_median(F.col("pitch")).alias("pitch"),
            F.first("width").alias("width"),
            F.first("height").alias("height"),
            F.first(origin).alias("origin"),
            F.first(half).alias("half"),
        )
        .where(
            (F.col("n") >= rules.block_members)
            & (F.col("x0_max") - F.col("x0") <= rules.block_x_tolerance * F.col("width"))
            & (F.col("x1") <= F.col("origin") + rules.block_left * F.col("half"))
            & (F.col("h_max") <= rules.block_uniform * F.col("h_min"))
        )
        .withColumn("bottom", F.least(rules.block_bottom * F.col("height"), F.col("last") + rules.block_pitch * F.col("pitch")))
    )
    w = words.join(folded, PAGE_KEY).select(*PAGE_KEY, side, G.cx().alias("w_cx"), G.cy().alias("w_cy"))
    inside = (
        F.col("w_cx").between(F.col("x0") - rules.slack, F.col("x1") + rules.slack)
        & (F.col("w_cy") >= F.col("first"))
        & (F.col("w_cy") <= F.col("bottom"))
    )
    crowded = (
        columns.join(w, key)
        .where(inside)
        .groupBy(*key, "n")
        .agg(F.count(F.lit(1)).alias("words"))
        .where(F.col("words") > rules.block_band_words * F.col("n"))
    )
    good = columns.join(crowded.select(*key), key, "left_anti").select(*key, F.col("x1").alias("column_x1"), "bottom")
    return (
        pitched.join(good, key)
        .select(*key, "sw_idx", "y0", F.coalesce(F.col("y0") + F.col("pitch"), F.col("bottom")).alias("y1"), "column_x1")
    )


def rescue_orphans(words: DataFrame, assigned: DataFrame, blocks: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """assign_words' result with would-be orphans bound to the block interval they stand right of (rule `block`)."""
    if not rules.at(7):
        return assigned
    folded = pages.withColumn("fold", G.fold(F.col("width"), F.col("height"), rules.fold_ratio))
    lost = (
        assigned.where("rule = 'orphan'")
        .select(*PAGE_KEY, "word_no")
        .join(words, [*PAGE_KEY, "word_no"])
        .join(folded, PAGE_KEY)
        .select(*PAGE_KEY, "word_no", F.coalesce(G.side(G.cx(), F.col("fold")), F.lit(True)).alias("side"), G.cx().alias("w_cx"), G.cy().alias("w_cy"))
    )
    found = (
        lost.join(blocks, [*PAGE_KEY, "side"])
        .where((F.col("y0") <= F.col("w_cy")) & (F.col("w_cy") < F.col("y1")) & (F.col("w_cx") > F.col("column_x1") + rules.slack))
        .groupBy(*PAGE_KEY, "word_no")
        .agg(F.min(F.struct("y0", "sw_idx"))["sw_idx"].alias("block_idx"))
    )
    return assigned.join(found, [*PAGE_KEY, "word_no"], "left").select(
        *PAGE_KEY,
        "word_no",
        F.coalesce("sw_idx", "block_idx").alias("sw_idx"),
        F.when(F.col("block_idx").isNotNull(), "block").otherwise(F.col("rule")).alias("rule"),
        F.when(F.col("block_idx").isNotNull(), F.lit(-2.0)).otherwise(F.col("d")).alias("d"),
    )


def icon_context(swatches: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """Swatches with median area of the document (true median; from version 13 without very large ones), whether
    their 20 pt position repeats, and whether they look like an icon."""
    n_pages = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_spec"))
    sized = swatches.join(pages, PAGE_KEY).withColumn("area", G.area()).withColumn("key", G.key20())
    counted = F.col("area") < rules.icon_big * F.col("width") * F.col("height") if rules.at(13) else F.lit(True)
    median = sized.groupBy("doc_id").agg(F.coalesce(F.median(F.when(counted, F.col("area"))), F.lit(0.0)).alias("median_area"))
    repeats = (
        sized.groupBy("doc_id", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(n_pages, "doc_id")
        .where(F.col("n") >= F.greatest(F.lit(float(rules.repeat_floor)), rules.repeat_pages * F.col("n_spec")))
        .select("doc_id", "key", F.lit(True).alias("repeated"))
    )
    joined = sized.join(median, "doc_id").join(repeats, ["doc_id", "key"], "left").withColumn("repeated", F.coalesce("repeated", F.lit(False)))
    suspect = G.icon_suspect(F.col("area"), F.col("median_area"), F.col("repeated"), rules.icon_small, rules.icon_repeated)
    return joined.select(*PAGE_KEY, "sw_idx", "area", "median_area", "repeated", suspect.alias("icon"))
