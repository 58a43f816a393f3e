"""Page verdicts: one row a code word, from which counts, bindings and the review queue are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import PRODUCTION, RuleConfig
from pagelattice.functions import geometry as G

from .components import materialize
from .detect import PAGE_KEY, in_row_with_size, normed, page_sizes
from .fields import BOX, KEY
from .layout import assign_words, column_blocks, icon_context, rescue_orphans

COUNTS = ["n_codes", "code_orphan", "code_far", "code_x_aligned", "code_block_bound", "code_icon_demoted", "code_needs_review"]


def verdicts(
    words: DataFrame, swatches: DataFrame, codes: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION
) -> DataFrame:
    """(page key, word_no, token, sw_idx, rule, d, aligned, blocked, demoted, far) of every code word."""
    # code words and their swatches are each read several times below, and to find either shuffles all words or all pairs
    own = materialize(normed(words).join(codes.select("doc_id", "token"), ["doc_id", "token"], "left_semi").select(*KEY, "token", *BOX), "code-words")
    assigned = assign_words(own, swatches, rules)
    if rules.at(7):
        assigned = rescue_orphans(own, materialize(assigned, "assigned"), column_blocks(words, swatches, pages, rules), pages, rules)
    r = swatches.select(*PAGE_KEY, "sw_idx", *(F.col(c).alias(f"r_{c}") for c in BOX))
    joined = own.join(assigned, KEY).join(r, [*PAGE_KEY, "sw_idx"], "left").join(pages, PAGE_KEY)
    inside = F.coalesce(G.x_aligned("", "r_", rules.slack), F.lit(False))
    icon = F.lit(False)
    if rules.at(6):
        context = icon_context(swatches, pages, rules).select(*PAGE_KEY, "sw_idx", "icon")
        joined = joined.join(context, [*PAGE_KEY, "sw_idx"], "left")
        icon = F.coalesce("icon", F.lit(False))
    block = F.col("rule") == "block"
    far = F.coalesce(F.col("d") > F.greatest(rules.far_height * G.height("r_"), rules.far_page * F.col("height")), F.lit(False))
    return joined.select(
        *KEY,
        "token",
        *BOX,
        "sw_idx",
        "rule",
        "d",
        (inside & ~icon).alias("aligned"),
        (block & ~icon).alias("blocked"),
        ((inside | block) & icon).alias("demoted"),
        far.alias("far"),
    )


def demote_photos(
    judged: DataFrame, words: DataFrame, swatches: DataFrame, pages: DataFrame, rules: RuleConfig, share: float = 0.10
) -> DataFrame:
    """Version 9 alone: alignments on photo-sized swatches go unless the code is the swatch's only aligned one and
    has a size on its row, or is the only code of the swatch's caption band.  Uniqueness is judged before anything goes."""
    if rules.version != 9:
        return judged
    judged = materialize(judged, "before-demotion")
    big = swatches.join(pages, PAGE_KEY).where(G.area() >= share * F.col("width") * F.col("height")).select(*PAGE_KEY, "sw_idx").withColumn("big", F.lit(True))
    one = judged.where("aligned").groupBy(*PAGE_KEY, "sw_idx").agg(F.count_distinct("token").alias("n_tokens"))
    # sizes are asked only for what may be demoted
    asked = judged.where("aligned").join(big, [*PAGE_KEY, "sw_idx"], "left_semi").select(*KEY, *BOX)
    sized = in_row_with_size(asked, page_sizes(words, rules), pages, rules).withColumn("sized", F.lit(True))
    r = swatches.select(*PAGE_KEY, "sw_idx", *(F.col(c).alias(f"r_{c}") for c in BOX))
    reach = F.greatest(rules.caption_reach * G.height("r_"), F.lit(rules.caption_floor))
    folds = pages.select(*PAGE_KEY, G.fold(F.col("width"), F.col("height"), rules.fold_ratio).alias("fold"))
    band = (
        judged.join(r, [*PAGE_KEY, "sw_idx"])
        .join(folds, PAGE_KEY)
        .where(F.col("d").between(0, reach) & G.side(G.cx(), F.col("fold")).eqNullSafe(G.side(G.cx("r_"), F.col("fold"))))
        .groupBy(*PAGE_KEY, "sw_idx")
        .agg(F.count_distinct("token").alias("n_band"), F.min("token").alias("band_token"))
    )
    out = (
        judged.join(big, [*PAGE_KEY, "sw_idx"], "left")
        .join(one, [*PAGE_KEY, "sw_idx"], "left")
        .join(sized, KEY, "left")
        .join(band, [*PAGE_KEY, "sw_idx"], "left")
    )
    proof = (F.coalesce("sized", F.lit(False)) & (F.col("n_tokens") == 1)) | F.coalesce(
        (F.col("n_band") == 1) & (F.col("band_token") == F.col("token")), F.lit(False)
    )
    photo = F.col("aligned") & F.coalesce("big", F.lit(False)) & ~proof
    return out.withColumn("photo", photo).withColumn("aligned", F.col("aligned") & ~F.col("photo")).select(*judged.columns, "photo")


def page_counts(judged: DataFrame) -> DataFrame:
    """Counters of each page with a code."""
    ok = F.col("aligned") | F.col("blocked")
    return judged.groupBy(*PAGE_KEY).agg(
        F.count(F.lit(1)).alias("n_codes"),
        F.count_if(F.col("sw_idx").isNull()).alias("code_orphan"),
        F.count_if("far").alias("code_far"),
        F.count_if("aligned").alias("code_x_aligned"),
        F.count_if("blocked").alias("code_block_bound"),
        F.count_if("demoted").alias("code_icon_demoted"),
        F.count_if(~ok).alias("code_needs_review"),
    )


def corpus_totals(counts: DataFrame) -> DataFrame:
    """Counters of every page, document and of the corpus in one pass (null keys are totals)."""
    return counts.rollup("doc_id", "page_no").agg(*(F.sum(c).alias(c) for c in COUNTS))


def page_types(swatches: DataFrame, judged: DataFrame, pages: DataFrame, rasters: DataFrame) -> DataFrame:
    """(page key, ptype): text_only, no_swatch_no_code, vector, dense_grid, lifestyle_caption or standard, in this order.
    rasters is (page key, n_raster)."""
    s = swatches.groupBy(*PAGE_KEY).agg(F.count(F.lit(1)).alias("n_sw"), G.upper_median(G.area()).alias("mid"))
    c = judged.groupBy(*PAGE_KEY).agg(F.count(F.lit(1)).alias("n_codes"))
    joined = pages.join(s, PAGE_KEY, "left").join(c, PAGE_KEY, "left").join(rasters, PAGE_KEY, "left")
    n_sw, n_codes, n_raster = (F.coalesce(k, F.lit(0)) for k in ("n_sw", "n_codes", "n_raster"))
    kind = (
        F.when((n_sw == 0) & (n_codes > 0), "text_only")
        .when(n_sw == 0, "no_swatch_no_code")
        .when(n_raster == 0, "vector")
        .when(n_sw > 15, "dense_grid")
        .when((n_sw <= 4) & (F.col("mid") > 0.05 * F.col("width") * F.col("height")), "lifestyle_caption")
        .otherwise("standard")
    )
    return joined.select(*PAGE_KEY, kind.alias("ptype"))


def bindings(judged: DataFrame, swatches: DataFrame) -> DataFrame:
    """Bound code words with ids in document order: (doc_id, page_no, seq, id, word_no, code, sw_idx, box, method)."""
    order = Window.partitionBy(*PAGE_KEY).orderBy("word_no")
    box = F.array(*(F.bround(F.col(f"r_{c}"), 1) for c in BOX))
    r = swatches.select(*PAGE_KEY, "sw_idx", *(F.col(c).alias(f"r_{c}") for c in BOX))
    return (
        judged.where("aligned or blocked")
        .withColumn("seq", F.row_number().over(order) - 1)
        .join(r, [*PAGE_KEY, "sw_idx"])
        .select(
            *PAGE_KEY,
            F.col("seq").cast("long").alias("seq"),
            F.concat_ws(":", F.lit("b"), F.col("page_no").cast("string"), F.col("seq").cast("string")).alias("id"),
            "word_no",
            F.col("token").alias("code"),
            "sw_idx",
            box.alias("box"),
            F.when(F.col("blocked"), "geom_v7_block").otherwise("geom_v6_x_aligned").alias("method"),
        )
    )


def review_items(judged: DataFrame) -> DataFrame:
    """Code words that are not bound, with the reason: (page key, word_no, code, reason)."""
    reason = F.when(F.col("demoted"), "icon_demoted").when(F.col("sw_idx").isNull(), "orphan").otherwise("not_x_aligned")
    return judged.where("not (aligned or blocked)").select(*KEY, F.col("token").alias("code"), reason.alias("reason"))


def identity_gap(swatches: DataFrame, assigned: DataFrame, words: DataFrame, codes: DataFrame) -> DataFrame:
    """(page key, n_sw, sw_no_code): swatches to which no code word is assigned, empty ones included."""
    coded = (
        normed(words)
        .join(codes.select("doc_id", "token"), ["doc_id", "token"], "left_semi")
        .join(assigned.where("sw_idx is not null"), KEY)
        .select(*PAGE_KEY, "sw_idx")
        .distinct()
        .withColumn("coded", F.lit(True))
    )
    return (
        swatches.join(coded, [*PAGE_KEY, "sw_idx"], "left")
        .groupBy(*PAGE_KEY)
        .agg(F.count(F.lit(1)).alias("n_sw"), F.count_if(F.col("coded").isNull()).alias("sw_no_code"))
    )


def dispositions(pages: DataFrame, auto: DataFrame, review: DataFrame, spec: DataFrame, texts: DataFrame) -> DataFrame:
    """(page key, state): auto (has a variant), review (has a queue item), noprod (passes the size gate), nonspec
    (has text) or image, the first that holds."""
    out = pages.select(*PAGE_KEY)
    state = F.lit("image")
    for name, found in (("nonspec", texts), ("noprod", spec), ("review", review), ("auto", auto)):
        out = out.join(found.select(*PAGE_KEY).distinct().withColumn(name, F.lit(True)), PAGE_KEY, "left")
        state = F.when(F.col(name), name).otherwise(state)
    return out.select(*PAGE_KEY, state.alias("state"))
