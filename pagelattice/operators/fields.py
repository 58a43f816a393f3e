"""Fields of a code word from its row and column: size, surface, price band, packing, colour name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import PRODUCTION, RuleConfig
from pagelattice.functions import geometry as G
from pagelattice.functions import tokens as T

from .components import materialize
from .detect import PAGE_KEY, normed, page_sizes

KEY = [*PAGE_KEY, "word_no"]
BOX = ["x0", "y0", "x1", "y1"]


def _as(df: DataFrame, prefix: str, *more: str) -> DataFrame:
    """Page key, plus word_no, box and the named columns under a prefix."""
    return df.select(*PAGE_KEY, *(F.col(c).alias(f"{prefix}{c}") for c in ("word_no", *BOX, *more)))


def _folds(pages: DataFrame, rules: RuleConfig) -> DataFrame:
    return pages.select(*PAGE_KEY, G.fold(F.col("width"), F.col("height"), rules.fold_ratio).alias("fold"))


def _same_side(a: str, b: str) -> Column:
    return G.side(G.cx(a), F.col("fold")).eqNullSafe(G.side(G.cx(b), F.col("fold")))


def row_words(words: DataFrame, code_words: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """Words on the row and side of each code word: (page key, w_*, u_*).  A word equal to the code word in
    place and text is not its neighbour, even as another word."""
    w, u = _as(code_words, "w_", "text"), _as(words, "u_", "text")
    differs = F.lit(False)
    for c in (*BOX, "text"):
        differs = differs | (F.col(f"w_{c}") != F.col(f"u_{c}"))
    return w.join(_folds(pages, rules), PAGE_KEY).join(u, PAGE_KEY).where(G.same_row("w_", "u_", rules.row_height) & _same_side("w_", "u_") & differs)


def row_size(words: DataFrame, code_words: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(page key, word_no, size): the size on the code word's row, or else above it within four heights; from
    version 4 on its side of the fold (by the size's left edge), and sizes over the code's column first."""
    w, s = _as(code_words, "w_"), page_sizes(words, rules)
    joined = w.join(_folds(pages, rules), PAGE_KEY).join(s, PAGE_KEY)
    if rules.at(4):
        joined = joined.where(F.col("fold").isNull() | ((F.col("s_x0") < F.col("fold")) == G.side(G.cx("w_"), F.col("fold"))))
    up = G.cy("w_") - G.cy("s_")
    tall = F.greatest(G.height("w_"), F.lit(1.0))
    same = G.same_row("w_", "s_", rules.row_height)
    above = (up > 0) & (up <= 4 * tall) & (F.col("s_x0") <= F.col("w_x1"))
    over = G.overlap_x("w_", "s_") > 0
    tier = F.when(same, 0).when(above & (over | F.lit(not rules.at(4))), 1).when(above, 2)
    best = F.min(F.struct("tier", F.abs(up).alias("dy"), F.abs(F.col("s_x0") - F.col("w_x0")).alias("dx"), F.col("size").alias("size")))
    return (
        joined.withColumn("tier", tier)
        .where("tier is not null")
        .groupBy(*PAGE_KEY, F.col("w_word_no").alias("word_no"))
        .agg(best["size"].alias("size"))
    )


def price_band(neighbours: DataFrame, bands: DataFrame) -> DataFrame:
    """(page key, word_no, band): the routed band nearest in x on the row; on a tie the smaller token."""
    b = neighbours.withColumn("token", T.norm(F.col("u_text"))).join(bands.select("doc_id", "token"), ["doc_id", "token"], "left_semi")
    nearest = F.min(F.struct(F.abs(G.cx("u_") - G.cx("w_")).alias("d"), "token"))
    return b.groupBy(*PAGE_KEY, F.col("w_word_no").alias("word_no")).agg(nearest["token"].alias("band"))


def packing(words: DataFrame, neighbours: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(page key, word_no, field, value): numbers on the row under the nearest header above in their column;
    the left-most number of each field."""
    numbers = neighbours.where(F.col("u_text").rlike(T.PACK_VALUE))
    headers = _as(words, "v_", "text").withColumn("field", T.pack_field(F.col("v_text"))).where("field is not null")
    d = G.cy("u_") - G.cy("v_")
    found = (
        numbers.join(headers, PAGE_KEY)
        .where((d > 0) & (G.overlap_x("u_", "v_") > 0) & _same_side("u_", "v_"))
        .groupBy(*PAGE_KEY, "w_word_no", "u_word_no", "u_x0", "u_text")
        .agg(F.min(F.struct(d.alias("d"), "v_word_no", "field"))["field"].alias("field"))
    )
    first = Window.partitionBy(*PAGE_KEY, "w_word_no", "field").orderBy("u_x0", "u_word_no")
    return (
        found.withColumn("r", F.row_number().over(first))
        .where("r = 1")
        .select(*PAGE_KEY, F.col("w_word_no").alias("word_no"), "field", F.replace("u_text", F.lit(","), F.lit(".")).alias("value"))
    )


def finish_vocabulary(neighbours: DataFrame, alpha_vocab: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, token): trade words that stand on the rows of several code words of the document."""
    found = neighbours.withColumn("token", T.norm(F.col("u_text"))).where(T.is_alpha(F.col("token")))
    return (
        found.join(alpha_vocab.select("token"), "token", "left_semi")
        .groupBy("doc_id", "token")
        .agg(F.count_distinct("page_no", "w_word_no").alias("n"))
        .where(F.col("n") >= rules.finish_rows)
        .select("doc_id", "token")
    )


def surface(neighbours: DataFrame, finishes: DataFrame) -> DataFrame:
    """(page key, word_no, surface): finish words of the row from left to right, each token once."""
    own = neighbours.withColumn("token", T.norm(F.col("u_text"))).where(~T.is_lower(F.col("u_text")))
    own = own.join(finishes, ["doc_id", "token"], "left_semi")
    first = own.groupBy(*PAGE_KEY, "w_word_no", "token").agg(F.min(F.struct("u_x0", "u_word_no", "u_text")).alias("u"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("u")), lambda u: u["u_text"]), " ")
    return first.groupBy(*PAGE_KEY, F.col("w_word_no").alias("word_no")).agg(joined.alias("surface"))


def captions(words: DataFrame, assigned: DataFrame, swatches: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """Caption words of each swatch: (page key, sw_idx, word_no, x0..y1, text): assigned within its reach (block-bound
    words count, their distance is below zero) and on its side of the fold."""
    r = swatches.select(*PAGE_KEY, "sw_idx", *(F.col(c).alias(f"r_{c}") for c in BOX))
    reach = F.greatest(rules.caption_reach * G.height("r_"), F.lit(rules.caption_floor))
    return (
        assigned.where("sw_idx is not null")
        .join(r, [*PAGE_KEY, "sw_idx"])
        .where(F.col("d") <= reach)
        .join(words, KEY)
        .join(_folds(pages, rules), PAGE_KEY)
        .where(G.side(G.cx(), F.col("fold")).eqNullSafe(G.side(G.cx("r_"), F.col("fold"))))
        .select(*PAGE_KEY, "sw_idx", "word_no", *BOX, "text")
    )


def caption_names(caption_words: DataFrame, alpha_vocab: DataFrame | None = None) -> DataFrame:
    """(page key, sw_idx, color): colour words of a swatch's caption by line and x, joined by a space."""
    own = caption_words.where(T.is_name_shape(F.col("text")) & T.is_latin(F.col("text"))).withColumn("token", T.norm(F.col("text")))
    if alpha_vocab is not None:
        own = own.join(alpha_vocab.select("token"), "token", "left_anti")
    listed = F.sort_array(F.collect_list(F.struct(F.bround("y0", 0).alias("y"), "x0", "word_no", "text")))
    return own.groupBy(*PAGE_KEY, "sw_idx").agg(F.array_join(F.transform(listed, lambda w: w["text"]), " ").alias("color"))


def name_index(caption_words: DataFrame, swatches: DataFrame, codes: DataFrame, alpha_vocab: DataFrame | None = None) -> DataFrame:
    """(doc_id, token, page_no, sw_idx): colour names of captions without a code, on swatches that are no strip."""
    square = swatches.where((G.height() < 6 * G.width()) & (G.width() < 6 * G.height())).select(*PAGE_KEY, "sw_idx")
    # the captions are read once: a window tells which swatches hold a code
    known = codes.select("doc_id", "token").distinct().withColumn("is_code", F.lit(True))
    named = normed(caption_words).select(*PAGE_KEY, "sw_idx", "text", "token").join(known, ["doc_id", "token"], "left")
    coded = F.count("is_code").over(Window.partitionBy(*PAGE_KEY, "sw_idx"))
    free = named.withColumn("coded", coded).where("coded = 0").join(square, [*PAGE_KEY, "sw_idx"], "left_semi")
    free = free.where(T.is_name_shape(F.col("text")))
    if alpha_vocab is not None:
        free = free.join(alpha_vocab.select("token"), "token", "left_anti")
    return free.select("doc_id", "token", "page_no", "sw_idx").distinct()


def good_names(words: DataFrame, code_words: DataFrame, pages: DataFrame, alpha_vocab: DataFrame | None = None, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(page key, token): names that share a row with some codes of the page, but not with too many."""
    u = words.where(T.is_name_shape(F.col("text"))).withColumn("token", T.norm(F.col("text")))
    if alpha_vocab is not None:
        u = u.join(alpha_vocab.select("token"), "token", "left_anti")
    c = _as(code_words, "c_")
    n = code_words.groupBy(*PAGE_KEY).agg(F.count(F.lit(1)).alias("n_codes"))
    together = (
        _as(u, "u_", "token")
        .join(_folds(pages, rules), PAGE_KEY)
        .join(c, PAGE_KEY)
        .where(G.same_row("u_", "c_", rules.row_height) & _same_side("u_", "c_"))
        .groupBy(*PAGE_KEY, F.col("u_token").alias("token"))
        .agg(F.count_distinct("c_word_no").alias("k"))
    )
    return together.join(n, PAGE_KEY).where(F.col("k") <= F.greatest(F.lit(3.0), F.col("n_codes") / 3)).select(*PAGE_KEY, "token")


def bind_names(
    words: DataFrame, open_codes: DataFrame, index: DataFrame, names: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION
) -> DataFrame:
    """(page key, word_no, to_page, to_sw): code words bound through the names on their row.

    Each name counts if it has one to three targets; the first target that all of them share wins, and without
    a shared one nothing is bound.  This is a relational division: targets hit by every name."""
    n_targets = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "token"))
    targets = index.select("doc_id", "token", F.col("page_no").alias("to_page"), F.col("sw_idx").alias("to_sw"), n_targets.alias("k"))
    # what lies behind the index is computed once, though its names are asked for on both sides
    targets = materialize(targets.where(F.col("k") <= rules.name_targets).drop("k"), "name-targets")
    few = targets.select("doc_id", "token").distinct()
    u = words.withColumn("token", T.norm(F.col("text"))).where(T.is_name_shape(F.col("text"))).join(names, [*PAGE_KEY, "token"], "left_semi")
    u = u.join(few, ["doc_id", "token"], "left_semi")
    pairs = (
        _as(open_codes, "w_")
        .join(_folds(pages, rules), PAGE_KEY)
        .join(_as(u, "u_", "token"), PAGE_KEY)
        .where(G.same_row("w_", "u_", rules.row_height) & _same_side("w_", "u_"))
        .select(*PAGE_KEY, F.col("w_word_no").alias("word_no"), F.col("u_token").alias("token"))
        .distinct()
    )
    wanted = pairs.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*KEY)))
    hits = wanted.join(targets, ["doc_id", "token"]).groupBy(*KEY, "n", "to_page", "to_sw").agg(F.count(F.lit(1)).alias("k"))
    return (
        hits.where("k = n")
        .groupBy(*KEY)
        .agg(F.min(F.struct("to_page", "to_sw")).alias("t"))
        .select(*KEY, "t.to_page", "t.to_sw")
    )


def name_collisions(index: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, n_unique, n_shared, shared): names of the index with one target, and those with two to name_targets, listed."""
    per = index.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("k"))
    few = F.col("k").between(2, rules.name_targets)
    listed = F.array_join(F.sort_array(F.collect_list(F.when(few, F.concat_ws("=", "token", F.col("k").cast("string"))))), ",")
    return per.groupBy("doc_id").agg(F.count_if(F.col("k") == 1).alias("n_unique"), F.count_if(few).alias("n_shared"), listed.alias("shared"))
