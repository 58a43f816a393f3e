"""Page extraction as one operator: bindings, review items with name hints, spec rows, sizes and counters of every page."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import PRODUCTION, RuleConfig
from pagelattice.functions import geometry as G
from pagelattice.functions import tokens as T

from . import fields, scan
from .components import materialize
from .detect import PAGE_KEY, detect_codes, normed, page_sizes
from .fields import KEY
from .layout import assign_words

#: A page whose codes are hardly aligned may be a table of colour names: this many codes or more, this share aligned or less.
NAME_PAGE_CODES = 5
NAME_PAGE_SHARE = 0.2
# Bands at the edges of a photo-sized swatch in which a caption stands, in points: fixed values.
CAPTION_PHOTO_HEIGHT, CAPTION_TOP, CAPTION_BOTTOM = 150.0, 35.0, 16.0


@dataclass
class Extraction:
    """The tables of all pages; every code word is in bindings or in review, and has one spec row."""

    judged: DataFrame
    bindings: DataFrame
    review: DataFrame
    spec_rows: DataFrame
    sizes: DataFrame
    counts: DataFrame


def name_hints(
    judged: DataFrame, words: DataFrame, swatches: DataFrame, codes: DataFrame, pages: DataFrame, alpha_vocab: DataFrame | None = None, rules: RuleConfig = PRODUCTION
) -> DataFrame:
    """(page key, word_no, to_page, to_sw): where the colour names on a code's row point, on pages whose codes are hardly aligned.

    Names and homes are judged on the geometry of version 3 at most, whatever the version.  A code that is aligned
    anywhere in its document has a home and takes no name."""
    old = RuleConfig(min(rules.version, 3))
    ok = F.col("aligned") | F.col("blocked")
    tables = judged.groupBy(*PAGE_KEY).agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("k"))
    tables = tables.where((F.col("n") >= NAME_PAGE_CODES) & (F.col("k") <= NAME_PAGE_SHARE * F.col("n"))).select(*PAGE_KEY)
    loose = materialize(judged.where(~ok).join(tables, PAGE_KEY, "left_semi").select(*KEY, "token"), "loose-codes")
    # homes are sought for loose codes alone, names for codes that are then still open: both know their documents only
    r = swatches.select(*PAGE_KEY, "sw_idx", *(F.col(c).alias(f"r_{c}") for c in fields.BOX))
    same = normed(words).join(loose.select("doc_id", "token").distinct(), ["doc_id", "token"], "left_semi")
    settled = assign_words(same, _of_documents(swatches, loose), old)
    home = same.join(settled, KEY).join(r, [*PAGE_KEY, "sw_idx"]).where(G.x_aligned("", "r_", rules.slack)).select("doc_id", "token").distinct()
    open_ = materialize(loose.join(home, ["doc_id", "token"], "left_anti").select(*KEY), "open-codes")
    words, swatches, pages = (_of_documents(df, open_) for df in (words, swatches, pages))
    known = codes.select("doc_id", "token").distinct().withColumn("is_code", F.lit(True))
    told = normed(words).join(known, ["doc_id", "token"], "left")
    # the index reads codes and names of a caption, no other words
    telling = told.where(F.col("is_code") | T.is_name_shape(F.col("text"))).select(*words.columns)
    index = fields.name_index(fields.captions(telling, assign_words(telling, swatches, old), swatches, pages, rules), swatches, codes, alpha_vocab)
    names = fields.good_names(words, told.where("is_code"), pages, alpha_vocab, rules)
    return fields.bind_names(words, words.join(open_, KEY, "left_semi"), index, names, pages, rules)


def _of_documents(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys.select("doc_id").distinct(), "doc_id", "left_semi")


def extract_pages(
    words: DataFrame,
    swatches: DataFrame,
    pages: DataFrame,
    codes: DataFrame | None = None,
    code_vocab: DataFrame | None = None,
    alpha_vocab: DataFrame | None = None,
    bands: DataFrame | None = None,
    rules: RuleConfig = PRODUCTION,
) -> Extraction:
    """Everything that a page gives under one version.  codes and bands are (doc_id, token); where they are not given, they
    are detected.  Detected codes and verdicts, which every part reads, are computed once.  Names need version 4, photo
    demotion is version 9's alone."""
    if codes is None:
        found = materialize(detect_codes(words, pages, code_vocab, alpha_vocab, rules), "detected")
        codes, bands = (found.where(F.col("bucket") == b).select("doc_id", "token") for b in ("kept", "band"))
    judged = scan.verdicts(words, swatches, codes, pages, rules)
    photo = F.lit(False)
    if rules.version == 9:
        judged, photo = scan.demote_photos(judged, words, swatches, pages, rules), F.col("photo")
    judged = materialize(judged.withColumn("photo", photo), "verdicts")
    own = words.join(judged.select(*KEY), KEY, "left_semi")
    sizes = fields.row_size(words, judged, pages, rules)  # the verdicts have the places
    near = fields.row_words(words, own, pages, rules)
    spec = judged.select(*KEY, F.col("token").alias("code")).join(sizes, KEY, "left")
    if bands is not None:
        spec = spec.join(fields.price_band(near, bands), KEY, "left")
    else:
        spec = spec.withColumn("band", F.lit(None).cast("string"))
    if alpha_vocab is not None:
        spec = spec.join(fields.surface(near, fields.finish_vocabulary(near, alpha_vocab, rules)), KEY, "left")
    else:
        spec = spec.withColumn("surface", F.lit(None).cast("string"))
    packed = fields.packing(words, near, pages, rules).groupBy(*KEY).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "value")))).alias("packing"))
    in_order = Window.partitionBy(*PAGE_KEY).orderBy("word_no")
    number = (F.row_number().over(in_order) - 1).cast("string")
    spec = spec.join(packed, KEY, "left").withColumn("id", F.concat_ws(":", F.lit("s"), F.col("page_no").cast("string"), number))
    review = scan.review_items(judged)
    if rules.at(4):
        hints = name_hints(judged, words, swatches, codes, pages, alpha_vocab, rules)
    else:
        hints = judged.where("false").select(*KEY, F.col("page_no").alias("to_page"), F.col("sw_idx").alias("to_sw"))
    review = review.join(hints, KEY, "left")
    sized = page_sizes(words, rules).select(*PAGE_KEY, T.norm_size(F.col("size")).alias("size"))
    return Extraction(judged, scan.bindings(judged, swatches), review, spec, sized, counters(judged, sizes, hints, swatches, pages))


def counters(judged: DataFrame, sizes: DataFrame, hints: DataFrame, swatches: DataFrame, pages: DataFrame) -> DataFrame:
    """The counters of every page: those of the verdicts, and n_sw, sw_no_code, code_with_size, code_name_bound, code_photo_demoted."""
    n = F.count(F.lit(1))
    coded = judged.where("sw_idx is not null").select(*PAGE_KEY, "sw_idx").distinct().withColumn("coded", F.lit(True))
    gap = swatches.join(coded, [*PAGE_KEY, "sw_idx"], "left").groupBy(*PAGE_KEY).agg(n.alias("n_sw"), F.count_if(F.col("coded").isNull()).alias("sw_no_code"))
    out = pages.select(*PAGE_KEY).join(scan.page_counts(judged), PAGE_KEY, "left")
    for df, name in ((sizes, "code_with_size"), (hints, "code_name_bound"), (judged.where("photo"), "code_photo_demoted")):
        out = out.join(df.groupBy(*PAGE_KEY).agg(n.alias(name)), PAGE_KEY, "left")
    return out.join(gap, PAGE_KEY, "left").na.fill(0)


def caption_windows(caption_words: DataFrame, swatches: DataFrame, codes: DataFrame, alpha_vocab: DataFrame | None = None) -> DataFrame:
    """(page key, sw_idx, word_no, text, box, window) of every word of the raw caption: `caption` for those that name the swatch,
    `code` for detected codes, and on photo-sized swatches, away from the edges, `excluded` for short names and `outside` for the rest."""
    r = swatches.select(*PAGE_KEY, "sw_idx", *(F.col(c).alias(f"r_{c}") for c in fields.BOX))
    top, bottom = F.abs(G.cy() - F.col("r_y0")), F.abs(F.col("r_y1") - G.cy())
    near = F.when(top <= bottom, top <= CAPTION_TOP).otherwise(bottom <= CAPTION_BOTTOM)
    named = normed(caption_words).join(codes.select("doc_id", "token").withColumn("is_code", F.lit(True)), ["doc_id", "token"], "left")
    plain = T.is_name_shape(F.col("text")) & T.is_latin(F.col("text")) & (F.length("token") <= 8)
    if alpha_vocab is not None:
        named = named.join(alpha_vocab.select("token", F.lit(True).alias("trade")), "token", "left")
        plain = plain & F.col("trade").isNull()
    window = (
        F.when(F.col("is_code"), "code")
        .when((G.height("r_") > CAPTION_PHOTO_HEIGHT) & ~near, F.when(plain, "excluded").otherwise("outside"))
        .otherwise("caption")
    )
    return named.join(r, [*PAGE_KEY, "sw_idx"]).select(*PAGE_KEY, "sw_idx", "word_no", "text", *fields.BOX, window.alias("window"))


def excluded_tokens(windows: DataFrame) -> DataFrame:
    """(doc_id, text, n, pages, page_no): the short names kept off photo captions, a lead for missed codes."""
    return windows.where("window = 'excluded'").groupBy("doc_id", "text").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.sort_array(F.collect_set("page_no")), lambda p: p.cast("string")), ",").alias("pages"), F.min("page_no").alias("page_no")
    )
