"""Code detection: vocabularies, junk routing, digit codes, alphabetic codes, regrouping, suspects.

Results are token tables keyed by doc_id; vocabularies are one-column tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import PRODUCTION, RuleConfig
from pagelattice.functions import geometry as G
from pagelattice.functions import tokens as T

from .components import materialize

PAGE_KEY = ["doc_id", "page_no"]
_PLACE = [*PAGE_KEY, "word_no", "x0", "y0", "x1", "y1"]


def normed(words: DataFrame) -> DataFrame:
    return words.withColumn("token", T.norm(F.col("text")))


def document_frequency(words: DataFrame) -> DataFrame:
    """(token, kind, n_docs): documents holding each alphanumeric code and each alphabetic token."""
    kind = F.when(T.is_code_shape(F.col("token")) & F.col("token").rlike("[0-9]") & F.col("token").rlike(r"\p{L}"), "code").when(
        T.is_alpha(F.col("token")), "alpha"
    )
    marked = normed(words).select("doc_id", "token", kind.alias("kind")).where("kind is not null").distinct()
    return marked.groupBy("token", "kind").agg(F.count(F.lit(1)).alias("n_docs"))


def vocabulary(words: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(token, kind) of tokens frequent enough over the vocabulary corpus to be trade words."""
    least = F.when(F.col("kind") == "code", rules.code_documents).otherwise(rules.alpha_documents)
    return document_frequency(words).where(F.col("n_docs") >= least).select("token", "kind")


def candidates(words: DataFrame, code_vocab: DataFrame | None = None) -> DataFrame:
    """(doc_id, token, n) of alphanumeric candidates; the vocabulary is taken out by an anti-join."""
    found = normed(words).where(T.is_alnum_code(F.col("token"))).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))
    return found if code_vocab is None else found.join(code_vocab.select("token"), "token", "left_anti").select("doc_id", "token", "n")


def route_junk(found: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, token, n, bucket): bucket is kept, or the kind of junk.  The band family is counted per document and letter."""
    letter = F.when(F.col("token").rlike(T.BAND), F.substring("token", 1, 1))
    family = F.count("letter").over(Window.partitionBy("doc_id", "letter"))
    kind = T.junk_kind(F.col("token"), F.col("family"), rules.band_family)
    return (
        found.withColumn("letter", letter)
        .withColumn("family", family)
        .select("doc_id", "token", "n", F.coalesce(kind, F.lit("kept")).alias("bucket"))
    )


def digit_codes(words: DataFrame, found: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, token): pure digit tokens of the most frequent length, in documents with few alphanumeric
    candidates.  Equal lengths are settled by the token met first in document order."""
    digits = (
        normed(words)
        .where(F.col("token").rlike("^[0-9]+$") & F.length("token").isin(*rules.digit_lengths))
        .groupBy("doc_id", "token")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("page_no", "word_no")).alias("first"))
        .where("n >= 2")
        .withColumn("len", F.length("token"))
    )
    lengths = digits.groupBy("doc_id", "len").agg(F.count(F.lit(1)).alias("k"), F.min("first").alias("first"))
    ahead = Window.partitionBy("doc_id").orderBy(F.desc("k"), "first")
    best = lengths.withColumn("r", F.row_number().over(ahead)).where((F.col("r") == 1) & (F.col("k") >= rules.digit_tokens))
    n_spec = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_spec"))
    n_found = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_found"))
    sparse = n_spec.join(n_found, "doc_id", "left").where(
        F.coalesce("n_found", F.lit(0)) < rules.digit_share * F.greatest("n_spec", F.lit(1))
    )
    return (
        digits.join(best.select("doc_id", "len"), ["doc_id", "len"]).join(sparse.select("doc_id"), "doc_id", "left_semi").select("doc_id", "token")
    )


def column_members(words: DataFrame, anchors: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """Words of alphabetic code shape that stand in a column with an anchor word of their page:
    (doc_id, page_no, word_no, token).  anchors is (doc_id, token)."""
    named = normed(words)
    anchor_words = named.join(anchors.select("doc_id", "token"), ["doc_id", "token"], "left_semi")
    return _in_columns(named, anchor_words, pages, rules).select(*PAGE_KEY, "word_no", "token").distinct()


def _in_columns(named: DataFrame, anchor_words: DataFrame, pages: DataFrame, rules: RuleConfig) -> DataFrame:
    """column_members with their places, some more than once."""
    a = anchor_words.select(*PAGE_KEY, F.col("x0").alias("a_x0"))
    # candidates meet anchors in steps of the tolerance: an equi-join on the step and its neighbours
    tolerance = pages.select(*PAGE_KEY, (F.col("width") * rules.column_tolerance).alias("tol"))
    a = a.join(tolerance, PAGE_KEY).withColumn("step", F.floor(F.col("a_x0") / F.col("tol"))).select(*PAGE_KEY, "a_x0", "step").distinct()
    c = (
        named.where(T.is_alpha(F.col("token")) & T.is_code_shape(F.col("token")) & ~T.is_lower(F.col("text")))
        .join(tolerance, PAGE_KEY)
        .withColumn("at", F.floor(F.col("x0") / F.col("tol")))
        .withColumn("step", F.explode(F.array(F.col("at") - 1, F.col("at"), F.col("at") + 1)))
    )
    return (
        c.join(a, [*PAGE_KEY, "step"])
        .where(F.abs(F.col("x0") - F.col("a_x0")) <= F.col("tol"))
        .select(*_PLACE, "token")
    )


def page_sizes(words: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, page_no, s_no, s_x0, s_y0, s_x1, s_y1, size) of words that hold a size."""
    return (
        words.withColumn("size", T.size_of(F.col("text"), rules.version))
        .where("size is not null")
        .select(*PAGE_KEY, F.col("word_no").alias("s_no"), *(F.col(k).alias(f"s_{k}") for k in ("x0", "y0", "x1", "y1")), "size")
    )


def in_row_with_size(words: DataFrame, sizes: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, page_no, word_no) of words with a size on their row and side of the fold."""
    folded = pages.select(*PAGE_KEY, G.fold(F.col("width"), F.col("height"), rules.fold_ratio).alias("fold"))
    w = words.select(*PAGE_KEY, "word_no", *(F.col(k).alias(f"w_{k}") for k in ("x0", "y0", "x1", "y1"))).join(folded, PAGE_KEY)
    near = G.same_row("w_", "s_", rules.row_height) & G.side(G.cx("w_"), F.col("fold")).eqNullSafe(G.side(G.cx("s_"), F.col("fold")))
    return w.join(sizes, PAGE_KEY).where(near).select(*PAGE_KEY, "word_no").distinct()


def inherited_sizes(members: DataFrame, with_size: DataFrame, words: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, page_no, word_no) of column members without a size on their row that reach, going up their own
    column through gaps of at most run_gap times its median gap, a member with one."""
    key = [*PAGE_KEY, "word_no"]
    placed = (
        words.select(*key, "x0", G.cy().alias("cy"))
        .join(members.select(*key).distinct(), key, "left_semi")
        .join(with_size.select(*key).withColumn("has", F.lit(True)), key, "left")
        .withColumn("has", F.coalesce("has", F.lit(False)))
        .join(pages.select(*PAGE_KEY, (F.col("width") * rules.column_tolerance).alias("tol")), PAGE_KEY)
    )
    p = placed.where("not has").select(*PAGE_KEY, F.col("word_no").alias("p_no"), F.col("x0").alias("p_x0"), F.col("cy").alias("p_cy"), "tol")
    column = p.join(placed.drop("tol"), PAGE_KEY).where(F.abs(F.col("x0") - F.col("p_x0")) <= F.col("tol"))
    down = Window.partitionBy(*PAGE_KEY, "p_no").orderBy(F.col("cy").desc(), "word_no")
    whole = Window.partitionBy(*PAGE_KEY, "p_no")
    up = Window.partitionBy(*PAGE_KEY, "p_no").orderBy("cy", "word_no")
    gap = F.col("cy") - F.lag("cy").over(up)
    gapped = column.withColumn("gap", F.when(gap > 0, gap))
    values = F.sort_array(F.collect_list("gap").over(whole))
    median = F.get(values, F.floor(F.size(values) / 2).cast("int"))
    above = (
        gapped.withColumn("median", median)
        .where(F.col("cy") < F.col("p_cy") - 1e-6)
        .withColumn("leap", F.coalesce(F.lag("cy").over(down), F.col("p_cy")) - F.col("cy"))
        .withColumn(
            "broken",
            F.max((F.col("leap") > rules.run_gap * F.col("median")).cast("int")).over(down.rowsBetween(Window.unboundedPreceding, 0)),
        )
    )
    return (
        above.where("broken = 0")
        .groupBy(*PAGE_KEY, "p_no")
        .agg(F.bool_or("has").alias("ok"))
        .where("ok")
        .select(*PAGE_KEY, F.col("p_no").alias("word_no"))
    )


def alpha_codes(
    words: DataFrame, anchors: DataFrame, pages: DataFrame, alpha_vocab: DataFrame | None = None, rules: RuleConfig = PRODUCTION
) -> DataFrame:
    """(doc_id, token): alphabetic codes vouched for by a column of alphanumeric ones and by sizes on their rows."""
    key = [*PAGE_KEY, "word_no"]
    # anchor words, members and who of them has a size are each read several times: all words are gone through once for each,
    # and sizes on a row are sought for these words alone
    named = normed(words)
    anchor_words = materialize(named.join(anchors.select("doc_id", "token"), ["doc_id", "token"], "left_semi").select(*_PLACE, "token"), "anchor-words")
    members = _in_columns(named, anchor_words, pages, rules).distinct()
    if alpha_vocab is not None:
        members = members.join(alpha_vocab.select("token"), "token", "left_anti").select(*_PLACE, "token")
    members = materialize(members, "column-members")
    both = members.select(*_PLACE).unionByName(anchor_words.select(*_PLACE)).distinct()
    sized = materialize(in_row_with_size(both, page_sizes(words, rules), pages, rules), "sized-words")
    vouched = members.join(sized, key, "left_semi").select("doc_id", "token")
    if rules.at(12):
        heirs = inherited_sizes(both, sized, both, pages, rules)
        vouched = vouched.unionByName(members.join(heirs, key, "left_semi").select("doc_id", "token"))
    effective = anchor_words.join(sized, key, "left_semi").select("doc_id", "token").distinct().withColumn("len", F.length("token"))
    by_length = effective.groupBy("doc_id", "len").agg(F.count(F.lit(1)).alias("k"))
    ranked = by_length.withColumn("r", F.rank().over(Window.partitionBy("doc_id").orderBy(F.desc("k")))).withColumn(
        "share", F.col("k") / F.sum("k").over(Window.partitionBy("doc_id"))
    )
    modal = ranked.where((F.col("r") == 1) & (F.col("share") >= rules.dominance)).select("doc_id", "len")
    rows = size_rows(words, pages, rules).where(F.col("n_rows") >= rules.size_rows).select("doc_id")
    mid = anchor_words.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n")).groupBy("doc_id").agg(G.upper_median(F.col("n")).alias("mid"))
    n_pages = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"))
    cap = F.greatest(
        (rules.occurrence_factor * F.col("mid")).cast("double"),
        F.least(rules.occurrence_pages * F.col("n_pages"), F.lit(float(rules.occurrence_cap))),
    )
    vouched = vouched.distinct().withColumn("len", F.length("token")).join(modal, ["doc_id", "len"], "left_semi").join(rows, "doc_id", "left_semi")
    vouched = materialize(vouched.select("doc_id", "token"), "vouched")
    counts = named.join(vouched, ["doc_id", "token"], "left_semi").groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))
    return (
        counts
        .join(mid, "doc_id")
        .join(n_pages, "doc_id")
        .where(F.col("n") <= cap)
        .select("doc_id", "token")
    )


def effective_anchors(words: DataFrame, anchors: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, token): anchors with a size on the row of an occurrence."""
    own = normed(words).join(anchors.select("doc_id", "token"), ["doc_id", "token"], "left_semi")
    return own.join(in_row_with_size(words, page_sizes(words, rules), pages, rules), [*PAGE_KEY, "word_no"], "left_semi").select("doc_id", "token").distinct()


def dominance_suspects(codes: DataFrame, effective: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, token): alphabetic codes of documents in which no length holds dominance_margin of the effective anchors."""
    lengths = effective.groupBy("doc_id", F.length("token").alias("len")).agg(F.count(F.lit(1)).alias("k"))
    loose = lengths.groupBy("doc_id").agg(F.max("k").alias("most"), F.sum("k").alias("all")).where(F.col("most") / F.col("all") < rules.dominance_margin)
    return codes.where(T.is_alpha(F.col("token"))).join(loose, "doc_id", "left_semi").select("doc_id", "token")


def detection_gap(words: DataFrame, detected: DataFrame, swatches: DataFrame, alpha_vocab: DataFrame | None = None) -> DataFrame:
    """(doc_id, detected, long_missed, alpha_missed, table_pages): detected codes, and what detection may have missed: tokens of
    9 to 14 letters and digits that occur twice, and words of 4 to 6 capitals that occur twice and stand on a page with
    three detected words; table_pages are pages of size texts with five detected words and two swatches at most."""
    named = normed(words).join(detected.select("doc_id", "token", F.lit(True).alias("known")).distinct(), ["doc_id", "token"], "left")
    per_page = named.groupBy(*PAGE_KEY).agg(F.count("known").alias("k"), F.sum(T.size_hits(F.col("text"))).alias("hits"))
    long_ = F.col("token").rlike("^[A-Za-z0-9]{9,14}$") & F.col("token").rlike("[0-9]") & F.col("token").rlike(r"\p{L}") & T.size_of(F.col("token"), 3).isNull()
    alpha = F.col("token").rlike("^[A-Z]{4,6}$")
    if alpha_vocab is not None:
        named = named.join(alpha_vocab.select("token", F.lit(True).alias("trade")).distinct(), "token", "left")
        alpha = alpha & F.col("trade").isNull()
    kind = F.when(long_, "long").when(alpha, "alpha")
    marked = named.withColumn("kind", kind).where("kind is not null").join(per_page.select(*PAGE_KEY, "k"), PAGE_KEY)
    tokens = marked.groupBy("doc_id", "token", "kind").agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k")).where("n >= 2 and (kind = 'long' or k >= 3)")
    missed = tokens.groupBy("doc_id").agg(F.count_if(F.col("kind") == "long").alias("long_missed"), F.count_if(F.col("kind") == "alpha").alias("alpha_missed"))
    n_sw = swatches.groupBy(*PAGE_KEY).agg(F.count(F.lit(1)).alias("n_sw"))
    tables = per_page.join(n_sw, PAGE_KEY, "left").where("hits >= 3 and k >= 5 and coalesce(n_sw, 0) <= 2").groupBy("doc_id").agg(F.count(F.lit(1)).alias("table_pages"))
    out = detected.groupBy("doc_id").agg(F.count_distinct("token").alias("detected"))
    return out.join(missed, "doc_id", "left").join(tables, "doc_id", "left").na.fill(0)


def size_rows(words: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, n_rows): rows that hold a size, counted per page and side; a row ends at a gap of 1.5 word heights."""
    folded = pages.select(*PAGE_KEY, G.fold(F.col("width"), F.col("height"), rules.fold_ratio).alias("fold"))
    tall = words.groupBy(*PAGE_KEY).agg(G.upper_median(G.height()).alias("h"))
    placed = (
        page_sizes(words, rules)
        .join(folded, PAGE_KEY)
        .join(tall, PAGE_KEY)
        .select(*PAGE_KEY, G.side(G.cx("s_"), F.col("fold")).alias("side"), G.cy("s_").alias("cy"), "s_no", "h")
    )
    order = Window.partitionBy(*PAGE_KEY, "side").orderBy("cy", "s_no")
    new = F.coalesce((F.col("cy") - F.lag("cy").over(order) > rules.row_height * F.col("h")).cast("long"), F.lit(1))
    return placed.select("doc_id", new.alias("new")).groupBy("doc_id").agg(F.sum("new").alias("n_rows"))


def regroup_bands(words: DataFrame, routed: DataFrame, pages: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, token): kept tokens that belong with the routed bands: their first letter is a band's, and they
    stand in a column with a band word or occur regroup_rows times on one row."""
    bands = routed.where("bucket = 'band'").select("doc_id", "token")
    letters = bands.select("doc_id", F.substring("token", 1, 1).alias("letter")).distinct()
    suspects = routed.where("bucket = 'kept'").select("doc_id", "token", F.substring("token", 1, 1).alias("letter"))
    suspects = suspects.join(letters, ["doc_id", "letter"], "left_semi").select("doc_id", "token")
    folded = pages.select(
        *PAGE_KEY, G.fold(F.col("width"), F.col("height"), rules.fold_ratio).alias("fold"), (F.col("width") * rules.column_tolerance).alias("tol")
    )
    tall = words.groupBy(*PAGE_KEY).agg(G.upper_median(G.height()).alias("h"))
    named = normed(words).select(*_PLACE, "token")
    own = named.join(suspects, ["doc_id", "token"], "left_semi").join(folded, PAGE_KEY).join(tall, PAGE_KEY)
    own = materialize(own, "band-suspects")
    b = named.join(bands, ["doc_id", "token"], "left_semi").select(*PAGE_KEY, F.col("x0").alias("b_x0"))
    aligned = own.join(b, PAGE_KEY).where(F.abs(F.col("x0") - F.col("b_x0")) <= F.col("tol")).select("doc_id", "token")
    row = F.bround(G.cy() / (rules.row_height * F.col("h")), 0)
    crowded = (
        own.groupBy(*PAGE_KEY, "token", G.side(G.cx(), F.col("fold")).alias("side"), row.alias("row"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= rules.regroup_rows)
        .select("doc_id", "token")
    )
    return aligned.unionByName(crowded).distinct()


def detect_codes(
    words: DataFrame,
    pages: DataFrame,
    code_vocab: DataFrame | None = None,
    alpha_vocab: DataFrame | None = None,
    rules: RuleConfig = PRODUCTION,
) -> DataFrame:
    """(doc_id, token, bucket): kept codes and routed junk of each document, with the branches of the version."""
    found = candidates(words, code_vocab)
    if not rules.at(5):
        routed = found.select("doc_id", "token", F.lit("kept").alias("bucket"))
    else:
        routed = route_junk(found, rules).select("doc_id", "token", "bucket")
    found = routed = materialize(routed, "routed")  # one row a candidate, read by every branch
    anchors = routed.where("bucket = 'kept'").select("doc_id", "token")
    kept = digit_codes(words, found, pages, rules)
    if rules.at(8):
        kept = kept.unionByName(alpha_codes(words, anchors, pages, alpha_vocab, rules))
    out = routed.unionByName(kept.withColumn("bucket", F.lit("kept"))).distinct()
    if rules.at(10):
        moved = regroup_bands(words, routed, pages, rules).withColumn("moved", F.lit(True))
        bucket = F.when(F.col("moved") & (F.col("bucket") == "kept"), "band").otherwise(F.col("bucket"))
        out = out.join(moved, ["doc_id", "token"], "left").select("doc_id", "token", bucket.alias("bucket")).distinct()
    return out


def file_name_suspects(codes: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, token): codes that are part of their document's own file name (upper-case letters and digits)."""
    clean = names.select("doc_id", F.regexp_replace(F.upper("file_name"), "[^A-Z0-9]", "").alias("clean"))
    return codes.join(clean, "doc_id").where(F.contains("clean", "token")).select("doc_id", "token")


def cap_suspects(
    codes: DataFrame, words: DataFrame, pages: DataFrame, anchors: DataFrame, alpha_vocab: DataFrame | None = None, rules: RuleConfig = PRODUCTION
) -> DataFrame:
    """(doc_id, token): alphabetic codes whose occurrences reach their cap, a multiple of the upper median over the document's
    effective anchors.  A document without an effective anchor has no cap; trade words are left out of the count."""
    counts = normed(words).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))
    effective = effective_anchors(words, anchors, pages, rules)
    mid = effective.join(counts, ["doc_id", "token"]).groupBy("doc_id").agg(G.upper_median(F.col("n")).alias("mid"))
    n_pages = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"))
    cap = F.greatest(
        (rules.occurrence_factor * F.col("mid")).cast("double"), F.least(rules.occurrence_pages * F.col("n_pages"), F.lit(float(rules.occurrence_cap)))
    )
    own = codes.where(T.is_alpha(F.col("token"))).join(counts, ["doc_id", "token"])
    if alpha_vocab is not None:
        own = own.join(alpha_vocab.select("token"), "token", "left_anti")
    return own.join(mid, "doc_id").join(n_pages, "doc_id").where(F.col("n") >= cap).select("doc_id", "token")
