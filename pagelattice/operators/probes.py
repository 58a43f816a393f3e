"""Instruments that measure a rule before it changes: replays under other configurations, fates of code words, hub swatches,
medians, and columns of names that no anchor vouches for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import PRODUCTION, RuleConfig
from pagelattice.functions import geometry as G
from pagelattice.functions import tokens as T

from .detect import PAGE_KEY, normed

# Replay


@dataclass(frozen=True)
class Replay:
    """A configuration to replay: guards by name, each on or off, and whether raw colour names are witnesses."""

    name: str
    collapse: bool = True
    single_page: bool = True
    borderline: bool = True
    radius: bool = True
    raw_witnesses: bool = True


def replay(clustered: DataFrame, areas: DataFrame, runs: list[Replay], rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, cluster, n, pages, run, kept, reason, color): what each configuration makes of each cluster.

    Clusters are summed up once; the configurations are rows beside every cluster, not runs of their own.  A guard
    that is off lets its clusters pass to the next one.  areas is (doc_id, sw, area_pct)."""
    clean, raw = F.nullif("color", F.lit("")), F.nullif(F.coalesce("color_raw", "color"), F.lit(""))
    stats = clustered.join(areas.select("doc_id", "sw", "area_pct"), ["doc_id", "sw"], "left").groupBy("doc_id", "cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("page_no").alias("pages"),
        F.count_distinct(clean).alias("k"),
        F.count_distinct(raw).alias("k_raw"),
        F.max(clean).alias("one"),
        F.coalesce(F.max("area_pct"), F.lit(0.0)).alias("area_pct"),
    )
    fields = ("collapse", "single_page", "borderline", "radius", "raw_witnesses")
    configs = F.array(*(F.struct(F.lit(r.name).alias("run"), *(F.lit(getattr(r, f)).alias(f) for f in fields)) for r in runs))
    each = stats.withColumn("c", F.explode(configs))
    conflict = (F.col("k") > 1) | (F.col("c.raw_witnesses") & (F.col("k_raw") > 1))
    many, across = F.col("n") >= rules.collapse, F.col("pages") >= 2
    grey = across & conflict & (F.col("n") >= rules.borderline)
    reason = (
        F.when(F.col("c.collapse") & many & across & conflict, "assembly_collapse_suspect")
        .when(F.col("c.single_page") & many & ~across & (F.col("area_pct") >= rules.single_page_area), "singlepage_overmerge_suspect")
        .when(F.col("c.borderline") & ~many & grey, "borderline_merge_suspect")
        .when(F.col("c.radius") & across & ((F.col("pages") > rules.merge_pages) | (F.col("n") > rules.merge_bindings)), "assembly_merge_radius_suspect")
    )
    color = F.when((F.col("k") == 1) & ~conflict, F.col("one"))
    return each.select("doc_id", "cluster", "n", "pages", F.col("c.run").alias("run"), reason.isNull().alias("kept"), reason.alias("reason"), color.alias("color"))


def replay_changes(replayed: DataFrame, base: str) -> DataFrame:
    """(run, doc_id, cluster, change): how each run's variants differ from those of `base`: new, disappeared, cross_page_new,
    cross_page_gone or value (another colour).  A cluster's runs meet in one row of as many columns as there are runs."""
    was = F.max(F.when(F.col("run") == base, F.struct("kept", "color")))
    rows = replayed.groupBy("doc_id", "cluster", "pages").agg(was.alias("was"), F.collect_list(F.struct("run", "kept", "color")).alias("runs"))
    pairs = rows.select("doc_id", "cluster", "pages", "was", F.explode("runs").alias("now")).where(F.col("now.run") != base)
    before, after, wide = F.col("was.kept"), F.col("now.kept"), F.col("pages") > 1
    changes = F.array_compact(
        F.array(
            F.when(~before & after, "new"),
            F.when(before & ~after, "disappeared"),
            F.when(~before & after & wide, "cross_page_new"),
            F.when(before & ~after & wide, "cross_page_gone"),
            F.when(before & after & ~F.col("was.color").eqNullSafe(F.col("now.color")), "value"),
        )
    )
    return pairs.select(F.col("now.run").alias("run"), "doc_id", "cluster", F.explode(changes).alias("change"))


# Fates of code words


def code_word_fates(words: DataFrame, detected: DataFrame, bound: DataFrame, queued: DataFrame) -> DataFrame:
    """(page key, x, y, token, state, fates): what became of every code-shaped word, by its rounded position.

    state is undetected (not a code of its document), bound, queued:<reason>, both or lost; fates is the number of records
    of a detected word, and one is right.  Words at one position count once, by their first.  detected is (doc_id,
    token); bound and queued (page key, x0, y0[, reason]) are the positions that the output's members and queue give."""
    at = [*PAGE_KEY, "x", "y"]
    place = [F.bround("x0", 1).alias("x"), F.bround("y0", 1).alias("y")]
    shaped = normed(words).where(T.is_alnum_code(F.col("token")))
    first = shaped.select(*PAGE_KEY, *place, "word_no", "token").groupBy(*at).agg(F.min_by("token", "word_no").alias("token"))
    known = first.join(detected.select("doc_id", "token").distinct().withColumn("known", F.lit(True)), ["doc_id", "token"], "left")
    own = bound.select(*PAGE_KEY, *place).distinct().withColumn("own", F.lit(True))
    held = queued.select(*PAGE_KEY, *place, "reason").groupBy(*at).agg(F.min("reason").alias("reason"))
    met = known.join(own, at, "left").join(held, at, "left")
    fates = F.coalesce(F.col("own").cast("int"), F.lit(0)) + F.col("reason").isNotNull().cast("int")
    state = (
        F.when(F.col("known").isNull(), "undetected")
        .when(fates == 2, "both")
        .when(F.col("own"), "bound")
        .when(F.col("reason").isNotNull(), F.concat(F.lit("queued:"), F.col("reason")))
        .otherwise("lost")
    )
    return met.select(*at, "token", state.alias("state"), fates.cast("long").alias("fates"))


def fate_equations(fates: DataFrame) -> DataFrame:
    """(doc_id, words, detected, bound, queued, wrong, ok): detected words are bound or queued, each once."""
    counted = fates.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("words"),
        F.count_if(F.col("state") != "undetected").alias("detected"),
        F.count_if(F.col("state") == "bound").alias("bound"),
        F.count_if(F.col("state").startswith("queued:")).alias("queued"),
        F.count_if(F.col("state").isin("both", "lost")).alias("wrong"),
    )
    return counted.withColumn("ok", F.col("detected") == F.col("bound") + F.col("queued"))


# Hubs


def hub_swatches(clustered: DataFrame, areas: DataFrame, least: int = 2) -> DataFrame:
    """(doc_id, cluster, page_no, n, n_codes, n_swatches, conflict, hub_sw, hub_codes, hub_pct, max_pct) of the clusters on one
    page with `least` bindings or more.  The hub is the swatch with most distinct codes, the first one on a tie."""
    color, raw = F.nullif("color", F.lit("")), F.nullif(F.coalesce("color_raw", "color"), F.lit(""))
    stats = clustered.groupBy("doc_id", "cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("page_no").alias("page_no"),
        F.max("page_no").alias("last"),
        F.count_distinct("code").alias("n_codes"),
        ((F.count_distinct(color) > 1) | (F.count_distinct(raw) > 1)).alias("conflict"),
    )
    swatches = clustered.groupBy("doc_id", "cluster", "sw").agg(F.count_distinct("code").alias("codes")).join(areas.select("doc_id", "sw", "area_pct"), ["doc_id", "sw"], "left")
    hub = F.max(F.struct("codes", (-F.col("sw")).alias("first"), "area_pct"))
    per = swatches.groupBy("doc_id", "cluster").agg(F.count(F.lit(1)).alias("n_swatches"), hub.alias("hub"), F.max("area_pct").alias("max_pct"))
    one_page = stats.where((F.col("page_no") == F.col("last")) & (F.col("n") >= least)).drop("last")
    return one_page.join(per, ["doc_id", "cluster"]).select(
        "doc_id", "cluster", "page_no", "n", "n_codes", "n_swatches", "conflict", (-F.col("hub.first")).alias("hub_sw"), F.col("hub.codes").alias("hub_codes"), F.col("hub.area_pct").alias("hub_pct"), "max_pct"
    )


def separation(hubs: DataFrame, value: str = "max_pct", step: float = 0.1) -> DataFrame:
    """(low, high, gap, agree_below, conflict_above, split): the widest gap between neighbouring values over all clusters (the
    lowest on a tie), how many clusters agree at or below it and conflict above it, and whether it parts the two.

    Values are cut into bands of `step`: neighbours within a band are found band by band, and between bands from
    their least and largest values, at most as many rows as there are bands up to 100 percent."""
    banded = hubs.select(F.col(value).alias("v"), "conflict").where("v is not null").withColumn("band", F.floor(F.col("v") / step))
    inside = banded.select("band", "v").distinct().withColumn("high", F.lead("v").over(Window.partitionBy("band").orderBy("v"))).where("high is not null")
    bands = banded.groupBy("band").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    between = bands.select(F.col("hi").alias("v"), F.lead("lo").over(Window.orderBy("band")).alias("high")).where("high is not null")
    gaps = inside.select("v", "high").unionByName(between)
    best = gaps.agg(F.max(F.struct((F.col("high") - F.col("v")).alias("gap"), (-F.col("v")).alias("first"), "high")).alias("g")).where("g is not null")
    best = best.select((-F.col("g.first")).alias("low"), "g.high", "g.gap")
    judged = banded.select("v", "conflict", F.lit(1).alias("k")).join(F.broadcast(best.withColumn("k", F.lit(1))), "k")  # one row
    below = F.col("v") <= F.col("low")
    counts = judged.groupBy("low", "high", "gap").agg(
        F.count_if(below & ~F.col("conflict")).alias("agree_below"),
        F.count_if(~below & F.col("conflict")).alias("conflict_above"),
        (F.count_if((below & F.col("conflict")) | (~below & ~F.col("conflict"))) == 0).alias("split"),
    )
    return counts


# Medians


def median_probe(swatches: DataFrame, pages: DataFrame, aligned: DataFrame, rules: RuleConfig = PRODUCTION, large: float = 0.10) -> DataFrame:
    """(doc_id, n_sw, n_large, median_all, median_small, median_page, small_all, small_small, small_page, repeated_all, codes_all,
    codes_small, codes_page, rescued): icons under three medians of a document's swatch areas, in one pass over swatches.

    The medians are of all swatches, of those below `large` of their page (of all where there are none), and of the pages'
    own medians.  small_* count swatches below the icon share of each, repeated_all those that only their repeated place
    makes icons; codes_* count aligned code words (page key, sw_idx) that each would demote, rescued those that
    the first demotes and the second does not."""
    n_pages = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_spec"))
    words = aligned.groupBy(*PAGE_KEY, "sw_idx").agg(F.count(F.lit(1)).alias("words"))
    sized = swatches.join(pages, PAGE_KEY).join(n_pages, "doc_id").join(words, [*PAGE_KEY, "sw_idx"], "left").na.fill(0, ["words"])
    sized = sized.withColumns({"area": G.area(), "key": G.key20(), "big": G.area() >= large * F.col("width") * F.col("height")})
    page = Window.partitionBy(*PAGE_KEY)
    sized = sized.withColumn("page_median", F.when(F.row_number().over(page.orderBy("sw_idx")) == 1, F.median("area").over(page)))
    place = Window.partitionBy("doc_id", "key")
    need = F.greatest(F.lit(float(rules.repeat_floor)), rules.repeat_pages * F.col("n_spec"))
    sized = sized.withColumn("repeated", F.count(F.lit(1)).over(place) >= need)
    medians = sized.groupBy("doc_id").agg(
        F.median("area").alias("median_all"), F.coalesce(F.median(F.when(~F.col("big"), F.col("area"))), F.median("area")).alias("median_small"), F.median("page_median").alias("median_page")
    )
    met = sized.select("doc_id", "area", "big", "repeated", "words").join(medians, "doc_id")
    names = ("all", "small", "page")
    tiny = {n: F.col("area") < rules.icon_small * F.col(f"median_{n}") for n in names}
    icon = {n: G.icon_suspect(F.col("area"), F.col(f"median_{n}"), F.col("repeated"), rules.icon_small, rules.icon_repeated) for n in names}
    coded = lambda test: F.sum(F.when(test, F.col("words")).otherwise(0)).cast("long")
    return met.groupBy("doc_id", *(f"median_{n}" for n in names)).agg(
        F.count(F.lit(1)).alias("n_sw"),
        F.count_if("big").alias("n_large"),
        *(F.count_if(tiny[n]).alias(f"small_{n}") for n in names),
        F.count_if(icon["all"] & ~tiny["all"]).alias("repeated_all"),
        *(coded(icon[n]).alias(f"codes_{n}") for n in names),
        coded(icon["all"] & ~icon["small"]).alias("rescued"),
    )


# Columns without anchors


def unanchored_columns(
    words: DataFrame, pages: DataFrame, kept: DataFrame, anchors: DataFrame, alpha_vocab: DataFrame | None = None, rules: RuleConfig = PRODUCTION, least: int = 2
) -> DataFrame:
    """(page key, word_no, token, verdict): every alphabetic word that could be a code, and why it is flagged or not.

    kept (already a code), anchored (an alphanumeric code in its column), few (fewer than `least` in the column), row (flagged:
    a size on its row), size or member (flagged: going up its column, a size or a word with a size on its row comes within a
    multiple of the column's median gap), no_gap (a column of one height), break (a gap too wide first) or top (nothing found).
    A column is what begins within a share of the page's width; kept and anchors are (doc_id, token)."""
    on_page = normed(words).join(pages, PAGE_KEY).withColumns({"cx": G.cx(), "cy": G.cy(), "h": F.greatest(G.height(), F.lit(1.0))})
    on_page = on_page.withColumn("left", G.side(F.col("cx"), G.fold(F.col("width"), F.col("height"), rules.fold_ratio)))
    size = F.col("text").rlike(T.SIZE)
    sizes = on_page.where(size).select(*PAGE_KEY, F.col("x0").alias("m_x"), F.col("cy").alias("m_y"), F.col("left").alias("m_left"))
    alpha = on_page.where(T.is_alpha(F.col("token")) & T.is_code_shape(F.col("token")) & ~T.is_lower(F.col("text")))
    if alpha_vocab is not None:
        alpha = alpha.join(alpha_vocab.select("token"), "token", "left_anti")
    key = [*PAGE_KEY, "word_no"]
    near_size = F.abs(F.col("m_y") - F.col("cy")) <= rules.row_height * F.col("h")
    in_row = alpha.join(sizes, PAGE_KEY).where(F.col("m_left").eqNullSafe(F.col("left")) & near_size).select(*key).distinct().withColumn("in_row", F.lit(True))
    alpha = alpha.join(in_row, key, "left").withColumn("in_row", F.coalesce("in_row", F.lit(False)))
    tagged = lambda df, kind: df.select(*PAGE_KEY, F.col("x0").alias("m_x"), F.col("cy").alias("m_y"), kind.alias("kind"))
    columns = tagged(alpha, F.when(F.col("in_row"), 1).otherwise(0)).unionByName(sizes.select(*PAGE_KEY, "m_x", "m_y", F.lit(2).alias("kind")))
    of_anchor = on_page.join(anchors.select("doc_id", "token"), ["doc_id", "token"], "left_semi")
    columns = columns.unionByName(tagged(of_anchor, F.lit(3)))
    same = F.abs(F.col("m_x") - F.col("x0")) <= rules.column_tolerance * F.col("width")
    own = alpha.select(*key, "token", "x0", "cy", "width", "in_row").join(columns, PAGE_KEY).where(same)
    member = F.when(F.col("kind") < 3, F.struct(F.col("m_y").alias("y"), F.col("kind").alias("kind")))
    met = own.groupBy(*key, "token", "cy", "in_row").agg(
        F.bool_or(F.col("kind") == 3).alias("anchored"), F.count_if(F.col("kind") < 2).alias("k"), F.sort_array(F.collect_set(member)).alias("members")
    )
    met = met.join(kept.select("doc_id", "token", F.lit(True).alias("kept")).distinct(), ["doc_id", "token"], "left")
    return met.select(*key, "token", _column_verdict(least, rules.run_gap).alias("verdict"))


def _column_verdict(least: int, run_gap: float) -> Column:
    """The verdict from a word's column: members (y, kind) in order, kind 0 a word, 1 one with a size on its row, 2 a size."""
    members = F.col("members")
    steps = F.filter(F.zip_with(F.slice(members, 2, F.greatest(F.size(members) - 1, F.lit(0))), members, lambda b, a: b["y"] - a["y"]), lambda g: g > 0)
    ordered = F.sort_array(steps)
    gap = F.get(ordered, F.floor(F.size(ordered) / 2).cast("int"))
    above = F.reverse(F.filter(members, lambda m: m["y"] < F.col("cy") - 1e-6))
    start = F.struct(F.col("cy").alias("at"), F.lit("").alias("end"))

    def up(state: Column, m: Column) -> Column:
        found = (
            F.when(state["end"] != "", state["end"])
            .when(state["at"] - m["y"] > run_gap * gap, "break")
            .when(m["kind"] == 2, "size")
            .when(m["kind"] == 1, "member")
            .otherwise("")
        )
        return F.struct(m["y"].alias("at"), found.alias("end"))

    walked = F.aggregate(above, start, up)["end"]
    return (
        F.when(F.col("kept"), "kept")
        .when(F.col("anchored"), "anchored")
        .when(F.col("k") < least, "few")
        .when(F.col("in_row"), "row")
        .when(gap.isNull(), "no_gap")
        .otherwise(F.when(walked == "", "top").otherwise(walked))
    )
