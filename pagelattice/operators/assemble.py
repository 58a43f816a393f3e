"""Assembly of bindings into product variants.

Bindings are (doc_id, id, page_no, sw, code, color, color_raw): sw names a swatch instance within
the document, ids are unique within it.  Merge keys are the swatch instance and the code;
colour and position never are.  Every binding ends in exactly one variant or in the queue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import PRODUCTION, RuleConfig

from .components import checkpoint, connected_components, fresh


def bridge_codes(bindings: DataFrame, band_letters: DataFrame) -> DataFrame:
    """(doc_id, code): codes with a band's first letter on two or more swatches, two of which hold other codes too,
    while some pair of its swatches shares nothing but this code."""
    placed = bindings.select("doc_id", "sw", "code").distinct()
    held = placed.groupBy("doc_id", "sw").agg(F.sort_array(F.collect_set("code")).alias("codes"))
    own = (
        placed.withColumn("letter", F.substring("code", 1, 1))
        .join(band_letters.select("doc_id", "letter").distinct(), ["doc_id", "letter"], "left_semi")
        .join(held, ["doc_id", "sw"])
    )
    enough = (
        own.groupBy("doc_id", "code")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("codes") > 1).alias("shared"))
        .where("n >= 2 and shared >= 2")
        .select("doc_id", "code")
    )
    a = own.join(enough, ["doc_id", "code"], "left_semi").select("doc_id", "code", F.col("sw").alias("sa"), F.col("codes").alias("ca"))
    b = a.select("doc_id", "code", F.col("sa").alias("sb"), F.col("ca").alias("cb"))
    return (
        a.join(b, ["doc_id", "code"])
        .where((F.col("sa") < F.col("sb")) & (F.size(F.array_intersect("ca", "cb")) == 1))
        .select("doc_id", "code")
        .distinct()
    )


def clusters(bindings: DataFrame) -> DataFrame:
    """bindings with `cluster`: the least binding id reachable over shared swatches and codes of the document.
    The result is computed once and kept (checkpoint): what follows reads it many times."""
    # nodes are numbers that are written with the bindings: the least of numbers is found in a hash table, that of ids by a sort
    no = fresh(bindings, "node")
    numbered = checkpoint(bindings.withColumn(no, F.monotonically_increasing_id()))
    edges = None
    for key in ("sw", "code"):
        least = numbered.groupBy("doc_id", key).agg(F.min(no).alias("to"))
        found = numbered.select("doc_id", key, no).join(least, ["doc_id", key]).select(F.col(no).alias("a"), F.col("to").alias("b"))
        edges = found if edges is None else edges.unionByName(found)
    roots = checkpoint(numbered.select(no, "id").join(connected_components(edges, "a", "b").withColumnRenamed("node", no), no))
    named = roots.groupBy("root").agg(F.min("id").alias("cluster"))
    placed = roots.join(named, "root").select(no, "cluster")
    return checkpoint(numbered.join(placed, no, "left").withColumn("cluster", F.coalesce("cluster", "id")).select(*bindings.columns, "cluster"))


def guard_reasons(clustered: DataFrame, swatch_areas: DataFrame | None = None, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, cluster, n, pages, conflict, area_pct, reason): why a cluster may not be merged, or null.
    swatch_areas is (doc_id, sw, area_pct); without it the single-page guard never fires."""
    joined = clustered
    if swatch_areas is not None:
        joined = joined.join(swatch_areas.select("doc_id", "sw", "area_pct"), ["doc_id", "sw"], "left")
    else:
        joined = joined.withColumn("area_pct", F.lit(0.0))
    color, raw = F.nullif("color", F.lit("")), F.nullif(F.coalesce("color_raw", "color"), F.lit(""))
    stats = joined.groupBy("doc_id", "cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("page_no").alias("pages"),
        ((F.count_distinct(color) > 1) | (F.count_distinct(raw) > 1)).alias("conflict"),
        F.coalesce(F.max("area_pct"), F.lit(0.0)).alias("area_pct"),
    )
    many, across = F.col("n") >= rules.collapse, F.col("pages") >= 2
    reason = (
        F.when(many & across & F.col("conflict"), "assembly_collapse_suspect")
        .when(many & (F.col("pages") == 1) & (F.col("area_pct") >= rules.single_page_area), "singlepage_overmerge_suspect")
        .when(~many & across & F.col("conflict") & (F.col("n") >= rules.borderline), "borderline_merge_suspect")
        .when(across & ((F.col("pages") > rules.merge_pages) | (F.col("n") > rules.merge_bindings)), "assembly_merge_radius_suspect")
    )
    return stats.withColumn("reason", reason)


def variant_sizes(clustered: DataFrame, spec_rows: DataFrame) -> DataFrame:
    """(doc_id, cluster, size, order_code, price_band, surface, claims): the sizes of each surviving cluster.

    spec_rows is (doc_id, id, code, size, surface, price_band).  A cluster of one code with two or more known
    sizes lists them under that code (regime B, order_code null); otherwise each (size, code) stands for itself
    (regime A).  Rows without a size go with the code's first known size.  Fields are the one value that all
    claimed rows agree on, or null."""
    codes = clustered.select("doc_id", "cluster", "code").distinct()
    rows = codes.join(spec_rows, ["doc_id", "code"])
    known = Window.partitionBy("doc_id", "cluster", "code")
    rows = rows.withColumn("first_size", F.min("size").over(known)).withColumn("size", F.coalesce("size", "first_size"))
    modes = regimes(clustered, spec_rows).select("doc_id", "cluster", "regime")

    def one(c: str):
        v = F.nullif(c, F.lit(""))
        return F.when(F.count_distinct(v) == 1, F.max(v))

    return (
        rows.join(modes, ["doc_id", "cluster"])
        .withColumn("order_code", F.when(F.col("regime") == "A", F.col("code")))
        .groupBy("doc_id", "cluster", "size", "order_code")
        .agg(one("surface").alias("surface"), one("price_band").alias("price_band"), F.count(F.lit(1)).alias("claims"))
    )


def rows_by_code(clustered: DataFrame, spec_rows: DataFrame) -> DataFrame:
    """(doc_id, cluster, code, n, sizes, unsized): the spec rows that each code of a cluster can claim, by code."""
    codes = clustered.select("doc_id", "cluster", "code").distinct()
    return codes.join(spec_rows, ["doc_id", "code"]).groupBy("doc_id", "cluster", "code").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("size").alias("sizes"), F.count_if(F.col("size").isNull()).alias("unsized")
    )


def regimes(clustered: DataFrame, spec_rows: DataFrame) -> DataFrame:
    """(doc_id, cluster, n_codes, most_sizes, regime, regime_conflict)."""
    codes = clustered.select("doc_id", "cluster", "code").distinct()
    sizes = spec_rows.groupBy("doc_id", "code").agg(F.count_distinct("size").alias("k"))
    out = (
        codes.join(sizes, ["doc_id", "code"], "left")
        .groupBy("doc_id", "cluster")
        .agg(F.count(F.lit(1)).alias("n_codes"), F.coalesce(F.max("k"), F.lit(0)).alias("most_sizes"))
    )
    b = (F.col("n_codes") == 1) & (F.col("most_sizes") >= 2)
    return out.withColumn("regime", F.when(b, "B").otherwise("A")).withColumn(
        "regime_conflict", (F.col("n_codes") > 1) & (F.col("most_sizes") >= 2)
    )


def colors(clustered: DataFrame) -> DataFrame:
    """(doc_id, cluster, color, color_conflict): the clean colour if witnesses agree; conflicts are judged on the
    raw witnesses as well.  Empty strings are no witness."""
    color, raw = F.nullif("color", F.lit("")), F.nullif(F.coalesce("color_raw", "color"), F.lit(""))
    out = clustered.groupBy("doc_id", "cluster").agg(
        F.count_distinct(color).alias("k"), F.count_distinct(raw).alias("k_raw"), F.max(color).alias("one")
    )
    return out.select(
        "doc_id",
        "cluster",
        F.when((F.col("k") == 1) & (F.col("k_raw") <= 1), F.col("one")).alias("color"),
        ((F.col("k") > 1) | (F.col("k_raw") > 1)).alias("color_conflict"),
    )


def assemble(
    bindings: DataFrame,
    spec_rows: DataFrame,
    band_letters: DataFrame,
    swatch_areas: DataFrame | None = None,
    rules: RuleConfig = PRODUCTION,
) -> tuple[DataFrame, DataFrame]:
    """Variants (doc_id, cluster, code, color, color_conflict, regime, regime_conflict, merged_from, sizes) and the
    queue of demoted bindings (doc_id, id, code, reason)."""
    bindings = checkpoint(bindings)
    bridged = checkpoint(bridge_codes(bindings, band_letters))
    suspects = bindings.join(bridged, ["doc_id", "code"], "left_semi").select("doc_id", "id", "code", F.lit("merge_key_suspect").alias("reason"))
    clustered = clusters(bindings.join(bridged, ["doc_id", "code"], "left_anti"))
    guarded = guard_reasons(clustered, swatch_areas, rules).select("doc_id", "cluster", "reason")
    judged = checkpoint(clustered.join(guarded, ["doc_id", "cluster"]))
    queue = suspects.unionByName(judged.where("reason is not null").select("doc_id", "id", "code", "reason"))
    kept = judged.where("reason is null").drop("reason")
    modes, shades = regimes(kept, spec_rows), colors(kept)
    size = F.struct("size", "order_code", "price_band", "surface", "claims")
    sizes = variant_sizes(kept, spec_rows).groupBy("doc_id", "cluster").agg(F.sort_array(F.collect_list(size)).alias("sizes"))
    merged = kept.groupBy("doc_id", "cluster").agg(F.sort_array(F.collect_list("id")).alias("merged_from"), F.min("code").alias("least_code"))
    variants = (
        merged.join(modes, ["doc_id", "cluster"])
        .join(shades, ["doc_id", "cluster"])
        .join(sizes, ["doc_id", "cluster"], "left")
        .select(
            "doc_id",
            "cluster",
            F.when(F.col("regime") == "B", F.col("least_code")).alias("code"),
            "color",
            "color_conflict",
            "regime",
            "regime_conflict",
            "merged_from",
            "sizes",
        )
    )
    return variants, queue


def unmerged_colors(variants: DataFrame) -> DataFrame:
    """(doc_id, same_color_unmerged): variants beyond the first of each colour."""
    per = variants.where("color is not null").groupBy("doc_id", "color").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return per.groupBy("doc_id").agg(F.sum(F.col("n") - 1).alias("same_color_unmerged"))


def all_sizes(spec_rows: DataFrame) -> DataFrame:
    """(doc_id, size, page_no): every size with the page it is first seen on (by page, then id)."""
    first = F.min(F.struct("page_no", "id"))
    return spec_rows.where("size is not null").groupBy("doc_id", "size").agg(first["page_no"].alias("page_no"))


def conservation(bindings: DataFrame, variants: DataFrame, queue: DataFrame) -> DataFrame:
    """(doc_id, n_in, n_merged, n_demoted, ok): every binding is in one variant or in the queue."""
    n_in = bindings.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_in"))
    merged = variants.groupBy("doc_id").agg(F.sum(F.size("merged_from")).alias("n_merged"))
    demoted = queue.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_demoted"))
    out = n_in.join(merged, "doc_id", "left").join(demoted, "doc_id", "left").na.fill(0)
    return out.withColumn("ok", F.col("n_in") == F.col("n_merged") + F.col("n_demoted"))
