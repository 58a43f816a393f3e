"""Reports and checks over finished products: field risks, provenance, formats, guards, conservation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import PRODUCTION, RuleConfig

from .assemble import guard_reasons
from .audit import golden_diff, set_diff

# Shapes of field values: fixed values.
CODE_LIKE_BAND = r"^[A-Z]\d{3}$"
BAND_MEMBER = r"^[A-Z]\d{1,2}$"
BAND_VALUE = r"^[A-Z]\d{1,3}$"
SIZE_VALUE = r"^\d+(?:[.,]\d+)?x\d+(?:[.,]\d+)?(?:x\d+(?:[.,]\d+)?)?(?:mm|cm)?$"
UNIT_WORD = r"(?i)(?:\d|\b(?:MM|CM|M2|MQ|SQM|KG|BOX|PALLET|PCS|PZ|PIECES|SCATOLA)\b)"
SIZE_TEXT = r"(?i)\d+(?:[.,]\d+)?\s*[x×]\s*\d+(?:[.,]\d+)?(?:\s*[x×]\s*\d+(?:[.,]\d+)?)?\s*(?:MM|CM)?"
SCALED_SIZE = r"^(\d+)x(\d+)(mm|cm)?$"
NUMBER = r"^\d+(?:[.,]\d+)?$"


def _finding(cls: str, field: Column | str, token: Column | str) -> list[Column]:
    return ["doc_id", F.lit(cls).alias("cls"), (F.lit(field) if isinstance(field, str) else field).alias("field"), (F.col(token) if isinstance(token, str) else token).alias("token")]


def code_price_swaps(rows: DataFrame, roles: DataFrame) -> DataFrame:
    """Codes shaped like a price band with three digits, in documents with a band family of their letter (three members or more)."""
    band = rows.where(F.col("price_band").rlike(BAND_MEMBER)).select("doc_id", F.substring("price_band", 1, 1).alias("letter"), "price_band")
    families = band.groupBy("doc_id", "letter").agg(F.count_distinct("price_band").alias("k")).where("k >= 3").select("doc_id", "letter")
    found = roles.where(F.col("token").rlike(CODE_LIKE_BAND)).withColumn("letter", F.substring("token", 1, 1))
    return found.join(families, ["doc_id", "letter"], "left_semi").select(*_finding("F1_code_price_swap", "code", "token")).distinct()


def pseudo_codes(roles: DataFrame, stems: DataFrame) -> DataFrame:
    """Codes of six characters or more that are part of the document's file name; stems is (doc_id, stem)."""
    found = roles.where(F.length("token") >= 6).join(stems, "doc_id").where(F.contains(F.lower("stem"), F.lower("token")))
    return found.select(*_finding("F1b_pseudo_code", "code", "token")).distinct()


def packing_defect(packing: Column) -> Column:
    return F.exists(F.map_values(packing), lambda v: v.isNotNull() & (v != "") & ~F.trim(v).rlike(NUMBER))


def mixed_fields(rows: DataFrame) -> DataFrame:
    """(doc_id, cls, field, token, id): values that do not have their field's shape."""
    bad = F.array_compact(
        F.array(
            *(
                F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(name).alias("field"), value.cast("string").alias("token")))
                for name, value, test in (
                    ("size", F.col("size"), (F.col("size") != "") & ~F.col("size").rlike(SIZE_VALUE)),
                    ("surface", F.col("surface"), F.col("surface").rlike(UNIT_WORD)),
                    ("price_band", F.col("price_band"), (F.col("price_band") != "") & ~F.col("price_band").rlike(BAND_MEMBER)),
                    ("packing", F.to_json("packing"), packing_defect(F.col("packing"))),
                )
            )
        )
    )
    return rows.select("doc_id", "id", F.explode(bad).alias("f")).select("doc_id", F.lit("F2_field_mixing").alias("cls"), "f.field", "f.token", "id")


def family_ranges(roles: DataFrame, prefix: Column, least: int = 3) -> DataFrame:
    """(doc_id, prefix, lo, hi, n_before, n_after): code families of `least` codes or more with their page ranges, and how many
    families of the document end before a family begins, or begin after it ends.  Counts, no pairs."""
    named = roles.select("doc_id", "token", "page_no", prefix.alias("prefix")).where("prefix is not null and prefix <> ''")
    ranges = named.groupBy("doc_id", "prefix").agg(F.min("page_no").alias("lo"), F.max("page_no").alias("hi"), F.count_distinct("token").alias("k"))
    ranges = ranges.where(F.col("k") >= least).drop("k")
    # begins and ends on one line: at one page, begins come first, so ends before it are on lower pages
    marks = ranges.select("doc_id", "prefix", F.explode(F.array(F.struct(F.col("lo").alias("at"), F.lit(0).alias("end")), F.struct(F.col("hi").alias("at"), F.lit(1).alias("end")))).alias("m"))
    line = Window.partitionBy("doc_id").orderBy("m.at", "m.end").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = marks.select("doc_id", "prefix", "m.end", F.sum("m.end").over(line).alias("ends"), F.sum(1 - F.col("m.end")).over(line).alias("begins"))
    counted = seen.groupBy("doc_id", "prefix").agg(
        F.max(F.when(F.col("end") == 0, F.col("ends"))).alias("n_before"), F.max(F.when(F.col("end") == 1, F.col("begins"))).alias("begun")
    )
    total = Window.partitionBy("doc_id")
    return (
        ranges.join(counted, ["doc_id", "prefix"])
        .withColumn("n_after", F.count(F.lit(1)).over(total) - F.col("begun"))
        .select("doc_id", "prefix", "lo", "hi", "n_before", "n_after")
    )


def split_series(roles: DataFrame) -> DataFrame:
    """Families of codes whose pages do not meet those of another family of the document."""
    prefix = F.upper(F.regexp_extract("token", r"^([A-Za-z]+)", 1))
    return family_ranges(roles, prefix).where("n_before + n_after > 0").select(*_finding("F3_series_split", "series", "prefix"))


def unit_collisions(rows: DataFrame) -> DataFrame:
    """Sizes that were printed in two ways or more; rows has raw, the printed text (other text than a size does not count)."""
    printed = F.upper(F.regexp_replace(F.regexp_extract("raw", SIZE_TEXT, 0), r"\s", ""))
    found = rows.where(F.col("size").isNotNull()).select("doc_id", "size", printed.alias("printed")).where("printed <> ''")
    return found.groupBy("doc_id", "size").agg(F.count_distinct("printed").alias("k")).where("k >= 2").select(*_finding("F4_unit_collision", "size", "size"))


def unit_aliases(rows: DataFrame) -> DataFrame:
    """Pairs of a document's sizes that are each other times 10, 100 or 1000."""
    part = [F.regexp_extract("size", SCALED_SIZE, k).try_cast("decimal(20,0)") for k in (1, 2)]
    sizes = rows.where(F.col("size").rlike(SCALED_SIZE)).select("doc_id", "size", part[0].alias("w"), part[1].alias("h")).distinct()
    times = sizes.withColumn("k", F.explode(F.array(*(F.lit(x).cast("decimal(5,0)") for x in (10, 100, 1000)))))
    times = times.select("doc_id", F.col("size").alias("small"), (F.col("w") * F.col("k")).cast("decimal(20,0)").alias("w"), (F.col("h") * F.col("k")).cast("decimal(20,0)").alias("h"))
    pairs = times.join(sizes.withColumnRenamed("size", "big"), ["doc_id", "w", "h"]).where("small <> big")
    return pairs.select(*_finding("F4_unit_alias", "size", F.concat_ws("|", F.least("small", "big"), F.greatest("small", "big")))).distinct()


def double_roles(rows: DataFrame, roles: DataFrame) -> DataFrame:
    """Codes that are also a price band, size or surface of the document."""
    values = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("token")) for c in ("price_band", "size", "surface")))).alias("v")
    other = rows.select("doc_id", values).select("doc_id", "v.*").where("token is not null and token <> ''").distinct()
    found = other.join(roles.select("doc_id", "token").distinct(), ["doc_id", "token"], "left_semi")
    fields = F.concat(F.lit("code+"), F.array_join(F.sort_array(F.collect_set("field")), "|"))
    return found.groupBy("doc_id", "token").agg(fields.alias("field")).select(*_finding("F5_multi_role", F.col("field"), "token"))


def field_risks(rows: DataFrame, roles: DataFrame, stems: DataFrame) -> DataFrame:
    """(doc_id, cls, field, token): all classes of field risks.

    rows is (doc_id, id, size, surface, price_band, packing map, raw), roles (doc_id, token, page_no) of all codes, stems
    (doc_id, stem).  Findings are shown, not ruled on; null and empty values are none."""
    found = [code_price_swaps(rows, roles), pseudo_codes(roles, stems), mixed_fields(rows).drop("id"), split_series(roles)]
    for more in (*found[1:], unit_collisions(rows), unit_aliases(rows), double_roles(rows, roles)):
        found[0] = found[0].unionByName(more)
    return found[0]


#: What each part of a product must carry.
PROVENANCE = {
    "variant": ("pdf", "page", "bbox", "method"),
    "swatch_crop": ("crop", "page", "bbox"),
    "color": ("pdf",),
    "merged_from": ("page", "bbox"),
    "variant_size": ("page", "bbox"),
    "all_size": ("pdf", "page"),
    "spec_row": ("pdf", "page", "bbox", "method"),
    "review": ("pdf", "page", "bbox"),
}


def provenance_gaps(parts: DataFrame) -> DataFrame:
    """(doc_id, kind, token, missing): parts that lack some of what their kind must carry.  parts is (doc_id, kind, token,
    value, pdf, page, bbox, method, crop); a part without a value (a colour that is null) owes nothing."""
    there = {
        "pdf": F.coalesce("pdf", F.lit("")) != "",
        "page": F.coalesce("page", F.lit(0)) != 0,
        "bbox": F.coalesce(F.size("bbox"), F.lit(0)) > 0,
        "method": F.coalesce("method", F.lit("")) != "",
        "crop": F.coalesce("crop", F.lit("")) != "",
    }
    missing = F.lit(None).cast("array<string>")
    for kind, needs in PROVENANCE.items():
        missing = F.when(F.col("kind") == kind, F.array_compact(F.array(*(F.when(~there[n], n) for n in needs)))).otherwise(missing)
    return parts.where("value is not null").withColumn("missing", F.array_join(missing, ",")).where("missing <> ''").select("doc_id", "kind", "token", "missing")


def format_defects(rows: DataFrame) -> DataFrame:
    """(doc_id, field, value): values out of the output format: bands, surfaces that are not words, packing that is no number."""
    words = F.filter(F.split("surface", r"\s+"), lambda w: w != "")
    odd_surface = F.exists(words, lambda w: ~F.upper(F.trim(w, F.lit("*,;:()."))).rlike(r"^\p{L}+$"))
    values = F.filter(F.map_values("packing"), lambda v: v.try_cast("double").isNull())
    found = F.concat(
        F.when(F.col("price_band").isNotNull() & (F.col("price_band") != "") & ~F.col("price_band").rlike(BAND_VALUE), F.array(F.struct(F.lit("price_band").alias("field"), F.col("price_band").alias("value")))).otherwise(F.array()),
        F.when(odd_surface, F.array(F.struct(F.lit("surface").alias("field"), F.col("surface").alias("value")))).otherwise(F.array()),
        F.coalesce(F.transform(values, lambda v: F.struct(F.lit("packing").alias("field"), v.alias("value"))), F.array()),
    )
    return rows.select("doc_id", F.explode(found).alias("f")).select("doc_id", "f.field", "f.value")


def extraction_rates(rows: DataFrame) -> DataFrame:
    """(doc_id, n_rows, n_size, n_surface, n_band, n_packing, packing_fields): how many rows have each field, and the packing
    fields by name as text (a map's keys counted over the rows)."""
    has = [F.count_if(F.col(c).isNotNull() & (F.col(c) != "")).alias(n) for c, n in (("size", "n_size"), ("surface", "n_surface"), ("price_band", "n_band"))]
    per = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_rows"), *has, F.count_if(F.coalesce(F.size("packing"), F.lit(0)) > 0).alias("n_packing"))
    keys = rows.select("doc_id", F.explode(F.map_keys("packing")).alias("k")).groupBy("doc_id", "k").agg(F.count(F.lit(1)).alias("n"))
    listed = F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "k", F.col("n").cast("string")))), ",")
    return per.join(keys.groupBy("doc_id").agg(listed.alias("packing_fields")), "doc_id", "left").na.fill("", ["packing_fields"])


def cluster_shapes(clustered: DataFrame) -> DataFrame:
    """(doc_id, cluster, n, pages, colors, raws, conflict): the numbers that the guards look at."""
    color, raw = F.nullif("color", F.lit("")), F.nullif(F.coalesce("color_raw", "color"), F.lit(""))
    return clustered.groupBy("doc_id", "cluster").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("page_no").alias("pages"), F.count_distinct(color).alias("colors"), F.count_distinct(raw).alias("raws")
    ).withColumn("conflict", (F.col("colors") > 1) | (F.col("raws") > 1))


def collapse_signatures(clustered: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """Clusters over several pages whose colours disagree, with whether they are large enough to be taken for a collapse."""
    return cluster_shapes(clustered).where("pages >= 2 and conflict").drop("conflict").withColumn("collapse", F.col("n") >= rules.collapse)


def near_threshold(clustered: DataFrame, low: int = 12, high: int = 28) -> DataFrame:
    """(doc_id, cluster, id, page_no, code, color): bindings of clusters over several pages with several raw colours, of a size near the guard's."""
    near = cluster_shapes(clustered).where((F.col("pages") >= 2) & (F.col("raws") > 1) & F.col("n").between(low, high)).select("doc_id", "cluster")
    return clustered.join(near, ["doc_id", "cluster"], "left_semi").select("doc_id", "cluster", "id", "page_no", "code", F.coalesce("color_raw", "color").alias("color"))


def borderline(clustered: DataFrame, areas: DataFrame | None = None, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, kind, n_clusters, most_bindings, most_pages) of clusters that the two collapse guards let pass: band (several
    pages, colours disagree), across (other clusters over several pages) or single."""
    stats = guard_reasons(clustered, areas, rules).where("reason is null or reason not in ('assembly_collapse_suspect', 'singlepage_overmerge_suspect')")
    kind = F.when((F.col("pages") >= 2) & F.col("conflict"), "band").when(F.col("pages") >= 2, "across").otherwise("single")
    return stats.groupBy("doc_id", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_clusters"), F.max("n").alias("most_bindings"), F.max("pages").alias("most_pages"))


def guard_changes(clustered: DataFrame, areas: DataFrame | None = None, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, cluster, n, change): variants that the guards take out (gone), and any that they bring in (new: there must be none)."""
    off = replace(rules, collapse=1 << 30, borderline=1 << 30, merge_pages=1 << 30, merge_bindings=1 << 30)
    with_, without = (guard_reasons(clustered, areas, r).where("reason is null").select("doc_id", "cluster", "n") for r in (rules, off))
    return set_diff(without, with_)


def smoke_equations(counts: DataFrame, bindings: DataFrame, variants: DataFrame, queue: DataFrame, review: DataFrame, rows: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """(doc_id, equation, lhs, rhs, ok): what goes in comes out, per document.

    counts are page counts (page key, n_codes, code_x_aligned, code_block_bound, code_needs_review), bindings what was
    assembled, variants and queue the outcome of assembly, review the items of the pages, rows the spec rows."""
    n = F.count(F.lit(1))
    page = counts.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in ("n_codes", "code_x_aligned", "code_block_bound", "code_needs_review")))
    wide = F.count_if((F.size("pages") > 1) & F.col("color").isNull() & F.col("color_conflict") & (F.size("merged_from") >= rules.collapse))
    radius = F.count_if((F.size("pages") > rules.merge_pages) | ((F.size("pages") > 1) & (F.size("merged_from") > rules.merge_bindings)))
    grey = F.count_if((F.size("pages") > 1) & F.col("color").isNull() & F.col("color_conflict") & F.size("merged_from").between(rules.borderline, rules.collapse - 1))
    paged = variants.join(
        variants.select("doc_id", "cluster", F.explode("merged_from").alias("id")).join(bindings.select("doc_id", "id", "page_no"), ["doc_id", "id"]).groupBy("doc_id", "cluster").agg(F.collect_set("page_no").alias("pages")),
        ["doc_id", "cluster"],
    )
    made = paged.groupBy("doc_id").agg(F.sum(F.size("merged_from")).alias("merged"), wide.alias("collapse"), radius.alias("radius"), grey.alias("grey"))
    out = page
    for df, name in ((bindings, "bindings"), (queue, "demoted"), (review, "review"), (rows, "rows")):
        out = out.join(df.groupBy("doc_id").agg(n.alias(name)), "doc_id", "left")
    out = out.join(made, "doc_id", "left").na.fill(0)
    zero = F.lit(0).cast("long")
    equations = (
        ("bound", F.col("bindings"), F.col("code_x_aligned") + F.col("code_block_bound")),
        ("merged_or_demoted", F.col("merged") + F.col("demoted"), F.col("bindings")),
        ("queued", F.col("review"), F.col("code_needs_review")),
        ("accounted", F.col("bindings") + F.col("review"), F.col("n_codes")),
        ("spec_rows", F.col("rows"), F.col("n_codes")),
        ("collapse_escapes", F.col("collapse"), zero),
        ("radius_escapes", F.col("radius"), zero),
        ("borderline_escapes", F.col("grey"), zero),
    )
    listed = F.array(*(F.struct(F.lit(name).alias("equation"), a.cast("long").alias("lhs"), b.cast("long").alias("rhs")) for name, a, b in equations))
    return out.select("doc_id", F.explode(listed).alias("e")).select("doc_id", "e.*", (F.col("e.lhs") == F.col("e.rhs")).alias("ok"))


def batch_agreement(scanned: DataFrame, extracted: DataFrame, key: list[str]) -> DataFrame:
    """(doc_id, cells, differ, only_scanned, only_extracted): two runs over the same pages, compared both ways on every column
    that they share."""
    shared = [c for c in scanned.columns if c in extracted.columns and c not in key]
    diff = golden_diff(extracted, scanned, key, shared)
    per = diff.groupBy("doc_id").agg(
        F.count_if(~F.col("cell").isin("missing", "extra")).alias("differ"), F.count_if(F.col("cell") == "missing").alias("only_scanned"), F.count_if(F.col("cell") == "extra").alias("only_extracted")
    )
    pages = scanned.select(*key).unionByName(extracted.select(*key)).distinct().groupBy("doc_id").agg((F.count(F.lit(1)) * len(shared)).alias("cells"))
    return pages.join(per, "doc_id", "left").na.fill(0)
