"""Whole product and review documents: nested, with the provenance of every value, and the rules that read them.

A document is one row, as it is one JSON object of the output; it holds what its pages hold and no more.  The
rules take each document apart once, by functions over its arrays and one explode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagelattice.config import PRODUCTION, RuleConfig
from pagelattice.sources.readers import PRODUCT_SCHEMA, REVIEW_SCHEMA

from . import audit, reports
from .assemble import all_sizes, regimes

BOX = ("x0", "y0", "x1", "y1")


def prov(pdf: Column | str, page: Column | str | None, box: Column | None, method: Column | str) -> Column:
    none = F.lit(None)
    column = lambda x: F.col(x) if isinstance(x, str) else x
    return F.struct(
        column(pdf).alias("pdf"),
        (none if page is None else column(page)).cast("long").alias("page"),
        (none if box is None else box).cast("array<double>").alias("bbox"),
        (F.lit(method) if isinstance(method, str) else method).alias("method"),
    )


def box(prefix: str = "") -> Column:
    """The four corners as an array; null where one is."""
    corners = [F.col(f"{prefix}{c}") for c in BOX]
    return F.when(F.greatest(*corners).isNotNull(), F.array(*corners))


def _listed(rows: DataFrame, by: list[str], name: str, *columns: Column | str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))


def claimed_sizes(members: DataFrame, spec_rows: DataFrame) -> DataFrame:
    """(doc_id, cluster, size, finish, order_code, price_band, derived_from, prov): the sizes of every variant with the spec
    rows they come from; a field is the one value that all of them agree on.  Rows without a size go with their code's
    least one.  members is (doc_id, cluster, code, regime), spec_rows has a prov."""
    least = spec_rows.groupBy("doc_id", "code").agg(F.min("size").alias("least"))
    rows = spec_rows.join(least, ["doc_id", "code"]).withColumn("size", F.coalesce("size", "least"))
    rows = members.select("doc_id", "cluster", "code", "regime").distinct().join(rows, ["doc_id", "code"])

    def one(c: str) -> Column:
        value = F.nullif(c, F.lit(""))
        return F.when(F.count_distinct(value) == 1, F.max(value))

    return (
        rows.withColumn("order_code", F.when(F.col("regime") == "A", F.col("code")))
        .groupBy("doc_id", "cluster", "size", "order_code")
        .agg(one("surface").alias("finish"), one("price_band").alias("price_band"), F.sort_array(F.collect_list("id")).alias("derived_from"), F.min_by("prov", "id").alias("prov"))
    )


def product_documents(
    documents: DataFrame,
    variants: DataFrame,
    bindings: DataFrame,
    spec_rows: DataFrame,
    queue: DataFrame,
    crops: DataFrame,
    suspects: DataFrame,
    rules: RuleConfig = PRODUCTION,
) -> DataFrame:
    """Rows of PRODUCT_SCHEMA, one a document, whatever it holds.

    documents is (doc_id, brand, file_name, stem, n_swatches); variants as assembly makes them (doc_id, cluster, color,
    merged_from); bindings (doc_id, id, code, page_no, box, sw, sw_ box) of the same words; spec_rows (doc_id, id, code, size,
    surface, price_band, packing, page_no, box, method); queue (doc_id, …) counts; crops (doc_id, sw, png); suspects
    (doc_id, code) of pseudo codes.  A document with swatches but without bindings is a skeleton."""
    files = documents.select("doc_id", F.col("file_name").alias("pdf"))
    of_word = prov("pdf", "page_no", box(), f"geom_v{rules.version}")
    placed = bindings.join(files, "doc_id").withColumn("prov", of_word).withColumn("swatch", F.struct(F.col("page_no").alias("page"), box("sw_").alias("bbox")))
    placed = placed.select("doc_id", "id", "code", "sw", "pdf", "prov", "swatch")
    modes = regimes(variants.select("doc_id", "cluster", F.explode("merged_from").alias("id")).join(placed.select("doc_id", "id", "code"), ["doc_id", "id"]), spec_rows)
    members = variants.select("doc_id", "cluster", "color", F.explode("merged_from").alias("id")).join(placed, ["doc_id", "id"])
    members = members.join(modes.select("doc_id", "cluster", "regime"), ["doc_id", "cluster"])
    members = members.join(crops.select("doc_id", "sw", "png"), ["doc_id", "sw"], "left")
    members = members.join(suspects.select("doc_id", "code", F.lit(True).alias("suspect")), ["doc_id", "code"], "left")
    one = F.struct("id", "prov", "swatch", "png", "pdf")
    shaped = members.groupBy("doc_id", "cluster").agg(
        F.min(F.struct("id", F.struct("code", "regime", "color").alias("of"))).alias("least"),
        F.min_by(one, "id").alias("first"),
        F.sort_array(F.collect_list(F.struct("id", "code", "prov"))).alias("mergedFrom"),
        F.sort_array(F.collect_set(F.when(F.col("suspect"), F.col("code")))).alias("pseudoCodeSuspect"),
    )
    rows = spec_rows.join(files, "doc_id").withColumn("prov", prov("pdf", "page_no", box(), F.col("method")))
    size = [F.col("size"), F.col("finish"), F.col("order_code").alias("orderCode"), F.col("price_band").alias("priceBand"), F.col("derived_from").alias("derivedFrom"), F.col("prov")]
    sizes = _listed(claimed_sizes(members, rows), ["doc_id", "cluster"], "variantSizes", *size)
    first = F.col("first")
    variant = [
        F.col("cluster").alias("id"),
        F.when(F.col("least.of.regime") == "B", F.col("least.of.code")).alias("code"),
        F.col("least.of.color").alias("color"),
        F.when(F.col("least.of.color").isNotNull(), prov(first["pdf"], None, None, "caption")).alias("colorProv"),
        F.col("least.of.regime").alias("regime"),
        first["swatch"].alias("swatch"),
        F.struct(first["png"].alias("png"), prov(first["pdf"], first["swatch"]["page"], first["swatch"]["bbox"], "clip").alias("prov")).alias("swatchCrop"),
        F.col("mergedFrom"),
        F.coalesce("variantSizes", F.array()).alias("variantSizes"),
        F.col("pseudoCodeSuspect"),
        first["prov"].alias("prov"),
    ]
    v = _listed(shaped.join(sizes, ["doc_id", "cluster"], "left"), ["doc_id"], "variants", *variant)
    seen = all_sizes(rows).join(files, "doc_id")
    a = _listed(seen, ["doc_id"], "allSizes", "size", prov("pdf", "page_no", None, "size_union").alias("prov"))
    spec = ["id", "code", "size", "surface", F.col("price_band").alias("priceBand"), F.to_json("packing").alias("packing"), "prov"]
    s = _listed(rows, ["doc_id"], "specByCode", *spec)
    n = queue.groupBy("doc_id").agg(F.count(F.lit(1)).alias("needsReviewCount"))
    bound = bindings.select("doc_id").distinct().withColumn("bound", F.lit(True))
    out = documents
    for part in (v, a, s, n, bound):
        out = out.join(part, "doc_id", "left")
    unpacked = F.transform("specByCode", lambda r: r.withField("packing", F.from_json(r["packing"], "map<string,string>")))  # a map cannot be sorted
    empty = F.array()
    series = F.struct(
        F.col("stem").alias("seriesName"),
        prov("file_name", None, None, "filename").alias("seriesProv"),
        F.coalesce("allSizes", empty).alias("allSizes"),
        F.coalesce(unpacked, empty).alias("specByCode"),
        F.coalesce("variants", empty).alias("variants"),
    )
    return out.select(
        "brand",
        "doc_id",
        F.lit(f"v{rules.version}").alias("bindingVersion"),
        (F.col("variants").isNull() & F.col("bound").isNull() & (F.col("n_swatches") > 0)).alias("seriesSkeleton"),
        F.coalesce("needsReviewCount", F.lit(0)).cast("long").alias("needsReviewCount"),
        F.array(series).alias("series"),
    ).to(StructType.fromDDL(PRODUCT_SCHEMA))


def review_documents(documents: DataFrame, products: DataFrame, queue: DataFrame, swatches: DataFrame, rules: RuleConfig = PRODUCTION) -> DataFrame:
    """Rows of REVIEW_SCHEMA, one a document: its queue as it stands, and every swatch where it is a skeleton.  queue is (doc_id,
    page_no, word_no, code, reason, box, hint_page, hint_sw)."""
    files = documents.select("doc_id", F.col("file_name").alias("pdf"))
    hint = F.when(F.col("hint_page").isNotNull(), F.struct(F.col("hint_page").alias("page"), F.col("hint_sw").alias("swatchIdx")))
    items = queue.join(files, "doc_id").withColumn("prov", prov("pdf", "page_no", box(), f"geom_v{rules.version}"))
    items = _listed(items, ["doc_id"], "items", "page_no", "word_no", "code", "reason", hint.alias("nameHint"), "prov")
    bare = products.where("seriesSkeleton").select("doc_id")
    skeleton = _listed(swatches.join(bare, "doc_id", "left_semi"), ["doc_id"], "skeletonSwatches", "page_no", "sw_idx", box().alias("bbox"))
    out = documents.select("brand", "doc_id", F.lit(f"v{rules.version}").alias("bindingVersion"))
    out = out.join(items, "doc_id", "left").join(skeleton, "doc_id", "left")
    columns = [F.coalesce(c, F.array()).alias(c) for c in ("items", "skeletonSwatches")]
    return out.select("brand", "doc_id", "bindingVersion", *columns).to(StructType.fromDDL(REVIEW_SCHEMA))


# Taking documents apart


def _each(items: Column | str, f: Callable[[Column], Column]) -> Column:
    """f over a list; a list that a document leaves out is empty."""
    return F.transform(F.coalesce(F.col(items) if isinstance(items, str) else items, F.array()), f)


def _part(kind: str, token: Column, value: Column, p: Column, crop: Column | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        token.alias("token"),
        value.alias("value"),
        p["pdf"].alias("pdf"),
        p["page"].alias("page"),
        p["bbox"].alias("bbox"),
        p["method"].alias("method"),
        (F.lit(None).cast("string") if crop is None else crop).alias("crop"),
    )


def _text(*parts: Column) -> Column:
    return F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts))


def product_parts(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """(doc_id, kind, token, value, pdf, page, bbox, method, crop): every part that owes provenance, for provenance_gaps."""

    def of_variant(v: Column) -> Column:
        one = F.array(
            _part("variant", v["id"], v["id"], v["prov"]),
            _part("swatch_crop", v["id"], v["id"], v["swatchCrop"]["prov"], v["swatchCrop"]["png"]),
            _part("color", v["id"], v["color"], v["colorProv"]),
        )
        merged = _each(v["mergedFrom"], lambda m: _part("merged_from", _text(v["id"], m["id"]), m["id"], m["prov"]))
        sizes = _each(v["variantSizes"], lambda x: _part("variant_size", _text(v["id"], x["size"], x["orderCode"]), v["id"], x["prov"]))
        return F.concat(one, merged, sizes)

    def of_series(s: Column) -> Column:
        return F.concat(
            F.flatten(_each(s["variants"], of_variant)),
            _each(s["allSizes"], lambda a: _part("all_size", a["size"], a["size"], a["prov"])),
            _each(s["specByCode"], lambda r: _part("spec_row", r["id"], r["id"], r["prov"])),
        )

    held = products.select("doc_id", F.explode(F.flatten(_each("series", of_series))).alias("p"))
    item = _each("items", lambda i: _part("review", _text(i["page_no"].cast("string"), i["word_no"].cast("string")), i["code"], i["prov"]))
    return held.unionByName(reviews.select("doc_id", F.explode(item).alias("p"))).select("doc_id", "p.*")


def field_values(products: DataFrame) -> DataFrame:
    """(doc_id, source, id, size, surface, price_band, packing, prov): the fields of spec rows (source spec) and of variant
    sizes (size), which have no packing."""

    def row(source: str, ident: Column, r: Column, surface: str, packing: Column) -> Column:
        return F.struct(
            F.lit(source).alias("source"), ident.alias("id"), r["size"].alias("size"), r[surface].alias("surface"), r["priceBand"].alias("price_band"), packing.alias("packing"), r["prov"].alias("prov")
        )

    none = F.lit(None).cast("map<string,string>")

    def of_variant(v: Column) -> Column:
        return _each(v["variantSizes"], lambda x: row("size", _text(v["id"], x["size"], x["orderCode"]), x, "finish", none))

    def of_series(s: Column) -> Column:
        return F.concat(_each(s["specByCode"], lambda r: row("spec", r["id"], r, "surface", r["packing"])), F.flatten(_each(s["variants"], of_variant)))

    return products.select("doc_id", F.explode(F.flatten(_each("series", of_series))).alias("r")).select("doc_id", "r.*")


def code_roles(products: DataFrame) -> DataFrame:
    """(doc_id, token, role, page_no, flagged): codes of variants, order codes and spec rows, with the page they stand on;
    flagged where the variant has pseudo codes."""

    def role(token: Column, name: str, p: Column, flagged: Column) -> Column:
        return F.struct(token.alias("token"), F.lit(name).alias("role"), p["page"].alias("page_no"), flagged.alias("flagged"))

    def of_variant(v: Column) -> Column:
        flagged = F.coalesce(F.size(v["pseudoCodeSuspect"]), F.lit(0)) > 0
        return F.concat(F.array(role(v["code"], "variant", v["prov"], flagged)), _each(v["variantSizes"], lambda x: role(x["orderCode"], "order", x["prov"], flagged)))

    def of_series(s: Column) -> Column:
        return F.concat(F.flatten(_each(s["variants"], of_variant)), _each(s["specByCode"], lambda r: role(r["code"], "spec", r["prov"], F.lit(False))))

    found = products.select("doc_id", F.explode(F.flatten(_each("series", of_series))).alias("r")).select("doc_id", "r.*")
    return found.where("token is not null and token <> ''")


def printed_values(values: DataFrame, words: DataFrame) -> DataFrame:
    """values with raw: the words whose centre lies within a point of the box that a value came from, in document order.
    Boxes and words meet by page; a value without a box has no raw.  values is (doc_id, source, id, prov, …)."""
    boxes = values.where("prov.page is not null and size(prov.bbox) = 4").select(
        "doc_id", F.col("prov.page").alias("page_no"), F.concat_ws("/", "source", "id").alias("part"), *(F.col("prov.bbox")[k].alias(c) for k, c in enumerate(BOX))
    )
    read = audit.text_inside(words, boxes, ["doc_id", "page_no"], "part").select("doc_id", "part", "raw")
    return values.withColumn("part", F.concat_ws("/", "source", "id")).join(read, ["doc_id", "part"], "left").drop("part")


def pseudo_flags(products: DataFrame) -> DataFrame:
    """Codes that a variant's own flag calls pseudo codes."""
    flags = F.flatten(_each("series", lambda s: F.flatten(_each(s["variants"], lambda v: F.coalesce(v["pseudoCodeSuspect"], F.array())))))
    found = products.select("doc_id", F.explode(flags).alias("token")).distinct()
    return found.select("doc_id", F.lit("F1b_pseudo_code").alias("cls"), F.lit("code").alias("field"), "token")


def document_risks(products: DataFrame, words: DataFrame, stems: DataFrame) -> DataFrame:
    """(doc_id, cls, field, token): the classes of field risks, read from whole documents.

    Spec rows and variant sizes both count for price band families, sizes in two prints (read back from the pages),
    scaled sizes and double roles; shapes are judged on spec rows; a pseudo code is one that its variant flags or,
    without a flag, a variant's code that is part of the file name."""
    values, roles = printed_values(field_values(products), words), code_roles(products)
    own = roles.where("role = 'variant' and not flagged")
    return (
        reports.code_price_swaps(values, roles)
        .unionByName(reports.pseudo_codes(own, stems))
        .unionByName(pseudo_flags(products))
        .unionByName(reports.mixed_fields(values.where("source = 'spec'")).drop("id"))
        .unionByName(reports.split_series(roles))
        .unionByName(reports.unit_collisions(values))
        .unionByName(reports.unit_aliases(values))
        .unionByName(reports.double_roles(values, roles))
    )
