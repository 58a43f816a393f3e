"""Registered queries over documents that are written out and read again, with SQL over the tables they come from."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import RuleConfig
from pagelattice.operators import assemble, detect, products, reports, scan
from pagelattice.operators.components import checkpoint, ensure_checkpoint_dir
from pagelattice.sources import bridge, documents, readers
from pagelattice.streaming.incremental import queue_arrivals

from . import layout_sql as Q
from .audit_queries import CL, GUARDS, REGIME, _areas
from .queries import KEY, Bridge, query


def shared_folder(b: Bridge, name: str) -> str:
    """A fresh folder that all executors see, removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(b.spark).rstrip('/')}/pagelattice-{name}-{uuid.uuid4().hex}"

    def remove() -> None:
        if b.spark.sparkContext._jsc is not None:
            at = b.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(b.spark._jsc.hadoopConfiguration()).delete(at, True)

    atexit.register(remove)
    return path


def _written(b: Bridge) -> str:
    """The bridge's documents as files, by the nation of their supplier.  Of every ten, one has a broken last page, one
    lacks it and one has no header."""
    words = b.words
    brands = b.table("supplier").join(b.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    brands = brands.select(F.col("s_suppkey").cast("long").alias("doc_id"), F.col("n_name").alias("brand"))
    lines = documents.page_lines(words, b.pages, brands)
    fate, last = F.col("doc_id") % 10, F.max("page_no").over(Window.partitionBy("doc_id"))
    lines = lines.withColumn("last", last).where(~((fate == 8) & (F.col("page_no") == F.col("last")))).where(~((fate == 9) & (F.col("page_no") == 0)))
    half = F.substr("line", F.lit(1), F.floor(F.length("line") / 2).cast("int"))
    path = shared_folder(b, "documents")
    documents.write_documents(lines.withColumn("line", F.when((fate == 7) & (F.col("page_no") == F.col("last")), half).otherwise(F.col("line"))), path)
    return path


FATE = "fate as (select doc_id, doc_id % 10 f, max(page_no) last, count(distinct page_no) k from w group by doc_id)"


@query(
    "s2_document_reader",
    f"""with {Q.W}, {FATE} select w.doc_id, page_no, word_no, x0, y0, x1, y1, "text" from w join fate using (doc_id) where f <> 9 and not (f in (7, 8) and page_no = last)""",
)
def _(b: Bridge) -> DataFrame:
    """Words of the pages that could be read."""
    found = documents.read_documents(b.spark, _written(b), schema="doc_id long, page_no long, word_no long, x0 double, y0 double, x1 double, y1 double, text string, error string")
    return found.where("error is null").drop("error")


@query(
    "s3_document_census",
    f"""with {Q.W}, {Q.N}, {FATE}, h as (select doc_id, page_no, count(*) n, count(*) filter (where regexp_matches("text", '{Q.SIZE}')) hits from n group by all),
c as (select doc_id, count(*) pages, sum(n) words, sum(hits) hits, count(*) filter (where hits >= 3) spec from h group by all)
select n_name brand, case when f <> 9 then c.doc_id end doc_id, case when f < 7 then pages else 0 end pages, case when f < 7 then pages else 0 end text_pages,
  cast(case when f < 7 then words else 0 end as bigint) words, cast(case when f < 7 then hits else 0 end as bigint) size_hits, case when f < 7 then spec else 0 end spec_pages,
  case f when 7 then 'unreadable page after ' || (k - 1) || ' of ' || k when 8 then (k - 1) || ' of ' || k || ' pages' when 9 then 'unreadable header' end "error"
from c join fate using (doc_id) join supplier on s_suppkey = c.doc_id join nation on s_nationkey = n_nationkey""",
)
def _(b: Bridge) -> DataFrame:
    return documents.census(b.spark, _written(b))


# Nested product documents

#: Spec rows of the bridge: each bound code's own row, and codes like price bands that are bound nowhere.
SPEC = """sp as (select b.doc_id, 's' || b.id id, b.page_no, b.word_no, case when b.word_no % 11 = 5 then 'T' || lpad(cast(b.word_no as varchar), 3, '0') else code end code,
  case b.word_no % 6 when 0 then null when 1 then '300x600' else cast(30 * (1 + b.word_no % 3) as varchar) || 'x60' end size,
  case when b.word_no % 4 = 0 then 'MATT' when b.word_no % 10 = 3 then 'MATT 10MM' else 'GLOSS' end surface,
  case b.word_no % 9 when 0 then '' when 1 then 'ON REQUEST' when 2 then code else 'T' || cast(b.word_no % 4 + 1 as varchar) end price_band,
  case when b.word_no % 5 = 0 then null when b.word_no % 13 = 4 then 'n/a' else cast(b.word_no as varchar) end pcs,
  x0 - 60 x0, y0 - 4 y0, x1 + 60 x1, y1 + 4 y1 from b join w using (doc_id, page_no, word_no)),
sr as (select doc_id, code, size from sp)"""
KEPT = "kp as (select cl.* from cl join gr using (doc_id, cluster) where reason is null), dm as (select cl.* from cl join gr using (doc_id, cluster) where reason is not null)"
SIZES = """ls as (select doc_id, code, min(size) least from sp group by all),
vs as (select k.doc_id, k.cluster, coalesce(sp.size, least) size, case when regime = 'A' then k.code end order_code, min(id) id, case when count(distinct surface) = 1 then max(surface) end surface,
    case when count(distinct nullif(price_band, '')) = 1 then max(nullif(price_band, '')) end price_band
  from (select distinct doc_id, cluster, code from kp) k join sp using (doc_id, code) join ls using (doc_id, code) join re using (doc_id, cluster) group by all)"""


def _products(b: Bridge) -> tuple[DataFrame, DataFrame]:
    """Product and review documents of the bridge's dense codes, written and read again.  Every ninth document has no
    file name, and swatches under 40 points of width have no crop."""
    words, rects, dense = b.words, b.rects, b.dense
    no = F.col("word_no")
    corner = lambda p: [F.col(c).alias(f"{p}{c}") for c in products.BOX]
    placed = dense.join(words.select(*KEY, *products.BOX), KEY)
    swatches = rects.select("doc_id", (F.col("page_no") * 10000 + F.col("sw_idx")).alias("sw"), *corner("sw_"))
    bound = placed.join(swatches, ["doc_id", "sw"])
    spec = placed.select(
        "doc_id",
        F.concat(F.lit("s"), F.col("id")).alias("id"),
        "page_no",
        F.when(no % 11 == 5, F.concat(F.lit("T"), F.lpad(no.cast("string"), 3, "0"))).otherwise(F.col("code")).alias("code"),
        F.when(no % 6 == 0, None).when(no % 6 == 1, "300x600").otherwise(F.concat((30 * (1 + no % 3)).cast("string"), F.lit("x60"))).alias("size"),
        F.when(no % 4 == 0, "MATT").when(no % 10 == 3, "MATT 10MM").otherwise("GLOSS").alias("surface"),
        F.when(no % 9 == 0, "").when(no % 9 == 1, "ON REQUEST").when(no % 9 == 2, F.col("code")).otherwise(F.concat(F.lit("T"), (no % 4 + 1).cast("string"))).alias("price_band"),
        F.when(no % 5 != 0, F.create_map(F.lit("pcsBox"), F.when(no % 13 == 4, "n/a").otherwise(no.cast("string")))).alias("packing"),
        *((F.col(c) + d).alias(c) for c, d in zip(products.BOX, (-60, -4, 60, 4), strict=True)),
        F.when(no % 12 != 7, "row").alias("method"),
    )
    spec, bound = checkpoint(spec), checkpoint(bound)
    none = dense.where("false").select("doc_id", F.col("code").alias("letter"))
    variants, queue = assemble.assemble(bound.select("doc_id", "page_no", "id", "sw", "code", "color", "color_raw"), spec, none, _areas(b))
    n_swatches = rects.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_swatches"))
    docs = b.table("supplier").join(b.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    docs = docs.select(F.col("s_suppkey").cast("long").alias("doc_id"), F.col("n_name").alias("brand"), F.lower("s_name").alias("stem")).join(n_swatches, "doc_id", "left").na.fill(0)
    docs = docs.withColumn("file_name", F.when(F.col("doc_id") % 9 != 0, F.concat("stem", F.lit(".pdf"))))
    crops = swatches.where("sw_x1 - sw_x0 >= 40").select("doc_id", "sw", F.concat(F.lit("sw"), F.col("sw").cast("string"), F.lit(".png")).alias("png"))
    suspects = dense.groupBy("doc_id", "code").agg(F.count_distinct("page_no").alias("k")).where("k >= 3")
    held = checkpoint(queue.join(bound.select("doc_id", "id", "page_no", "word_no", *products.BOX), ["doc_id", "id"]))
    held = held.withColumns({"hint_page": F.lit(None).cast("long"), "hint_sw": F.lit(None).cast("long")})
    made = checkpoint(products.product_documents(docs, variants, bound, spec, held, crops, suspects))
    reviews = products.review_documents(docs, made, held, rects)
    path = shared_folder(b, "products")
    readers.write_products(made, f"{path}/products")
    readers.write_reviews(reviews, f"{path}/reviews")
    return readers.read_products(b.spark, f"{path}/products"), readers.read_reviews(b.spark, f"{path}/reviews")


DOCS = f"{CL}, {GUARDS}, {SPEC}, {REGIME}, {KEPT}, {SIZES}"
#: Parts with their provenance: pdf, page, box (null where there is none), method and crop.
PARTS = f"""{DOCS}, bw as (select b.*, x0, y0, x1, y1 from b join w using (doc_id, page_no, word_no)),
bs as (select b.doc_id, b.id, r.page_no page, r.x0, r.y0, r.x1, r.y1 from b join r on r.doc_id = b.doc_id and r.page_no * 10000 + r.sw_idx = b.sw),
va as (select doc_id, cluster, case when count(distinct color) = 1 then max(color) end color from kp group by all),
parts as (
  select doc_id, 'variant' kind, cluster token, bw.page_no page, x0, y0, x1, y1, true m, true crop from va join bw using (doc_id) where bw.id = cluster
  union all select doc_id, 'swatch_crop', cluster, page, x0, y0, x1, y1, true, x1 - x0 >= 40 from va join bs using (doc_id) where bs.id = cluster
  union all select doc_id, 'color', cluster, null, null, null, null, null, true, true from va where color is not null
  union all select kp.doc_id, 'merged_from', kp.cluster || '|' || kp.id, bw.page_no, x0, y0, x1, y1, true, true from kp join bw using (doc_id, id)
  union all select vs.doc_id, 'variant_size', vs.cluster || '|' || coalesce(vs.size, '') || '|' || coalesce(order_code, ''), page_no, x0, y0, x1, y1, true, true from vs join sp using (doc_id, id)
  union all select doc_id, 'all_size', size, min({{'p': page_no, 'i': id}}).p, null, null, null, null, true, true from sp where size is not null group by doc_id, size
  union all select doc_id, 'spec_row', id, page_no, x0, y0, x1, y1, word_no % 12 <> 7, true from sp
  union all select dm.doc_id, 'review', dm.page_no || '|' || dm.word_no, dm.page_no, x0, y0, x1, y1, true, true from dm join bw using (doc_id, id))"""


@query("s7_product_documents", f"""{PARTS} select doc_id, kind, token, case when doc_id % 9 <> 0 then lower(s_name) || '.pdf' end pdf, page, x0, y0, x1, y1 from parts join supplier on s_suppkey = doc_id""")
def _(b: Bridge) -> DataFrame:
    """Every part of the written documents with where it stands."""
    parts = products.product_parts(*_products(b))
    corners = [F.get("bbox", F.lit(k)).alias(c) for k, c in enumerate(products.BOX)]
    return parts.where("value is not null").select("doc_id", "kind", "token", "pdf", "page", *corners)


_NEED = " union all ".join(f"select '{kind}' kind, '{n}' need, {k} k" for kind, needs in reports.PROVENANCE.items() for k, n in enumerate(needs))


@query(
    "p23_document_provenance",
    f"""{PARTS}, nd as ({_NEED})
select doc_id, kind, token, string_agg(need, ',' order by k) missing from parts join nd using (kind)
where case need when 'pdf' then doc_id % 9 = 0 when 'page' then page is null when 'bbox' then x0 is null when 'method' then not m else not crop end group by all""",
)
def _(b: Bridge) -> DataFrame:
    return reports.provenance_gaps(products.product_parts(*_products(b)))


#: Values with what is printed in their boxes.
VALUES = f"""{DOCS}, vl as (select doc_id, 'spec' source, id, size, surface, price_band, pcs, page_no, x0, y0, x1, y1 from sp
  union all select vs.doc_id, 'size', vs.cluster || '|' || coalesce(vs.size, '') || '|' || coalesce(order_code, ''), vs.size, vs.surface, vs.price_band, null, page_no, x0, y0, x1, y1 from vs join sp using (doc_id, id)),
rd as (select vl.doc_id, source, vl.id, string_agg("text", ' ' order by n.word_no) raw from vl join n on n.doc_id = vl.doc_id and n.page_no = vl.page_no
  and n.cx between vl.x0 - 1 and vl.x1 + 1 and n.cy between vl.y0 - 1 and vl.y1 + 1 group by all)"""


@query("j22_printed_values", f"{VALUES} select doc_id, source, vl.id, size, raw from vl left join rd using (doc_id, source, id)")
def _(b: Bridge) -> DataFrame:
    made, _ = _products(b)
    return products.printed_values(products.field_values(made), b.words).select("doc_id", "source", "id", "size", "raw")


@query(
    "a28_document_risks",
    rf"""{VALUES}, fl as (select doc_id, code from b group by all having count(distinct page_no) >= 3), fv as (select distinct doc_id, cluster, code from kp join fl using (doc_id, code)),
ro as (select doc_id, code token, page_no from sp union all select vs.doc_id, order_code, page_no from vs join sp using (doc_id, id) where order_code is not null
  union all select kp.doc_id, min(code), min(case when id = cluster then page_no end) from kp join re using (doc_id, cluster) where regime = 'B' group by kp.doc_id, kp.cluster),
bf as (select doc_id, substr(price_band, 1, 1) l from vl where regexp_matches(price_band, '^[A-Z]\d{{1,2}}$') group by all having count(distinct price_band) >= 3),
fr as (select doc_id, upper(regexp_extract(token, '^([A-Za-z]+)', 1)) prefix, min(page_no) lo, max(page_no) hi from ro group by doc_id, prefix having prefix <> '' and count(distinct token) >= 3),
sz as (select distinct doc_id, size, cast(regexp_extract(size, '^(\d+)x(\d+)$', 1) as bigint) w, cast(regexp_extract(size, '^(\d+)x(\d+)$', 2) as bigint) h from vl where size is not null),
pr as (select vl.doc_id, size, upper(replace(regexp_extract(raw, '(?i)\d+(?:[.,]\d+)?\s*[x×]\s*\d+(?:[.,]\d+)?(?:\s*[x×]\s*\d+(?:[.,]\d+)?)?\s*(?:MM|CM)?', 0), ' ', '')) p from vl join rd using (doc_id, source, id) where size is not null),
ot as (select doc_id, 'price_band' f, price_band t from vl union select doc_id, 'size', size from vl union select doc_id, 'surface', surface from vl)
select distinct doc_id, 'F1_code_price_swap' cls, 'code' field, token from ro where regexp_matches(token, '^[A-Z]\d{{3}}$') and (doc_id, substr(token, 1, 1)) in (select (doc_id, l) from bf)
union all select distinct doc_id, 'F1b_pseudo_code', 'code', code from fv
union all select doc_id, 'F2_field_mixing', 'surface', surface from sp where regexp_matches(surface, '\d')
union all select doc_id, 'F2_field_mixing', 'price_band', price_band from sp where price_band <> '' and not regexp_matches(price_band, '^[A-Z]\d{{1,2}}$')
union all select doc_id, 'F2_field_mixing', 'packing', '{{"pcsBox":"' || pcs || '"}}' from sp where pcs = 'n/a'
union all select distinct x.doc_id, 'F3_series_split', 'series', x.prefix from fr x join fr y on x.doc_id = y.doc_id where x.lo > y.hi or x.hi < y.lo
union all select doc_id, 'F4_unit_collision', 'size', size from pr where p <> '' group by doc_id, size having count(distinct p) >= 2
union all select distinct a.doc_id, 'F4_unit_alias', 'size', least(a.size, z.size) || '|' || greatest(a.size, z.size) from sz a join sz z on a.doc_id = z.doc_id and ((z.w = a.w * 10 and z.h = a.h * 10) or (z.w = a.w * 100 and z.h = a.h * 100))
union all select doc_id, 'F5_multi_role', 'code+' || string_agg(distinct f, '|' order by f), t from ot where t <> '' and (doc_id, t) in (select (doc_id, token) from ro) group by doc_id, t""",
)
def _(b: Bridge) -> DataFrame:
    made, _ = _products(b)
    stems = b.table("supplier").select(F.col("s_suppkey").cast("long").alias("doc_id"), F.lower("s_name").alias("stem"))
    return products.document_risks(checkpoint(made), b.words, stems)


# Arrivals


@query(
    "u6_arrival_queue",
    f"""with {Q.scan(4)} select doc_id, page_no, word_no, token code, case when sw_idx is null then 'orphan' else 'not_x_aligned' end reason from v where not aligned""".replace(Q.icon(4), "icon as (select doc_id, page_no, sw_idx, false icon from r)"),
)
def _(b: Bridge) -> DataFrame:
    """The review queue of documents that arrive in files, each of which is sent twice, by a streaming query of four files a
    trigger: as many rows as the batch query has."""
    path = shared_folder(b, "arrivals")
    columns = ["doc_id", "page_no", "word_no", *products.BOX, "text"]
    words = b.words.select(*columns).repartition(6, "doc_id")
    words.write.parquet(f"{path}/in/first")
    words.write.parquet(f"{path}/in/again")
    rects, rules = checkpoint(b.rects), RuleConfig(4)

    def judge(batch: DataFrame) -> DataFrame:
        codes = detect.route_junk(detect.candidates(batch)).where("bucket = 'kept'").select("doc_id", "token")
        return scan.review_items(scan.verdicts(batch, rects, codes, bridge.pages(batch), rules))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    running = queue_arrivals(b.spark, schema, f"{path}/in/*", judge, KEY, f"{path}/queue", f"{path}/state", files=4)
    running.awaitTermination()
    if running.exception():
        raise running.exception()
    return b.spark.read.parquet(f"{path}/queue").drop("batch")
