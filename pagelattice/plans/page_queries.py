"""Registered queries of page extraction and of the reports, with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelattice.config import RuleConfig
from pagelattice.functions import tokens as T
from pagelattice.operators import assemble, detect, fields, layout, pages, reports, scan

from . import layout_sql as Q
from .audit_queries import AREAS, CL, GUARDS, _areas
from .queries import CAPTIONS, GOOD, INDEX, KEY, LEFT, PK, ROWSIZE, Bridge, _index, _left, query

# Page extraction by version


def _captions3(base: str) -> str:
    """The captions of version 3 beside another version's assignment."""
    return base.replace("pairs", "pairs3").replace("best", "best3").replace("a as (select n.doc_id", "a3 as (select n.doc_id").replace("from a join r", "from a3 a join r")


NAMED = f"""{_captions3(CAPTIONS)}, {INDEX}, {GOOD},
home as (select distinct cw.doc_id, cw.token from cw join a3 using (doc_id, page_no, word_no) join r using (doc_id, page_no, sw_idx) where cw.cx between r.x0 - 2 and r.x1 + 2),
tp as (select doc_id, page_no from v group by all having count(*) >= 5 and count(*) filter (where aligned or blocked) <= 0.2 * count(*)),
oc as (select * from v where not aligned and not blocked and (doc_id, page_no) in (select (doc_id, page_no) from tp) and (doc_id, token) not in (select (doc_id, token) from home)),
few as (select doc_id, token from idx group by all having count(*) <= 3),
pr as (select distinct c.doc_id, c.page_no, c.word_no, u.token from oc c join n u using (doc_id, page_no) join gn on gn.doc_id = u.doc_id and gn.page_no = u.page_no and gn.token = u.token
  join few on few.doc_id = u.doc_id and few.token = u.token where abs(c.cy - u.cy) <= 1.5 * greatest(c.h, 1) and not (u."text" = lower(u."text") and u."text" <> upper(u."text"))),
want as (select doc_id, page_no, word_no, count(*) n from pr group by all),
ht as (select pr.doc_id, pr.page_no, pr.word_no, idx.page_no tp, idx.sw_idx ts, count(*) k from pr join idx on idx.doc_id = pr.doc_id and idx.token = pr.token group by all),
hint as (select distinct ht.doc_id, ht.page_no, ht.word_no from ht join want using (doc_id, page_no, word_no) where k = n)"""

COUNTERS = """cod as (select distinct doc_id, page_no, sw_idx from v where sw_idx is not null),
gp as (select r.doc_id, r.page_no, count(*) n_sw, count(*) filter (where cod.sw_idx is null) sw_no_code from r left join cod using (doc_id, page_no, sw_idx) group by all),
vc as (select doc_id, page_no, count(*) n_codes, count(*) filter (where sw_idx is null) code_orphan, count(*) filter (where far) code_far, count(*) filter (where aligned) code_x_aligned,
  count(*) filter (where blocked) code_block_bound, count(*) filter (where demoted) code_icon_demoted, count(*) filter (where not aligned and not blocked) code_needs_review from v group by all)"""


def _verdict_sql(version: int, words: str = Q.W, codes: str = Q.C, rects: str = Q.R) -> str:
    """v with the block rescue of version 7; the rectangles are those moved into left columns.  words gives w, codes cand, routed,
    codes and cw."""
    rescued = f"""{LEFT}, res as (select a.doc_id, a.page_no, a.word_no, min({{'y0': bl.y0, 'sw_idx': bl.sw_idx}}).sw_idx bi from a join n using (doc_id, page_no, word_no) join bl using (doc_id, page_no)
  where a.rule = 'orphan' and bl.y0 <= n.cy and n.cy < bl.y1 and n.cx > column_x1 + 2 group by all),
az as (select a.doc_id, a.page_no, a.word_no, coalesce(a.sw_idx, bi) sw_idx, case when bi is not null then 'block' else a.rule end "rule", case when bi is not null then -2.0 else a.d end d
  from a left join res using (doc_id, page_no, word_no))"""
    if version < 7:
        rescued = "az as (select * from a)"
    icon = Q.icon(version) if version >= 6 else "icon as (select doc_id, page_no, sw_idx, false icon from r)"
    moved = f"""{rects.replace("r as (", "r0 as (")}, r as (select doc_id, page_no, sw_idx, rid, case when rid % 3 = 0 then 10.0 else x0 end x0, y0, case when rid % 3 = 0 then 60.0 else x1 end x1,
  case when rid % 3 = 0 then y0 + 60 else y0 + 20 end y1 from r0)"""
    verdict = Q.V.replace("join a using", "join az a using").replace("v as (", "v0 as (")
    judged = """v as (select * exclude (aligned, demoted), aligned,
    rule = 'block' and not coalesce(icon.icon, false) blocked, demoted or (rule = 'block' and coalesce(icon.icon, false)) demoted from v0 left join icon using (doc_id, page_no, sw_idx))"""
    return ", ".join((words, moved, Q.N, Q.S, codes, Q.PG, Q.assign(version), icon, rescued, verdict, judged))


def extraction_sql(version: int, words: str = Q.W, codes: str = Q.C, rects: str = Q.R) -> str:
    """The counters of every page."""
    names = NAMED if version >= 4 else "hint as (select doc_id, page_no, word_no from v where false)"
    sides = f"{ROWSIZE}" if version >= 4 else ROWSIZE.replace("case when least(cw.x1, s_x1) - greatest(cw.x0, s_x0) > 0 then 1 else 2 end", "1")
    return f"""with {_verdict_sql(version, words, codes, rects)}, {names}, {sides}, {COUNTERS}
select pg.doc_id, pg.page_no, coalesce(n_codes, 0) n_codes, coalesce(code_orphan, 0) code_orphan, coalesce(code_far, 0) code_far, coalesce(code_x_aligned, 0) code_x_aligned,
  coalesce(code_block_bound, 0) code_block_bound, coalesce(code_icon_demoted, 0) code_icon_demoted, coalesce(code_needs_review, 0) code_needs_review,
  (select count(*) from rs where rs.doc_id = pg.doc_id and rs.page_no = pg.page_no) code_with_size, (select count(*) from hint where hint.doc_id = pg.doc_id and hint.page_no = pg.page_no) code_name_bound,
  coalesce(n_sw, 0) n_sw, coalesce(sw_no_code, 0) sw_no_code
from pg left join vc using (doc_id, page_no) left join gp using (doc_id, page_no)"""


def _extraction(version: int) -> None:
    @query(f"q4_pages_v{version}", extraction_sql(version))
    def _(b):
        """The counters of every page from the whole extraction, over swatches of which some stand in left columns."""
        counts = pages.extract_pages(b.words, _left(b), b.pages, b.codes.select("doc_id", "token"), rules=RuleConfig(version)).counts
        return counts.drop("code_photo_demoted")


for _version in (3, 4, 7, 13):
    _extraction(_version)


def _detected(version: int) -> None:
    @query(f"q4_pages_v{version}")
    def _(b):
        """With the version's own detection, over swatches of which some stand in left columns."""
        return pages.extract_pages(b.words, _left(b), b.pages, alpha_vocab=detect.vocabulary(b.words).where("kind = 'alpha'"), rules=RuleConfig(version)).counts


for _version in (8, 9, 10, 12):
    _detected(_version)


@query(
    "q9_batch_agreement",
    f"""with {Q.scan(5)}, o as (select * from v), {Q.icon(6).replace("icon as (", "icon6 as (").replace("sized", "sized6").replace("spec as", "spec6 as").replace("join spec", "join spec6").replace("med as", "med6 as").replace("join med", "join med6").replace("rep as", "rep6 as").replace("join rep", "join rep6").replace("rep.", "rep6.")},
x as (select o.doc_id, o.page_no, count(*) n_codes, count(*) filter (where sw_idx is null) code_orphan, count(*) filter (where far) code_far, count(*) filter (where inside) a5, count(*) filter (where inside and not ic) a6,
    count(*) filter (where inside and ic) d6 from (select o.*, coalesce(o.cx between r_x0 - 2 and r_x1 + 2, false) inside, coalesce(icon6.icon, false) ic from o left join icon6 using (doc_id, page_no, sw_idx)) o group by all)
select doc_id, count(*) * 7 cells, cast(sum(case when a5 <> a6 then 2 else 0 end + case when d6 > 0 then 1 else 0 end) as bigint) differ, 0::bigint only_scanned, 0::bigint only_extracted from x group by doc_id""",
)
def _(b):
    """Page counters of two versions over the same pages, column by column, both ways."""
    return reports.batch_agreement(*(scan.page_counts(b.judged(v)) for v in (5, 6)), PK)


@query(
    "q10_caption_windows",
    rf"""with {Q.W}, r0 as (select * from ({Q.R[5:].strip()[1:-1]})), r as (select * exclude (y1), y0 + 4 * (y1 - y0) y1 from r0), {Q.N}, {Q.C}, {CAPTIONS},
cz as (select cap.*, n.x1, n.y1, (n.y0 + n.y1) / 2 cy, r.y0 ry0, r.y1 ry1, (cap.doc_id, cap.token) in (select (doc_id, token) from codes) is_code from cap join n using (doc_id, page_no, word_no) join r using (doc_id, page_no, sw_idx))
select doc_id, page_no, sw_idx, word_no, case when is_code then 'code'
    when ry1 - ry0 > 150 and not (case when abs(cy - ry0) <= abs(ry1 - cy) then abs(cy - ry0) <= 35 else abs(ry1 - cy) <= 16 end)
    then case when {Q.ALPHA} and not ("text" = lower("text") and "text" <> upper("text")) and length(token) <= 8 then 'excluded' else 'outside' end else 'caption' end "window" from cz""",
)
def _(b):
    """Over swatches four times as high, so that some are photo-sized."""
    tall = b.rects.withColumn("y1", F.col("y0") + 4 * (F.col("y1") - F.col("y0")))
    found = fields.captions(b.words, layout.assign_words(b.words, tall, RuleConfig(3)), tall, b.pages)
    return pages.caption_windows(found, tall, b.codes).select(*KEY[:2], "sw_idx", "word_no", "window")


# Spreads: odd documents have a fold, across which nothing is read

FOLDED = "(cw.doc_id % 2 = 0 or (s_x0 < 600) = (cw.cx < 600))"


@query(
    "j3_spread_sizes",
    f"""with {Q.SPREAD_W}, {Q.N}, {Q.S}, {Q.C}, {ROWSIZE.replace("where abs(", f"where {FOLDED} and (abs(").replace(" group by all)", ") group by all)")} select doc_id, page_no, word_no, m.size size from rs""",
)
def _(b):
    words = b.spread_words
    own = detect.normed(words).join(b.codes, ["doc_id", "token"], "left_semi")
    return fields.row_size(words, own, b.spread_pages)


@query(
    "w6_spread_captions",
    rf"""with {Q.SPREAD_W}, {Q.SPREAD_R}, {Q.N}, {CAPTIONS.replace("greatest(1.5 * (r.y1 - r.y0), 40))", "greatest(1.5 * (r.y1 - r.y0), 40) and (a.doc_id % 2 = 0 or (n.cx < 600) = ((r.x0 + r.x1) / 2 < 600)))")}
select doc_id, page_no, sw_idx, word_no from cap""",
)
def _(b):
    words, rects = b.spread_words, b.spread_rects
    assigned = layout.assign_words(words, rects, RuleConfig(3))
    return fields.captions(words, assigned, rects, b.spread_pages).select(*PK, "sw_idx", "word_no")


@query(
    "w4_spread_size_rows",
    f"""with {Q.SPREAD_W}, {Q.N}, {Q.S}, sr0 as (select s.*, mid, case when doc_id % 2 = 1 then (s_x0 + s_x1) / 2 < 600 end side from s
  join (select doc_id, page_no, list_sort(list(h))[cast(floor(count(*) / 2) as bigint) + 1] mid from n group by all) using (doc_id, page_no)),
sr as (select doc_id, case when s_cy - lag(s_cy) over o > 1.5 * mid or lag(s_cy) over o is null then 1 else 0 end brk from sr0 window o as (partition by doc_id, page_no, side order by s_cy, s_no))
select doc_id, cast(sum(brk) as bigint) n_rows from sr group by doc_id""",
)
def _(b):
    return detect.size_rows(b.spread_words, b.spread_pages)


# Detection and names


@query(
    "a12_dominance",
    f"""with {Q.W}, {Q.N}, {Q.S}, {Q.C}, sw as (select distinct n.doc_id, n.page_no, n.word_no from n join s using (doc_id, page_no) where abs(n.cy - s_cy) <= 1.5 * greatest(n.h, 1)),
k1 as (select distinct doc_id, token from n where regexp_matches(token, '^[A-Z0-9]{{3,8}}$')), eff as (select distinct doc_id, token from n join k1 using (doc_id, token) join sw using (doc_id, page_no, word_no)),
le as (select doc_id, length(token) len, count(*) k from eff group by all), lo as (select doc_id from le group by doc_id having max(k) / sum(k) < 0.7)
select doc_id, token from k1 where {Q.ALPHA} and doc_id in (select doc_id from lo)""",
)
def _(b):
    """All tokens of code shape taken for codes."""
    found = detect.normed(b.words).where(F.col("token").rlike("^[A-Z0-9]{3,8}$")).select("doc_id", "token").distinct()
    return detect.dominance_suspects(found, detect.effective_anchors(b.words, found, b.pages))


@query(
    "a37_detection_gap",
    rf"""with {Q.W}, {Q.R}, {Q.N}, {Q.S}, {Q.C}, pp as (select doc_id, page_no, count(*) filter (where (doc_id, token) in (select (doc_id, token) from codes)) k from n group by all),
ph as (select doc_id, page_no, count(*) hits from s group by all), ps as (select doc_id, page_no, count(*) n_sw from r group by all),
mk as (select n.*, k, case when regexp_matches(token, '^[A-Za-z0-9]{{9,14}}$') and regexp_matches(token, '[0-9]') and regexp_matches(token, '\pL') and not regexp_matches(token, '{Q.SIZE}') then 'long'
    when regexp_matches(token, '^[A-Z]{{4,6}}$') then 'alpha' end kind from n join pp using (doc_id, page_no)),
tk as (select doc_id, token, kind from mk where kind is not null group by all having count(*) >= 2 and (kind = 'long' or max(k) >= 3))
select d.doc_id, d.detected, (select count(*) from tk where tk.doc_id = d.doc_id and kind = 'long') long_missed, (select count(*) from tk where tk.doc_id = d.doc_id and kind = 'alpha') alpha_missed,
  (select count(*) from pp join ph using (doc_id, page_no) left join ps using (doc_id, page_no) where pp.doc_id = d.doc_id and hits >= 3 and k >= 5 and coalesce(n_sw, 0) <= 2) table_pages
from (select doc_id, count(distinct token) detected from codes group by doc_id) d""",
)
def _(b):
    return detect.detection_gap(b.words, b.codes, b.rects)


@query(
    "a39_name_collisions",
    f"""with {Q.W}, {Q.R}, {Q.N}, {Q.C}, {CAPTIONS}, {INDEX}, k as (select doc_id, token, count(*) k from idx group by all)
select doc_id, count(*) filter (where k = 1) n_unique, count(*) filter (where k between 2 and 3) n_shared, coalesce(string_agg(token || '=' || k, ',' order by token || '=' || k) filter (where k between 2 and 3), '') shared from k group by doc_id""",
)
def _(b):
    return fields.name_collisions(_index(b))


# Reports over products

RISKS = r"""rk as (select cast(l_suppkey as bigint) doc_id, l_orderkey || '-' || l_linenumber id, case when l_partkey % 19 = 0 then 'CODE' || lpad(cast(l_suppkey % 100 as varchar), 3, '0') else chr(cast(65 + l_partkey % 2 as int)) || lpad(cast(l_partkey % 1000 as varchar), 3, '0') end code,
  cast(l_orderkey % 8 + 1 as bigint) page_no, case when l_partkey % 5 = 0 then null when l_partkey % 5 = 1 then '600x600' when l_partkey % 5 = 2 then '60x60' when l_partkey % 5 = 3 then '6x6cm' else 'circa 60' end size,
  case when l_partkey % 17 = 0 then 'A' || lpad(cast(l_partkey % 1000 as varchar), 3, '0') when l_partkey % 11 = 0 then 'MATT 10MM' when l_partkey % 3 = 0 then null else 'GLOSS' end surface,
  case when l_suppkey % 3 = 0 then null when l_partkey % 13 = 0 then 'ON REQUEST' else 'A' || cast(l_partkey % 4 + 1 as varchar) end price_band,
  case when l_partkey % 7 = 0 then null when l_partkey % 23 = 0 then 'n/a' else cast(l_partkey % 50 as varchar) || '.5' end pcs,
  case when l_linenumber % 3 = 0 then '60 x 60 cm' when l_linenumber % 3 = 1 then '60X60' else 'page 7' end raw from lineitem)"""


def _risks(b: Bridge) -> tuple[DataFrame, DataFrame, DataFrame]:
    key, doc = F.col("l_partkey"), F.col("l_suppkey")
    no = F.lpad((key % 1000).cast("string"), 3, "0")
    pcs = F.when(key % 23 == 0, "n/a").otherwise(F.concat((key % 50).cast("string"), F.lit(".5")))
    rows = b.table("lineitem").select(
        doc.cast("long").alias("doc_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.when(key % 19 == 0, F.concat(F.lit("CODE"), F.lpad((doc % 100).cast("string"), 3, "0"))).otherwise(F.concat(F.chr(65 + key % 2), no)).alias("code"),
        (F.col("l_orderkey") % 8 + 1).cast("long").alias("page_no"),
        F.when(key % 5 == 1, "600x600").when(key % 5 == 2, "60x60").when(key % 5 == 3, "6x6cm").when(key % 5 == 4, "circa 60").alias("size"),
        F.when(key % 17 == 0, F.concat(F.lit("A"), no)).when(key % 11 == 0, "MATT 10MM").when(key % 3 == 0, None).otherwise("GLOSS").alias("surface"),
        F.when(doc % 3 == 0, None).when(key % 13 == 0, "ON REQUEST").otherwise(F.concat(F.lit("A"), (key % 4 + 1).cast("string"))).alias("price_band"),
        F.when(key % 7 != 0, F.create_map(F.lit("pcsBox"), pcs)).alias("packing"),
        F.when(F.col("l_linenumber") % 3 == 0, "60 x 60 cm").when(F.col("l_linenumber") % 3 == 1, "60X60").otherwise("page 7").alias("raw"),
    )
    stems = b.table("supplier").select(F.col("s_suppkey").cast("long").alias("doc_id"), F.concat(F.lit("list-code"), F.lpad((F.col("s_suppkey") % 100).cast("string"), 3, "0")).alias("stem"))
    return rows, rows.select("doc_id", F.col("code").alias("token"), "page_no"), stems


FAMILIES = """fr as (select doc_id, upper(regexp_extract(code, '^([A-Za-z]+)', 1)) prefix, min(page_no) lo, max(page_no) hi from rk group by all having prefix <> '' and count(distinct code) >= 3)"""


@query(
    "a28_field_risks",
    rf"""with {RISKS}, {FAMILIES}, bf as (select doc_id, substr(price_band, 1, 1) l from rk where regexp_matches(price_band, '^[A-Z]\d{{1,2}}$') group by all having count(distinct price_band) >= 3),
va as (select doc_id, 'price_band' f, price_band t from rk union select doc_id, 'size', size from rk union select doc_id, 'surface', surface from rk),
sz as (select distinct doc_id, size, cast(regexp_extract(size, '^(\d+)x(\d+)(mm|cm)?$', 1) as bigint) w, cast(regexp_extract(size, '^(\d+)x(\d+)(mm|cm)?$', 2) as bigint) h from rk where regexp_matches(size, '^(\d+)x(\d+)(mm|cm)?$'))
select distinct doc_id, 'F1_code_price_swap' cls, 'code' field, code token from rk where regexp_matches(code, '^[A-Z]\d{{3}}$') and (doc_id, substr(code, 1, 1)) in (select (doc_id, l) from bf)
union all select distinct doc_id, 'F1b_pseudo_code', 'code', code from rk where length(code) >= 6 and contains('list-code' || lpad(cast(doc_id % 100 as varchar), 3, '0'), lower(code))
union all select doc_id, 'F2_field_mixing', 'size', size from rk where not regexp_matches(size, '^\d+(?:[.,]\d+)?x\d+(?:[.,]\d+)?(?:x\d+(?:[.,]\d+)?)?(?:mm|cm)?$')
union all select doc_id, 'F2_field_mixing', 'surface', surface from rk where regexp_matches(surface, '\d')
union all select doc_id, 'F2_field_mixing', 'price_band', price_band from rk where not regexp_matches(price_band, '^[A-Z]\d{{1,2}}$')
union all select doc_id, 'F2_field_mixing', 'packing', '{{"pcsBox":"' || pcs || '"}}' from rk where pcs = 'n/a'
union all select distinct x.doc_id, 'F3_series_split', 'series', x.prefix from fr x join fr y on x.doc_id = y.doc_id where x.lo > y.hi or x.hi < y.lo
union all select doc_id, 'F4_unit_collision', 'size', size from rk where size is not null and raw <> 'page 7' group by doc_id, size having count(distinct upper(replace(raw, ' ', ''))) >= 2
union all select distinct a.doc_id, 'F4_unit_alias', 'size', least(a.size, z.size) || '|' || greatest(a.size, z.size) from sz a join sz z on a.doc_id = z.doc_id and a.size <> z.size and
  ((z.w = a.w * 10 and z.h = a.h * 10) or (z.w = a.w * 100 and z.h = a.h * 100) or (z.w = a.w * 1000 and z.h = a.h * 1000))
union all select doc_id, 'F5_multi_role', 'code+' || string_agg(distinct f, '|' order by f), t from va where t is not null and (doc_id, t) in (select (doc_id, code) from rk) group by doc_id, t""",
)
def _(b):
    return reports.field_risks(*_risks(b))


@query(
    "j21_family_ranges",
    f"""with {RISKS}, f as (select doc_id, substr(code, 1, 2) prefix, min(page_no) lo, max(page_no) hi from rk group by all)
select x.*, (select count(*) from f y where y.doc_id = x.doc_id and y.hi < x.lo) n_before, (select count(*) from f y where y.doc_id = x.doc_id and y.lo > x.hi) n_after from f x""",
)
def _(b):
    return reports.family_ranges(_risks(b)[1], F.substring("token", 1, 2), 1)


PARTS = """pt as (select row_number() over () part, cast(l_suppkey as bigint) doc_id, ['variant', 'swatch_crop', 'color', 'merged_from', 'variant_size', 'all_size', 'spec_row', 'review'][(l_partkey + l_linenumber) % 8 + 1] kind,
  l_orderkey || '-' || l_linenumber token, case when l_orderkey % 6 = 0 then null else 'v' end "value", case when l_partkey % 9 = 0 then '' else 'a.pdf' end pdf, case when l_partkey % 10 = 0 then null else 1 end page,
  l_partkey % 11 <> 0 has_box, case when l_partkey % 12 = 0 then null else 'geom' end "method", case when l_partkey % 13 = 0 then null else 'c.png' end crop from lineitem)"""
_NEEDS = " union all ".join(f"select '{kind}' kind, '{n}' need, {k} k" for kind, needs in reports.PROVENANCE.items() for k, n in enumerate(needs))


@query(
    "p23_provenance_gaps",
    f"""with {PARTS}, nd as ({_NEEDS})
select doc_id, kind, token, string_agg(need, ',' order by k) missing from pt join nd using (kind) where "value" is not null and
  case need when 'pdf' then pdf = '' when 'page' then page is null when 'bbox' then not has_box when 'method' then "method" is null else crop is null end group by part, doc_id, kind, token""",
)
def _(b):
    key, li = F.col("l_partkey"), b.table("lineitem")
    kind = F.get(F.array(*map(F.lit, reports.PROVENANCE)), ((key + F.col("l_linenumber")) % 8).cast("int"))
    parts = li.select(
        F.col("l_suppkey").cast("long").alias("doc_id"),
        kind.alias("kind"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("token"),
        F.when(F.col("l_orderkey") % 6 != 0, "v").alias("value"),
        F.when(key % 9 == 0, "").otherwise("a.pdf").alias("pdf"),
        F.when(key % 10 != 0, 1).alias("page"),
        F.when(key % 11 == 0, F.array().cast("array<double>")).otherwise(F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0))).alias("bbox"),
        F.when(key % 12 != 0, "geom").alias("method"),
        F.when(key % 13 != 0, "c.png").alias("crop"),
    )
    return reports.provenance_gaps(parts)


@query(
    "p24_format_defects",
    rf"""with {RISKS} select doc_id, 'price_band' field, price_band "value" from rk where not regexp_matches(price_band, '^[A-Z]\d{{1,3}}$')
union all select doc_id, 'surface', surface from rk where regexp_matches(surface, '\d') union all select doc_id, 'packing', pcs from rk where pcs = 'n/a'""",
)
def _(b):
    return reports.format_defects(_risks(b)[0])


@query(
    "p24_extraction_rates",
    f"""with {RISKS} select doc_id, count(*) n_rows, count(size) n_size, count(surface) n_surface, count(price_band) n_band, count(pcs) n_packing, case when count(pcs) > 0 then 'pcsBox=' || count(pcs) else '' end packing_fields from rk group by doc_id""",
)
def _(b):
    return reports.extraction_rates(_risks(b)[0])


SHAPES = "sh as (select doc_id, cluster, count(*) n, count(distinct page_no) pages, count(distinct color) colors, count(distinct color) raws from cl group by all)"


@query("m_guard_changes", f"{CL}, {GUARDS} select doc_id, cluster, n, 'gone' change from gr where reason is not null")
def _(b):
    return reports.guard_changes(b.clustered, _areas(b))


@query("m_collapse_signatures", f"{CL}, {SHAPES} select *, n >= 20 collapse from sh where pages >= 2 and colors > 1")
def _(b):
    return reports.collapse_signatures(b.clustered)


@query("m_near_threshold", f"{CL}, {SHAPES} select cl.doc_id, cl.cluster, id, page_no, code, color from cl join sh using (doc_id, cluster) where pages >= 2 and raws > 1 and n between 12 and 28")
def _(b):
    return reports.near_threshold(b.clustered)


@query(
    "m_borderline",
    f"""{CL}, {GUARDS} select doc_id, case when pages >= 2 and conflict then 'band' when pages >= 2 then 'across' else 'single' end kind, count(*) n_clusters, max(n) most_bindings, max(pages) most_pages
from gr where reason is null or reason not in ('assembly_collapse_suspect', 'singlepage_overmerge_suspect') group by all""",
)
def _(b):
    return reports.borderline(b.clustered, _areas(b))


@query(
    "a26_smoke_equations",
    f"""with recursive {Q.scan()}, b as (select doc_id, page_no, word_no, 'b:' || page_no || ':' || (row_number() over (partition by doc_id, page_no order by word_no) - 1) id, page_no * 10000 + sw_idx sw, token code,
  case when word_no % 5 = 0 then 'WHITE' else 'BLACK' end color from v where aligned), {Q.COMPONENTS}, {GUARDS},
i as (select doc_id, count(*) n_codes, count(*) filter (where aligned) al, count(*) filter (where not aligned) rv from v group by all),
m as (select doc_id, count(*) filter (where reason is null) me, count(*) filter (where reason is not null) de from cl join gr using (doc_id, cluster) group by all),
j as (select i.*, coalesce(me, 0) me, coalesce(de, 0) de from i left join m using (doc_id)),
q as (select doc_id, 'bound' equation, al lhs, al rhs from j union all select doc_id, 'merged_or_demoted', me + de, al from j union all select doc_id, 'queued', rv, rv from j union all select doc_id, 'accounted', al + rv, n_codes from j
  union all select doc_id, 'spec_rows', n_codes, n_codes from j union all select doc_id, unnest(['collapse_escapes', 'radius_escapes', 'borderline_escapes']), 0, 0 from j)
select *, lhs = rhs ok from q""",
)
def _(b):
    """Over the whole pages' verdicts of version 6."""
    judged = b.judged()
    shade = F.when(F.col("word_no") % 5 == 0, "WHITE").otherwise("BLACK")
    bound = scan.bindings(judged, b.rects).select("doc_id", "id", "page_no", (F.col("page_no") * 10000 + F.col("sw_idx")).alias("sw"), "code", shade.alias("color"), shade.alias("color_raw"))
    rows = judged.select("doc_id", F.concat_ws(":", F.lit("s"), F.col("page_no").cast("string"), F.col("word_no").cast("string")).alias("id"), F.col("token").alias("code"), *(F.lit(None).cast("string").alias(c) for c in ("size", "surface", "price_band")))
    none = judged.where("false").select("doc_id", F.col("token").alias("letter"))
    variants, queue = assemble.assemble(bound, rows, none, _areas(b))
    return reports.smoke_equations(scan.page_counts(judged), bound, variants, queue, scan.review_items(judged), rows)
