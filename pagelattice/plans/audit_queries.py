"""Registered queries of assembly, audits, inventory and set operations, with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import RuleConfig
from pagelattice.functions import geometry as G
from pagelattice.functions import tokens as T
from pagelattice.operators import assemble, audit, detect, emit, layout, scan

from . import layout_sql as Q
from .queries import KEY, PK, STATES, WNC, WNS, Bridge, query

CL = f"with recursive {Q.DENSE}, {Q.COMPONENTS}"

#: The same without the bindings of bridge codes, which go to the queue before anything is merged.
BRIDGED = f"""with recursive {Q.DENSE.replace("b as (", "b0 as (")}, {Q.C}, pl as (select distinct doc_id, sw, code from b0), hd as (select doc_id, sw, list(distinct code) cs from pl group by all),
ow as (select pl.*, cs from pl join hd using (doc_id, sw) where (doc_id, substr(code, 1, 1)) in (select (doc_id, substr(token, 1, 1)) from routed where bucket = 'band')),
en as (select doc_id, code from ow group by all having count(*) >= 2 and count(*) filter (where len(cs) > 1) >= 2),
bc as (select distinct x.doc_id, x.code from ow x join ow y on x.doc_id = y.doc_id and x.code = y.code and x.sw < y.sw
  where (x.doc_id, x.code) in (select (doc_id, code) from en) and len(list_intersect(x.cs, y.cs)) = 1),
b as (select b0.* from b0 left join bc using (doc_id, code) where bc.code is null), {Q.COMPONENTS}"""

# Assembly


@query("a17_components", f"{CL} select doc_id, id, sw, code, cluster from cl")
def _(b):
    return b.clustered.select("doc_id", "id", "sw", "code", "cluster")


AREAS = "ar as (select doc_id, page_no * 10000 + sw_idx sw, 100 * (x1 - x0) * (y1 - y0) / 480000 area_pct from r)"
GUARDS = f"""{AREAS}, st as (select cl.doc_id, cluster, count(*) n, count(distinct page_no) pages, count(distinct color) > 1 conflict, max(area_pct) area_pct
  from cl join ar using (doc_id, sw) group by all),
gr as (select *, case when n >= 20 and pages >= 2 and conflict then 'assembly_collapse_suspect' when n >= 20 and pages = 1 and area_pct >= 5 then 'singlepage_overmerge_suspect'
    when n < 20 and pages >= 2 and conflict and n >= 18 then 'borderline_merge_suspect' when pages >= 2 and (pages > 5 or n > 24) then 'assembly_merge_radius_suspect' end reason from st)"""


def _areas(b: Bridge) -> DataFrame:
    return b.rects.select("doc_id", (F.col("page_no") * 10000 + F.col("sw_idx")).alias("sw"), (100 * G.area() / 480000).alias("area_pct"))


@query("a18_a24_guards", f"{CL}, {GUARDS} select doc_id, cluster, n, pages, conflict, area_pct, reason from gr")
def _(b):
    return assemble.guard_reasons(b.clustered, _areas(b))


@query(
    "a34_cluster_kinds",
    f"""{CL}, {GUARDS} select doc_id, cluster, case when n >= 20 and pages >= 2 and conflict then 'collapse' when n >= 20 and pages = 1 and area_pct >= 5 then 'overmerge'
  when n >= 20 then 'unguarded' when n >= 18 then 'grey' else 'small' end kind from st""",
)
def _(b):
    stats = assemble.guard_reasons(b.clustered, _areas(b))
    return stats.select("doc_id", "cluster", audit.cluster_kind(stats).alias("kind"))


@query(
    "a19_bridge_codes",
    f"""with {Q.DENSE}, pl as (select distinct doc_id, sw, code from b), hd as (select doc_id, sw, list(distinct code) cs from pl group by all),
ow as (select pl.*, cs from pl join hd using (doc_id, sw) where substr(code, 1, 1) in ('A', 'B')),
en as (select doc_id, code from ow group by all having count(*) >= 2 and count(*) filter (where len(cs) > 1) >= 2)
select distinct x.doc_id, x.code from ow x join ow y on x.doc_id = y.doc_id and x.code = y.code and x.sw < y.sw
where (x.doc_id, x.code) in (select (doc_id, code) from en) and len(list_intersect(x.cs, y.cs)) = 1""",
)
def _(b):
    bound = b.dense
    letters = bound.select("doc_id").distinct().withColumn("letter", F.explode(F.array(F.lit("A"), F.lit("B"))))
    return assemble.bridge_codes(bound, letters)


SPEC = """sr as (select doc_id, id, page_no, code, case when word_no % 6 = 0 then null else cast(30 * (1 + word_no % 3) as varchar) || 'x60' end size,
  case when word_no % 4 = 0 then 'MATT' else 'GLOSS' end surface, case when word_no % 9 = 0 then '' else 'T31' end price_band from b)"""
REGIME = """cc as (select distinct doc_id, cluster, code from cl),
rg as (select doc_id, cluster, count(*) n_codes, coalesce(max(k), 0) most_sizes from cc left join (select doc_id, code, count(distinct size) k from sr group by all) using (doc_id, code) group by all),
re as (select *, case when n_codes = 1 and most_sizes >= 2 then 'B' else 'A' end regime from rg)"""


@query("a21_regimes", f"{CL}, {SPEC}, {REGIME} select *, n_codes > 1 and most_sizes >= 2 regime_conflict from re")
def _(b):
    return assemble.regimes(b.clustered, b.spec_rows)


@query(
    "a20_a22_variant_sizes",
    f"""{CL}, {SPEC}, {REGIME}, rw as (select cc.doc_id, cc.cluster, cc.code, surface, price_band, regime,
    coalesce(size, min(size) over (partition by cc.doc_id, cc.cluster, cc.code)) size from cc join sr using (doc_id, code) join re using (doc_id, cluster))
select doc_id, cluster, size, case when regime = 'A' then code end order_code, case when count(distinct nullif(surface, '')) = 1 then max(nullif(surface, '')) end surface,
  case when count(distinct nullif(price_band, '')) = 1 then max(nullif(price_band, '')) end price_band, count(*) claims from rw group by all""",
)
def _(b):
    return assemble.variant_sizes(b.clustered, b.spec_rows)


@query(
    "a23_colors",
    f"{CL} select doc_id, cluster, case when count(distinct color) = 1 then max(color) end color, count(distinct color) > 1 color_conflict from cl group by all",
)
def _(b):
    return assemble.colors(b.clustered)


@query(
    "a25_unmerged_colors",
    f"""{CL}, co as (select doc_id, cluster, case when count(distinct color) = 1 then max(color) end color from cl group by all)
select doc_id, cast(sum(n - 1) as bigint) same_color_unmerged from (select doc_id, color, count(*) n from co where color is not null group by all having count(*) > 1) group by doc_id""",
)
def _(b):
    return assemble.unmerged_colors(assemble.colors(b.clustered))


@query("a27_all_sizes", f"with {Q.DENSE}, {SPEC} select doc_id, size, min({{'p': page_no, 'i': id}}).p page_no from sr where size is not null group by all")
def _(b):
    return assemble.all_sizes(b.spec_rows)


@query(
    "a26_q3_conservation",
    f"""{BRIDGED}, {GUARDS}, me as (select doc_id, count(*) n from cl join gr using (doc_id, cluster) where reason is null group by all),
de as (select doc_id, count(*) n from (select doc_id, id from cl join gr using (doc_id, cluster) where reason is not null union all select doc_id, id from b0 join bc using (doc_id, code)) group by all),
i as (select doc_id, count(*) n_in from b0 group by all)
select doc_id, n_in, coalesce(me.n, 0) n_merged, coalesce(de.n, 0) n_demoted, n_in = coalesce(me.n, 0) + coalesce(de.n, 0) ok from i left join me using (doc_id) left join de using (doc_id)""",
)
def _(b):
    bound = b.dense
    variants, queue = assemble.assemble(bound, b.spec_rows, b.band_letters, _areas(b))
    return assemble.conservation(bound, variants, queue)


# Diffs

COUNTS = """pc as (select doc_id, page_no, count(*) n_codes, count(*) filter (where aligned) x_aligned, count(*) filter (where sw_idx is null) orphan from v group by all)"""


@query(
    "j14_golden_diff",
    f"""with {Q.scan()}, {COUNTS}, old as (select doc_id, page_no, n_codes + (case when page_no = 3 then 1 else 0 end) n_codes, case when doc_id % 7 = 0 then 0 else x_aligned end x_aligned, orphan
  from pc where doc_id % 10 <> 1 union all select doc_id + 100000, page_no, n_codes, x_aligned, orphan from pc where doc_id % 25 = 2),
j as (select doc_id, page_no, o.n_codes a1, p.n_codes b1, o.x_aligned a2, p.x_aligned b2, o.orphan a3, p.orphan b3, o.n_codes is null lo, p.n_codes is null lp from old o full join pc p using (doc_id, page_no))
select doc_id, page_no, 'extra' cell, null::varchar was, null::varchar now from j where lo union all select doc_id, page_no, 'missing', null, null from j where lp
union all select doc_id, page_no, 'n_codes', a1::varchar, b1::varchar from j where not lo and not lp and a1 is distinct from b1
union all select doc_id, page_no, 'x_aligned', a2::varchar, b2::varchar from j where not lo and not lp and a2 is distinct from b2
union all select doc_id, page_no, 'orphan', a3::varchar, b3::varchar from j where not lo and not lp and a3 is distinct from b3""",
)
def _(b):
    now = b.judged().groupBy(*PK).agg(
        F.count(F.lit(1)).alias("n_codes"), F.count_if("aligned").alias("x_aligned"), F.count_if(F.col("sw_idx").isNull()).alias("orphan")
    )
    changed = now.where("doc_id % 10 <> 1").select(
        *PK,
        (F.col("n_codes") + (F.col("page_no") == 3).cast("long")).alias("n_codes"),
        F.when(F.col("doc_id") % 7 == 0, 0).otherwise(F.col("x_aligned")).alias("x_aligned"),
        "orphan",
    )
    frozen = changed.unionByName(now.where("doc_id % 25 = 2").withColumn("doc_id", F.col("doc_id") + 100000))
    return audit.golden_diff(now, frozen, PK, ["n_codes", "x_aligned", "orphan"])


TREES = """va as (select doc_id, string_agg(id, ',' order by id) ids, case when count(distinct code) = 1 then max(code) end code, case when count(distinct color) = 1 then max(color) end color, count(distinct page_no) pages from cl group by doc_id, cluster),
v1 as (select * from va where doc_id % 5 <> 0), v2 as (select doc_id, ids, code, case when doc_id % 4 = 0 then 'RED' else color end color, pages from va where doc_id % 6 <> 0),
jj as (select doc_id, ids, x.pages pa, y.pages pb, x.ids is null na, y.ids is null nb, (x.code is distinct from y.code or x.color is distinct from y.color) df
  from (select *, ids i2 from v1) x full join (select *, ids i2 from v2) y using (doc_id, ids))"""


def _trees(b: Bridge) -> tuple[DataFrame, DataFrame]:
    def one(c: str):
        return F.when(F.count_distinct(c) == 1, F.max(c)).alias(c)

    va = b.clustered.groupBy("doc_id", "cluster").agg(
        F.collect_list("id").alias("merged_from"), one("code"), one("color"), F.count_distinct("page_no").alias("pages")
    )
    recoloured = va.withColumn("color", F.when(F.col("doc_id") % 4 == 0, "RED").otherwise(F.col("color")))
    return va.where("doc_id % 5 <> 0"), recoloured.where("doc_id % 6 <> 0")


@query(
    "j15_tree_diff",
    f"""{CL}, {TREES} select doc_id, ids, 'new' change from jj where pa is null union all select doc_id, ids, 'disappeared' from jj where pb is null
union all select doc_id, ids, 'cross_page_new' from jj where pa is null and pb > 1 union all select doc_id, ids, 'cross_page_gone' from jj where pb is null and pa > 1
union all select doc_id, ids, 'value' from jj where pa is not null and pb is not null and df""",
)
def _(b):
    return audit.tree_diff(*_trees(b))


@query(
    "u1_u2_u4_version_diff",
    f"""{WNC} select doc_id, token, 'gone' change from (select doc_id, token from cand except select doc_id, token from codes)
union all select doc_id, token, 'new' from (select doc_id, token from codes except select doc_id, token from cand)""",
)
def _(b):
    """Codes of version 3, which routes nothing, against those of version 7."""
    kept = (detect.detect_codes(b.words, b.pages, rules=RuleConfig(v)).where("bucket = 'kept'").select("doc_id", "token") for v in (3, 7))
    return audit.set_diff(*kept)


@query("u5_disjoint", f"{WNC} select count(*) n from (select doc_id, token from codes intersect select doc_id, token from routed where bucket = 'band')")
def _(b):
    banded = b.routed.where("bucket = 'band'").select("doc_id", "token")
    return b.codes.intersect(banded).agg(F.count(F.lit(1)).alias("n"))


@query("u7_coverage", f"with {STATES} select state, count(*) pages, cast(sum(count(*)) over () as bigint) = (select count(*) from every) covered from st group by state")
def _(b):
    """Pages by state; every page has one."""
    every = b.every_page.agg(F.count(F.lit(1))).scalar()
    return b.states.groupBy("state").agg(F.count(F.lit(1)).alias("pages")).withColumn("covered", F.sum("pages").over(Window.partitionBy(F.lit(1))) == every)


# Overlaps

IX = "greatest(least(a.x1, z.x1) - greatest(a.x0, z.x0), 0) * greatest(least(a.y1, z.y1) - greatest(a.y0, z.y0), 0)"


@query(
    "j16_iou_pairs",
    f"""with {Q.W}, p as (select a.doc_id, a.page_no, a.word_no a, z.word_no b, {IX} i, (a.x1-a.x0)*(a.y1-a.y0) + (z.x1-z.x0)*(z.y1-z.y0) u
  from w a join w z on a.doc_id = z.doc_id and a.page_no = z.page_no and a.word_no < z.word_no)
select doc_id, page_no, a, b, i / (u - i) iou from p where i > 0 and i / (u - i) >= 0.25""",
)
def _(b):
    """Words printed over each other."""
    return audit.overlapping(b.words, PK, "word_no", RuleConfig(iou=0.25))


@query(
    "j17_covered_words",
    f"""with {Q.W}, {Q.R} select r.doc_id, r.page_no, r.sw_idx, min(a.word_no) word_no from w a join r using (doc_id, page_no)
where {IX.replace("z.", "r.")} / ((a.x1-a.x0)*(a.y1-a.y0)) >= 0.6 group by all""",
)
def _(b):
    return audit.covered_words(b.words, b.rects, PK, "sw_idx")


@query(
    "j18_unclaimed",
    f"""with {Q.scan()}, cl as (select distinct r.* from r join v using (doc_id, page_no, sw_idx) where aligned)
select a.doc_id, a.page_no, a.sw_idx from r a where not exists (select 1 from cl z where z.doc_id = a.doc_id and z.page_no = a.page_no and {IX} / ((a.x1-a.x0)*(a.y1-a.y0)) > 0.3)""",
)
def _(b):
    bound = b.rects.join(b.judged().where("aligned").select(*PK, "sw_idx").distinct(), [*PK, "sw_idx"], "left_semi")
    return audit.unclaimed(b.rects, bound, PK, "sw_idx")


@query(
    "j19_sizes_near",
    f"""with {Q.W}, {Q.R}, {Q.N}, {Q.S} select distinct r.doc_id, r.page_no, r.sw_idx from r join s using (doc_id, page_no)
where s_cy - r.y1 between -0.3 * (r.y1 - r.y0) and 1.2 * (r.y1 - r.y0) and abs((s_x0 + s_x1) / 2 - (r.x0 + r.x1) / 2) <= greatest(60, r.x1 - r.x0)""",
)
def _(b):
    return audit.sizes_near(b.rects, detect.page_sizes(b.words), PK, "sw_idx")


@query(
    "j22_text_inside",
    f"""with {Q.W}, {Q.R}, {Q.N} select r.doc_id, r.page_no, r.sw_idx, string_agg("text", ' ' order by word_no) raw from r join n using (doc_id, page_no)
where cx between r.x0 - 1 and r.x1 + 1 and cy between r.y0 - 1 and r.y1 + 1 group by all""",
)
def _(b):
    return audit.text_inside(b.words, b.rects, PK, "sw_idx")


@query(
    "a38_caption_signal",
    f"""with {Q.W}, {Q.R}, {Q.N}, {Q.assign(2)} select doc_id, page_no, count(distinct sw_idx) only_above from a z where rule = 'above'
  and not exists (select 1 from a y where y.doc_id = z.doc_id and y.page_no = z.page_no and y.sw_idx = z.sw_idx and y.rule = 'below') group by all""",
)
def _(b):
    found = layout.assign_words(b.words, b.rects, RuleConfig(2))
    key = [*PK, "sw_idx"]
    above = found.where("rule = 'above'").select(*key).distinct().join(found.where("rule = 'below'").select(*key), key, "left_anti")
    return above.groupBy(*PK).agg(F.count(F.lit(1)).alias("only_above"))


@query(
    "a39_small_winners",
    f"""with {Q.scan()}, u as (select doc_id, page_no, sw_idx, count(distinct token) n_tokens from v where aligned or demoted group by all)
select u.*, repeated, icon from u join icon using (doc_id, page_no, sw_idx) where area < 0.5 * median_area or n_tokens between 2 and 3""",
)
def _(b):
    won = b.judged().where("aligned or demoted").groupBy(*PK, "sw_idx").agg(F.count_distinct("token").alias("n_tokens"))
    context = layout.icon_context(b.rects, b.pages, RuleConfig(6))
    found = won.join(context, [*PK, "sw_idx"]).where("area < 0.5 * median_area or n_tokens between 2 and 3")
    return found.select(*PK, "sw_idx", "n_tokens", "repeated", "icon")


# Families, lifecycle, inventory


@query(
    "j20_scale_aliases",
    """with z as (select distinct cast(p_partkey % 7 as bigint) doc_id, w, h, w || 'x' || h size from (select p_partkey, p_size * (case when p_partkey % 3 = 0 then 10 else 1 end) w,
  p_size * (case when p_partkey % 3 = 0 then 10 else 1 end) * 2 h from part))
select distinct a.doc_id, a.size small, b.size "large" from z a join z b on a.doc_id = b.doc_id and ((b.w = a.w * 10 and b.h = a.h * 10) or (b.w = a.w * 100 and b.h = a.h * 100))""",
)
def _(b):
    w = F.col("p_size") * F.when(F.col("p_partkey") % 3 == 0, 10).otherwise(1)
    sizes = b.table("part").select((F.col("p_partkey") % 7).cast("long").alias("doc_id"), w.alias("w"), (w * 2).alias("h"))
    return audit.scale_aliases(sizes.distinct().withColumn("size", F.concat_ws("x", F.col("w").cast("string"), F.col("h").cast("string"))))


@query(
    "a29_lifecycle",
    f"""with {Q.scan()}, de as (select distinct doc_id, token from cw), pr as (select distinct doc_id, token from v where aligned), rv as (select distinct doc_id, token from v where not aligned)
select doc_id, count(*) n_detected, count(*) filter (where (doc_id, token) not in (select (doc_id, token) from pr) and (doc_id, token) not in (select (doc_id, token) from rv)) vanished,
  (select count(*) from rv where rv.doc_id = de.doc_id and (rv.doc_id, rv.token) not in (select (doc_id, token) from de)) phantom,
  count(*) filter (where (doc_id, token) in (select (doc_id, token) from rv)) >= 0.9 * count(*) stuck from de group by doc_id""",
)
def _(b):
    judged = b.judged()
    return audit.lifecycle(b.code_words, judged.where("aligned"), judged.where("not aligned").select("doc_id", "token"))


@query(
    "a30_cross_version",
    f"""with {Q.DENSE}, {SPEC} select doc_id % 9 brand, code, count(distinct doc_id) n_docs, count(distinct size) n_sizes, count(distinct size) > 1 differs from sr group by all having count(distinct doc_id) >= 2""",
)
def _(b):
    return audit.cross_version(b.spec_rows.withColumn("brand", F.col("doc_id") % 9))


@query(
    "a31_duplicate_groups",
    """select md5("text") "hash", count(*) n, count(distinct source) owners from documents where "text" is not null group by 1 having count(distinct source) >= 2""",
)
def _(b):
    docs = b.table("documents").where("text is not null")
    return audit.duplicate_groups(docs.select(F.md5("text").alias("hash"), "source"), "hash", "source")


@query(
    "a32_fan_out",
    f"""with {Q.DENSE} select doc_id, 'sw' side, cast(sw as varchar) item, count(distinct code) n from b group by all having count(distinct code) >= 2
union all select doc_id, 'code', code, count(distinct sw) from b group by all having count(distinct sw) >= 2""",
)
def _(b):
    return audit.fan_out(b.dense, "sw", "code")


@query(
    "a33_escapes",
    f"""{CL}, {GUARDS} select count(*) filter (where reason is null) kept, count(*) filter (where reason is null and n >= 20 and pages >= 2 and conflict) collapse_escapes,
  count(*) filter (where reason is null and pages > 5) radius_escapes, count(*) filter (where reason is not null) demoted from gr""",
)
def _(b):
    g = assemble.guard_reasons(b.clustered, _areas(b))
    kept = F.col("reason").isNull()
    return g.agg(
        F.count_if(kept).alias("kept"),
        F.count_if(kept & (F.col("n") >= 20) & (F.col("pages") >= 2) & F.col("conflict")).alias("collapse_escapes"),
        F.count_if(kept & (F.col("pages") > 5)).alias("radius_escapes"),
        F.count_if(~kept).alias("demoted"),
    )


@query(
    "a35_largest_gap",
    f"""with {Q.R}, g as (select doc_id, (x1-x0)*(y1-y0) low, lead((x1-x0)*(y1-y0)) over (partition by doc_id order by (x1-x0)*(y1-y0)) high from r)
select doc_id, low, high, high - low gap from g where high is not null qualify row_number() over (partition by doc_id order by high - low desc, low) = 1""",
)
def _(b):
    return audit.largest_gap(b.rects.select("doc_id", G.area().alias("area")), "doc_id", "area")


@query(
    "s12_s13_a36_inventory",
    """with p as (select source, doc_id, md5("text") h from documents), f as (select source, h, min(doc_id) doc_id from p where h not in (select md5("text") from documents where doc_id % 10 = 0) group by all)
select source, min(doc_id) doc_id, count(*) "left" from f group by source""",
)
def _(b):
    pool = b.table("documents").select("source", "doc_id", F.md5("text").alias("h"))
    return audit.first_unused(pool, pool.where("doc_id % 10 = 0"), "source", "h", "doc_id")


FOOT = """ft as (select distinct doc_id, page_no, unnest([0, 1]) k from w),
fw as (select doc_id, page_no, word_no, x0, y0, x1, y1, "text" from w union all select doc_id, page_no, 900000 + k, 300.0 + 200 * k, 780.0, 312.0 + 200 * k, 790.0,
  cast((case when k = 0 or doc_id % 2 = 0 then page_no else page_no * 3 end) + 40 + doc_id % 3 + k * 500 as varchar) from ft),
nm as (select *, (y0 + y1) / 2 cy from fw where regexp_matches("text", '^[0-9]{1,4}$')),
bd as (select *, case when x0 - lag(x0) over o > 3 or lag(x0) over o is null then 1 else 0 end brk from nm where cy < 64 or cy > 736 window o as (partition by doc_id order by x0, page_no, word_no)),
ck as (select *, sum(brk) over (partition by doc_id order by x0, page_no, word_no rows unbounded preceding) cluster, cast("text" as bigint) - page_no off from bd),
fm as (select doc_id, cluster, off from ck group by all having count(distinct page_no) >= 5),
fi as (select ck.doc_id, page_no, word_no from ck join fm using (doc_id, cluster, off))"""


@query(
    "a40_page_foot",
    f"""with {Q.W}, {FOOT} select doc_id, "text" token from nm left join (select *, true f from fi) using (doc_id, page_no, word_no) group by all having bool_and(coalesce(f, false))""",
)
def _(b):
    """Pages with a running number at the foot, and another that runs on half of the documents only."""
    foot = b.pages.select(*PK, F.explode(F.array(F.struct(F.lit(900000).cast("long").alias("no"), F.lit(300.0).alias("x")), F.struct(F.lit(900001).cast("long").alias("no"), F.lit(500.0).alias("x")))).alias("f"))
    step = F.when((F.col("f.no") == 900000) | (F.col("doc_id") % 2 == 0), F.col("page_no")).otherwise(F.col("page_no") * 3)
    running = foot.select(
        *PK, F.col("f.no").alias("word_no"), F.col("f.x").alias("x0"), F.lit(780.0).alias("y0"), (F.col("f.x") + 12).alias("x1"), F.lit(790.0).alias("y1"), (step + 40 + F.col("doc_id") % 3 + F.col("f.no") % 900000 * 500).cast("string").alias("text")
    )
    return audit.page_foot_tokens(b.words.unionByName(running), b.pages)


@query(
    "a41_score",
    f"""with {Q.scan()}, tr as (select distinct on (doc_id, token) doc_id, token, sw_idx from v where aligned order by doc_id, token, page_no, word_no),
g as (select doc_id, token, count(*) n, min(sw_idx) got from v where aligned group by all)
select doc_id, token, coalesce(n = 1 and got = tr.sw_idx, false) hit from tr left join g using (doc_id, token)""",
)
def _(b):
    bound = b.judged().where("aligned")
    truth = bound.groupBy("doc_id", "token").agg(F.min(F.struct("page_no", "word_no", "sw_idx"))["sw_idx"].alias("sw_idx"))
    return audit.score(bound.select("doc_id", "token", "sw_idx"), truth, ["doc_id", "token"])


@query(
    "s8_code_sidecar",
    f"""{WNC} select doc_id, token, count(*) n, min({{'p': page_no, 'w': word_no}}).p first_page, string_agg(distinct cast(page_no as varchar), ',' order by cast(page_no as varchar)) pages from cw group by all""",
)
def _(b):
    pages = F.array_join(F.sort_array(F.collect_set(F.col("page_no").cast("string"))), ",")
    first = F.min(F.struct("page_no", "word_no"))["page_no"]
    return b.code_words.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"), first.alias("first_page"), pages.alias("pages"))


@query(
    "s3_census",
    f"""{WNS} select doc_id, count(distinct page_no) pages, count(*) words, (select count(*) from s where s.doc_id = n.doc_id) size_hits,
  (select count(*) from (select page_no from s where s.doc_id = n.doc_id group by page_no having count(*) >= 3)) spec_pages, count(*) filter (where {Q.CODE}) code_words from n group by doc_id""",
)
def _(b):
    w = detect.normed(b.words).withColumn("hits", T.size_hits(F.col("text")))
    per = w.groupBy(*PK).agg(F.count(F.lit(1)).alias("words"), F.sum("hits").alias("hits"), F.count_if(T.is_alnum_code(F.col("token"))).alias("codes"))
    return per.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("words").alias("words"),
        F.sum("hits").alias("size_hits"),
        F.count_if(F.col("hits") >= 3).alias("spec_pages"),
        F.sum("codes").alias("code_words"),
    )


@query(
    "w9_top_tokens",
    f"{WNC}, g as (select doc_id, token, count(*) n from cw group by all) select * from g qualify row_number() over (partition by doc_id order by n desc, token) <= 10",
)
def _(b):
    counted = b.code_words.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("doc_id").orderBy(F.desc("n"), "token")
    return counted.withColumn("r", F.row_number().over(best)).where("r <= 10").drop("r")


@query(
    "a42_two_per_corpus",
    """select source, doc_id from (select source, doc_id, row_number() over (partition by source order by md5('s' || doc_id), doc_id) k from documents) where k <= 2""",
)
def _(b):
    drawn = Window.partitionBy("source").orderBy(F.md5(F.concat(F.lit("s"), F.col("doc_id").cast("string"))), "doc_id")
    return b.table("documents").select("source", "doc_id", F.row_number().over(drawn).alias("k")).where("k <= 2").drop("k")


@query(
    "a12_cap_suspects",
    f"""with {Q.W}, {Q.N}, {Q.S}, {Q.C}, ct as (select doc_id, token, count(*) n from n group by all),
ef as (select distinct cw.doc_id, cw.token from cw join s using (doc_id, page_no) where abs(cy - s_cy) <= 1.5 * greatest(h, 1)),
md as (select doc_id, list_sort(list(n))[cast(floor(count(*) / 2) as bigint) + 1] mid from ef join ct using (doc_id, token) where doc_id % 3 <> 1 group by doc_id),
np as (select doc_id, count(distinct page_no) p from w group by doc_id)
select doc_id, token from ct join md using (doc_id) join np using (doc_id) where regexp_matches(token, '^[A-Z]{{3,8}}$') and token <> 'PROMO' and n >= greatest(2.0 * mid, least(0.6 * p, 5.0))""",
)
def _(b):
    """Every third document has no anchor; PROMO is a trade word."""
    w = detect.normed(b.words)
    codes = w.where(F.col("token").rlike("^[A-Z]{3,8}$")).select("doc_id", "token").distinct()
    trade = b.spark.createDataFrame([("PROMO",)], "token string")
    return detect.cap_suspects(codes, b.words, b.pages, b.codes.where("doc_id % 3 <> 1"), trade)


@query(
    "p23_provenance",
    f"""with {Q.scan()} select doc_id, count(*) n, count(*) filter (where sw_idx is null) no_swatch, count(*) filter (where r_x0 is null) no_box, count(*) filter (where token is null) no_code from v group by doc_id""",
)
def _(b):
    r = b.rects.select(*PK, "sw_idx", F.col("x0").alias("r_x0"))
    v = b.judged().join(r, [*PK, "sw_idx"], "left")
    return v.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(F.col(c).isNull()).alias(k) for c, k in (("sw_idx", "no_swatch"), ("r_x0", "no_box"), ("token", "no_code"))),
    )


@query(
    "p21_photo_level",
    f"with {Q.R} select doc_id, count(*) filter (where (x1-x0)*(y1-y0) >= 0.01 * 480000) photo, count(*) n from r group by doc_id",
)
def _(b):
    return b.rects.groupBy("doc_id").agg(F.count_if(G.area() >= 0.01 * 480000).alias("photo"), F.count(F.lit(1)).alias("n"))


@query(
    "j9_code_words",
    f"{WNC} select doc_id, page_no, word_no, token from cw",
)
def _(b):
    return b.code_words.select(*KEY, "token")


# Emission and the version ladder

GAP = """cod as (select distinct doc_id, page_no, sw_idx from v where sw_idx is not null),
gp as (select r.doc_id, r.page_no, count(*) n_sw, count(*) filter (where cod.sw_idx is null) bare from r left join cod using (doc_id, page_no, sw_idx) group by all)"""


@query(
    "p19_flagged_pages",
    f"""with {Q.scan()}, {GAP}, c as (select doc_id, page_no, count(*) n, count(*) filter (where sw_idx is null) + count(*) filter (where far) astray from v group by all)
select doc_id, page_no from c left join gp using (doc_id, page_no) where n >= 3 and (astray > 0.2 * n or coalesce(n_sw, 0) = 0 or bare > 0.5 * n_sw)""",
)
def _(b):
    gaps = scan.identity_gap(b.rects, layout.assign_words(b.words, b.rects, RuleConfig(6)), b.words, b.codes)
    return emit.flagged_pages(scan.page_counts(b.judged()), gaps)


@query(
    "s9_crop_boxes",
    f"""with {Q.scan()}, bd as (select distinct doc_id, page_no, sw_idx from v where aligned),
k as (select r.*, case when bd.sw_idx is not null then 'v' when hd.sw_idx is not null then 'q' else 'sk' end kind from r left join bd using (doc_id, page_no, sw_idx)
  left join (select distinct doc_id, page_no, sw_idx from v where not aligned and sw_idx is not null) hd using (doc_id, page_no, sw_idx))
select doc_id, page_no, sw_idx, kind || lpad(cast(row_number() over (partition by doc_id, kind order by page_no, sw_idx) - 1 as varchar), 3, '0') || '_p' || page_no "name",
  x0 - 4 x0, y0 - 4 y0, x1 + 4 x1, y1 + 4 y1 from k""",
)
def _(b):
    judged = b.judged()
    return emit.crop_boxes(judged.where("aligned"), judged.where("not aligned"), b.rects, margin=4.0)


@query(
    "q8_read_model",
    f"""with {Q.scan()}, {Q.S}, p as (select doc_id, page_no, string_agg(distinct token, ',' order by token) codes, count(*) filter (where aligned) bound,
    coalesce(string_agg(distinct case when demoted then 'icon_demoted' when sw_idx is null then 'orphan' when not aligned then 'not_x_aligned' end, ',' order by
      case when demoted then 'icon_demoted' when sw_idx is null then 'orphan' when not aligned then 'not_x_aligned' end), '') reasons from v group by all)
select pg.doc_id, pg.page_no, case when bound > 0 then 'auto' when codes is not null then 'review' when (doc_id, page_no) in (select (doc_id, page_no) from s group by all having count(*) >= 3) then 'noprod'
  else 'nonspec' end state, codes, bound, reasons from pg left join p using (doc_id, page_no)""",
)
def _(b):
    judged, pages = b.judged(), b.pages
    spec = b.words.groupBy(*PK).agg(F.sum(T.size_hits(F.col("text"))).alias("hits")).where("hits >= 3")
    return emit.read_model(judged, scan.dispositions(pages, judged.where("aligned"), judged, spec, pages))


@query(
    "q1_product_documents",
    f"""{BRIDGED}, {GUARDS}, vr as (select doc_id, cluster, list_sort(list(id)) ids, count(distinct code) n_codes, case when count(distinct color) = 1 then max(color) end color
    from cl join gr using (doc_id, cluster) where reason is null group by all),
vn as (select doc_id, count(*) n_variants, string_agg(array_to_string(ids, ',') || '=' || coalesce(color, '?'), ';' order by ids) variant_ids from vr group by all),
i as (select doc_id, count(*) n_rows, string_agg(id, ',' order by id) row_ids from b0 group by all), me as (select doc_id, sum(len(ids)) n from vr group by all)
select doc_id, n_variants, variant_ids, n_rows, row_ids, cast(n_rows - coalesce(n, 0) as bigint) needs_review, n_variants is null skeleton from i left join vn using (doc_id) left join me using (doc_id)""",
)
def _(b):
    bound, rows = b.dense, b.spec_rows
    variants, queue = assemble.assemble(bound, rows, b.band_letters, _areas(b))
    made = emit.product_documents(variants, rows, queue)
    one = F.transform("variants", lambda v: F.struct(v["merged_from"].alias("ids"), F.concat(F.array_join(v["merged_from"], ","), F.lit("="), F.coalesce(v["color"], F.lit("?"))).alias("t")))
    ids = F.array_join(F.transform(F.sort_array(one), lambda x: x["t"]), ";").alias("variant_ids")
    rows = F.array_join(F.transform("spec_by_code", lambda r: r["id"]), ",").alias("row_ids")
    n_variants = F.when(~F.col("skeleton"), F.size("variants").cast("long")).alias("n_variants")
    return made.select("doc_id", n_variants, ids, F.size("spec_by_code").cast("long").alias("n_rows"), rows, "needs_review", "skeleton")


def _ladder(version: int) -> None:
    icon = Q.icon(version) if version >= 6 else "icon as (select doc_id, page_no, sw_idx, false icon from r)"
    sql = ", ".join((Q.W, Q.R, Q.N, Q.C, Q.PG, Q.assign(version), icon, Q.V))

    @query(
        f"q4_scan_v{version}",
        f"""with {sql} select doc_id, count(*) n_codes, count(*) filter (where sw_idx is null) code_orphan, count(*) filter (where far) code_far, count(*) filter (where aligned) code_x_aligned,
  count(*) filter (where demoted) code_icon_demoted from v group by doc_id""",
    )
    def _(b):
        counts = scan.page_counts(b.judged(version))
        return counts.groupBy("doc_id").agg(
            *(F.sum(c).alias(c) for c in ("n_codes", "code_orphan", "code_far", "code_x_aligned", "code_icon_demoted"))
        )


for _version in (1, 2, 3, 5, 6):
    _ladder(_version)
