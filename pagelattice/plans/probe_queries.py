"""Registered queries of the probes, with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelattice.config import RuleConfig
from pagelattice.operators import assemble, audit, detect, layout, probes, scan
from pagelattice.operators.components import checkpoint

from . import layout_sql as Q
from .audit_queries import AREAS, CL, GUARDS, _areas
from .queries import KEY, PK, Bridge, query

# Replay: guards tight enough for the bridge's clusters to meet each of them

TIGHT = RuleConfig(collapse=5, borderline=3, merge_pages=2, merge_bindings=4, single_page_area=0.5)
RUNS = [
    probes.Replay("base"),
    probes.Replay("no_collapse", collapse=False),
    probes.Replay("no_single_page", single_page=False),
    probes.Replay("no_borderline", borderline=False, radius=False),
    probes.Replay("none", False, False, False, False),
    probes.Replay("clean_names", raw_witnesses=False),
]
_SQL_RUNS = " union all ".join(
    "select " + ", ".join([f"'{r.name}' run", *(f"{str(getattr(r, f)).lower()} {f}" for f in ("collapse", "single_page", "borderline", "radius", "raw_witnesses"))]) for r in RUNS
)
REPLAY = f"""{CL}, {AREAS}, cr as (select *, case when word_no % 21 = 5 then 'BEIGE' else color end raw from cl), runs as ({_SQL_RUNS}),
rs as (select cr.doc_id, cluster, count(*) n, count(distinct page_no) pages, count(distinct color) k, count(distinct raw) k_raw, max(color) one, max(area_pct) area_pct from cr join ar using (doc_id, sw) group by all),
rj as (select *, k > 1 or (raw_witnesses and k_raw > 1) conflict from rs, runs),
rp as (select doc_id, cluster, n, pages, run, case when collapse and n >= 5 and pages >= 2 and conflict then 'assembly_collapse_suspect'
    when single_page and n >= 5 and pages = 1 and area_pct >= 0.5 then 'singlepage_overmerge_suspect' when borderline and n < 5 and pages >= 2 and conflict and n >= 3 then 'borderline_merge_suspect'
    when radius and pages >= 2 and (pages > 2 or n > 4) then 'assembly_merge_radius_suspect' end reason, case when k = 1 and not conflict then one end color from rj)"""


def _replayed(b: Bridge) -> DataFrame:
    raw = F.when(F.col("word_no") % 21 == 5, "BEIGE").otherwise(F.col("color"))
    return probes.replay(assemble.clusters(b.dense.withColumn("color_raw", raw)), _areas(b), RUNS, TIGHT)


@query("m_replay", f"{REPLAY} select doc_id, cluster, n, pages, run, reason is null kept, reason, color from rp")
def _(b: Bridge) -> DataFrame:
    return _replayed(b)


@query(
    "m_replay_changes",
    f"""{REPLAY}, pr as (select y.run base, x.run, x.doc_id, x.cluster, x.pages, y.reason is null was, x.reason is null now, x.color is distinct from y.color other from rp x join rp y on x.doc_id = y.doc_id and x.cluster = y.cluster and x.run <> y.run where y.run in ('base', 'none'))
select base, run, doc_id, cluster, unnest(list_filter([case when not was and now then 'new' end, case when was and not now then 'disappeared' end, case when not was and now and pages > 1 then 'cross_page_new' end,
  case when was and not now and pages > 1 then 'cross_page_gone' end, case when was and now and other then 'value' end], lambda c: c is not null)) change from pr""",
)
def _(b: Bridge) -> DataFrame:
    replayed = checkpoint(_replayed(b))
    both = [probes.replay_changes(replayed, base).withColumn("base", F.lit(base)) for base in ("base", "none")]
    return both[0].unionByName(both[1])


# Fates

FATES = f"""with recursive {Q.scan()}, b as (select doc_id, page_no, word_no, 'b:' || page_no || ':' || (row_number() over (partition by doc_id, page_no order by word_no) - 1) id, page_no * 10000 + sw_idx sw, token code,
  case when word_no % 5 = 0 then 'WHITE' else 'BLACK' end color from v where aligned), {Q.COMPONENTS}, {GUARDS},
pos as (select doc_id, page_no, word_no, token, round_even(x0, 1) x, round_even(y0, 1) y from n where {Q.CODE}),
fw as (select doc_id, page_no, x, y, min_by(token, word_no) token from pos group by all),
bo as (select distinct doc_id, page_no, x, y from cl join gr using (doc_id, cluster) join pos using (doc_id, page_no, word_no) where reason is null),
qu as (select doc_id, page_no, x, y, min(reason) reason from (select cl.doc_id, cl.page_no, cl.word_no, reason from cl join gr using (doc_id, cluster) where reason is not null
  union all select doc_id, page_no, word_no, case when sw_idx is null then 'orphan' when demoted then 'icon_demoted' else 'not_x_aligned' end from v where not aligned) join pos using (doc_id, page_no, word_no) group by all),
ft as (select fw.*, bo.x is not null own, reason, (doc_id, token) in (select (doc_id, token) from codes) known from fw left join bo using (doc_id, page_no, x, y) left join qu using (doc_id, page_no, x, y)),
fs as (select doc_id, page_no, x, y, token, case when not known then 'undetected' when own and reason is not null then 'both' when own then 'bound' when reason is not null then 'queued:' || reason else 'lost' end state,
  cast(own as bigint) + cast(reason is not null as bigint) fates from ft)"""


def _fates(b: Bridge) -> DataFrame:
    judged = b.judged()
    shade = F.when(F.col("word_no") % 5 == 0, "WHITE").otherwise("BLACK")
    made = scan.bindings(judged, b.rects).select("doc_id", "id", *PK[1:], "word_no", (F.col("page_no") * 10000 + F.col("sw_idx")).alias("sw"), "code", shade.alias("color"), shade.alias("color_raw"))
    rows = judged.where("false").select("doc_id", F.lit("").alias("id"), F.col("token").alias("code"), *(F.lit(None).cast("string").alias(c) for c in ("size", "surface", "price_band")))
    variants, demoted = assemble.assemble(made, rows, rows.select("doc_id", F.col("code").alias("letter")), _areas(b))
    spots = b.words.select(*KEY, "x0", "y0")
    members = variants.select("doc_id", F.explode("merged_from").alias("id")).join(made.select("doc_id", "id", "page_no", "word_no"), ["doc_id", "id"]).join(spots, KEY)
    reason = F.when(F.col("sw_idx").isNull(), "orphan").when(F.col("demoted"), "icon_demoted").otherwise("not_x_aligned")
    open_ = judged.where(~(F.col("aligned") | F.col("blocked"))).select(*KEY, reason.alias("reason"))
    queued = open_.unionByName(demoted.join(made.select("doc_id", "id", "page_no", "word_no"), ["doc_id", "id"]).select(*KEY, "reason")).join(spots, KEY)
    return probes.code_word_fates(b.words, b.codes, members, queued)


@query("m_code_word_fates", f"{FATES} select * from fs")
def _(b: Bridge) -> DataFrame:
    return _fates(b)


@query(
    "m_fate_equations",
    f"""{FATES}, eq as (select doc_id, count(*) words, count(*) filter (where state <> 'undetected') detected, count(*) filter (where state = 'bound') bound, count(*) filter (where state like 'queued:%') queued,
  count(*) filter (where state in ('both', 'lost')) wrong from fs group by doc_id) select *, detected = bound + queued ok from eq""",
)
def _(b: Bridge) -> DataFrame:
    return probes.fate_equations(_fates(b))


# Hubs

HUBS = f"""{CL}, {AREAS}, hs as (select cl.doc_id, cluster, sw, count(distinct code) codes, max(area_pct) area_pct from cl join ar using (doc_id, sw) group by all),
ht as (select doc_id, cluster, count(*) n, min(page_no) page_no, max(page_no) last, count(distinct code) n_codes, count(distinct color) > 1 conflict from cl group by all),
hh as (select distinct on (doc_id, cluster) doc_id, cluster, sw hub_sw, codes hub_codes, area_pct hub_pct from hs order by doc_id, cluster, codes desc, sw),
hb as (select doc_id, cluster, page_no, n, n_codes, (select count(*) from hs where hs.doc_id = ht.doc_id and hs.cluster = ht.cluster) n_swatches, conflict, hub_sw, hub_codes, hub_pct,
  (select max(area_pct) from hs where hs.doc_id = ht.doc_id and hs.cluster = ht.cluster) max_pct from ht join hh using (doc_id, cluster) where page_no = last and n >= 2)"""


@query("m_hub_swatches", f"{HUBS} select * from hb")
def _(b: Bridge) -> DataFrame:
    return probes.hub_swatches(b.clustered, _areas(b))


@query(
    "m_separation",
    f"""{HUBS}, vs as (select max_pct v, lead(max_pct) over (order by max_pct) high from (select distinct max_pct from hb)),
bg as (select v low, high, high - v gap from vs where high is not null order by gap desc, low limit 1)
select low, high, gap, count(*) filter (where max_pct <= low and not conflict) agree_below, count(*) filter (where max_pct > low and conflict) conflict_above,
  count(*) filter (where (max_pct <= low) = conflict) = 0 split from hb, bg group by all""",
)
def _(b: Bridge) -> DataFrame:
    return probes.separation(probes.hub_swatches(b.clustered, _areas(b)))


# Medians: large is 1 % of the page and an icon under 30 % of the median, as the bridge has no swatches much larger or smaller

MEDIANS = f"""with {Q.scan()}, z0 as (select r.*, (r.x1 - r.x0) * (r.y1 - r.y0) area, {{'x0': round_even(r.x0/20, 0), 'y0': round_even(r.y0/20, 0), 'x1': round_even(r.x1/20, 0), 'y1': round_even(r.y1/20, 0)}} k from r join pg using (doc_id, page_no)),
z as (select *, area >= 0.01 * 480000 big, median(area) over (partition by doc_id, page_no) pm, row_number() over (partition by doc_id, page_no order by sw_idx) rn,
  count(*) over (partition by doc_id, k) >= greatest(2, 0.1 * (select count(*) from pg where pg.doc_id = z0.doc_id)) rep from z0),
m as (select doc_id, median(area) median_all, coalesce(median(area) filter (where not big), median(area)) median_small, median(pm) filter (where rn = 1) median_page from z group by doc_id),
wn as (select doc_id, page_no, sw_idx, count(*) words from v where aligned or demoted group by all),
j as (select z.*, m.*, coalesce(words, 0) words from z join m using (doc_id) left join wn using (doc_id, page_no, sw_idx))
select doc_id, median_all, median_small, median_page, count(*) n_sw, count(*) filter (where big) n_large,
  count(*) filter (where area < 0.3 * median_all) small_all, count(*) filter (where area < 0.3 * median_small) small_small, count(*) filter (where area < 0.3 * median_page) small_page,
  count(*) filter (where area >= 0.3 * median_all and rep and area < 0.6 * median_all) repeated_all,
  cast(sum(case when area < 0.3 * median_all or (rep and area < 0.6 * median_all) then words else 0 end) as bigint) codes_all,
  cast(sum(case when area < 0.3 * median_small or (rep and area < 0.6 * median_small) then words else 0 end) as bigint) codes_small,
  cast(sum(case when area < 0.3 * median_page or (rep and area < 0.6 * median_page) then words else 0 end) as bigint) codes_page,
  cast(sum(case when (area < 0.3 * median_all or (rep and area < 0.6 * median_all)) and not (area < 0.3 * median_small or (rep and area < 0.6 * median_small)) then words else 0 end) as bigint) rescued
from j group by doc_id, median_all, median_small, median_page"""


@query("m_median_probe", MEDIANS)
def _(b: Bridge) -> DataFrame:
    rules = RuleConfig(icon_small=0.3, icon_repeated=0.6, repeat_floor=2, repeat_pages=0.1)
    return probes.median_probe(b.rects, b.pages, b.judged().where("aligned or demoted").select(*PK, "sw_idx"), rules, large=0.01)


# Columns without anchors

COLUMNS = f"""{Q.W}, {Q.N}, {Q.S}, {Q.C}, al0 as (select * from n where {Q.ALPHA} and regexp_matches(token, '^[A-Za-z0-9]{{3,8}}$') and not ("text" = lower("text") and "text" <> upper("text"))),
ir as (select distinct al0.doc_id, al0.page_no, word_no from al0 join s using (doc_id, page_no) where abs(s_cy - cy) <= 1.5 * greatest(h, 1)),
al as (select al0.*, ir.word_no is not null in_row from al0 left join ir using (doc_id, page_no, word_no)),
mb as (select doc_id, page_no, x0 m_x, cy m_y, case when in_row then 1 else 0 end kind from al union all select doc_id, page_no, s_x0, s_cy, 2 from s union all select doc_id, page_no, x0, cy, 3 from cw where doc_id % 2 = 0),
pr as (select al.doc_id, al.page_no, word_no, token, cy, in_row, m_y, kind from al join mb on mb.doc_id = al.doc_id and mb.page_no = al.page_no and abs(m_x - x0) <= 0.02 * 600),
st as (select doc_id, page_no, word_no, token, in_row, bool_or(kind = 3) anchored, count(*) filter (where kind < 2) k from pr group by all),
dm as (select distinct doc_id, page_no, word_no, cy, m_y, kind from pr where kind < 3),
gp as (select doc_id, page_no, word_no, m_y - lag(m_y) over (partition by doc_id, page_no, word_no order by m_y, kind) g from dm),
gm as (select doc_id, page_no, word_no, list_sort(list(g))[cast(floor(count(*) / 2) as bigint) + 1] gap from gp where g > 0 group by all),
up as (select dm.*, gap, coalesce(lag(m_y) over o, cy) - m_y step, row_number() over o i from dm join gm using (doc_id, page_no, word_no) where m_y < cy - 1e-6 window o as (partition by doc_id, page_no, word_no order by m_y desc, kind desc)),
en as (select distinct on (doc_id, page_no, word_no) doc_id, page_no, word_no, case when step > 2.0 * gap then 'break' when kind = 2 then 'size' else 'member' end fin from up where step > 2.0 * gap or kind > 0 order by doc_id, page_no, word_no, i),
kt as (select doc_id, token from n group by all having count(*) >= 20)"""


@query(
    "m_unanchored_columns",
    f"""with {COLUMNS} select doc_id, page_no, word_no, token, case when (doc_id, token) in (select (doc_id, token) from kt) then 'kept' when anchored then 'anchored' when k < 2 then 'few' when in_row then 'row'
  when gap is null then 'no_gap' else coalesce(fin, 'top') end verdict from st left join gm using (doc_id, page_no, word_no) left join en using (doc_id, page_no, word_no)""",
)
def _(b: Bridge) -> DataFrame:
    """A name that a document has twenty times counts as kept; odd documents have no anchors; columns are four times as wide."""
    kept = detect.normed(b.words).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n")).where("n >= 20")
    return probes.unanchored_columns(b.words, b.pages, kept, b.codes.where("doc_id % 2 = 0"), rules=RuleConfig(column_tolerance=0.02))


# Batches left, and scores with names


@query(
    "a36_batches_left",
    """with p as (select source, doc_id, md5("text") h from documents), f as (select source, h, min(doc_id) doc_id from p where h not in (select md5("text") from documents where doc_id % 10 = 0) group by all),
l as (select source, count(*) - 1 rem from f group by source) select cast(row_number() over (order by rem desc, source) as bigint) need, rem batches from l where rem > 0""",
)
def _(b: Bridge) -> DataFrame:
    pool = b.table("documents").select("source", "doc_id", F.md5("text").alias("h"))
    left = audit.first_unused(pool, pool.where("doc_id % 10 = 0"), "source", "h", "doc_id")
    return audit.batches_left(left, "source", "left")


@query(
    "a41_names_present",
    f"""with {Q.scan()}, tk as (select distinct n.doc_id, n.page_no, sw_idx, upper(trim(t, '*,;:()')) tok from (select *, unnest(string_split("text", ' ')) t from n) n join a using (doc_id, page_no, word_no) where sw_idx is not null),
tr as (select cw.doc_id, cw.page_no, cw.word_no, cw.token code, upper(trim(string_split(x."text", ' ')[1], '*,;:()')) "name" from cw join n x on x.doc_id = cw.doc_id and x.page_no = cw.page_no and x.word_no = cw.word_no + 1),
mt as (select tr.doc_id, tr.page_no, tr.word_no, count(*) k, min(sw_idx) sw_idx from tr join tk on tk.doc_id = tr.doc_id and tk.page_no = tr.page_no and tok = code group by all)
select tr.doc_id, tr.page_no, tr.word_no, coalesce(k = 1, false) code_hit, coalesce(k = 1, false) and (tr.doc_id, tr.page_no, mt.sw_idx, "name") in (select (doc_id, page_no, sw_idx, tok) from tk) full_hit
from tr left join mt using (doc_id, page_no, word_no)""",
)
def _(b: Bridge) -> DataFrame:
    """Each code word with the first word behind it as its name."""
    texts = b.words.join(layout.assign_words(b.words, b.rects, RuleConfig(6)), KEY).where("sw_idx is not null").select(*PK, "sw_idx", "text")
    behind = b.words.select(*PK, (F.col("word_no") - 1).alias("word_no"), F.col("text").alias("name"))
    truth = b.code_words.select(*KEY, F.col("token").alias("code")).join(behind, KEY)
    return audit.score_texts(texts, truth, KEY)


@query(
    "j10_rows_by_code",
    f"""{CL}, sr as (select doc_id, id, code, case when word_no % 6 = 0 then null else cast(30 * (1 + word_no % 3) as varchar) || 'x60' end size from b)
select cl.doc_id, cluster, code, count(*) n, count(distinct size) sizes, count(*) filter (where size is null) unsized from (select distinct doc_id, cluster, code from cl) cl join sr using (doc_id, code) group by all""",
)
def _(b: Bridge) -> DataFrame:
    return assemble.rows_by_code(b.clustered, b.spec_rows)
