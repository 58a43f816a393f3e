"""SQL (DuckDB) for the same rows as pagelattice.plans.queries, written on the raw tables.

Each text starts from the layout bridge: w are words, r rectangles, pg pages (all 600 x 800).
"""

from __future__ import annotations

W = """w as (
  select cast(l_suppkey as bigint) doc_id, cast(l_orderkey % 8 + 1 as bigint) page_no,
    row_number() over (partition by l_suppkey, l_orderkey % 8 order by l_orderkey, l_linenumber, l_partkey) - 1 word_no,
    cast((l_partkey*37) % 560 as double) x0, cast((l_orderkey*53 + l_linenumber*11) % 780 as double) y0,
    cast((l_partkey*37) % 560 + 20 + (l_partkey % 5)*8 as double) x1,
    cast((l_orderkey*53 + l_linenumber*11) % 780 + 8 + l_linenumber % 3 as double) y1,
    case when l_partkey % 10 < 3 then chr(cast(65 + l_partkey % 6 as int)) || 'Q' || lpad(cast(l_partkey % 97 as varchar), 2, '0')
         when l_partkey % 10 < 6 then cast(p_size as varchar) || 'x' || cast(p_size*2 as varchar)
         when l_partkey % 10 = 6 then chr(cast(65 + l_partkey % 2 as int)) || cast(10 + l_partkey % 80 as varchar)
         when l_partkey % 10 = 7 then upper(p_type) else p_name end "text"
  from lineitem join part on p_partkey = l_partkey)"""

R = """r as (
  select doc_id, page_no, row_number() over (partition by doc_id, page_no order by y0, x0, rid) - 1 sw_idx, rid, x0, y0, x1, y1
  from (select cast(o_orderkey % (select count(*) from supplier) as bigint) doc_id,
    cast(floor(o_orderkey / (select count(*) from supplier)) as bigint) % 8 + 1 page_no, o_orderkey rid,
    cast((o_orderkey*71) % 520 as double) x0, cast((o_orderkey*29) % 700 as double) y0,
    cast((o_orderkey*71) % 520 + 30 + o_custkey % 60 as double) x1, cast((o_orderkey*29) % 700 + 20 + o_custkey % 80 as double) y1
  from orders))"""

#: Odd documents on spreads: odd words and rectangles stand on the right-hand page.
SPREAD_W = f"""{W.replace("w as (", "w0 as (", 1)}, w as (select doc_id, page_no, word_no, x0 + s x0, y0, x1 + s x1, y1, "text" from (select *, case when doc_id % 2 = 1 and word_no % 2 = 1 then 600 else 0 end s from w0))"""
SPREAD_R = f"""{R.replace("r as (", "r0 as (", 1)}, r as (select doc_id, page_no, sw_idx, rid, x0 + s x0, y0, x1 + s x1, y1 from (select *, case when doc_id % 2 = 1 and rid % 2 = 1 then 600 else 0 end s from r0))"""

#: Pages of eight kinds: 3 has rectangles only, 4 sizes only, 5 lower-case names only, 6 no rectangles, 7 hairlines for rectangles;
#: every fifth document has no rectangles at all.
VARIED_W = f"""{W.replace("w as (", "w_plain as (", 1)}, w as (select * from w_plain where case (doc_id + page_no) % 8 when 3 then false
    when 4 then regexp_matches("text", '^[0-9]+x[0-9]+$') when 5 then regexp_matches("text", '^[a-z ]+$') else true end)"""
VARIED_R = f"""{R.replace("r as (", "r_plain as (", 1)}, r as (select doc_id, page_no, sw_idx, rid, x0, y0, case when (doc_id + page_no) % 8 = 7 then x0 + 2 else x1 end x1,
    case when (doc_id + page_no) % 8 = 7 then y0 + 12 else y1 end y1 from r_plain where (doc_id + page_no) % 8 <> 6 and doc_id % 5 <> 4)"""

#: Words with their normal form, and the two kinds of shapes.
N = r"""n as (select *, upper(trim("text", '*,;:().')) token, (x0 + x1) / 2 cx, (y0 + y1) / 2 cy, y1 - y0 h from w)"""
SIZE = r"(?i)\b\d{1,4}(?:[.,]\d{1,2})?\s*[x×]\s*\d{1,4}(?:[.,]\d{1,2})?\s*(?:cm|mm)?"
CODE = rf"""(regexp_matches(token, '^[A-Za-z0-9]{{3,8}}$') and regexp_matches(token, '[0-9]') and regexp_matches(token, '\pL')
  and not regexp_matches(token, '{SIZE}'))"""
ALPHA = r"regexp_matches(token, '^\pL{3,}$')"
S = rf"""s as (select doc_id, page_no, word_no s_no, x0 s_x0, y0 s_y0, x1 s_x1, y1 s_y1, cy s_cy, regexp_extract("text", '{SIZE}', 0) size
  from n where regexp_matches("text", '{SIZE}'))"""
#: Candidates, routed by kind.
C = rf"""cand as (select doc_id, token, count(*) n from n where {CODE} group by all),
fam as (select *, case when regexp_matches(token, '^[A-Z]\d{{1,2}}$') then substr(token, 1, 1) end letter from cand),
routed as (select doc_id, token, n, case
    when regexp_matches(token, '^[A-Z]\d{{1,2}}$') and count(letter) over (partition by doc_id, letter) >= 3 then 'band'
    when regexp_matches(token, '^(?:CM|MM|M)[23]$') then 'unit'
    when regexp_matches(token, '^\d{{1,2}}(?:[.,]\d)?MM$') then 'thickness'
    when regexp_matches(token, '^\d{{1,4}}(?:[.,]\d{{1,2}})?(?:X\d{{1,4}}(?:[.,]\d{{1,2}})?)+(?:CM|MM|H)?$') then 'size' else 'kept' end bucket
  from fam),
codes as (select doc_id, token from routed where bucket = 'kept'),
cw as (select n.* from n join codes using (doc_id, token))"""

PAGE_H = 800


def tiers(version: int) -> str:
    """One case for a pair's best tier in a version, as (tier, key, idx, d)."""
    mid = "abs((r.x0 + r.x1) / 2 - n.cx)"
    in_y, in_x = "n.cy between r.y0 - 2 and r.y1 + 2", "n.cx between r.x0 - 2 and r.x1 + 2"
    near = "least(n.x1, r.x1) - greatest(n.x0, r.x0) > 0.3 * (n.x1 - n.x0)"
    reach = "greatest(1.5 * (r.y1 - r.y0), 40)"
    below, above = "n.cy - r.y1", "r.y0 - n.cy"
    far = f"greatest(0.0, {below})"
    rules = {
        "row_x": (f"{in_y} and {in_x}", mid, "0.0"),
        "row": (in_y, mid, "0.0"),
        "below": (f"r.y1 - 2 <= n.cy and {near} and {below} < {reach}", below, below),
        "above": (f"r.y0 + 2 >= n.cy and {near} and {above} < {reach}", above, above),
        "section_x": (f"r.y0 <= n.cy and {in_x}", "n.cy - r.y0", far),
        "section": ("r.y0 <= n.cy", "n.cy - r.y0", far),
    }
    order = {
        1: ["row", "below", "section"],
        2: ["row", "below", "above", "section_x", "section"],
        3: ["row_x", "below", "above", "section_x", "row", "section"],
    }.get(version, ["row_x", "below", "above", "section_x"])
    whens = " ".join(
        f"when {t} then {{'tier': {k}, 'key': cast({key} as double), 'idx': r.sw_idx, 'd': cast({d} as double), 'rule': '{name}'}}"
        for k, name in enumerate(order)
        for t, key, d in [rules[name]]
    )
    return f"case {whens} end"


def assign(version: int) -> str:
    """CTEs: a = every word's swatch, rule and distance."""
    return f"""pairs as (select n.doc_id, n.page_no, n.word_no, {tiers(version)} b from n join r using (doc_id, page_no)),
best as (select doc_id, page_no, word_no, min(b) b from pairs where b is not null group by all),
a as (select n.doc_id, n.page_no, n.word_no, b.idx sw_idx, coalesce(b.rule, 'orphan') "rule", coalesce(b.d, -1.0) d
  from n left join best using (doc_id, page_no, word_no))"""


ICON = """sized as (select *, (x1 - x0) * (y1 - y0) area, {'x0': round_even(x0/20, 0)::bigint, 'y0': round_even(y0/20, 0)::bigint,
    'x1': round_even(x1/20, 0)::bigint, 'y1': round_even(y1/20, 0)::bigint} k from r join pg using (doc_id, page_no)),
spec as (select doc_id, count(*) n_spec from pg group by doc_id),
med as (select doc_id, coalesce(median(area) filter (where MEDIAN_OF), 0) median_area from sized group by doc_id),
rep as (select doc_id, k from sized join spec using (doc_id) group by doc_id, k, n_spec having count(*) >= greatest(5, 0.5 * n_spec)),
icon as (select s.doc_id, s.page_no, s.sw_idx, s.area, median_area, rep.k is not null repeated,
    median_area > 0 and (area < 0.05 * median_area or (rep.k is not null and area < 0.5 * median_area)) icon
  from sized s join med using (doc_id) left join rep on rep.doc_id = s.doc_id and rep.k = s.k)"""


def icon(version: int) -> str:
    return ICON.replace("MEDIAN_OF", "area < 0.10 * 480000" if version >= 13 else "true")


PG = "pg as (select distinct doc_id, page_no from w)"

#: Verdicts of code words at version 6 (no block rescue).
V = """v as (select cw.*, a.sw_idx, a.rule, a.d,
    coalesce(cw.cx between r.x0 - 2 and r.x1 + 2, false) and not coalesce(icon.icon, false) aligned,
    coalesce(cw.cx between r.x0 - 2 and r.x1 + 2, false) and coalesce(icon.icon, false) demoted,
    coalesce(a.d > greatest(2 * (r.y1 - r.y0), 0.15 * 800), false) far,
    r.x0 r_x0, r.y0 r_y0, r.x1 r_x1, r.y1 r_y1
  from cw join a using (doc_id, page_no, word_no) left join r using (doc_id, page_no, sw_idx) left join icon using (doc_id, page_no, sw_idx))"""


def scan(version: int = 6, words: str = W, rects: str = R) -> str:
    return ", ".join((words, rects, N, C, PG, assign(version), icon(version), V))


#: Bindings of dense codes at version 4, and their components by repeated least labels.
DENSE = rf"""{W}, {R}, {N}, {assign(4)},
b as (select n.doc_id, n.page_no, n.word_no, 'b:' || n.page_no || ':' || lpad(cast(n.word_no as varchar), 5, '0') id,
    n.page_no * 10000 + a.sw_idx sw, substr("text", 1, 2) || '0' || cast(cast(substr("text", 4, 1) as int) % 3 as varchar) code,
    case when n.word_no % 7 = 0 then null when n.word_no % 5 = 0 then 'WHITE' else 'BLACK' end color
  from n join a using (doc_id, page_no, word_no) where regexp_matches("text", '^[A-F]Q[0-9]{{2}}$') and a.rule = 'row_x')"""
COMPONENTS = """e as (
  select b.doc_id, b.id x, m.id y from b join (select doc_id, sw, min(id) id from b group by all) m using (doc_id, sw)
  union select b.doc_id, b.id, m.id from b join (select doc_id, code, min(id) id from b group by all) m using (doc_id, code)),
links as (select doc_id, x, y from e union select doc_id, y, x from e),
reach as (select doc_id, id x, id y from b union select reach.doc_id, reach.x, links.y from reach join links on links.doc_id = reach.doc_id and links.x = reach.y),
cl as (select b.*, c.cluster from b join (select doc_id, x id, min(y) cluster from reach group by all) c using (doc_id, id))"""
