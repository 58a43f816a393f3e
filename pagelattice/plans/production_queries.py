"""Detection and page extraction of the later versions, with SQL for the same rows.

The words are the bridge's with short names: capital words are cut to three letters and get a fourth by their
number, so that alphabetic codes of the anchors' length occur; names that end in A are trade words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelattice.config import RuleConfig
from pagelattice.operators import detect, pages, scan
from pagelattice.operators.components import materialize

from . import layout_sql as Q
from .page_queries import _verdict_sql, extraction_sql
from .queries import KEY, ROWS, SIZED, Bridge, _left, query

WORDS = f"""{Q.W.replace("w as (", "w0 as (", 1)}, w as (select * replace (case when regexp_matches("text", '^[A-Z]{{5,}}$') then substr("text", 1, 3) || chr(cast(65 + word_no % 26 as int)) else "text" end as "text") from w0)"""


def _words(b: Bridge) -> DataFrame:
    short = F.concat(F.substring("text", 1, 3), F.chr(65 + F.col("word_no") % 26))
    return b.kept("short-words", lambda: b.words.withColumn("text", F.when(F.col("text").rlike("^[A-Z]{5,}$"), short).otherwise(F.col("text"))))


def _trade(words: DataFrame) -> DataFrame:
    return detect.normed(words).where(F.col("token").rlike(r"^\p{L}{3,}$") & F.col("token").endswith("A")).select("token").distinct()


#: Anchors (codes0, cw0) and what an alphabetic code needs.
ANCHORS = Q.C.replace("codes as (", "codes0 as (").replace("join codes using", "join codes0 using").replace("cw as (", "cw0 as (")
ALPHA = rf"""{SIZED}, {ROWS}, mem as (select distinct n.doc_id, n.page_no, n.word_no, n.token from n join cw0 on cw0.doc_id = n.doc_id and cw0.page_no = n.page_no
  where regexp_matches(n.token, '^\pL{{3,}}$') and regexp_matches(n.token, '^[A-Za-z0-9]{{3,8}}$') and not (n."text" = lower(n."text") and n."text" <> upper(n."text")) and n.token not like '%A' and abs(n.x0 - cw0.x0) <= 600 * 0.005),
ct as (select doc_id, token, count(*) n from n group by all),
md as (select doc_id, list_sort(list(n))[cast(floor(count(*) / 2) as bigint) + 1] mid from ct join codes0 using (doc_id, token) group by doc_id),
np as (select doc_id, count(distinct page_no) p from w group by doc_id),
le as (select doc_id, length(token) len, count(distinct token) k from cw0 join sized_words using (doc_id, page_no, word_no) group by all),
modal as (select doc_id, len from (select *, k / sum(k) over (partition by doc_id) share, rank() over (partition by doc_id order by k desc) rk from le) where rk = 1 and share >= 0.6),
rw as (select doc_id from sr group by doc_id having sum(brk) >= 3)"""
#: Sizes inherited from further up the column (version 12).
HEIRS = """col as (select doc_id, page_no, word_no from mem union select doc_id, page_no, word_no from cw0),
hp as (select n.doc_id, n.page_no, n.word_no, n.x0, n.cy, sized_words.word_no is not null has from n join col using (doc_id, page_no, word_no) left join sized_words using (doc_id, page_no, word_no)),
hc as (select p.doc_id, p.page_no, p.word_no p_no, p.cy p_cy, q.word_no, q.cy, q.has from hp p join hp q using (doc_id, page_no) where not p.has and abs(q.x0 - p.x0) <= 600 * 0.005),
hg as (select *, cy - lag(cy) over (partition by doc_id, page_no, p_no order by cy, word_no) gap from hc),
hm as (select doc_id, page_no, p_no, list_sort(list(gap))[cast(floor(count(*) / 2) as bigint) + 1] mid from hg where gap > 0 group by all),
hl as (select hc.*, mid, coalesce(lag(cy) over o, p_cy) - cy leap from hc left join hm using (doc_id, page_no, p_no) where cy < p_cy - 1e-6 window o as (partition by doc_id, page_no, p_no order by cy desc, word_no)),
hb as (select *, max(case when leap > 2.0 * mid then 1 else 0 end) over (partition by doc_id, page_no, p_no order by cy desc, word_no rows unbounded preceding) broken from hl),
heirs as (select doc_id, page_no, p_no word_no from hb where broken = 0 group by all having bool_or(has))"""
REGROUP = """letters as (select distinct doc_id, substr(token, 1, 1) letter from routed where bucket = 'band'),
sus as (select doc_id, token from routed where bucket = 'kept' and (doc_id, substr(token, 1, 1)) in (select (doc_id, letter) from letters)),
own as (select n.*, mid from n join sus using (doc_id, token) join (select doc_id, page_no, list_sort(list(h))[cast(floor(count(*) / 2) as bigint) + 1] mid from n group by all) using (doc_id, page_no)),
bw as (select n.* from n join routed using (doc_id, token) where bucket = 'band'),
moved as (select own.doc_id, own.token from own join bw on bw.doc_id = own.doc_id and bw.page_no = own.page_no where abs(own.x0 - bw.x0) <= 3
  union select doc_id, token from own group by doc_id, page_no, token, round_even(cy / (1.5 * mid), 0) having count(*) >= 3)"""


def detection_sql(version: int) -> str:
    """CTEs up to det (doc_id, token, bucket), codes and cw, over w, n and s."""
    vouched = "select mem.doc_id, mem.token from mem join sized_words using (doc_id, page_no, word_no)"
    parts = [ANCHORS, ALPHA]
    if version >= 12:
        parts.append(HEIRS)
        vouched += " union select mem.doc_id, mem.token from mem join heirs using (doc_id, page_no, word_no)"
    parts.append(f"""vo as ({vouched}), al as (select distinct vo.doc_id, vo.token from vo join modal on modal.doc_id = vo.doc_id and modal.len = length(vo.token) join rw on rw.doc_id = vo.doc_id
  join ct on ct.doc_id = vo.doc_id and ct.token = vo.token join md on md.doc_id = vo.doc_id join np on np.doc_id = vo.doc_id where n <= greatest(2.0 * mid, least(0.6 * p, 5.0)))""")
    bucket = "bucket"
    if version >= 10:
        parts.append(REGROUP)
        bucket = "case when bucket = 'kept' and (doc_id, token) in (select (doc_id, token) from moved) then 'band' else bucket end bucket"
    parts.append(f"det as (select doc_id, token, {bucket} from routed union select doc_id, token, 'kept' from al)")
    parts.append("codes as (select doc_id, token from det where bucket = 'kept'), cw as (select n.* from n join codes using (doc_id, token))")
    return ", ".join(parts)


def _detected(b: Bridge, version: int) -> tuple[DataFrame, DataFrame]:
    words = _words(b)
    return words, detect.detect_codes(words, b.pages, None, _trade(words), RuleConfig(version))


def _register(version: int) -> None:
    if version != 9:  # detects like 8

        @query(f"a11_production_v{version}", f"with {WORDS}, {Q.N}, {Q.S}, {detection_sql(version)} select * from det")
        def _(b: Bridge) -> DataFrame:
            return _detected(b, version)[1]

    @query(f"q4_production_v{version}", extraction_sql(version, WORDS, detection_sql(version)))
    def _(b: Bridge) -> DataFrame:
        """The counters of every page with the version's own detection, over swatches of which some stand in left columns."""
        words, found = _detected(b, version)
        kept = materialize(found, "detected").where("bucket = 'kept'").select("doc_id", "token")
        return pages.extract_pages(words, _left(b), b.pages, kept, rules=RuleConfig(version)).counts.drop("code_photo_demoted")


for _version in (8, 9, 10, 12):
    _register(_version)


@query(
    "p22_photo_demotion",
    f"""with {_verdict_sql(9)}, {SIZED}, one as (select doc_id, page_no, sw_idx, count(distinct token) n_tokens from v where aligned group by all),
band as (select v.doc_id, v.page_no, v.sw_idx, count(distinct v.token) n_band, min(v.token) band_token from v join r using (doc_id, page_no, sw_idx) where d between 0 and greatest(1.5 * (r.y1 - r.y0), 40) group by all),
ph as (select v.*, coalesce(aligned and (r_x1 - r_x0) * (r_y1 - r_y0) >= 0.01 * 480000
    and not ((sz.word_no is not null and n_tokens = 1) or coalesce(n_band = 1 and band_token = v.token, false)), false) photo
  from v left join sized_words sz using (doc_id, page_no, word_no) left join one using (doc_id, page_no, sw_idx) left join band using (doc_id, page_no, sw_idx))
select doc_id, page_no, word_no, aligned and not photo aligned, photo from ph""",
)
def _(b: Bridge) -> DataFrame:
    """Version 9's demotion with photo-sized swatches from 1 % of the page on, some of them in left columns."""
    swatches, rules = _left(b), RuleConfig(9)
    judged = scan.verdicts(b.words, swatches, b.codes, b.pages, rules)
    return scan.demote_photos(judged, b.words, swatches, b.pages, rules, share=0.01).select(*KEY, "aligned", "photo")
