"""Registered queries over pages of several kinds, so that every state of a page, of a queue and of a comparison occurs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelattice.config import RuleConfig
from pagelattice.operators import audit, detect, pages, reports, scan
from pagelattice.sources import bridge, readers

from . import layout_sql as Q
from .document_queries import shared_folder
from .page_queries import extraction_sql
from .queries import PK, Bridge, _left, query, states_sql


class Varied(Bridge):
    """The bridge over varied words and rectangles."""

    @property
    def words(self) -> DataFrame:
        return bridge.varied_words(super().words)

    @property
    def rects(self) -> DataFrame:
        return bridge.varied_rects(super().rects)


def _varied(b: Bridge) -> Varied:
    return Varied(b.spark, b.sf_dir)


VARIED = f"{Q.VARIED_W}, {Q.VARIED_R}"
STATES = states_sql(Q.scan(6, Q.VARIED_W, Q.VARIED_R))


@query("p20_varied_dispositions", f"with {STATES} select * from st")
def _(b):
    return _varied(b).states


@query("u7_varied_coverage", f"with {STATES} select state, count(*) pages, cast(sum(count(*)) over () as bigint) = (select count(*) from every) covered from st group by state")
def _(b):
    """Pages by state, and whether the states add up to all pages with a word or a rectangle."""
    v = _varied(b)
    every = v.every_page.agg(F.count(F.lit(1))).scalar()
    return v.states.groupBy("state").agg(F.count(F.lit(1)).alias("pages")).withColumn("covered", F.sum("pages").over(Window.partitionBy(F.lit(1))) == every)


# A queue left by an earlier run, which saw six pages and routed nothing, against the codes of now

EARLIER = f"""{Q.VARIED_W.replace("w as (select * from w_plain where", "w as (select * from w_plain where page_no <= 6 and")}, {Q.VARIED_R}, {Q.N}, {Q.C.replace("where bucket = 'kept'", "")}, {Q.PG}, {Q.assign(6)}, {Q.icon(6)}, {Q.V}"""


@query(
    "a29_stale_queue",
    f"""with old as (with {EARLIER} select doc_id, token, aligned from v), new as (with {Q.VARIED_W}, {Q.N}, {Q.C} select doc_id, token from cw),
de as (select distinct doc_id, token from new), pr as (select distinct doc_id, token from old where aligned), rv as (select distinct doc_id, token from old where not aligned),
ghost as (select rv.doc_id, count(*) k from rv anti join de on rv.doc_id = de.doc_id and rv.token = de.token group by all)
select de.doc_id, count(*) n_detected, count(*) filter (where pr.token is null and rv.token is null) vanished, coalesce(any_value(ghost.k), 0) phantom, count(rv.token) >= 0.9 * count(*) stuck
from de left join pr using (doc_id, token) left join rv using (doc_id, token) left join ghost on ghost.doc_id = de.doc_id group by de.doc_id""",
)
def _(b):
    v = _varied(b)
    seen = v.words.where("page_no <= 6")
    tokens = detect.candidates(seen).select("doc_id", "token")
    judged = scan.verdicts(seen, v.rects, tokens, bridge.pages(seen), RuleConfig(6))
    return audit.lifecycle(v.code_words, judged.where("aligned"), judged.where("not aligned").select("doc_id", "token"))


# Page counts against frozen ones

COUNTERS = ("n_codes", "code_orphan", "code_far", "code_x_aligned", "code_needs_review")


def _counted(version: int, pages_: str) -> str:
    """Counters of the pages, at a version."""
    return f"""(with {Q.scan(version, Q.VARIED_W, Q.VARIED_R)} select doc_id, page_no, count(*) n_codes, count(*) filter (where sw_idx is null) code_orphan, count(*) filter (where far) code_far,
  count(*) filter (where {"aligned" if version >= 6 else "aligned or demoted"}) code_x_aligned, count(*) filter (where not ({"aligned" if version >= 6 else "aligned or demoted"})) code_needs_review
  from v where {pages_} group by all)"""


@query(
    "q9_frozen_agreement",
    f"""with was as {_counted(5, "page_no <= 7")}, now as {_counted(6, "page_no >= 2")},
met as (select coalesce(was.doc_id, now.doc_id) doc_id, was.doc_id is null extra, now.doc_id is null missing,
  {" + ".join(f"(was.{c} <> now.{c})::int" for c in COUNTERS)} cells_off
  from was full join now on was.doc_id = now.doc_id and was.page_no = now.page_no)
select doc_id, count(*) * {len(COUNTERS)} cells, cast(sum(case when extra or missing then 0 else cells_off end) as bigint) differ, count(*) filter (where missing) only_scanned, count(*) filter (where extra) only_extracted
from met group by doc_id""",
)
def _(b):
    """Counters frozen to CSV by version 5 over pages 1 to 7, read back and compared with version 6 over pages 2 to 8."""
    v, path = _varied(b), shared_folder(b, "frozen-counts")
    frozen = scan.page_counts(v.judged(5)).where("page_no <= 7").select(F.col("doc_id").cast("string").alias("doc"), F.col("page_no").alias("page"), *COUNTERS)
    readers.write_counts(frozen, path)
    was = readers.read_counts(b.spark, path, "doc string, page long, " + ", ".join(f"{c} long" for c in COUNTERS))
    was = was.select(F.col("doc").cast("long").alias("doc_id"), F.col("page").alias("page_no"), *COUNTERS)
    now = scan.page_counts(v.judged(6)).where("page_no >= 2").select(*PK, *COUNTERS)
    return reports.batch_agreement(was, now, PK)


def _extraction(version: int) -> None:
    @query(f"q4_varied_pages_v{version}", extraction_sql(version, Q.VARIED_W, rects=Q.VARIED_R))
    def _(b):
        v = _varied(b)
        return pages.extract_pages(v.words, _left(v), v.pages, v.codes, rules=RuleConfig(version)).counts.drop("code_photo_demoted")


for _version in (5, 7):
    _extraction(_version)
