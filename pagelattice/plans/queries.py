"""Registered queries: each applies one operator to the layout bridge, with SQL for the same rows beside it.

"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelattice.config import RuleConfig
from pagelattice.functions import geometry as G
from pagelattice.functions import tokens as T
from pagelattice.operators import assemble, audit, detect, fields, layout, scan
from pagelattice.operators.components import materialize, size_by_rows
from pagelattice.sources import bridge

from . import layout_sql as Q

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
PK = ["doc_id", "page_no"]
KEY = [*PK, "word_no"]


@dataclass
class Bridge:
    """The bridge tables of one folder.  Words, rectangles, routed candidates, dense bindings and verdicts, which plans read more than
    once, are written once, when they are first asked for: each reading of the words' own plan shuffles all line items twice."""

    spark: SparkSession
    sf_dir: str

    def __post_init__(self) -> None:
        size_by_rows(self.spark)
        self._judged: dict[int, DataFrame] = {}
        self._kept: dict[str, DataFrame] = {}

    def kept(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of that name as it was written by its first use."""
        if name not in self._kept:
            self._kept[name] = materialize(make(), name)
        return self._kept[name]

    def table(self, name: str) -> DataFrame:
        return bridge.table(self.spark, self.sf_dir, name)

    @property
    def words(self) -> DataFrame:
        return self.kept("words", lambda: bridge.words(self.spark, self.sf_dir))

    @property
    def rects(self) -> DataFrame:
        return self.kept("rects", lambda: bridge.rects(self.spark, self.sf_dir))

    @property
    def pages(self) -> DataFrame:
        return bridge.pages(self.words)

    @property
    def spread_words(self) -> DataFrame:
        return bridge.spread_words(self.words)

    @property
    def spread_rects(self) -> DataFrame:
        return bridge.spread_rects(self.rects)

    @property
    def spread_pages(self) -> DataFrame:
        return bridge.spread_pages(self.words)

    @property
    def routed(self) -> DataFrame:
        return self.kept("routed", lambda: detect.route_junk(detect.candidates(self.words)))

    @property
    def codes(self) -> DataFrame:
        return self.routed.where("bucket = 'kept'").select("doc_id", "token")

    @property
    def code_words(self) -> DataFrame:
        return detect.normed(self.words).join(self.codes, ["doc_id", "token"], "left_semi")

    def judged(self, version: int = 6) -> DataFrame:
        if version not in self._judged:
            self._judged[version] = materialize(scan.verdicts(self.words, self.rects, self.codes, self.pages, RuleConfig(version)), "verdicts")
        return self._judged[version]

    @property
    def band_letters(self) -> DataFrame:
        """(doc_id, letter) of the routed bands."""
        return self.routed.where("bucket = 'band'").select("doc_id", F.substring("token", 1, 1).alias("letter")).distinct()

    @property
    def every_page(self) -> DataFrame:
        """Pages with a word or a rectangle."""
        known = self.words.select(*PK).unionByName(self.rects.select(*PK)).distinct()
        return known.withColumn("width", F.lit(600.0)).withColumn("height", F.lit(800.0))

    @property
    def states(self) -> DataFrame:
        judged = self.judged()
        bound = F.col("aligned") | F.col("blocked")
        spec = self.words.groupBy(*PK).agg(F.sum(T.size_hits(F.col("text"))).alias("hits")).where("hits >= 3")
        return scan.dispositions(self.every_page, judged.where(bound), judged.where(~bound), spec, self.words)

    @property
    def dense(self) -> DataFrame:
        """Bindings of a coarser code, so that clusters grow large enough for the guards."""
        return self.kept("dense", self._dense)

    def _dense(self) -> DataFrame:
        words = self.words.where(F.col("text").rlike("^[A-F]Q[0-9]{2}$"))
        bound = layout.assign_words(words, self.rects, RuleConfig(4)).where("rule = 'row_x'")
        color = F.when(F.col("word_no") % 7 == 0, None).when(F.col("word_no") % 5 == 0, "WHITE").otherwise("BLACK")
        return (
            words.join(bound, KEY)
            .select(
                *KEY,
                F.concat_ws(":", F.lit("b"), F.col("page_no").cast("string"), F.lpad(F.col("word_no").cast("string"), 5, "0")).alias("id"),
                (F.col("page_no") * 10000 + F.col("sw_idx")).alias("sw"),
                bridge.dense_code(F.col("text")).alias("code"),
                color.alias("color"),
                color.alias("color_raw"),
            )
        )

    @property
    def clustered(self) -> DataFrame:
        return assemble.clusters(self.dense)

    @property
    def spec_rows(self) -> DataFrame:
        """Sizes of dense codes, for the assembly queries: (doc_id, id, page_no, code, size, surface, price_band)."""
        no = F.col("word_no")
        size = F.when(no % 6 == 0, None).otherwise(F.concat((30 * (1 + no % 3)).cast("string"), F.lit("x60")))
        surface, band = F.when(no % 4 == 0, "MATT").otherwise("GLOSS"), F.when(no % 9 == 0, "").otherwise("T31")
        return self.dense.select("doc_id", "id", "page_no", "code", size.alias("size"), surface.alias("surface"), band.alias("price_band"))


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Bridge], DataFrame]], Callable[[Bridge], DataFrame]]:
    def keep(f: Callable[[Bridge], DataFrame]) -> Callable[[Bridge], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Bridge(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return keep


WN = f"with {Q.W}, {Q.N}"
WNS = f"{WN}, {Q.S}"
WNC = f"{WN}, {Q.C}"


# Tokens


@query("p1_norm_tokens", f"{WN} select token, count(*) n from n group by token")
def _(b):
    return detect.normed(b.words).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p2_p3_code_shapes",
    rf"{WN} select token, regexp_matches(token, '^[A-Za-z0-9]{{3,8}}$') code_shape, {Q.CODE} alnum_code from (select distinct token from n)",
)
def _(b):
    t = F.col("token")
    return detect.normed(b.words).select("token").distinct().select("token", T.is_code_shape(t).alias("code_shape"), T.is_alnum_code(t).alias("alnum_code"))


@query("p4_p6_sizes", f"{WNS} select lower(replace(size, ' ', '')) size, count(*) n, count(distinct doc_id) n_docs from s group by 1")
def _(b):
    s = detect.page_sizes(b.words)
    return s.groupBy(T.norm_size(F.col("size")).alias("size")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_docs"))


@query(
    "p5_composite_sizes",
    """select p_partkey, cast(p_size as varchar) || 'x' || cast(p_size * 2 as varchar) head,
  case when p_partkey % 2 = 0 then cast(p_size as varchar) || 'x' || cast(p_size * 2 as varchar) else cast(p_size as varchar) || ' X ' || cast(p_size * 2 as varchar) || ' cm' end plain
from part""",
)
def _(b):
    n = F.col("p_size").cast("string")
    w = (F.col("p_size") * 2).cast("string")
    long = F.concat(n, F.lit("x"), w, F.lit("x3,2 cm"))
    plain = F.when(F.col("p_partkey") % 2 == 0, F.concat(n, F.lit("x"), w)).otherwise(F.concat(n, F.lit(" X "), w, F.lit(" cm")))
    return b.table("part").select("p_partkey", T.size_of(long, 4).alias("head"), T.size_of(plain, 3).alias("plain"))


@query(
    "p7_p8_fold_sides",
    f"""with {Q.SPREAD_W}, {Q.N} select doc_id, page_no, case when doc_id % 2 = 1 then cx < 600 end left_side, count(*) n from n group by all""",
)
def _(b):
    """Words by side of the fold, on spreads and on single pages, which have none."""
    placed = b.spread_words.join(b.spread_pages, PK)
    side = G.side(G.cx(), G.fold(F.col("width"), F.col("height")))
    return placed.groupBy(*PK, side.alias("left_side")).agg(F.count(F.lit(1)).alias("n"))


NAMES = rf"""named as (select *, {Q.ALPHA} and not ("text" = lower("text") and "text" <> upper("text")) is_name from n)"""


@query("p9_colour_names", f"{WN}, {NAMES} select token, count(*) n from named where is_name group by token")
def _(b):
    return detect.normed(b.words).where(T.is_name_shape(F.col("text"))).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p10_latin_words",
    r"""with t as (select doc_id, unnest(regexp_extract_all("text", '[^\x20\x09-\x0D]+')) x from documents)
select doc_id, count(*) n, count(*) filter (where not regexp_matches(x, '[^\x00-\x{24F}]')) latin from t group by doc_id""",
)
def _(b):
    x = F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("x")
    latin = F.sum(T.is_latin(F.col("x")).cast("long"))
    return b.table("documents").select("doc_id", x).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), latin.alias("latin"))


@query(
    "p11_color_quality",
    """select p_partkey, case when len(string_split(p_name || ' ' || p_type || ' ' || case when p_partkey % 3 = 0 then 'X Y' else 'Z' end, ' ')) >= 4
  or length(p_name || ' ' || p_type || ' ' || case when p_partkey % 3 = 0 then 'X Y' else 'Z' end) > 30 then 'needs_review' else 'clean' end quality from part""",
)
def _(b):
    name = F.concat_ws(" ", "p_name", "p_type", F.when(F.col("p_partkey") % 3 == 0, "X Y").otherwise("Z"))
    return b.table("part").select("p_partkey", T.color_quality(name).alias("quality"))


@query("p12_a4_junk_routing", f"{WNC} select doc_id, token, n, bucket from routed")
def _(b):
    return b.routed


@query(
    "p24_field_format",
    rf"""{WN} select doc_id, count(*) n, count(*) filter (where regexp_matches(token, '^[A-Z]\d{{1,3}}$')) band_shape,
  count(*) filter (where try_cast(replace("text", 'x', '') as double) is null) no_number from n group by doc_id""",
)
def _(b):
    w = detect.normed(b.words)
    return w.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("token").rlike(r"^[A-Z]\d{1,3}$")).alias("band_shape"),
        F.count_if(F.replace("text", F.lit("x"), F.lit("")).try_cast("double").isNull()).alias("no_number"),
    )


# Vocabularies and detection


@query(
    "a1_document_frequency",
    rf"""{WN}, k as (select distinct doc_id, token, case when regexp_matches(token, '^[A-Za-z0-9]{{3,8}}$') and regexp_matches(token, '[0-9]')
  and regexp_matches(token, '\pL') then 'code' when {Q.ALPHA} then 'alpha' end kind from n)
select token, kind, count(*) n_docs from k where kind is not null group by all""",
)
def _(b):
    return detect.document_frequency(b.words)


@query("a2_occurrences", f"{WNC} select doc_id, token, n from cand")
def _(b):
    return detect.candidates(b.words)


@query(
    "j8_without_vocabulary",
    f"""{WNC}, df as (select token from cand group by token having count(*) >= 20)
select doc_id, token, n from cand where token not in (select token from df)""",
)
def _(b):
    return detect.candidates(b.words, detect.vocabulary(b.words, RuleConfig(code_documents=20)).where("kind = 'code'"))


DIGITS = r"""d0 as (select *, cast(l_orderkey % 100 as varchar) || '7' || cast(l_partkey % 13 as varchar) tok, cast(l_suppkey as bigint) doc_id from lineitem),
d1 as (select doc_id, tok token, count(*) n, min({'page_no': l_orderkey, 'word_no': l_partkey * 10 + l_linenumber}) first from d0 where length(tok) in (2,3,5,6,7,8) group by all having count(*) >= 2),
d2 as (select doc_id, length(token) len, count(*) k, min(first) first from d1 group by all),
d3 as (select *, row_number() over (partition by doc_id order by k desc, first) rn from d2)"""


@query(
    "a3_digit_branch",
    f"with {DIGITS} select d1.doc_id, d1.token from d1 join d3 on d3.doc_id = d1.doc_id and d3.len = length(d1.token) and rn = 1 and k >= 8",
)
def _(b):
    li = b.table("lineitem")
    text = F.concat((F.col("l_orderkey") % 100).cast("string"), F.lit("7"), (F.col("l_partkey") % 13).cast("string"))
    words = li.select(
        F.col("l_suppkey").cast("long").alias("doc_id"),
        F.col("l_orderkey").alias("page_no"),
        (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("word_no"),
        text.alias("text"),
    )
    none = detect.candidates(words)
    return detect.digit_codes(words, none, words.select("doc_id", "page_no").distinct())


@query(
    "a5_upper_median",
    f"{WN} select doc_id, page_no, list_sort(list(h))[cast(floor(count(*) / 2) as bigint) + 1] mid, median(h) middle from n group by all",
)
def _(b):
    return b.words.groupBy(*PK).agg(G.upper_median(G.height()).alias("mid"), F.median(G.height()).alias("middle"))


ROWS = """sr0 as (select s.*, mid from s join (select doc_id, page_no, list_sort(list(h))[cast(floor(count(*) / 2) as bigint) + 1] mid from n group by all) using (doc_id, page_no)),
sr as (select doc_id, case when s_cy - lag(s_cy) over o > 1.5 * mid or lag(s_cy) over o is null then 1 else 0 end brk from sr0 window o as (partition by doc_id, page_no order by s_cy, s_no))"""


@query("a8_w4_size_rows", f"{WNS}, {ROWS} select doc_id, cast(sum(brk) as bigint) n_rows from sr group by doc_id")
def _(b):
    return detect.size_rows(b.words, b.pages)


SIZED = """sized_words as (select distinct n.doc_id, n.page_no, n.word_no from n join s using (doc_id, page_no) where abs(n.cy - s_cy) <= 1.5 * greatest(n.h, 1))"""


@query(
    "a9_effective_anchors",
    f"""{WNS}, {Q.C}, {SIZED}, eff as (select distinct doc_id, token, length(token) len from cw join sized_words using (doc_id, page_no, word_no)),
g as (select doc_id, len, count(*) k from eff group by all)
select doc_id, len, k, k / sum(k) over (partition by doc_id) share from g qualify rank() over (partition by doc_id order by k desc) = 1""",
)
def _(b):
    sized = detect.in_row_with_size(b.words, detect.page_sizes(b.words), b.pages)
    eff = b.code_words.join(sized, KEY, "left_semi").select("doc_id", "token").distinct().withColumn("len", F.length("token").cast("long"))
    doc = Window.partitionBy("doc_id")
    return (
        eff.groupBy("doc_id", "len")
        .agg(F.count(F.lit(1)).alias("k"))
        .withColumn("share", F.col("k") / F.sum("k").over(doc))
        .withColumn("r", F.rank().over(doc.orderBy(F.desc("k"))))
        .where("r = 1")
        .drop("r")
    )


MEMBERS = rf"""mem as (select distinct n.doc_id, n.page_no, n.word_no, n.token from n join cw on cw.doc_id = n.doc_id and cw.page_no = n.page_no
  where regexp_matches(n.token, '^\pL{{3,}}$') and regexp_matches(n.token, '^[A-Za-z0-9]{{3,8}}$') and not (n."text" = lower(n."text") and n."text" <> upper(n."text"))
  and abs(n.x0 - cw.x0) <= 600 * 0.005)"""


@query("j11_column_members", f"{WNC}, {MEMBERS} select doc_id, page_no, word_no, token from mem")
def _(b):
    return detect.column_members(b.words, b.codes, b.pages)


BOTH = f"""{SIZED}, col as (select distinct doc_id, page_no, word_no from n where "text" like '_Q__' or regexp_matches("text", '^[AB][0-9][0-9]$')),
pl as (select n.doc_id, n.page_no, n.word_no, n.x0, n.cy, sw.word_no is not null has from n join col using (doc_id, page_no, word_no)
  left join sized_words sw using (doc_id, page_no, word_no)),
pc as (select p.doc_id, p.page_no, p.word_no p_no, p.cy p_cy, q.word_no, q.cy, q.has from pl p join pl q using (doc_id, page_no)
  where not p.has and abs(q.x0 - p.x0) <= 600 * 0.02),
pg1 as (select *, cy - lag(cy) over (partition by doc_id, page_no, p_no order by cy, word_no) gap from pc),
pg2 as (select *, list_sort(list(gap) filter (where gap > 0) over (partition by doc_id, page_no, p_no)) gaps from pg1),
pg3 as (select *, gaps[cast(floor(len(gaps) / 2) as bigint) + 1] mid from pg2 where cy < p_cy - 1e-6),
pg4 as (select *, coalesce(lag(cy) over o, p_cy) - cy leap from pg3 window o as (partition by doc_id, page_no, p_no order by cy desc, word_no)),
pg5 as (select *, max(case when leap > 2.0 * mid then 1 else 0 end) over (partition by doc_id, page_no, p_no order by cy desc, word_no rows unbounded preceding) broken from pg4)"""


@query(
    "j12_w5_inherited_sizes",
    f"{WNS}, {BOTH} select doc_id, page_no, p_no word_no from pg5 where coalesce(broken, 0) = 0 group by all having bool_or(has)",
)
def _(b):
    rules = RuleConfig(column_tolerance=0.02)
    members = b.words.where(F.col("text").rlike("^.Q..$|^[AB][0-9][0-9]$")).select(*KEY)
    sized = detect.in_row_with_size(b.words, detect.page_sizes(b.words), b.pages)
    return detect.inherited_sizes(members, sized.join(members, KEY, "left_semi"), b.words, b.pages, rules)


@query(
    "a10_w10_regroup",
    f"""{WNC}, letters as (select distinct doc_id, substr(token, 1, 1) letter from routed where bucket = 'band'),
sus as (select doc_id, token from routed where bucket = 'kept' and (doc_id, substr(token, 1, 1)) in (select (doc_id, letter) from letters)),
own as (select n.*, mid from n join sus using (doc_id, token) join (select doc_id, page_no, list_sort(list(h))[cast(floor(count(*) / 2) as bigint) + 1] mid from n group by all) using (doc_id, page_no)),
bw as (select n.* from n join routed using (doc_id, token) where bucket = 'band')
select own.doc_id, own.token from own join bw on bw.doc_id = own.doc_id and bw.page_no = own.page_no where abs(own.x0 - bw.x0) <= 3
union select doc_id, token from own group by doc_id, page_no, token, round_even(cy / (1.5 * mid), 0) having count(*) >= 3""",
)
def _(b):
    return detect.regroup_bands(b.words, b.routed, b.pages)


@query("a11_detect_v7", f"{WNC} select doc_id, token, bucket from routed")
def _(b):
    return detect.detect_codes(b.words, b.pages, rules=RuleConfig(7))


@query("a11_detect_v12")
def _(b):
    return detect.detect_codes(b.words, b.pages, rules=RuleConfig(12))


@query(
    "j13_a12_file_names",
    """with """
    + Q.W
    + ", "
    + Q.N
    + ", "
    + Q.C
    + """, nm as (select s_suppkey doc_id, regexp_replace(upper(s_name || '-AQ' || lpad(cast(s_suppkey % 97 as varchar), 2, '0')), '[^A-Z0-9]', '', 'g') clean from supplier)
select doc_id, token from codes join nm using (doc_id) where contains(clean, token)""",
)
def _(b):
    name = F.concat(F.col("s_name"), F.lit("-AQ"), F.lpad((F.col("s_suppkey") % 97).cast("string"), 2, "0"))
    return detect.file_name_suspects(b.codes, b.table("supplier").select(F.col("s_suppkey").alias("doc_id"), name.alias("file_name")))


# Swatches and assignment


@query("s4_spec_pages", f"{WNS} select doc_id, page_no, count(*) hits from s group by all having count(*) >= 3")
def _(b):
    return b.words.groupBy(*PK).agg(F.sum(T.size_hits(F.col("text"))).alias("hits")).where(F.col("hits") >= 3)


SWATCHES = """ras as (select *, true is_raster from r where rid % 3 = 0 and (x1-x0)*(y1-y0) between 60.0000001 and 0.55*480000 and x1-x0 > 6 and y1-y0 > 6),
sws as (select doc_id, page_no, rid, is_raster from ras union all
  select doc_id, page_no, rid, false from r where rid % 3 = 1 and (x1-x0)*(y1-y0) > 60 and (x1-x0)*(y1-y0) < 48000
    and not ((y1-y0) >= 6*(x1-x0) and (y1-y0) >= 200) and (doc_id, page_no) not in (select (doc_id, page_no) from ras))"""


@query("p13_swatch_candidates", f"with {Q.R}, {SWATCHES} select * from sws")
def _(b):
    images, drawings = b.rects.where("rid % 3 = 0"), b.rects.where("rid % 3 <> 0").withColumn("has_fill", F.col("rid") % 3 == 1)
    every = b.rects.select(*PK).distinct().withColumn("width", F.lit(600.0)).withColumn("height", F.lit(800.0))
    return layout.candidate_rects(images, drawings, every).select(*PK, "rid", "is_raster")


NMS = """step as (
  select doc_id, page_no, -1::bigint k, [] kept from (select distinct doc_id, page_no from r)
  union all
  select step.doc_id, step.page_no, r.sw_idx,
    case when len(list_filter(kept, lambda o: least(o.x1, r.x1) > greatest(o.x0, r.x0) and least(o.y1, r.y1) > greatest(o.y0, r.y0)
        and (least(o.x1, r.x1) - greatest(o.x0, r.x0)) * (least(o.y1, r.y1) - greatest(o.y0, r.y0))
          > 0.5 * least((o.x1-o.x0)*(o.y1-o.y0), (r.x1-r.x0)*(r.y1-r.y0)))) > 0
      then kept else list_append(kept, {'rid': r.rid, 'x0': r.x0, 'y0': r.y0, 'x1': r.x1, 'y1': r.y1}) end
  from step join r on r.doc_id = step.doc_id and r.page_no = step.page_no and r.sw_idx = step.k + 1),
fin as (select doc_id, page_no, kept from step qualify row_number() over (partition by doc_id, page_no order by k desc) = 1)"""
NMS_TYPED = NMS.replace("[] kept", "cast([] as struct(rid bigint, x0 double, y0 double, x1 double, y1 double)[]) kept")


@query(
    "w2_overlap_suppression",
    f"with recursive {Q.R}, {NMS_TYPED} select doc_id, page_no, cast(i - 1 as bigint) sw_idx, kept[i].rid rid from (select *, unnest(range(1, len(kept) + 1)) i from fin)",
)
def _(b):
    return layout.suppress_overlaps(b.rects).select(*PK, "sw_idx", "rid")


def _assigned(version: int) -> None:
    sql = f"with {Q.W}, {Q.R}, {Q.N}, {Q.assign(version)} select doc_id, page_no, word_no, sw_idx, rule, d from a"

    @query(f"j1_assign_v{version}", sql)
    def _(b):
        return layout.assign_words(b.words, b.rects, RuleConfig(version))


for _version in (1, 2, 3, 4):
    _assigned(_version)

#: Every seventh order's rectangle moved into a left column of equal blocks.
LEFT = """lr as (select doc_id, page_no, sw_idx, case when rid % 3 = 0 then 10.0 else x0 end x0, y0, case when rid % 3 = 0 then 60.0 else x1 end x1,
    case when rid % 3 = 0 then y0 + 60 else y0 + 20 end y1 from r),
mh as (select doc_id, page_no, list_sort(list(h))[cast(floor(count(*) / 2) as bigint) + 1] wh from n group by all),
mb as (select lr.*, lead(lr.y0) over (partition by doc_id, page_no order by lr.y0, sw_idx) - lr.y0 pitch from lr join mh using (doc_id, page_no)
  where y1 - y0 >= 3 * wh and (x1 - x0) * (y1 - y0) <= 0.03 * 480000),
co as (select doc_id, page_no, count(*) n, min(x0) cx0, max(x1) cx1, min(y0) f, max(y0) l, list_sort(list(pitch) filter (where pitch is not null)) ps from mb group by all
  having count(*) >= 2 and max(x0) - min(x0) <= 12 and max(x1) <= 270 and max(y1 - y0) <= 1.5 * min(y1 - y0)),
cb as (select *, least(0.92 * 800, l + 1.5 * ps[cast(floor(len(ps) / 2) as bigint) + 1]) bottom from co),
gd as (select cb.* from cb where (select count(*) from n where n.doc_id = cb.doc_id and n.page_no = cb.page_no and n.cx between cx0 - 2 and cx1 + 2 and n.cy between f and bottom) <= 2 * cb.n),
bl as (select mb.doc_id, mb.page_no, mb.sw_idx, mb.y0, coalesce(mb.y0 + pitch, bottom) y1, cx1 column_x1 from mb join gd using (doc_id, page_no))"""


def _left(b: Bridge) -> DataFrame:
    own = F.col("rid") % 3 == 0
    return b.rects.select(
        *PK,
        "sw_idx",
        F.when(own, 10.0).otherwise(F.col("x0")).alias("x0"),
        "y0",
        F.when(own, 60.0).otherwise(F.col("x1")).alias("x1"),
        F.when(own, F.col("y0") + 60).otherwise(F.col("y0") + 20).alias("y1"),
    )


@query("j2_w3_column_blocks", f"with {Q.W}, {Q.R}, {Q.N}, {LEFT} select doc_id, page_no, sw_idx, y0, y1, column_x1 from bl")
def _(b):
    return layout.column_blocks(b.words, _left(b), b.pages).drop("side")


@query(
    "j2_block_rescue",
    f"""with {Q.W}, {Q.R}, {Q.N}, {LEFT}, {Q.assign(4).replace("join r using", "join lr r using")},
res as (select a.doc_id, a.page_no, a.word_no, min({{'y0': bl.y0, 'sw_idx': bl.sw_idx}}).sw_idx bi from a join n using (doc_id, page_no, word_no) join bl using (doc_id, page_no)
  where a.rule = 'orphan' and bl.y0 <= n.cy and n.cy < bl.y1 and n.cx > column_x1 + 2 group by all)
select a.doc_id, a.page_no, a.word_no, coalesce(a.sw_idx, bi) sw_idx, case when bi is not null then 'block' else a.rule end "rule", case when bi is not null then -2.0 else a.d end d
from a left join res using (doc_id, page_no, word_no)""",
)
def _(b):
    rects, rules = _left(b), RuleConfig(7)
    assigned = layout.assign_words(b.words, rects, rules)
    return layout.rescue_orphans(b.words, assigned, layout.column_blocks(b.words, rects, b.pages), b.pages, rules)


def _icons(version: int) -> None:
    sql = f"with {Q.W}, {Q.R}, {Q.PG}, {Q.icon(version)} select doc_id, page_no, sw_idx, area, median_area, repeated, icon from icon"

    @query(f"p15_p16_a6_a7_icons_v{version}", sql)
    def _(b):
        return layout.icon_context(b.rects, b.pages, RuleConfig(version))


for _version in (6, 13):
    _icons(_version)


# Page verdicts


@query(
    "a15_page_counts",
    f"""with {Q.scan()} select doc_id, page_no, count(*) n_codes, count(*) filter (where sw_idx is null) code_orphan, count(*) filter (where far) code_far, count(*) filter (where aligned) code_x_aligned,
  0::bigint code_block_bound, count(*) filter (where demoted) code_icon_demoted, count(*) filter (where not aligned) code_needs_review from v group by all""",
)
def _(b):
    return scan.page_counts(b.judged())


@query(
    "a16_totals",
    f"""with {Q.scan()} select doc_id, page_no, count(*) n_codes, count(*) filter (where sw_idx is null) code_orphan, count(*) filter (where far) code_far, count(*) filter (where aligned) code_x_aligned,
  0::bigint code_block_bound, count(*) filter (where demoted) code_icon_demoted, count(*) filter (where not aligned) code_needs_review from v group by rollup (doc_id, page_no)""",
)
def _(b):
    return scan.corpus_totals(scan.page_counts(b.judged()))


@query("p14_p17_verdicts", f"with {Q.scan()} select doc_id, page_no, word_no, token, sw_idx, rule, d, aligned, demoted, far from v")
def _(b):
    return b.judged().select(*KEY, "token", "sw_idx", "rule", "d", "aligned", "demoted", "far")


@query(
    "w1_bindings",
    f"""with {Q.scan()}, q as (select *, row_number() over (partition by doc_id, page_no order by word_no) - 1 seq from v where aligned)
select doc_id, page_no, seq, 'b:' || page_no || ':' || seq id, word_no, token code, sw_idx, r_x0 || '|' || r_y1 box, 'geom_v6_x_aligned' "method" from q""",
)
def _(b):
    made = scan.bindings(b.judged(), b.rects)
    return made.withColumn("box", F.concat_ws("|", F.col("box")[0].cast("string"), F.col("box")[3].cast("string")))


@query(
    "u6_review_queue",
    f"""with {Q.scan()} select doc_id, page_no, word_no, token code, case when demoted then 'icon_demoted' when sw_idx is null then 'orphan' else 'not_x_aligned' end reason
from v where not aligned""",
)
def _(b):
    return scan.review_items(b.judged())


@query(
    "a43_identity_gap",
    f"""with {Q.scan()}, cod as (select distinct doc_id, page_no, sw_idx from v where sw_idx is not null)
select r.doc_id, r.page_no, count(*) n_sw, count(*) filter (where cod.sw_idx is null) sw_no_code from r left join cod using (doc_id, page_no, sw_idx) group by all""",
)
def _(b):
    return scan.identity_gap(b.rects, layout.assign_words(b.words, b.rects, RuleConfig(6)), b.words, b.codes)


@query(
    "p18_page_types",
    f"""with {Q.scan()}, sx as (select doc_id, page_no, count(*) n_sw, list_sort(list((x1-x0)*(y1-y0)))[cast(floor(count(*) / 2) as bigint) + 1] mid, count(*) filter (where rid % 5 = 0) n_ras from r group by all),
cx as (select doc_id, page_no, count(*) n_codes from v group by all)
select pg.doc_id, pg.page_no, case when n_sw is null and n_codes > 0 then 'text_only' when n_sw is null then 'no_swatch_no_code' when n_ras = 0 then 'vector'
  when n_sw > 15 then 'dense_grid' when n_sw <= 4 and mid > 0.05 * 480000 then 'lifestyle_caption' else 'standard' end ptype
from pg left join sx using (doc_id, page_no) left join cx using (doc_id, page_no)""",
)
def _(b):
    rasters = b.rects.groupBy(*PK).agg(F.count_if(F.col("rid") % 5 == 0).alias("n_raster"))
    return scan.page_types(b.rects, b.judged(), b.pages, rasters)


def states_sql(tables: str) -> str:
    """The CTE st (doc_id, page_no, state) over the CTEs of Q.scan."""
    return f"""{tables}, {Q.S}, every as (select distinct doc_id, page_no from w union select distinct doc_id, page_no from r),
auto as (select distinct doc_id, page_no from v where aligned), rev as (select distinct doc_id, page_no from v where not aligned),
sp as (select doc_id, page_no from s group by all having count(*) >= 3),
st as (select every.doc_id, every.page_no, case when auto.doc_id is not null then 'auto' when rev.doc_id is not null then 'review' when sp.doc_id is not null then 'noprod'
    when pg.doc_id is not null then 'nonspec' else 'image' end state
  from every left join auto using (doc_id, page_no) left join rev using (doc_id, page_no) left join sp using (doc_id, page_no) left join pg using (doc_id, page_no))"""


STATES = states_sql(Q.scan())


@query("p20_dispositions", f"with {STATES} select * from st")
def _(b):
    return b.states


@query("p22_photo_demotion_v9")
def _(b):
    rules = RuleConfig(9)
    judged = scan.verdicts(b.words, b.rects, b.codes, b.pages, rules)
    return scan.demote_photos(judged, b.words, b.rects, b.pages, rules, share=0.01).select(*KEY, "aligned", "photo")


# Fields

ROWSIZE = """rs as (select cw.doc_id, cw.page_no, cw.word_no, min({'tier': case when abs(cw.cy - s_cy) <= 1.5 * greatest(cw.h, 1) then 0
    when cw.cy - s_cy > 0 and cw.cy - s_cy <= 4 * greatest(cw.h, 1) and s_x0 <= cw.x1 then case when least(cw.x1, s_x1) - greatest(cw.x0, s_x0) > 0 then 1 else 2 end end,
    'dy': abs(cw.cy - s_cy), 'dx': abs(s_x0 - cw.x0), 'size': size}) m
  from cw join s using (doc_id, page_no) where abs(cw.cy - s_cy) <= 1.5 * greatest(cw.h, 1)
    or (cw.cy - s_cy > 0 and cw.cy - s_cy <= 4 * greatest(cw.h, 1) and s_x0 <= cw.x1) group by all)"""


@query("j3_row_size", f"{WNS}, {Q.C}, {ROWSIZE} select doc_id, page_no, word_no, m.size size from rs")
def _(b):
    return fields.row_size(b.words, b.code_words, b.pages)


NEIGHBOURS = """nb as (select c.doc_id, c.page_no, c.word_no, c.cx w_cx, u.word_no u_no, u.token u_token, u."text" u_text, u.x0 u_x0, u.cx u_cx
  from cw c join n u using (doc_id, page_no) where abs(c.cy - u.cy) <= 1.5 * greatest(c.h, 1)
    and not (c.x0 = u.x0 and c.y0 = u.y0 and c.x1 = u.x1 and c.y1 = u.y1 and c."text" = u."text"))"""


@query("j4_row_words", f"{WNC}, {NEIGHBOURS} select doc_id, page_no, word_no, count(*) n, min(u_token) first from nb group by all")
def _(b):
    found = fields.row_words(b.words, b.code_words, b.pages)
    return found.groupBy(*PK, F.col("w_word_no").alias("word_no")).agg(F.count(F.lit(1)).alias("n"), F.min(T.norm(F.col("u_text"))).alias("first"))


@query(
    "j6_price_band",
    f"""{WNC}, {NEIGHBOURS} select nb.doc_id, nb.page_no, nb.word_no, min({{'d': abs(u_cx - w_cx), 'token': u_token}}).token band
from nb join routed on routed.doc_id = nb.doc_id and routed.token = nb.u_token and bucket = 'band' group by all""",
)
def _(b):
    return fields.price_band(fields.row_words(b.words, b.code_words, b.pages), b.routed.where("bucket = 'band'"))


def _packed(b: Bridge) -> DataFrame:
    """Words in which some sizes become headers and numbers, for the packing fields."""
    no = F.col("word_no")
    text = (
        F.when(no % 9 == 0, "PZ")
        .when(no % 9 == 1, "m²/box")
        .when(no % 9 == 2, "Kg")
        .when(no % 3 == 1, F.concat((no % 50).cast("string"), F.lit(",5")))
        .otherwise(F.col("text"))
    )
    return b.words.withColumn("text", F.when(F.col("text").rlike("x"), text).otherwise(F.col("text")))


PACKED = """w2 as (select doc_id, page_no, word_no, x0, y0, x1, y1, case when contains("text", 'x') then case when word_no % 9 = 0 then 'PZ' when word_no % 9 = 1 then 'm²/box'
    when word_no % 9 = 2 then 'Kg' when word_no % 3 = 1 then cast(word_no % 50 as varchar) || ',5' else "text" end else "text" end "text" from w)"""
HEADERS = r"""hd as (select *, case when regexp_matches(replace(upper("text"), '²', '2'), '\b(?:PZ|PCS|PIECES|PZZ)\b') then 'pcsBox'
    when regexp_matches(replace(upper("text"), '²', '2'), '\b(?:MQ|M2|SQM)\b') then 'm2Box'
    when regexp_matches(replace(upper("text"), '²', '2'), '\bKG\b') then 'kgBox' end field from n)"""


@query(
    "j5_w7_packing",
    f"""with {Q.W}, {PACKED}, {Q.N.replace("from w)", "from w2)")}, {Q.C}, {NEIGHBOURS}, {HEADERS},
f as (select nb.doc_id, nb.page_no, nb.word_no, u_no, u_x0, u_text, min({{'d': u.cy - hd.cy, 'v': hd.word_no, 'field': field}}).field field
  from nb join n u on u.doc_id = nb.doc_id and u.page_no = nb.page_no and u.word_no = u_no join hd on hd.doc_id = nb.doc_id and hd.page_no = nb.page_no
  where regexp_matches(u_text, '^\\d{{1,4}}(?:[.,]\\d{{1,3}})?$') and field is not null and u.cy > hd.cy and least(u.x1, hd.x1) - greatest(u.x0, hd.x0) > 0 group by all)
select doc_id, page_no, word_no, field, replace(u_text, ',', '.') "value" from f qualify row_number() over (partition by doc_id, page_no, word_no, field order by u_x0, u_no) = 1""",
)
def _(b):
    words = _packed(b)
    codes = detect.route_junk(detect.candidates(words)).where("bucket = 'kept'")
    own = detect.normed(words).join(codes, ["doc_id", "token"], "left_semi")
    return fields.packing(words, fields.row_words(words, own, b.pages), b.pages)


VOCAB = r"av as (select token from n where regexp_matches(token, '^\pL{3,}$') group by token having count(distinct doc_id) >= 8)"


@query(
    "a13_finish_vocabulary",
    rf"{WNC}, {NEIGHBOURS}, {VOCAB} select doc_id, u_token token from nb where u_token in (select token from av) group by all having count(distinct (page_no, word_no)) >= 3",
)
def _(b):
    vocab = detect.vocabulary(b.words).where("kind = 'alpha'")
    return fields.finish_vocabulary(fields.row_words(b.words, b.code_words, b.pages), vocab)


@query(
    "q7_surface",
    rf"""{WNC}, {NEIGHBOURS}, {VOCAB}, fv as (select doc_id, u_token from nb where u_token in (select token from av) group by all having count(distinct (page_no, word_no)) >= 3),
one as (select nb.doc_id, nb.page_no, nb.word_no, nb.u_token, min({{'x': u_x0, 'n': u_no, 't': u_text}}) m from nb join fv using (doc_id, u_token)
  where not (u_text = lower(u_text) and u_text <> upper(u_text)) group by all)
select doc_id, page_no, word_no, string_agg(m.t, ' ' order by m) surface from one group by all""",
)
def _(b):
    near = fields.row_words(b.words, b.code_words, b.pages)
    finishes = fields.finish_vocabulary(near, detect.vocabulary(b.words).where("kind = 'alpha'"))
    return fields.surface(near, finishes)


CAPTIONS = f"""{Q.assign(3)}, cap as (select a.doc_id, a.page_no, a.sw_idx, n.word_no, n.x0, n.y0, n."text", n.token from a join r using (doc_id, page_no, sw_idx) join n using (doc_id, page_no, word_no)
  where d <= greatest(1.5 * (r.y1 - r.y0), 40))"""


@query(
    "w6_q10_captions",
    rf"""with {Q.W}, {Q.R}, {Q.N}, {CAPTIONS} select doc_id, page_no, sw_idx, string_agg("text", ' ' order by round_even(y0, 0), x0, word_no) color from cap
where {Q.ALPHA} and not ("text" = lower("text") and "text" <> upper("text")) group by all""",
)
def _(b):
    assigned = layout.assign_words(b.words, b.rects, RuleConfig(3))
    return fields.caption_names(fields.captions(b.words, assigned, b.rects, b.pages))


INDEX = rf"""idx as (select distinct doc_id, token, page_no, sw_idx from cap join (select doc_id, page_no, sw_idx from r where (y1-y0) < 6*(x1-x0) and (x1-x0) < 6*(y1-y0)) using (doc_id, page_no, sw_idx)
  where (doc_id, page_no, sw_idx) not in (select (cap.doc_id, cap.page_no, cap.sw_idx) from cap join codes using (doc_id, token))
  and regexp_matches(token, '^\pL{{3,}}$') and not ("text" = lower("text") and "text" <> upper("text")))"""


def _index(b: Bridge) -> DataFrame:
    assigned = layout.assign_words(b.words, b.rects, RuleConfig(3))
    return fields.name_index(fields.captions(b.words, assigned, b.rects, b.pages), b.rects, b.codes)


@query("q5_name_index", f"with {Q.W}, {Q.R}, {Q.N}, {Q.C}, {CAPTIONS}, {INDEX} select * from idx")
def _(b):
    return _index(b)


GOOD = rf"""nc as (select doc_id, page_no, count(*) n_codes from cw group by all),
gn as (select u.doc_id, u.page_no, u.token from n u join cw c using (doc_id, page_no) join nc using (doc_id, page_no)
  where regexp_matches(u.token, '^\pL{{3,}}$') and not (u."text" = lower(u."text") and u."text" <> upper(u."text")) and abs(u.cy - c.cy) <= 1.5 * greatest(u.h, 1)
  group by u.doc_id, u.page_no, u.token, n_codes having count(distinct c.word_no) <= greatest(3, n_codes / 3))"""


@query("a14_good_names", f"{WNC}, {GOOD} select * from gn")
def _(b):
    return fields.good_names(b.words, b.code_words, b.pages)


@query(
    "j7_u3_bind_names",
    f"""with {Q.W}, {Q.R}, {Q.N}, {Q.C}, {CAPTIONS}, {INDEX}, {GOOD},
few as (select doc_id, token from idx group by all having count(*) <= 12),
pr as (select distinct c.doc_id, c.page_no, c.word_no, u.token from cw c join n u using (doc_id, page_no) join gn on gn.doc_id = u.doc_id and gn.page_no = u.page_no and gn.token = u.token
  join few on few.doc_id = u.doc_id and few.token = u.token where abs(c.cy - u.cy) <= 1.5 * greatest(c.h, 1) and not (u."text" = lower(u."text") and u."text" <> upper(u."text"))),
want as (select doc_id, page_no, word_no, count(*) n from pr group by all),
ht as (select pr.doc_id, pr.page_no, pr.word_no, idx.page_no tp, idx.sw_idx ts, count(*) k from pr join idx on idx.doc_id = pr.doc_id and idx.token = pr.token group by all)
select doc_id, page_no, word_no, min({{'p': tp, 's': ts}}).p to_page, min({{'p': tp, 's': ts}}).s to_sw from ht join want using (doc_id, page_no, word_no) where k = n group by all""",
)
def _(b):
    names = fields.good_names(b.words, b.code_words, b.pages)
    return fields.bind_names(b.words, b.code_words, _index(b), names, b.pages, RuleConfig(name_targets=12))
