"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a keyed shuffle, passed through up to twice.  A
document's virtual finish time is the number of its source's tokens up to and with it,
divided by the source's weight.  All copies are sorted by finish time and cut off at the
total budget.  A source whose two passes are over drops out and the others go on, so the
cut shares the budget by weight with a cap of twice each source's size.

The running totals are two-level: the shuffle key's leading digits make buckets, bucket
totals give each bucket its offset, and only one bucket is ever sorted in one task, so a
source with a third of all documents is as many tasks as any other third.  The cut is found
as a range sort finds its bounds: words are summed by range of finish times, the range that
holds the cut is divided again until few rows are left, and only these are put in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, read_table, row_key, with_row_id, word_count

WEIGHTS = (3, 1, 2)
PASSES = 2
#: Ranges that a range of finish times is divided into.
_RANGES = 4096


def _targets(sizes: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """(source, s, weight, source_size, target), one row per source.  Sources are ranked in one task: their list,
    some 50 bytes each, is taken to fit there (millions do)."""
    every = Window.partitionBy(F.lit(1))
    by_name = Window.partitionBy(F.lit(1)).orderBy(F.col("source").isNull(), "source")
    by_cap = Window.partitionBy(F.lit(1)).orderBy("ratio", "s")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("s") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("s", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("budget", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("ratio", F.lit(PASSES) * F.col("source_size") / F.col("weight"))
        .withColumn(
            "level",
            (
                F.col("budget")
                - F.coalesce(
                    F.sum(F.lit(PASSES) * F.col("source_size")).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)),
                    F.lit(0),
                )
            )
            / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)),
        )
        .withColumn("line", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "s", "level"))).over(every))
    )
    cap = (F.lit(PASSES) * F.col("source_size")).cast("double")
    level = F.coalesce(F.col("line.level"), F.max("ratio").over(every))
    return ranked.select("source", "s", "weight", "source_size", "budget", F.least(cap, level * F.col("weight")).alias("target"))


def finish_times(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    seed: str = "mix",
    bucket_rows: int = 200_000,
    row_col: str | None = None,
) -> DataFrame:
    """(doc_id, doc_key, row, source, size, source_size, target, budget, s, key, f1, f2): f1 and f2 are the finish times of
    the two passes.  row tells apart rows that share a doc_id: a hash of text and source, or what row_col holds."""
    doc_key, row = row_key(F.col("doc_id"), F.col("text").cast("string"), F.col("source").cast("string"))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        doc_key.alias("doc_key"),
        (F.col(row_col) if row_col else row).alias("row"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
    ).withColumn("key", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
    base = materialize(base, "mix-sizes")
    rows = base.count()
    digits = 2
    while rows > bucket_rows * 16**digits and digits < 6:
        digits += 1
    base = base.withColumn("bucket", F.substring("key", 1, digits))
    bucketed = base.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucketed.select(
        F.col("source").alias("source_"), F.col("bucket").alias("bucket_"), F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("ahead")
    )
    targets = _targets(bucketed, weights, share).withColumnRenamed("source", "source__")
    table = offsets.join(targets, F.col("source_").eqNullSafe(F.col("source__"))).drop("source__")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    queued = base.withColumn("inside", F.sum("size").over(inside))
    joined = queued.join(table, F.col("source").eqNullSafe(F.col("source_")) & (F.col("bucket") == F.col("bucket_")))
    return joined.select(
        "doc_id",
        "doc_key",
        "row",
        "source",
        "size",
        "source_size",
        "target",
        "budget",
        "s",
        "key",
        ((F.col("ahead") + F.col("inside")) / F.col("weight")).alias("f1"),
        ((F.col("ahead") + F.col("inside") + F.col("source_size")) / F.col("weight")).alias("f2"),
    )


def _cut(copies: DataFrame, budget: float, last: float, order: list[str], range_rows: int):
    """The first copy, in order, that does not fit within the budget; None if all do.  Copies of no words fit anywhere."""
    part, low, high, left = copies.where("size > 0"), 0.0, last, budget
    every = Window.partitionBy(F.lit(1))
    while True:
        width = (high - low) / _RANGES or 1.0
        ranged = part.withColumn("r", F.floor((F.col("f") - F.lit(low)) / F.lit(width)))
        totals = ranged.groupBy("r").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("f").alias("low"), F.max("f").alias("high"))
        run = totals.withColumn("to", F.sum("size").over(every.orderBy("r")))  # some _RANGES rows
        over = run.where(F.col("to") > F.lit(left)).orderBy("r").limit(1).first()
        if over is None:
            return None
        left -= over["to"] - over["size"]
        part = part.where((F.col("f") >= F.lit(over["low"])) & (F.col("f") <= F.lit(over["high"])))
        # one finish time is that of one copy a source and pass, at most
        if over["n"] <= range_rows or over["low"] == over["high"] or (over["low"], over["high"]) == (low, high):
            break
        low, high = over["low"], over["high"]
    line = part.withColumn("to", F.sum("size").over(every.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    return line.where(F.col("to") > F.lit(left)).orderBy(*order).limit(1).first()


def plan_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    seed: str = "mix",
    bucket_rows: int = 200_000,
    range_rows: int = 100_000,
    row_col: str | None = None,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies, f1, doc_key, row), one row per document row.

    size counts white-space words (null text: 0).  Sources are ranked by code point, null
    last, and weigh `weights` in turn.  taken = size x copies; copies is how many of the two
    passes end within the budget of `share` times all words.  The order is a function of
    seed, doc_id, text and source: reruns agree, and rows that repeat a doc_id stand next to
    each other.  Rows without doc_id take part like others.  Rows equal in all of these have
    their order from row_col, or are interchangeable without it.  An empty table, or one
    without any word, takes nothing but empty documents.
    """
    timed = materialize(finish_times(docs, weights, share, seed, bucket_rows, row_col), "mix-times")
    order = ["f", "s", "key", "doc_key", "row", "pass"]
    common = ["s", "key", "doc_key", "row"]
    copies = timed.select(
        F.explode(F.array(*(F.struct(F.col(f"f{k}").alias("f"), *common, F.lit(k).alias("pass"), "size") for k in (1, 2)))).alias("c")
    ).select("c.*")
    head = timed.agg(F.max("f2").alias("last"), F.max("budget").alias("budget")).first()
    cut = _cut(copies, head["budget"] or 0.0, head["last"] or 0.0, order, range_rows)
    if cut is None:
        inside = F.lit(True), F.lit(True)
    else:
        at = F.struct(*(F.lit(cut[c]).cast(kind) for c, kind in zip(order, ("double", "long", "string", "long", "long", "int"), strict=True)))
        place = [F.col(c).cast("long") if c == "s" else F.col(c) for c in common]
        inside = tuple(F.struct(F.col(f"f{k}"), *place, F.lit(k)) < at for k in (1, 2))
    n = inside[0].cast("int") + inside[1].cast("int")
    return timed.withColumn("copies", n).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "f1", "doc_key", "row"
    )


def mix(docs: DataFrame, ordered: bool = False, **parameters) -> DataFrame:
    """The mixed documents: each row as many times as plan_mix takes it, columns as they come, whatever their names.

    Rows without doc_id, and rows that share one, are taken each by its own plan.  Where rows
    are equal in doc_id, text and source, the table is written once more with a row number,
    which then tells them apart.  ordered=True adds the global range sort by finish time (one
    more shuffle of the texts).
    """
    k, r, n, f, c = (fresh(docs, x) for x in ("doc_key", "row_key", "copies", "finish", "copy"))
    plan = materialize(plan_mix(docs, **parameters).select("doc_key", "row", "copies", "f1"), "mix-plan")
    if plan.groupBy("doc_key", "row").count().where("count > 1").head(1):
        base, number = with_row_id(docs)
        plan = materialize(plan_mix(base, row_col=number, **parameters).select("doc_key", "row", "copies", "f1"), "mix-plan")
        keyed = base.withColumnsRenamed({number: r})
    else:
        keyed = docs.withColumn(r, row_key(F.col("doc_id"), F.col("text").cast("string"), F.col("source").cast("string"))[1])
    keyed = keyed.withColumn(k, row_key(F.col("doc_id"))[0])
    taken = plan.where("copies > 0").select(F.col("doc_key").alias(k), F.col("row").alias(r), F.col("copies").alias(n), F.col("f1").alias(f))
    out = keyed.join(taken, [k, r]).withColumn(c, F.explode(F.sequence(F.lit(1), F.col(n))))
    if ordered:
        out = out.orderBy(c, f, k)
    return out.select(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = plan_mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
with base as (
  select doc_id, source, md5('mix:' || coalesce(cast(doc_id as varchar), 'null')) k,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) size from documents),
named as (
  select source, source_size, row_number() over (order by source is null, source) - 1 s
  from (select source, cast(sum(size) as bigint) source_size from base group by source)),
weighed as (
  select *, [3, 1, 2][s % 3 + 1] weight, sum(source_size) over () * cast(1.5 as double) budget,
    2 * source_size / cast([3, 1, 2][s % 3 + 1] as double) ratio from named),
levels as (
  select *, (budget - coalesce(sum(2 * source_size) over (order by ratio, s rows between unbounded preceding and 1 preceding), 0))
    / cast(sum(weight) over (order by ratio, s rows between current row and unbounded following) as double) level_ from weighed),
targets as (
  select source, s, weight, source_size, budget,
    least(cast(2 * source_size as double), coalesce((select level_ from levels where ratio > level_ order by ratio, s limit 1),
      (select max(ratio) from levels)) * weight) target from levels),
timed as (
  select b.doc_id, b.k, b.size, t.*, sum(b.size) over (partition by t.s order by b.k, b.doc_id rows unbounded preceding) cum
  from base b join targets t on b.source is not distinct from t.source),
copies as (
  select doc_id, k, s, size, budget, 1 pass, cum / cast(weight as double) f from timed
  union all select doc_id, k, s, size, budget, 2, (cum + source_size) / cast(weight as double) from timed),
taken as (
  select doc_id, size, budget, sum(size) over (order by f, s, k, doc_id, pass rows unbounded preceding) upto from copies)
select t.doc_id, t.size, t.source_size, t.target, cast(coalesce(x.taken, 0) as bigint) taken
from timed t left join (select doc_id, sum(size) taken from taken where upto <= budget group by doc_id) x using (doc_id)
"""
