"""Near-duplicate lines by an exact set-similarity join, in DataFrame functions only.

A line is the set of its lower-cased words.  Words are ordered from rare to common (by
counts over all lines, in hashed buckets: any fixed order is correct, a rarity order is
fast).  Two sets of Jaccard similarity `t` or more share a word within their prefixes.
Prefix entries meet on the word; lengths and positions rule pairs out, and so do 64 bits an
entry (128 in long lines), of which each word flips one: two sets differ in at least as many words as in bits.  Pairs left are verified on the words of both lines.

A line goes if an earlier line (by doc_id, then line number) is similar enough, whether or
not that one stays.  So a line needs one witness, not all partners.  Where a word is in many
prefixes, its sets are first compared with the earliest of them alone; those left without a
witness meet the others on two shared words instead of one, which similar sets also have
(within prefixes longer by one).  Lines with equal word sets collapse before anything else.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, drop_table, free_shuffles, materialize, read_table

SIMILARITY = 0.8
FREQUENCY_BITS = 17
_HASH_BITS = 56
#: A word in more prefixes than this has its sets compared with the earliest of them first.
HOT = 500
#: Sets of more words than this have 128 bits, others 64: few bits tell long lines badly apart, many cost a third of an entry.
LONG = 64
_BITS = [1 << k if k < 63 else -(1 << 63) for k in range(64)]
#: Lines to verify (four numbers each) are told to the scan of the texts up to this number; beyond, texts are shuffled to them.
_TOLD = 1_000_000
#: Words in many prefixes, and the earliest set of each (some 80 bytes), are broadcast up to this number; beyond, prefixes are shuffled to them.
_SENT = 400_000
#: Of the entries of such words, so many a set are paired with the later words of their prefixes at once.
_ENTRIES_A_SET = 0.5


def _clean(text: Column) -> Column:
    """The text with blanks for other white space within its lines; few texts have any."""
    text = text.cast("string")
    has = text.contains("\t") | text.contains("\x0b") | text.contains("\x0c") | text.contains("\r")
    return F.when(has, F.regexp_replace(text, r"[\t\x0B\x0C\r]", " ")).otherwise(text)


def _words(line: Column) -> Column:
    """The lower-cased words of a line whose white space is blanks."""
    return F.array_remove(F.split(F.lower(line), " "), "")


def _numbered_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row, line_no, line) of every line with a word; row tells apart rows that share a doc_id."""
    base = docs.select(
        _id(F.col("doc_id")).alias("doc_id"),
        F.xxhash64("text").alias("row"),
        F.posexplode(F.split(_clean(F.col("text")), "\n")).alias("line_no", "line"),
    )
    return base.where(F.ltrim("line") != "")


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))


def word_frequencies(docs: DataFrame, bits: int = FREQUENCY_BITS) -> list[int]:
    """Class (up to 127) of each hash bucket of words by its count over all texts, four classes a doubling, rare first."""
    counts = (
        docs.select(F.explode(F.split(F.lower(F.replace(_clean(F.col("text")), F.lit("\n"), F.lit(" "))), " ")).alias("w"))
        .groupBy(F.shiftrightunsigned(F.xxhash64("w"), 64 - bits).cast("int").alias("b"))
        .count()
        .collect()  # at most 2 ** bits rows
    )
    rank = [0] * (1 << bits)
    for r in counts:
        rank[r["b"]] = _class(r["count"])
    return rank


def _class(count: int) -> int:
    return min(127, int(4 * math.log2(1 + count)))


def _least(n: Column, share: float) -> Column:
    """The smallest whole number that is at least share * n."""
    return F.ceil(n * F.lit(share) - F.lit(1e-9)).cast("int")


def _table(values: list[int], kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _ordered(line: Column, rank: list[int]) -> Column:
    """A line's distinct words as longs that sort from rare to common: the bucket's class above the word's hash."""
    table, shift = _table(rank, "int"), 65 - len(rank).bit_length()

    def code(h: Column) -> Column:
        kind = F.coalesce(F.get(table, F.shiftrightunsigned(h, shift).cast("int")), F.lit(0)).cast("long")  # never null: a sort of plain longs
        return F.shiftleft(kind, _HASH_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - _HASH_BITS))

    coded = F.transform(F.transform(_words(line), lambda w: F.xxhash64(w)), code)
    return F.sort_array(F.array_distinct(coded))


def _jaccard_at_least(a: Column, b: Column, t: float) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both >= F.lit(t) * (F.size(a) + F.size(b) - both) - F.lit(1e-9)


def _flips(words: Column) -> tuple[Column, Column]:
    """Bits of which each word flips one, by the low bits of its hash: in sets of more than LONG words 128 as two halves, else
    64 and zero.  The halves of a long set flipped together are its 64 bits."""

    def bits(table: list[int]) -> Column:
        last, values = F.lit(len(table) - 1), _table(table, "bigint")
        return F.aggregate(words, F.lit(0).cast("long"), lambda s, h: s.bitwiseXOR(F.get(values, h.bitwiseAND(last).cast("int"))))

    none, long_ = [0] * 64, F.size(words) > LONG
    return F.when(long_, bits(_BITS + none)).otherwise(bits(_BITS)), F.when(long_, bits(none + _BITS)).otherwise(F.lit(0).cast("long"))


def _may_match(t: float) -> Column:
    """Length filter; positional filter (similar sets also meet at the first word they share, and from
    there on both still have the overlap before them); and the bits in which the sets differ are no more
    than the words in which they may."""
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    needed = _least(F.col("na") + F.col("nb"), t / (1 + t))
    may_differ = F.col("na") + F.col("nb") - 2 * needed
    x, y = (F.col(f"{c}a").bitwiseXOR(F.col(f"{c}b")) for c in "xy")
    differ = F.when(small > LONG, F.bit_count(x) + F.bit_count(y)).otherwise(F.bit_count(x.bitwiseXOR(y)))
    return (
        (differ <= may_differ)
        & (F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= needed)
        & (small >= F.lit(t) * large - F.lit(1e-9))
    )


_ENTRY = ("s", "n", "p", "x", "y")


def _entries(sets: DataFrame, t: float, *more: str) -> DataFrame:
    """(word, s, n, p, x, y): the prefix entries of the sets that can have a partner with other words."""
    able = sets.where(F.col("n") >= F.lit(t / (1 - t) - 1e-9))
    every = able.select(F.col("th").alias("s"), "n", "x", "y", *more, F.posexplode("prefix").alias("p", "word"))
    return every.where(F.col("p") <= F.col("n") - _least(F.col("n"), t))


def _shorter_first(t: float) -> Column:
    """a is the shorter set (the smaller hash of equals), at a place where it can first meet one as long: the two share more
    words than a shorter partner need share with it, so fewer places are enough.  One condition on both sides, which is not
    moved before the shuffle: both sides read the same one."""
    places = F.col("pa") <= F.col("na") - _least(F.col("na"), 2 * t / (1 + t))
    return F.when((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("sa") < F.col("sb"))), places)


def _side(entries: DataFrame, side: str, key: str = "word") -> DataFrame:
    return entries.select(key, *(F.col(c).alias(f"{c}{side}") for c in _ENTRY))


def _word_pairs(sets: DataFrame, crowded: DataFrame, t: float) -> DataFrame:
    """(word, s, n, p, x, y): entries of two words, the first of them in many prefixes and the second from the prefix longer by one."""
    able = sets.where(F.col("n") >= F.lit(t / (1 - t) - 1e-9))
    first = able.select(F.col("th").alias("s"), "n", "x", "y", "prefix", F.posexplode("prefix").alias("p", "word"))
    of_many = first.where(F.col("p") <= F.col("n") - _least(F.col("n"), t)).join(crowded, "word", "left_semi")
    later = F.slice("prefix", F.col("p") + 2, F.size("prefix"))
    return of_many.select("s", "n", "x", "y", "p", "word", F.explode(later).alias("next")).select(
        F.xxhash64("word", "next").alias("word"), "s", "n", "p", "x", "y"
    )


def similar_lines(docs: DataFrame, t: float = SIMILARITY, hot: int = HOT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The lines (doc_id, row, line_no, th); the word sets (th, first, copies); and the th of those with an earlier similar set.

    Sets are told apart by 64 bits of hash.  `hot` decides on the order of comparisons, not on the result."""
    rank, lines, spark = word_frequencies(docs), _numbered_lines(docs), docs.sparkSession
    n, (x, y) = F.size("words"), _flips(F.col("words"))
    full = materialize(
        lines.select("doc_id", "row", "line_no", _ordered(F.col("line"), rank).alias("words")).select(
            "doc_id",
            "row",
            "line_no",
            F.xxhash64("words").alias("th"),
            F.struct(n.alias("n"), x.alias("x"), y.alias("y"), F.slice("words", F.lit(1), n - _least(n, t) + 2).alias("prefix")).alias("set"),
        ),
        "lines",
    )
    keyed = materialize(full.select("doc_id", "row", "line_no", "th"), "lines")
    sets = materialize(
        full.groupBy("th")
        .agg(F.min(F.struct("doc_id", "line_no", "row")).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("set").alias("set"))
        .select("th", "first", "copies", "set.*"),
        "line-sets",
    )
    drop_table(full)
    free_shuffles(spark)
    # words in many prefixes, and the earliest set of each
    least = _class(hot) << _HASH_BITS  # no word of a lower class is in more than `hot` prefixes
    entries = _entries(sets, t)
    frequent = _entries(sets, t, "first").where(F.col("word") >= least)
    counted = materialize(frequent.groupBy("word").count().where(F.col("count") > hot), "line-crowded")
    free_shuffles(spark)
    known = counted.agg(F.count(F.lit(1)).alias("words"), F.sum("count").alias("entries")).first()
    some, sent = known["words"] > 0, F.broadcast if known["words"] <= _SENT else lambda df: df
    crowded = sent(counted.select("word"))
    of_crowded = frequent.join(crowded, "word", "left_semi")
    heads = of_crowded.groupBy("word").agg(F.min(F.struct("first", *_ENTRY)).alias("h")).select("word", *(f"h.{c}" for c in _ENTRY))
    heads = materialize(heads, "line-heads") if some else None
    few = entries.join(crowded, "word", "left_anti") if some else entries
    # without the crowded words no key has many rows; one shuffle serves both sides
    met = _side(few, "a").join(_side(few, "b"), "word")
    pairs = met.where(_shorter_first(t)).where(_may_match(t)).select("sa", "sb")
    if some:
        star = _side(frequent, "b").join(sent(_side(heads, "a")), "word").where("sa <> sb")
        pairs = pairs.unionByName(star.where(_may_match(t)).select("sa", "sb"))
    ends = F.least("sa", "sb").alias("a"), F.greatest("sa", "sb").alias("b")
    pairs = materialize(pairs.select(*ends).distinct(), "line-pairs")
    del few, entries, met, frequent, of_crowded
    free_shuffles(spark)
    gone = _later(docs, sets, pairs, rank, t)
    if some:
        # sets without a witness against all others, where they share a word of many prefixes and one more; the larger the input,
        # the more words are in many prefixes, so these words are taken in as many parts as keep the pairs of words few to a set
        found, parts = [], max(1, math.ceil(known["entries"] / (_ENTRIES_A_SET * sets.count())))
        for part in range(parts):
            mine = sent(counted.where(F.pmod(F.xxhash64("word"), F.lit(parts)) == part).select("word"))
            double = _word_pairs(sets, mine, t).join(gone.select(F.col("th").alias("s"), F.lit(True).alias("has")), "s", "left")
            double = materialize(double, "line-doubles")
            free_shuffles(spark)
            left = _side(double.where("has is null"), "a").join(_side(double, "b"), "word").where("sa <> sb")
            found.append(materialize(left.where(_may_match(t)).select(*ends).distinct().join(pairs, ["a", "b"], "left_anti"), "line-pairs"))
            drop_table(double)
            del double, left
            free_shuffles(spark)
        rest = reduce(DataFrame.unionByName, found)
        if not rest.isEmpty():
            gone = materialize(gone.unionByName(_later(docs, sets, rest, rank, t)).distinct(), "line-settled")
            free_shuffles(spark)
    return keyed, sets.select("th", "first", "copies"), gone


def _later(docs: DataFrame, sets: DataFrame, pairs: DataFrame, rank: list[int], t: float) -> DataFrame:
    """(th) of the later sets of the pairs whose words are similar enough."""
    spark = docs.sparkSession
    ends = pairs.select(F.explode(F.array("a", "b")).alias("th")).distinct()
    wanted = sets.select("th", "first.doc_id", "first.row", "first.line_no").join(ends, "th", "left_semi")
    # only those lines are read for words; whole texts move where there are more lines than can be told to the scan
    wanted = materialize(wanted, "line-ends")
    told = wanted.count() <= _TOLD
    holders = wanted.select("doc_id", "row").distinct()
    texts = docs.select(_id(F.col("doc_id")).alias("doc_id"), F.xxhash64("text").alias("row"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(holders) if told else holders, ["doc_id", "row"], "left_semi")
    found = texts.select("doc_id", "row", F.posexplode(F.split(_clean(F.col("text")), "\n")).alias("line_no", "line"))
    found = found.join(F.broadcast(wanted) if told else wanted, ["doc_id", "row", "line_no"])
    words = materialize(found.select("th", _ordered(F.col("line"), rank).alias("words")).dropDuplicates(["th"]), "line-words")
    del found, texts, holders
    free_shuffles(spark)
    ended = words.join(sets.select("th", "first"), "th")
    left, right = (ended.select(F.col("th").alias(k), F.col("words").alias(f"w{k}"), F.col("first").alias(f"f{k}")) for k in "ab")
    close = pairs.join(left, "a").join(right, "b").where(_jaccard_at_least(F.col("wa"), F.col("wb"), t))
    gone = materialize(close.select(F.when(F.col("fa") > F.col("fb"), F.col("a")).otherwise(F.col("b")).alias("th")).distinct(), "line-settled")
    del close, left, right, ended
    drop_table(words)
    free_shuffles(spark)
    return gone


def _verdicts(docs: DataFrame, t: float) -> DataFrame:
    """(doc_id, row, n_lines, removed): lines with a word, and the numbers (from 0) of those that go."""
    lines, sets, gone = similar_lines(docs, t)
    # lines that stand alone in their set and stay need no partner
    settled = sets.join(gone.withColumn("gone", F.lit(True)), "th", "left").where("copies > 1 or gone").select("th", "first", "gone")
    judged = lines.join(settled, "th", "left")
    out = F.coalesce("gone", F.lit(False)) | F.coalesce(F.struct("doc_id", "line_no", "row") != F.col("first"), F.lit(False))
    return (
        judged.select("doc_id", "row", "line_no", out.alias("out"))
        .groupBy("doc_id", "row")
        .agg(F.collect_set("line_no").alias("all"), F.sort_array(F.collect_set(F.when(F.col("out"), F.col("line_no")))).alias("removed"))
        .select("doc_id", "row", F.size("all").cast("long").alias("n_lines"), "removed")
    )


def _with_verdicts(docs: DataFrame, t: float, *columns: Column) -> DataFrame:
    found = _verdicts(docs, t).withColumnsRenamed({"doc_id": "k_", "row": "r_"})
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns, _id(F.col("doc_id")).alias("k_"), F.xxhash64("text").alias("r_"))
    none = F.array().cast("array<int>")
    return keyed.join(found, ["k_", "r_"], "left").select(
        "doc_id",
        *(c for c in keyed.columns if c not in ("doc_id", "k_", "r_")),
        F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
        F.coalesce("removed", none).alias("removed"),
    )


def mark_lines(docs: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed_lines), one row per row of docs.

    n_lines counts lines with a word; removed_lines are the numbers (from 0) of the lines that
    go.  A null or blank text has no line and loses none; lines without a word always stay.
    A line goes if an earlier line, by doc_id (null first), line number and text hash, has an
    equal or similar word set.  Rows that repeat doc_id and text count as one document and
    are marked alike.  Other columns are not read; an empty table gives an empty result.
    """
    return _with_verdicts(docs, t).select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.col("removed").alias("removed_lines"))


def remove_lines(docs: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """(doc_id, text, n_removed): the texts without the lines that mark_lines names."""
    marked = _with_verdicts(docs, t, F.col("text").cast("string").alias("text"))
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
    text = F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(F.transform(stay, lambda k: F.get(lines, k)), "\n"))
    return marked.select("doc_id", text.alias("text"), F.size("removed").cast("long").alias("n_removed"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_lines(read_table(spark, sf_dir, "documents"))
