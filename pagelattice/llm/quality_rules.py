"""Quality rules: base rules and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Word unigrams and bigrams are hashed into a fixed number of buckets.  One multinomial is
counted over the whole corpus, one over trusted documents; a document's score is the mean
over its n-grams of log(p_trusted / p_raw), and a document is kept where the score reaches
a threshold, without any random draw.  The ratios are whole numbers (ten-thousandths), so a
score is an exact fraction and does not depend on the order of addition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, read_table

BUCKETS = 10_000
SCALE = 10_000
SYMBOLS = r"[#*$%&|<>]"
BLANK = r"[\x20\x09-\x0D]"
#: Documents score around 0; junk, whose n-grams trusted documents lack, well below.
THRESHOLD = -0.05


def base_columns(text: Column) -> dict[str, Column]:
    """word_chars, n_symbols and n_dup_lines of a text (not null)."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return {
        "word_chars": (F.char_length(text) - F.regexp_count(text, F.lit(BLANK))).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def _bound(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(hashes: Column, width: int = 5) -> Column:
    """Words covered by windows that occur twice or more in the text, the first included.
    Windows are told apart by 64 bits of hash within one text."""
    windows = F.when(
        F.size(hashes) >= width,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - width),
            lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(width))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(pairs: Column) -> Column:
        twice = F.filter(
            pairs,
            lambda p, i: (p["h"] == F.get(pairs, i - 1)["h"]) | (p["h"] == F.get(pairs, i + 1)["h"]),
        )
        return _bound(
            F.array_sort(F.transform(twice, lambda p: p["i"])),
            lambda at: F.aggregate(
                F.transform(at, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(at, i + 1) - x, F.lit(width)))),
                F.lit(0),
                lambda a, x: a + x,
            ),
        )

    def when_any(w: Column) -> Column:
        pairs = F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_bound(F.sort_array(pairs), covered))

    return _bound(windows, when_any).cast("long")


def _word_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def _grams(hashes: Column, buckets: int) -> Column:
    """Buckets of the unigrams and bigrams of a text."""
    n = F.size(hashes)
    follow = F.when(n > 1, F.zip_with(F.slice(hashes, F.lit(1), n - 1), F.slice(hashes, F.lit(2), n - 1), lambda a, b: F.xxhash64(a, b)))
    both = F.concat(hashes, F.coalesce(follow, F.array().cast("array<bigint>")))
    return F.transform(both, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id) of all documents labelled as good and not toxic."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()


def gram_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = 1.0) -> list[int]:
    """log(p_trusted / p_raw) of each bucket, in units of 1 / SCALE, from counts over all documents."""
    # buckets, not hashes, go through the join's shuffle: two bytes a gram where they fit
    narrow = _grams(F.col("h"), buckets).cast("array<smallint>" if buckets <= 1 << 15 else "array<int>")
    read = docs.select("doc_id", _word_hashes(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h"))
    marked = read.select("doc_id", narrow.alias("g")).join(
        trusted.select(F.col("doc_id").alias("t")).hint("merge"), F.col("doc_id") == F.col("t"), "left"  # ids grow with the corpus
    )
    counts = (
        marked.select(F.col("t").isNotNull().cast("long").alias("t"), F.explode_outer("g").alias("b"))  # explode alone would filter below the join, and count the grams twice
        .where("b is not null")
        .groupBy("b")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("trusted"))
        .collect()  # at most `buckets` rows
    )
    raw, good = [0] * buckets, [0] * buckets
    for r in counts:
        raw[r["b"]], good[r["b"]] = r["raw"], r["trusted"]
    if not sum(good):
        return [0] * buckets
    bottom = math.log((sum(good) + smoothing * buckets) / (sum(raw) + smoothing * buckets))
    return [round(SCALE * (math.log((g + smoothing) / (r + smoothing)) - bottom)) for r, g in zip(raw, good, strict=True)]


def score(docs: DataFrame, ratios: list[int], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    A null text counts as empty: it has no words, fails the base rules and scores 0.  A text
    without n-grams scores 0.  Repeated rows are judged each; no other column is read; an
    empty table gives an empty result.
    """
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select("doc_id", text.alias("text")).select("doc_id", "text", _word_hashes(F.col("text")).alias("h"))
    total = F.aggregate(
        _grams(F.col("h"), len(ratios)), F.lit(0).cast("long"), lambda a, b: a + F.get(table, b)
    )
    n = F.size("h")
    grams = F.greatest(n + F.greatest(n - 1, F.lit(0)), F.lit(1))
    scored = read.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        *(c.alias(k) for k, c in base_columns(F.col("text")).items()),
        _repeat_words(F.col("h")).alias("n_repeat_words"),
        (total / grams / F.lit(float(SCALE))).alias("score"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Count both multinomials, then score every document."""
    return score(docs, gram_ratios(docs, trusted_ids(labels), buckets), threshold)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
