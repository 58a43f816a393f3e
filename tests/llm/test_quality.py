import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagelattice.llm import neighbours, quality_rules

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    w = re.findall(WORD, text or "")
    seen = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    hit = set()
    for k in range(len(w) - 4):
        if seen[tuple(w[k : k + 5])] > 1:
            hit.update(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed


def base(df):
    return {r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in df.collect()}


def test_base_against_brute_force(spark, documents, texts):
    made = {-1: "a b c d e f a b c d e", -2: "a " * 50, -3: "x\ny\nx\nx\n \n \ny", -4: "\U0001f600 é" * 3, -5: "a b c d e a b c d e a b c d e", -6: "a b c d"}
    more = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(more)
    assert base(quality_rules.score(docs, [0] * 100)) == {i: brute(t) for i, t in (texts | made).items()}


def plain_grams(text, buckets):
    """Hashed uni- and bigrams with the library's XXH64, word by word."""
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(WORD, text or "")]
    pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(h, h[1:], strict=False)]
    return [(x - (x >> 63 << 64)) % buckets for x in (*h, *pairs)]


def test_verdicts_against_brute_force(spark, documents, texts):
    """score and kept of every document, from counts made one gram at a time."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    trusted = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and not r["toxic"]}
    grams = {i: plain_grams(t, quality_rules.BUCKETS) for i, t in texts.items()}
    raw, good = Counter(g for x in grams.values() for g in x), Counter(g for i, x in grams.items() if i in trusted for g in x)
    bottom = math.log((good.total() + quality_rules.BUCKETS) / (raw.total() + quality_rules.BUCKETS))
    ratio = [round(quality_rules.SCALE * (math.log((good[b] + 1) / (raw[b] + 1)) - bottom)) for b in range(quality_rules.BUCKETS)]
    got = {r["doc_id"]: (r["score"], r["kept"]) for r in quality_rules.op4_quality_rules(spark, SF).collect()}
    for i, x in grams.items():
        score = sum(ratio[g] for g in x) / max(len(x), 1) / quality_rules.SCALE
        assert got[i][0] == pytest.approx(score, abs=1e-12)
        assert got[i][1] == (not brute(texts[i])[-1] and got[i][0] >= quality_rules.THRESHOLD)


def test_ratio_counts(spark):
    """Words of trusted documents alone score above, words of the others below."""
    docs = spark.createDataFrame([(1, "good fine good"), (2, "bad worse bad bad"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    scored = {r["doc_id"]: r["score"] for r in quality_rules.judge(docs, labels).collect()}
    assert scored[1] > 0 > scored[2] and scored[3] == 0


def test_all_trusted_documents_count(spark):
    """Where every document is trusted, however many there are, both multinomials are the same."""
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 997, F.lit(" x"), F.col("id") % 31).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert set(quality_rules.gram_ratios(docs, quality_rules.trusted_ids(labels.union(labels)))) == {0}


def test_trusted_join_by_shuffle(spark, documents):
    """The counts are the same where the ids are joined by shuffle, and for more buckets than two bytes hold."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = {n: quality_rules.gram_ratios(documents, quality_rules.trusted_ids(labels), n) for n in (10_000, 40_000)}
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert want == {n: quality_rules.gram_ratios(documents, quality_rules.trusted_ids(labels), n) for n in want}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_separates_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.judge(docs, labels).join(labels, "doc_id").collect()
    kept = {q: np.mean([r["kept"] for r in rows if r["quality"] == q]) for q in (0, 1)}
    assert kept[1] > 0.9 and kept[0] < 0.1


def test_odd_rows(spark, odd):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality_rules.judge(odd, labels).collect()
    assert len(rows) == odd.count() and not any(r["kept"] for r in rows if r["doc_id"] in (1, 2, 3, 4, 9))
    assert quality_rules.judge(odd.where(F.lit(False)), labels).count() == 0
    assert quality_rules.judge(odd, labels.where(F.lit(False))).count() == odd.count()


def test_neighbours_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = neighbours.op7_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(rows) == docs.count() and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95


def test_neighbours_are_exact():
    """Scores equal the vote over all cosines, computed one document at a time."""
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    known, new = unit(rng.standard_normal((300, 8))), unit(rng.standard_normal((20, 8)))
    y = rng.integers(0, 2, 300)
    model = neighbours.NeighbourModel(np.zeros((1, 8)), known, y, np.ones(2), 0.5, 25)
    for v, s in zip(new, model.scores(new), strict=True):
        top = np.argsort(-(known @ v))[:25]
        w = np.maximum(known[top] @ v, 0) ** 4
        assert s == pytest.approx(((w * y[top]).sum() + 0.0005) / (w.sum() + 0.001))


def test_predictions_against_a_plain_version(spark, documents, texts):
    """Features counted word by word, vectors summed one by one, all cosines sorted."""
    model = neighbours.fit(documents, spark.read.parquet(f"{SF}/labels.parquet"))

    def plain(text):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        if not words:
            return np.zeros(model.projection.shape[1])
        shape = lambda w: b"A" if w.isupper() else b"a" if w.islower() else b"x"
        n = Counter(f for w in words for f in (zlib.crc32(w) % neighbours.FEATURES, zlib.crc32(shape(w) + w[-3:]) % neighbours.FEATURES))
        value = {f: 1 + math.log(k) for f, k in n.items()}
        again = sum(zlib.crc32(a) % neighbours.FEATURES == zlib.crc32(b) % neighbours.FEATURES for a, b in zip(words, words[1:], strict=False)) / len(words)
        length = math.sqrt(sum(v * v for v in value.values()))
        value |= {neighbours.FEATURES + k: 0.4 * length for k, x in enumerate(neighbours.AGAIN) if again >= x}
        v = sum(w * model.projection[f].astype(float) for f, w in value.items())
        return v / max(np.linalg.norm(v), 1e-9)

    got = {r["doc_id"]: r for r in neighbours.predict(documents, model).collect()}
    for i, text in sorted(texts.items())[:120]:
        near = model.vectors.astype(float) @ plain(text)
        top = np.argsort(-near, kind="stable")[: model.neighbours]
        w = np.maximum(near[top], 0) ** 4
        assert got[i]["score"] == pytest.approx(((w * model.labels[top]).sum() + 1e-3 * model.prior) / (w.sum() + 1e-3), abs=2e-3)


def test_query_without_ids(spark, odd, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    rows = neighbours.op7_quality_classifier(spark, str(tmp_path)).collect()
    assert len(rows) == odd.count() and [r["held_out"] for r in rows if r["doc_id"] is None] == [False]


def test_neighbours_odd_rows(spark, odd, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = neighbours.fit(documents, labels)
    rows = neighbours.predict(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)} == {model.prior}
    assert neighbours.predict(odd.where(F.lit(False)), model).count() == 0
    nothing = neighbours.fit(documents, labels.where(F.lit(False)))
    assert {r["score"] for r in neighbours.predict(odd, nothing).collect()} == {0.5}


def test_an_id_that_repeats_is_learned_once(spark):
    """However often a labelled id occurs, one row of it reaches the driver, and what is learned stays the same."""
    texts = [(i, f"{'good plain words' if i % 2 else 'junk junk spam'} number {i}") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, quality int")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    many = docs.unionByName(spark.createDataFrame([(3, texts[3][1])] * 500, "doc_id long, text string"))
    once, often = (neighbours.fit(d, labels) for d in (docs, many))
    assert len(often.vectors) == 40 and (once.vectors == often.vectors).all()
