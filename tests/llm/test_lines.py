import re

import numpy as np
from pyspark.sql import functions as F

from pagelattice.llm import lines


def sets(text):
    return [(k, frozenset(re.findall(r"[^\x20\x09-\x0D]+", x.lower()))) for k, x in enumerate((text or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)]


def brute(texts, t=0.8):
    seen, out = [], {}
    for i in sorted(texts):
        own = sets(texts[i])
        gone = []
        for k, s in own:
            if any(10 * len(s & o) >= 10 * t * len(s | o) - 1e-6 for o in seen):
                gone.append(k)
            seen.append(s)
        out[i] = (len(own), gone)
    return out


def marked(docs):
    return {r["doc_id"]: (r["n_lines"], r["removed_lines"]) for r in lines.mark_lines(docs).collect()}


def test_documents_against_brute_force(documents, texts):
    some = {i: t for i, t in texts.items()}
    assert marked(documents) == brute(some)


def test_few_words_and_near_copies(spark):
    rng = np.random.default_rng(2)
    texts = {}
    for i in range(60):
        own = []
        for _ in range(rng.integers(0, 6)):
            k = int(rng.integers(1, 25))
            base = [f"w{x}" for x in range(k)]
            for _ in range(rng.integers(0, 4)):
                base[rng.integers(0, k)] = f"v{rng.integers(0, 6)}"
            own.append(" ".join(base).title() if rng.random() < 0.2 else " ".join(base))
        texts[i] = "\n".join(own)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got, want = marked(rows), brute(texts)
    assert got == want and sum(len(g) for _, g in got.values()) > 40


def test_odd_rows(odd):
    rows = lines.mark_lines(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_lines"] == 0 and by[5]["removed_lines"] == [0] and by[4]["removed_lines"] == [] and by[6]["n_lines"] == 2
    out = {r["doc_id"]: r["text"] for r in lines.remove_lines(odd).collect()}
    assert out[1] is None and out[5] == "" and out[4] == "one"
    assert lines.mark_lines(odd.where(F.lit(False))).count() == 0


def test_comparing_with_the_earliest_first_changes_nothing(spark):
    rng = np.random.default_rng(5)
    lined = []
    for i in range(80):
        words = [f"w{x}" for x in rng.choice(14, int(rng.integers(8, 13)), replace=False)]
        lined.append((i, "\t".join(words) if i % 9 == 0 else "  ".join(words) if i % 7 == 0 else " ".join(words)))
    rows = spark.createDataFrame(lined, "doc_id long, text string")
    want = {i for i, (_, gone) in brute(dict(lined)).items() if gone}
    for hot in (1, 1 << 40):
        _, sets, gone = lines.similar_lines(rows, hot=hot)
        kept = {r["doc_id"] for r in sets.join(gone, "th", "left_anti").select("first.doc_id").collect()}
        assert set(range(80)) - kept == want and 5 < len(want) < 75, hot


def test_crowded_words_meet_on_two(spark):
    """Words in many prefixes: sets left without a witness are found by pairs of words, near copies by the earliest."""
    rng = np.random.default_rng(8)
    common = [f"c{x}" for x in range(9)]
    lined = []
    for i in range(300):
        if i % 3 == 0:
            words = [*common, *(f"z{x}" for x in rng.choice(40, 2, replace=False))]
        else:
            words = list(rng.choice([*common, *(f"q{x}" for x in range(12))], int(rng.integers(4, 9)), replace=False))
        lined.append((i, " ".join(words)))
    rows = spark.createDataFrame(lined, "doc_id long, text string").repartition(3)
    want = brute(dict(lined))
    for hot in (3, 1 << 40):
        _, sets, gone = lines.similar_lines(rows, hot=hot)
        kept = {r["doc_id"] for r in sets.join(gone, "th", "left_anti").select("first.doc_id").collect()}
        first = {}
        for i, t in lined:
            first.setdefault(frozenset(t.split()), i)
        assert kept == {i for i in first.values() if not want[i][1]} and 20 < len(kept) < len(first), hot


def test_long_lines(spark):
    """Lines of some hundred words, near copies and others that share many words."""
    rng = np.random.default_rng(11)
    lined, base = [], None
    for i in range(60):
        if i % 4 == 0:
            base = [f"w{x}" for x in rng.choice(500, int(rng.integers(70, 300)), replace=False)]
        words = list(base)
        for k in rng.choice(len(base), int(len(base) * rng.choice([0.02, 0.09, 0.11, 0.13, 0.3])), replace=False):
            words[k] = f"x{rng.integers(0, 300)}"
        lined.append((i, "\t".join(words) if i % 5 == 0 else " ".join(words)))
    want = brute(dict(lined))
    assert marked(spark.createDataFrame(lined, "doc_id long, text string")) == want and 5 < sum(len(g) for _, g in want.values()) < 50


def test_words_are_sorted_as_plain_longs(spark):
    rows = spark.createDataFrame([("b a b",)], "line string").select(lines._ordered(F.col("line"), [0] * 8).alias("words"))
    assert not rows.schema["words"].dataType.containsNull


def test_lines_on_both_sides_of_the_longer_bits(spark):
    """Near copies whose lengths lie below, at and above the bound from which a set has twice as many bits."""
    rng = np.random.default_rng(13)
    lined, base = [], [f"w{x}" for x in range(lines.LONG + 8)]
    for i in range(60):
        if i % 6 == 0:
            base = [f"w{x}" for x in rng.choice(400, lines.LONG + 8, replace=False)]
        words = base[: lines.LONG + int(rng.integers(-8, 9))]
        for k in rng.choice(len(words), int(len(words) * rng.choice([0.02, 0.07, 0.1, 0.12])), replace=False):
            words[k] = f"x{rng.integers(0, 300)}"
        lined.append((i, " ".join(words)))
    want = brute(dict(lined))
    assert marked(spark.createDataFrame(lined, "doc_id long, text string")) == want and 5 < sum(len(g) for _, g in want.values()) < 58
