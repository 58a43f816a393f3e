import hashlib
import re

import pytest
from pyspark.sql import functions as F

from pagelattice.llm import mixing


def brute(rows, weights=(3, 1, 2), share=1.5):
    """Water-filling by rounds, then one sorted queue."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    total = {n: sum(z for z, r in zip(size, rows, strict=True) if r[2] == n) for n in names}
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    budget, target, open_ = share * sum(size), {}, set(names)
    while open_:
        left = budget - sum(target.values())
        level = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if level * weight[n] > 2 * total[n]}
        if not full:
            target |= {n: level * weight[n] for n in open_}
            break
        target |= {n: 2.0 * total[n] for n in full}
        open_ -= full
    queue, copies = [], [0] * len(rows)
    for n in names:
        own = sorted((hashlib.md5(f"mix:{'null' if rows[k][0] is None else rows[k][0]}".encode()).hexdigest(), rows[k][0] or 0, k) for k in range(len(rows)) if rows[k][2] == n)
        cum = 0
        for lap in (0, 1):
            for key, i, k in own:
                cum += size[k]
                queue.append((cum / weight[n], names.index(n), key, i, lap, k))
    spent = 0
    for *_, k in sorted(queue):
        spent += size[k]
        if spent > budget:
            break
        copies[k] += 1
    return {r[0]: (size[k], total[r[2]], target[r[2]], size[k] * copies[k]) for k, r in enumerate(rows)}


def check(got, want):
    assert set(got) == set(want)
    for i, w in want.items():
        assert got[i][:2] == w[:2] and got[i][3] == w[3] and got[i][2] == pytest.approx(w[2], abs=1e-6)


def plan(docs, **more):
    rows = mixing.plan_mix(docs, **more).select("doc_id", "size", "source_size", "target", "taken").collect()
    return {r["doc_id"]: tuple(r)[1:] for r in rows}


def test_documents_against_brute_force(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text", "source").collect()]
    got = plan(documents)
    check(got, brute(rows))
    assert got == plan(documents.repartition(7), bucket_rows=1, range_rows=3)


def test_skewed_sources_and_nulls(spark):
    rows = [(k, "w " * (k % 9), "big" if k % 3 else ("a", "b", None, "\U0001f600", "z")[k % 5]) for k in range(200)]
    rows += [(900, None, "empty"), (901, "", "empty"), (902, "x " * 500, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(plan(docs), brute(rows))
    taken = {i: (w[3], w[0]) for i, w in plan(docs).items()}
    assert all(t <= 2 * z for t, z in taken.values())


def test_mixed_rows(spark):
    rows = [(k, "w " * 5, "s" + str(k % 2)) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit("own"))
    want = {i: t // 5 for i, (_, _, _, t) in plan(docs).items()}
    for ordered in (False, True):
        mixed = mixing.mix(docs, ordered=ordered)
        got = mixed.groupBy("doc_id").count().collect()
        assert mixed.columns == docs.columns and {r["doc_id"]: r["count"] for r in got} == {i: n for i, n in want.items() if n}


def test_odd_rows(odd):
    assert mixing.plan_mix(odd).count() == odd.count()
    assert mixing.plan_mix(odd.where(F.lit(False))).count() == 0
    assert all(r["taken"] == 0 for r in mixing.plan_mix(odd.where("doc_id in (1, 2, 3)")).collect())


@pytest.mark.parametrize("repeats", [False, True])
def test_rows_without_and_with_shared_ids(spark, repeats):
    """Every row comes as often as planned: null ids, ids shared by different texts, and rows equal in all but other columns."""
    rows = [(None, f"null {k} " * (1 + k % 3), "a", k) for k in range(12)] + [(7, "seven " * k, "b", k) for k in range(1, 9)]
    rows += [(k, "w " * (k % 5), "ab"[k % 2], k) for k in range(20, 60)]
    if repeats:
        rows += [(99, "same same", "b", k) for k in range(100, 130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies long").withColumns({c: F.lit(1) for c in ("copies_", "f1_", "copy_", "row_key", "row_id")})
    planned = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["copies"]) for r in mixing.plan_mix(docs).collect())
    for ordered in (False, True):
        mixed = mixing.mix(docs, ordered=ordered)
        assert mixed.columns == docs.columns
        came = {}
        for r in mixed.collect():
            came[r["copies"]] = came.get(r["copies"], 0) + 1
        own = {k: (i is None, i or 0, len((t or "").split())) for i, t, _, k in rows[20:]} | {100_000 + k: (i is None, i or 0, len(t.split())) for k, (i, t, _, _) in enumerate(rows[:20])}
        total = sum(c for *_, c in planned)
        assert sum(came.values()) == total and len(own) == len(rows)
        if repeats:
            assert sum(came.get(k, 0) for k in range(100, 130)) == sum(c for _, i, _, c in planned if i == 99)
            assert max(came.get(k, 0) for k in range(100, 130)) <= 2
    nulls = [r for r in mixing.mix(docs).collect() if r["doc_id"] is None]
    assert sum(len(r["text"].split()) for r in nulls) == sum(z * c for none, _, z, c in planned if none) > 0


def test_ranges_are_divided_until_few_rows_are_left(spark, monkeypatch):
    """Many short documents beside one long source: the cut lies in a crowded range."""
    rows = [(k, "w", "a") for k in range(600)] + [(k, "", "a") for k in range(600, 700)] + [(k, "w " * 400, "b") for k in range(1000, 1003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    monkeypatch.setattr(mixing, "_RANGES", 3)
    check(plan(docs, range_rows=2), brute(rows))
