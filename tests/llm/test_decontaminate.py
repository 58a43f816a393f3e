import hashlib
import re

import pytest
from pyspark.sql import functions as F

from pagelattice.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, n=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = {}
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (own := windows.get(tuple(w[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    found |= own
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog again and again"),
    (2, "short item"),
    (10, "Short, ITEM"),
    (3, None),
    (4, "..."),
    (None, "no id here at all"),
    (5, "été à la plage"),
    (6, "a a a"),
]
TEXTS = [
    (1, "x THE quick-brown fox, jumps over the lazy dog again; and then"),
    (2, "the quick brown fox jumps over the lazy cat"),
    (3, "a short item and short item"),
    (4, None),
    (5, "a a a a b ÉTÉ été à la plage!"),
    (6, ""),
    (7, "quick brown fox jumps over the lazy dog again and again"),
]


@pytest.mark.parametrize("bound", [0, 10**6])
def test_both_ways_against_brute_force(spark, bound):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in D.scan(docs, bench, max_broadcast_windows=bound).collect()}
    assert got == brute(TEXTS, [x for x in ITEMS if x[0] is not None])


def test_documents_against_brute_force(spark, documents, texts):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in D.scan(documents, bench).collect()}
    assert got == brute(texts.items(), [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert any(v[-1] for v in got.values())


def test_removal(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for bound in (0, 10**6):
        kept = D.remove(docs, bench, max_broadcast_windows=bound)
        assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 6]
        cut = {r["doc_id"]: r["text"] for r in D.remove(docs, bench, what="spans", max_broadcast_windows=bound).collect()}
        assert cut[1] == "x  then" and cut[3] == "a  and " and cut[4] is None and cut[2] == TEXTS[1][1] and cut[5] == " b ÉTÉ !"
    with pytest.raises(ValueError):
        D.remove(docs, bench, what="words")


@pytest.mark.parametrize("bound", [{}, {"max_broadcast_windows": 0}, {"max_broadcast_bytes": 10}])
@pytest.mark.parametrize("what", ["documents", "spans"])
def test_removal_row_by_row(spark, bound, what):
    """Rows without an id, rows that share one, repeated rows and odd column names: each is judged by its own text."""
    rows = [(None, "with a short item"), (None, "clean"), (1, "the short item"), (1, "clean too"), (2, None), (2, None), (3, "short item"), (3, "short item"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("row_id", "runs", "at", "window")})
    out = D.remove(docs, spark.createDataFrame(ITEMS, "item_id long, text string"), what=what, **bound)
    want = [r for r in rows if "short" not in (r[1] or "")]
    if what == "spans":
        want += [(None, "with a "), (1, "the "), (3, ""), (3, "")]
    assert out.columns == docs.columns and sorted(map(str, want)) == sorted(str(tuple(r)[:2]) for r in out.collect())
    assert {r["runs"] for r in out.collect()} == {"own"}


def test_odd_rows(spark, odd):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.scan(odd, bench).count() == odd.count()
    assert D.remove(odd, bench).columns == odd.columns
    none = bench.where(F.lit(False))
    assert not any(r["contaminated"] for r in D.scan(odd, none).collect())
    assert D.scan(odd.where(F.lit(False)), bench).count() == 0


@pytest.mark.parametrize("bound", [500_000, 0])
def test_items_without_id(spark, bound):
    """Passages of items without an id are hits as in the SQL: one item more, which the listing leaves out."""
    items = spark.createDataFrame([(1, "short item"), (None, "no id here"), (None, "short item"), (None, "id here too")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "with no id here too"), (2, "a short item"), (3, "clean")], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[2:] for r in D.scan(docs, items, max_broadcast_windows=bound).collect()}
    sha = {x: hashlib.sha256(x.encode()).hexdigest() for x in ("", "1")}
    assert got == {1: (4, 1, sha[""], True), 2: (2, 2, sha["1"], True), 3: (0, 0, sha[""], False)}
