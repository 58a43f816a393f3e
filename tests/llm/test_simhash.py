import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagelattice.llm import simhash
from pagelattice.operators.components import connected_components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_documents_against_brute_force(documents, texts):
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(documents).collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {i: f for i, (f, _) in got.items()} == fps
    assert {i: c for i, (_, c) in got.items()} == plain_components(fps)
    assert len(set(plain_components(fps).values())) < len(fps)


@pytest.mark.parametrize("cap", [2, 256])
def test_links_by_either_way(spark, cap):
    """Balls around a few centres at all distances up to 6; a small cap sends them through the star path."""
    rng = np.random.default_rng(5)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 6, dtype=np.uint64).tolist():
        for _ in range(40):
            flips = rng.choice(64, rng.integers(0, 7), replace=False).tolist()
            fps.add(centre ^ sum(1 << f for f in flips))
    fps = sorted(fps)
    want = plain_components({f: f for f in fps})
    rows = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = connected_components(simhash.fingerprint_links(rows, cap), "a", "b").collect()
    got = {}
    for r in roots:
        got.setdefault(r["root"], set()).add(r["node"] % (1 << 64))
    groups = {}
    for f, c in want.items():
        groups.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_odd_rows(odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert {by[i][0]["component_id"] for i in (1, 2, 3)} == {1} and by[1][0]["fp"] == 0
    assert [r["component_id"] for r in by[5]] == [4, 4] and by[None][0]["component_id"] is None
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.select("doc_id").collect()) == [0, 1, 4, 6, 7, 8, 9, 10]


def test_one_row_of_each_component_stays(spark):
    """Null ids, ids shared by different texts, repeated rows and column names of our own: components lose all rows but one."""
    long = "one two three four five six seven eight nine ten"
    rows = [(None, "alone without an id", 1), (None, long, 2), (8, long, 3), (5, "apple pear plum cherry", 4), (5, "zebra lion tiger", 5)]
    rows += [(6, "twice over and over", 6), (6, "twice over and over", 7), (None, "void", 8), (None, "void", 9), (3, None, 10), (4, "", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc_key long").withColumns({c: F.lit(1) for c in ("row_key", "often", "root")})
    kept = simhash.keep_one(docs.repartition(3))
    got = sorted((r["doc_key"] for r in kept.collect()))
    assert kept.columns == docs.columns and got == [1, 3, 4, 5, 6, 8, 10]


def test_empty(odd):
    none = odd.where(F.lit(False))
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
