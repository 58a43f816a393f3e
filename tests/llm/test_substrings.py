import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelattice.llm import substrings as S


def digest(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in df.collect()}


def plain_repeats(texts: dict[int, str | None], size: int = S.WINDOW) -> dict[int, tuple[int, int, str]]:
    """The same by comparing all windows in one place, for small fixtures: id -> (n_words, n_removed, sha256 of the kept words)."""
    words = {i: (t or "").encode().split() for i, t in texts.items()}
    seen: dict[tuple[bytes, ...], int] = {}
    for w in words.values():
        for k in range(len(w) - size + 1):
            window = tuple(w[k : k + size])
            seen[window] = seen.get(window, 0) + 1
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        left = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("bits", [3, 26])
def test_documents_against_brute_force(documents, texts, bits):
    """Over the sketch's bound, anchors are counted by shuffle; the result is the same."""
    got = digest(S.remove_repeats(documents, max_width_bits=bits))
    assert got == plain_repeats(texts)
    assert any(n for _, n, _ in got.values())


@pytest.mark.parametrize("hot", [2, 200])
@pytest.mark.parametrize("flush", [50, 10**6])
def test_few_words(spark, monkeypatch, hot, flush):
    """Texts over a tiny vocabulary: periodic windows, repeats within a text, frequent anchors."""
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "_FLUSH", flush)
    rng = np.random.default_rng(3)
    texts = {i: " ".join(rng.choice(list("abc"), rng.integers(0, 60), p=(0.9, 0.05, 0.05))) for i in range(60)}
    texts |= {100: "x y " * 40, 101: None, 102: "q " * 34, 103: "z " * 35, 104: "w " * 36, 105: "x y " * 20}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    for size, bits in ((5, 26), (12, 26), (12, 3), (35, 26)):
        assert digest(S.remove_repeats(rows, size, bits)) == plain_repeats(texts, size)


def test_full_sketch_changes_nothing(documents, texts, monkeypatch):
    """A sketch of eight cells lets everything through."""
    monkeypatch.setattr(S, "_width_bits", lambda docs: 3)
    assert digest(S.remove_repeats(documents)) == plain_repeats(texts)


@pytest.mark.parametrize("bits", [3, 26])
def test_odd_rows(odd, bits):
    rows = S.remove_repeats(odd, max_width_bits=bits).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[9]["n_words"] == 30_000 and by[9]["n_removed"] == 30_000 and by[9]["kept"] == ""
    assert by[1]["n_words"] == 0 and by[6]["kept"].startswith("the cat sat on the mat") and by[5]["n_removed"] == 0
    assert S.remove_repeats(odd.where(F.lit(False)), max_width_bits=bits).count() == 0
    twice = odd.where("doc_id = 9").unionByName(odd.where("doc_id = 9"))
    assert [r["n_removed"] for r in S.remove_repeats(twice, max_width_bits=bits).collect()] == [30_000, 30_000]
