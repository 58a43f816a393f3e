import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelattice.llm import language


@pytest.fixture(scope="module")
def model(documents):
    return language.fit(language.training_rows(documents), max_docs_per_language=60, rounds=2)


def every_segmentation(word, pieces, prob, n_bytes):
    """Sum over all ways to cut the word, by enumeration."""
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, start = [], 0
        for k, c in enumerate(cuts, 1):
            if c:
                parts.append(word[start:k])
                start = k
        parts.append(word[start:])
        p = 1.0
        for x in parts:
            if x in pieces:
                p *= prob[pieces[x]]
            elif len(x) == 1:
                for b in x.encode():
                    p *= prob[n_bytes + b]
            else:
                p = 0.0
        total += p
    return total


def test_forward_equals_enumeration():
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "bab"]
    lattice = language.Lattice(pieces)
    table = np.random.default_rng(1).dirichlet(np.ones(lattice.n_rows), 2).T
    table[-1] = 0
    words = ["a", "ab", "abab", "babab", "aéb", "zz", "éa", "abbababa"]
    got = language.word_scores(words, lattice, table)
    for w, row in zip(words, got, strict=True):
        want = [np.log(every_segmentation("▁" + w, {p: i for i, p in enumerate(pieces)}, table[:, k], len(pieces))) for k in range(2)]
        assert row == pytest.approx(want, rel=1e-9)


def test_expected_counts_add_up():
    """Weighted by length, expected pieces cover every character once."""
    pieces = ["▁", "▁a", "a", "b", "ab"]
    lattice = language.Lattice(pieces)
    table = np.full((lattice.n_rows, 1), 0.01)
    table[-1] = 0
    got = language.expected_counts(["ab", "ba"], np.array([3.0, 2.0]), lattice, table) / language._UNIT
    assert sum(got[k] * len(p) for k, p in enumerate(pieces)) == pytest.approx(5 * 3, rel=1e-4)


def test_expected_counts_equal_enumeration():
    """Posterior uses of every row, by enumerating the segmentations, long words and characters outside the vocabulary included."""
    pieces = ["▁", "▁a", "a", "b", "ab", "ba"]
    lattice = language.Lattice(pieces)
    table = np.random.default_rng(3).dirichlet(np.ones(lattice.n_rows), 1).T.copy()
    table[-1] = 0
    of, words, n = {p: i for i, p in enumerate(pieces)}, ["abab", "aéb", "世界", "bab"], np.array([3.0, 5.0, 2.0, 1.0])
    want = np.zeros(lattice.n_rows)
    for word, times in zip(words, n, strict=True):
        word, found = "▁" + word, []
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            ends = [k for k, c in enumerate(cuts, 1) if c] + [len(word)]
            parts = [word[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            if all(x in of or len(x) == 1 for x in parts):
                rows = [r for x in parts for r in ([of[x]] if x in of else lattice.byte_rows(ord(x)))]
                found.append((np.prod(table[rows, 0]), rows))
        whole = sum(p for p, _ in found)
        for p, rows in found:
            for r in rows:
                want[r] += times * p / whole
    got = language.expected_counts(words, n, lattice, table) / language._UNIT
    assert got == pytest.approx(want, abs=1e-4)
    assert language.expected_counts(["a" * 3000], np.array([1.0]), lattice, table).sum() > 0


def test_very_long_word_does_not_underflow():
    lattice = language.Lattice(["▁", "a", "aa"])
    table = np.full((lattice.n_rows, 2), [[1e-6, 2e-6]])
    table[-1] = 0
    score = language.word_scores(["a" * 5000], lattice, table)
    assert np.isfinite(score).all() and score[0, 1] > score[0, 0]


def test_predictions_against_a_plain_version(documents, texts, model):
    """Every text scored word by word with a plain forward sum, without groups, hashes or memory."""
    of, n = {p: i for i, p in enumerate(model.pieces)}, len(model.pieces)
    known = {}

    def plain(word):
        word = "▁" + word
        alpha = [np.ones(len(model.languages))]
        for j in range(1, len(word) + 1):
            total = np.zeros(len(model.languages))
            for i in range(j):
                x = word[i:j]
                if x in of:
                    total += alpha[i] * model.table[of[x]]
                elif j - i == 1:
                    total += alpha[i] * np.prod(model.table[[n + b for b in x.encode()]], axis=0)
            alpha.append(total)
        return np.log(alpha[-1])

    some = dict(sorted(texts.items())[:80])
    got = {r["doc_id"]: r for r in language.predict(documents, model).collect()}
    for i, text in some.items():
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not any(map(str.isalpha, text or "")):
            assert got[i]["lang_pred"] == "und"
            continue
        total = sum(known[w] if w in known else known.setdefault(w, plain(w)) for w in words)
        best = int(total.argmax())
        assert got[i]["lang_pred"] == model.languages[best]
        assert got[i]["score"] == pytest.approx(1 / np.exp(total - total[best]).sum(), abs=1e-6)


def test_query_without_ids(spark, odd, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    rows = language.op3_language_id(spark, str(tmp_path)).collect()
    assert len(rows) == odd.count() and [r["held_out"] for r in rows if r["doc_id"] is None] == [False]


def test_held_out_accuracy(documents, model):
    langs = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    got = {r["doc_id"]: r for r in language.predict(documents, model).collect()}
    held = [i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert set(got) == set(langs) and np.mean([got[i]["lang_pred"] == langs[i] for i in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_odd_rows(odd, model):
    rows = language.predict(odd, model).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert all(by[i] == ("und", 0.0) for i in (1, 2, 3, 7)) and by[6][0] in model.languages and by[9][1] > 0
    kept = language.keep_identified(odd, model, 0.0)
    assert kept.columns == odd.columns and not {1, 2, 3, 7} & {r["doc_id"] for r in kept.collect()}
    assert language.predict(odd.where(F.lit(False)), model).count() == 0


def test_nothing_to_learn_from(odd):
    model = language.fit(odd.where(F.lit(False)))
    assert {r["lang_pred"] for r in language.predict(odd, model).collect()} == {"und"}
