"""Words in many prefixes are paired with later words in parts, so that what is on disk at once does not outgrow the sets."""

import numpy as np
import pytest

from pagelattice.llm import lines

from .test_lines import brute


@pytest.mark.parametrize("sent", [0, 400_000])
def test_many_crowded_words_are_taken_in_parts(spark, monkeypatch, sent):
    rng = np.random.default_rng(9)
    texts = {}
    for i in range(80):
        own = []
        for _ in range(6):
            words = [f"w{k}" for k in rng.choice(24, 12, replace=False)]
            own += [" ".join(words), " ".join(words[: rng.integers(9, 12)] + ["x"])]
        texts[i] = "\n".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept, real = {}, lines.materialize

    def materialize(df, name):
        out = real(df, name)
        kept.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(lines, "materialize", materialize)
    monkeypatch.setattr(lines, "_SENT", sent)
    monkeypatch.setattr(lines.similar_lines, "__defaults__", (lines.SIMILARITY, 5))
    assert {r["doc_id"]: (r["n_lines"], r["removed_lines"]) for r in lines.mark_lines(docs).collect()} == brute(texts)
    (sets,), doubles = kept["line-sets"], kept["line-doubles"]
    assert len(doubles) > 1
    assert max(doubles) < 0.6 * sum(doubles)
    assert sum(doubles) > sets
