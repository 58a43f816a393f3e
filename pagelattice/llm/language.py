"""Language identification with segmentation-marginalised unigrams.

Each language has a unigram distribution over the pieces of one fixed public vocabulary.
The probability of a word is the sum over all of its segmentations into pieces (forward
algorithm); a text's log-likelihood is the sum over its words.  The distributions come
from expectation-maximisation over word counts, with expected piece counts from the
forward-backward sums.  Words are maximal runs of letters, lower-cased.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, crc_mod, read_table

UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
#: Expected counts are summed as whole numbers of this unit, so that the order of addition cannot matter.
_UNIT = 1 << 20
_GROUP = 2048
_CACHE = 1_000_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(path: str) -> list[str]:
    """The vocabulary's lower-case forms, in id order, without control pieces; the 256 byte pieces come last."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (
        model.id_to_piece(i).lower()
        for i in range(model.vocab_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    )
    return list(dict.fromkeys(p for p in pieces if p and p != "▁"))


_SLOT_BITS = 20
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _letters(words: list[str]) -> np.ndarray:
    """(word, position) -> code point, for words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1)


class Lattice:
    """Pieces as rows of a probability table; the spans of many words are looked up at once, by 64-bit
    hashes that differ for all pieces.  Rows: pieces, 256 bytes, one impossible, then the characters met
    outside the vocabulary, which `extended` fills from their bytes."""

    def __init__(self, pieces: list[str]) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.n_rows = len(pieces) + 256 + 1
        self.fallback: dict[int, int] = {}  # code point -> row
        self._of: np.ndarray | None = None  # the table that _grown extends
        by_length: dict[int, list[int]] = {}
        for r, p in enumerate(pieces):
            by_length.setdefault(len(p), []).append(r)
        rows, keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for of in by_length.values():
            codes = _letters([pieces[r] for r in of]).astype(np.uint64) + np.uint64(1)
            h = np.zeros(len(of), np.uint64)
            for column in codes.T:
                h = h * _BASE + column
            rows.append(np.array(of))
            keys.append(h * _MIX)
        key, row = np.concatenate(keys), np.concatenate(rows)
        order = np.argsort(key)
        self.key, self.piece = np.append(key[order], np.uint64(0)), np.append(row[order], 0).astype(np.int32)
        if len(key) and (np.diff(key[order]) == 0).any():
            raise ValueError("two pieces of one hash")
        slot = (key[order] >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        self.first = np.full(1 << _SLOT_BITS, -1, np.int32)
        self.first[slot[::-1]] = np.arange(len(slot))[::-1]
        self.depth = int(np.bincount(slot).max(initial=0)) if len(slot) else 0

    def byte_rows(self, code: int) -> list[int]:
        return [len(self.pieces) + b for b in chr(code).encode("utf-8", "replace")]

    def spans(self, words: list[str]) -> np.ndarray:
        """(end, length - 1, word) -> row, for words of one length."""
        letters = _letters(words)
        codes = letters.astype(np.uint64) + np.uint64(1)
        m, n = codes.shape
        deep, miss = min(self.longest, n), self.n_rows - 1
        out = np.full((n, deep, m), miss, np.int32)
        h = codes
        for back in range(deep):
            if back:
                h = h[:, :-1] * _BASE + codes[:, back:]
            mixed = (h * _MIX).ravel()
            first = self.first[(mixed >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)]
            may = np.flatnonzero(first >= 0)
            sought, at = mixed[may], first[may]
            row = np.full(len(may), -1, np.int32)
            for step in range(self.depth):
                here = np.minimum(at + step, len(self.key) - 1)
                row = np.where(self.key[here] == sought, self.piece[here], row)
            may, row = may[row >= 0], row[row >= 0]
            word, end = np.divmod(may, n - back)
            out[end + back, back, word] = row
        end, word = np.nonzero(out[:, 0] == miss)
        if len(word):
            alone = letters[word, end]
            unique, which = np.unique(alone, return_inverse=True)
            rows = [self.fallback.setdefault(c, self.n_rows + len(self.fallback)) for c in unique.tolist()]
            out[end, 0, word] = np.array(rows, np.int32)[which]
        return out

    def extended(self, table: np.ndarray) -> np.ndarray:
        """The table with the rows of the characters met so far: new ones are added to what was made before."""
        if not self.fallback:
            return table
        if self._of is not table:
            self._of, self._filled, self._grown = table, 0, table
        need = self.n_rows + len(self.fallback)
        if need > len(self._grown):
            more = np.zeros((need + 1000 - len(self._grown), table.shape[1]))
            self._grown = np.vstack((self._grown, more))
        for c in list(self.fallback)[self._filled :]:
            self._grown[self.fallback[c]] = np.prod(table[self.byte_rows(c)], axis=0)
        self._filled = len(self.fallback)
        return self._grown

    def forget(self) -> None:
        """Let go of the characters met, if they have become many."""
        if len(self.fallback) > 20_000:
            self.fallback, self._of = {}, None


def _forward(spans: np.ndarray, table: np.ndarray, miss: int, backward: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """alpha (position, word, language), each scaled to 1 at every position, and the logarithms of the scales;
    backward, beta: the sums over what follows a position."""
    n, deep, m = spans.shape
    alpha = np.zeros((n + 1, m, table.shape[1]))
    logs = np.zeros_like(alpha)
    scale = np.ones_like(alpha)
    used = (spans != miss).any(2)
    alpha[n if backward else 0] = 1
    for j in range(n):
        total, factor = np.zeros_like(alpha[0]), None  # factor: product of the scales since the other end of the span
        for back in range(min(deep, j + 1)):
            i = n - j + back if backward else j - back
            end = i - 1 if backward else j
            if back:
                nearer = i - 1 if backward else i + 1
                factor = scale[nearer] if factor is None else np.maximum(factor * scale[nearer], 1e-290)
            if used[end, back]:
                part = alpha[i] * table[spans[end, back]]
                total += part if factor is None else part / factor
        new, old = (n - j - 1, n - j) if backward else (j + 1, j)
        scale[new] = np.maximum(total, 1e-300)
        alpha[new] = total / scale[new]
        logs[new] = logs[old] + np.log(scale[new])
    return alpha, logs


def _groups(words: list[str], lattice: Lattice) -> Iterator[list[int]]:
    """Places of words of one length, a bounded number at a time."""
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w), []).append(k)
    for n, of in by_length.items():
        step = max(1, min(_GROUP, (1 << 21) // ((n + 1) * min(n + 1, lattice.longest))))
        for at in range(0, len(of), step):
            yield of[at : at + step]


def word_scores(words: list[str], lattice: Lattice, table: np.ndarray) -> np.ndarray:
    """Log-probability of each word (with the mark of a word's begin) in each language, over all segmentations."""
    out = np.empty((len(words), table.shape[1]))
    for part in _groups(words, lattice):
        spans = lattice.spans(["▁" + words[k] for k in part])
        _, logs = _forward(spans, lattice.extended(table), lattice.n_rows - 1)
        out[part] = logs[-1]
    lattice.forget()
    return out


def expected_counts(words: list[str], counts: np.ndarray, lattice: Lattice, table: np.ndarray) -> np.ndarray:
    """Expected uses of each row, in units of 1 / _UNIT, for one language (table has one column)."""
    out = np.zeros(lattice.n_rows, np.int64)
    for part in _groups(words, lattice):
        spans = lattice.spans(["▁" + words[k] for k in part])
        n, deep, _ = spans.shape
        grown = lattice.extended(table)
        (alpha, before), (beta, after) = (_forward(spans, grown, lattice.n_rows - 1, backward) for backward in (False, True))
        weight = counts[part] * _UNIT
        others = np.zeros(len(grown), np.int64)
        for j in range(n):
            for back in range(min(deep, j + 1)):
                rows, i = spans[j, back], j - back
                on = np.flatnonzero(rows != lattice.n_rows - 1)
                if len(on):
                    p = alpha[i, on, 0] * grown[rows[on], 0] * beta[j + 1, on, 0]
                    p *= np.exp(before[i, on, 0] + after[j + 1, on, 0] - before[n, on, 0])
                    use = np.rint(p * weight[on]).astype(np.int64)
                    np.add.at(others, rows[on], use)
        out += others[: lattice.n_rows]
        for c, r in lattice.fallback.items():
            if r < len(others) and others[r]:
                for b in lattice.byte_rows(c):
                    out[b] += others[r]
    lattice.forget()
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[str]
    table: np.ndarray  # row, language: probabilities


def _normalised(counts: np.ndarray, smoothing: float) -> np.ndarray:
    """Probabilities from counts (row, language); the last row stays impossible."""
    p = counts + smoothing
    p[-1] = 0
    return p / p.sum(0)


def fit(
    docs: DataFrame,
    lang_col: str = "lang",
    vocabulary: str | None = None,
    max_docs_per_language: int = 1500,
    rounds: int = 3,
    smoothing: float = 0.05,
    max_languages: int = 1000,
) -> LanguageModel:
    """Learn the piece distributions from labelled documents (doc_id, text, lang).

    At most about `max_docs_per_language` documents of each language are used, those with the
    smallest hash of doc_id; the bound keeps the fit small, and prediction covers everything.
    Rows with null doc_id, text or language teach nothing.  Words of any length count whole; more than
    `max_languages` languages are refused, as the model holds vocabulary x languages numbers.
    """
    spark = docs.sparkSession
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col(lang_col).alias("lang")).where(
        "doc_id is not null and text is not null and lang is not null"
    )
    sizes = known.groupBy("lang").count().orderBy("lang").limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages = [r["lang"] for r in sizes]
    pieces = load_pieces(vocabulary or default_vocabulary())
    if not languages:
        return LanguageModel([], pieces, np.zeros((len(pieces) + 257, 0)))
    grain = 1 << 20
    share = spark.createDataFrame(
        [(r["lang"], min(grain, -(-grain * max_docs_per_language // r["count"]))) for r in sizes], "lang string, share long"
    )
    words = checkpoint(
        known.join(F.broadcast(share), "lang")  # one row a language, at most max_languages
        .where(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < F.col("share"))
        .select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    table = _normalised(np.ones((len(pieces) + 257, len(languages))), 0.0)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, languages, table))  # vocabulary size x languages
        counts = np.zeros_like(table)

        def e_step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pieces, languages, table = shared.value
            lattice = Lattice(pieces)
            for b in batches:
                lang, word = np.array(b.column(0).to_pylist()), b.column(1).to_pylist()
                n = b.column(2).to_numpy(zero_copy_only=False)
                for k, name in enumerate(languages):
                    of = np.flatnonzero(lang == name)
                    if len(of):
                        got = expected_counts([word[i] for i in of], n[of].astype(float), lattice, table[:, [k]])
                        rows = np.flatnonzero(got)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), k)), pa.array(rows), pa.array(got[rows])], ["k", "r", "u"]
                        )

        summed = words.mapInArrow(e_step, "k long, r long, u long").groupBy("k", "r").agg(F.sum("u").alias("u"))
        got = summed.toPandas()  # at most vocabulary size x languages rows
        counts[got["r"], got["k"]] = got["u"] / _UNIT
        table = _normalised(counts, smoothing)
        shared.unpersist()
    return LanguageModel(languages, pieces, table)


class _Numbers(dict):
    """Words in the order met; new ones are noted down for scoring."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        number = self[word] = len(self)
        return number


class Scorer:
    """Scores texts batch by batch; words are scored once and remembered, up to a bound."""

    def __init__(self, model: LanguageModel) -> None:
        self.model, self.lattice = model, Lattice(model.pieces)
        self.memory = min(_CACHE, (1 << 24) // max(1, len(model.languages)))  # words remembered
        self._forget()

    def _forget(self) -> None:
        self.words = _Numbers()
        self.scores = np.empty((1 << 12, len(self.model.languages)))

    def _score_new(self) -> None:
        new, self.words.new = self.words.new, []
        if len(self.words) > len(self.scores):
            self.scores = np.vstack((self.scores, np.empty((len(self.words), self.scores.shape[1]))))
        if new:  # they are the last ones numbered
            self.scores[len(self.words) - len(new) : len(self.words)] = word_scores(new, self.lattice, self.model.table)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.model.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if len(self.words) > self.memory:
            self._forget()
        number, got, cuts = self.words.__getitem__, [], [0]
        for t in texts:
            if t:
                got.extend(map(number, LETTERS.findall(t.lower())))
            cuts.append(len(got))
        self._score_new()
        codes = np.array(got, np.int64)
        names, best = [], []
        for text, a, b in zip(texts, cuts, cuts[1:], strict=False):
            if a == b or not any(map(str.isalpha, text)):
                names.append(UNDETERMINED)
                best.append(0.0)
                continue
            total = self.scores[codes[a:b]].sum(0)
            k = int(total.argmax())
            names.append(self.model.languages[k])
            best.append(float(1 / np.exp(total - total[k]).sum()))
        return names, best


def _apply(docs: DataFrame, model: LanguageModel, columns: list[str], text_at: int, keep: float | None) -> DataFrame:
    """With keep None, `columns` plus (lang_pred, score); else the rows of a language and at least that score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary size x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                names, scores = scorer(part.column(text_at).to_pylist())
                if keep is None:
                    done = [*(c for i, c in enumerate(part.columns) if i != text_at), pa.array(names, pa.string()), pa.array(scores)]
                    yield pa.RecordBatch.from_arrays(done, names=[*columns, "lang_pred", "score"])
                else:
                    ok = [n != UNDETERMINED and s >= keep for n, s in zip(names, scores, strict=True)]
                    yield part.filter(pa.array(ok, pa.bool_()))

    if keep is not None:
        return docs.mapInArrow(run, docs.schema)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields) if i != text_at)
    return docs.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of (doc_id, text).

    A null or empty text, or one without a letter, is `und` with score 0.  Otherwise the score
    is the posterior probability of the best language under equal priors; on a tie the
    language first in code point order wins.  Very long texts are read whole.
    """
    return _apply(docs.select("doc_id", F.col("text").cast("string").alias("text")), model, ["doc_id"], 1, None)


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """The rows whose text has a language with at least that posterior; columns and values as they come."""
    return _apply(docs, model, docs.columns, docs.columns.index("text"), least)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(crc_mod("doc_id", 4) != 2)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score.  A row without doc_id has no remainder: it teaches nothing and is not held out."""
    docs = read_table(spark, sf_dir, "documents")
    found = predict(docs, fit(training_rows(docs)))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
