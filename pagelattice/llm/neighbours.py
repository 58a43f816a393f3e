"""Quality classifier: similarity-weighted voting of the nearest labelled neighbours.

Documents become latent-semantic vectors: hashed counts of words and word endings, damped
by logarithm and inverse document frequency, with features for the share of words that
repeat the word before, projected on the leading singular vectors of the labelled sample
and scaled to unit length.  The labelled vectors (a bounded sample) are
broadcast; every document's cosine to all of them is computed in blocks, and the labels of
the nearest vote by similarity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, read_table

FEATURES = 1 << 14
_MEMORY = 500_000
_BLOCK = 256
#: Shares of words equal to the word before; each share reached is a feature.
AGAIN = (0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)
ROWS = FEATURES + len(AGAIN)


class Features:
    """Hashed counts of words and of word shapes with their endings."""

    def __init__(self, size: int = FEATURES) -> None:
        self.size = size
        self.known: dict[bytes, bytes] = {}

    def _of(self, word: bytes) -> bytes:
        if len(self.known) >= _MEMORY:
            self.known.clear()
        shape = b"A" if word.isupper() else b"a" if word.islower() else b"x"
        pair = (zlib.crc32(word) % self.size, zlib.crc32(shape + word[-3:]) % self.size)
        out = self.known[word] = np.array(pair, "<u4").tobytes()
        return out

    def __call__(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Features present, and their damped counts."""
        words = text.split() if text else []
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.float32)
        known, make = self.known.get, self._of
        ids = np.frombuffer(b"".join([known(w) or make(w) for w in words]), "<u4")
        if len(ids) > self.size // 8:
            counts = np.bincount(ids, minlength=self.size)
            at = np.flatnonzero(counts)
            counts = counts[at]
        else:
            at, counts = np.unique(ids, return_counts=True)
        value = 1 + np.log(counts)
        again = np.count_nonzero(ids[2::2] == ids[:-2:2]) / len(words)
        level = sum(again >= x for x in AGAIN)
        at = np.concatenate((at, self.size + np.arange(level)))
        value = np.concatenate((value, np.full(level, 0.4 * np.linalg.norm(value))))
        return at.astype(np.int64), value.astype(np.float32)


@dataclass
class NeighbourModel:
    projection: np.ndarray  # feature x dimension, with the inverse document frequencies multiplied in
    vectors: np.ndarray  # labelled document x dimension, unit length
    labels: np.ndarray  # 0 or 1
    weights: np.ndarray  # a vote's weight, by label
    prior: float
    neighbours: int

    def vector(self, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at, value = found
        v = value @ self.projection[at] if len(at) else np.zeros(self.projection.shape[1], np.float32)
        length = float(np.linalg.norm(v))
        return v / length if length > 1e-9 else v

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(vectors), self.prior)
        near = vectors @ self.vectors.T  # one block of documents against every labelled vector
        k = min(self.neighbours, near.shape[1])
        # ties at the last place are settled by rounding and then by the labelled row's order
        key = np.rint(near * 1e6).astype(np.int64) * near.shape[1] - np.arange(near.shape[1])
        top = np.argpartition(-key, k - 1, axis=1)[:, :k]
        similarity = np.maximum(np.take_along_axis(near, top, 1), 0).astype(np.float64) ** 4
        weight = similarity * self.weights[self.labels[top]]
        mass = 1e-3
        return ((weight * self.labels[top]).sum(1) + mass * self.prior) / (weight.sum(1) + mass)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    max_labelled: int = 4000,
    dimensions: int = 64,
    neighbours: int = 25,
) -> NeighbourModel:
    """Vectors of at most about `max_labelled` labelled documents, those with the smallest hash of doc_id.

    Rows with a null label, id or text teach nothing; a document with several labels
    teaches their rounded mean, an id with several texts the greatest one.  The sample is a documented bound on what is learned from,
    collected (a document has at most ROWS features of eight bytes, so 0.5 GB in the worst case
    at 4,000) and broadcast (one vector of `dimensions` each); every document is scored.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
        .groupBy("doc_id")
        .agg(F.round(F.avg(F.col(label_col).cast("double"))).cast("int").alias("label"))
    )
    n, grain = known.count(), 1 << 20
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < F.lit(grain * max_labelled // max(n, 1) + 1))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for b in batches:
            got = [make(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(2),
                    pa.array([a.astype("<i4").tobytes() for a, _ in got], pa.binary()),
                    pa.array([v.astype("<f4").tobytes() for _, v in got], pa.binary()),
                ],
                ["doc_id", "label", "at", "value"],
            )

    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    sample = sample.join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label"))  # about max_labelled rows, however often an id repeats
    rows = sample.select("doc_id", "text", "label").mapInArrow(extract, "doc_id long, label int, at binary, value binary").collect()
    rows = sorted(rows, key=lambda r: r["doc_id"])
    y = np.array([min(1, max(0, r["label"])) for r in rows], np.int64)
    found = [(np.frombuffer(r["at"], "<i4").astype(np.int64), np.frombuffer(r["value"], "<f4")) for r in rows]
    seen = np.zeros(ROWS)
    for at, _ in found:
        seen[at] += 1
    idf = np.log((1 + len(rows)) / (1 + seen)).astype(np.float32) + 1
    prior = float(y.mean()) if len(y) else 0.5
    share = np.array([1.0, 1.0])
    model = NeighbourModel(np.zeros((ROWS, dimensions), np.float32), np.zeros((0, dimensions), np.float32), y, share, prior, neighbours)
    if not len(rows):
        return model
    model.projection = _singular_directions(found, idf, dimensions)
    model.vectors = np.stack([model.vector(f) for f in found])
    return model


def _singular_directions(found: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, dimensions: int, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors of the sample's matrix by randomised subspace iteration, times idf."""
    rng = np.random.default_rng(11)

    def unit(at: np.ndarray, value: np.ndarray) -> np.ndarray:
        v = value * idf[at]
        return v / max(float(np.linalg.norm(v)), 1e-9)

    rows = [(at, unit(at, value)) for at, value in found if len(at)]
    basis = rng.standard_normal((len(idf), dimensions)).astype(np.float32)
    for _ in range(rounds):
        out = np.zeros_like(basis)
        for at, v in rows:
            out[at] += np.outer(v, v @ basis[at])
        basis, _ = np.linalg.qr(out)
    return (basis * idf[:, None]).astype(np.float32)


def predict(docs: DataFrame, model: NeighbourModel, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) for every row of docs.

    Null, empty and wordless texts have a null vector, no neighbour, and score the share of
    label 1 among the labelled.  Long texts are read whole; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_labelled and FEATURES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, model = Features(), shared.value
        for b in batches:
            for at in range(0, b.num_rows, _BLOCK):
                part = b.slice(at, _BLOCK)
                vectors = np.stack([model.vector(make(t)) for t in part.column(1).cast(pa.binary()).to_pylist()])
                score = np.clip(model.scores(vectors), 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double, predicted int")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted.  A row without doc_id has no remainder: it teaches nothing and is not held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(crc_mod("doc_id", 5) != 0))
    scored = predict(docs, model)
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
