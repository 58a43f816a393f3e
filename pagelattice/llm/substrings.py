"""Exact substring deduplication with a count-min prefilter.

A window is `size` consecutive words.  Every window has an anchor: the left-most smallest
of its 8-word grams by hash, so equal windows have equal anchors and one anchor serves some
ten windows.  Pass 1 counts anchors in count-min sketches, one a partition, which are merged
by adding; an estimate is never too small.  Pass 2 emits the windows whose anchor is
estimated to occur twice or more, and groups those exactly by hash: 64 bits over the anchor's
words and 64 over all words of the window, from two independent hashes of each word.  A
window that repeats is always among them; one that is let through by a collision in the
sketch is told apart by its own hash.  Hashes decide; the words of windows that meet are not
compared again.

A sketch is broadcast, so its width is bounded.  A corpus that needs over four times as many cells has
its anchors counted by a shuffle of their hashes instead (32 bytes an anchor, combined before
they are sent), and only documents with a repeated anchor are read again.  The result is the
same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table

WINDOW = 35
GRAM = 8
#: The sketch: cells a row at most (two bits of each are broadcast), and rows.
MAX_WIDTH_BITS = 26
DEPTH = 2
#: An anchor estimated to occur so often is dealt by window.
HOT = 200
_CHUNK_BITS = 20
_B1, _B2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_POSITION_BITS = 24
_MEMORY = 500_000
#: Candidate windows that a task holds before it combines equal ones and sends them.
_FLUSH = 1_500_000


class _Hashes(dict):
    """Two 64-bit hashes of each word seen, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _MEMORY:
            self.clear()
        h = self[word] = xxhash.xxh3_128_digest(word)
        return h

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        both = np.frombuffer(b"".join(map(self.__getitem__, words)), "<u8").reshape(-1, 2)
        return both[:, 0].copy(), both[:, 1].copy()


def _rolled(h: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hash, modulo 2^64, of every `size` neighbours, by doubling."""
    out, have = None, 0
    power, length = h, 1
    while True:
        if size & length:
            if out is None:
                out, have = power, length
            else:
                n = len(h) - have - length + 1
                out = out[:n] * np.uint64(pow(base, length, 1 << 64)) + power[have : have + n]
                have += length
        length *= 2
        if length > size:
            return out
        n = len(h) - length + 1
        half = length // 2
        power = power[:n] * np.uint64(pow(base, half, 1 << 64)) + power[half : half + n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, done = 1, x
    while span * 2 <= width:
        done = np.minimum(done[: len(done) - span], done[span:])
        span *= 2
    rest = width - span
    return np.minimum(done[: len(done) - rest], done[rest:]) if rest else done


def anchors(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window: the position of its anchor gram; and the hash of the gram at every position."""
    gram = min(GRAM, size)
    grams = _mixed(_rolled(hashes, gram, _B2))
    places = np.arange(len(grams), dtype=np.uint64)
    mask = np.uint64((1 << _POSITION_BITS) - 1)
    low = _sliding_min((grams & ~mask) | (places & mask), size - gram + 1)
    at = (low & mask).astype(np.int64)
    first = np.arange(len(low), dtype=np.int64)
    # a text of more than 2^24 words: the position is known modulo 2^24, and lies within the window
    at += (first - at + (1 << _POSITION_BITS) - 1) >> _POSITION_BITS << _POSITION_BITS
    return at, grams


def _cells(grams: np.ndarray, bits: int) -> list[np.ndarray]:
    again = _mixed(grams ^ np.uint64(_B1))
    return [(x >> np.uint64(64 - bits)).astype(np.int64) for x in (grams * np.uint64(_B1), again)][:DEPTH]


def _words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def _width_bits(docs: DataFrame) -> int:
    """The sketch's width for some five cells an anchor."""
    amount = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(16, (amount // 16).bit_length())


def _sketch(docs: DataFrame, size: int, bits: int) -> np.ndarray:
    """The merged sketch's cells that count two or more, and those that count HOT or more, as bit-maps.

    A partition sends its non-zero cells only, packed by stretch, so what is moved follows
    the number of anchors and not partitions x width.  The result has 2 x DEPTH x 2^bits
    bits, whatever the corpus."""
    chunk_bits = min(bits, _CHUNK_BITS)
    chunks = 1 << (bits - chunk_bits)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sketch = _Hashes(), np.zeros((DEPTH, 1 << bits), np.uint8)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                got: list[np.ndarray] = []
                for text in b.column(0).slice(at, 1000).cast(pa.binary()).to_pylist():
                    words = _words(text)
                    if len(words) >= size:
                        places, grams = anchors(known.of(words)[0], size)
                        got.append(grams[np.unique(places)])
                if got:
                    for row, cells in zip(sketch, _cells(np.concatenate(got), bits), strict=True):
                        cell, n = np.unique(cells, return_counts=True)
                        row[cell] = np.minimum(row[cell] + n, HOT)
        for k, row in enumerate(sketch):
            for c in range(chunks):
                part = row[c << chunk_bits : (c + 1) << chunk_bits]
                cell = np.flatnonzero(part).astype("<u4")
                if len(cell):
                    packed = zlib.compress(np.diff(cell, prepend=np.uint32(0)).tobytes() + part[cell].tobytes(), 1)
                    yield pa.RecordBatch.from_arrays([pa.array([k * chunks + c]), pa.array([packed])], ["chunk", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, of = None, None

        def done() -> pa.RecordBatch:
            maps = b"".join(np.packbits(total >= least, bitorder="little").tobytes() for least in (2, HOT))
            return pa.RecordBatch.from_arrays([pa.array([of]), pa.array([zlib.compress(maps, 1)])], ["chunk", "maps"])

        for b in batches:
            for chunk, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if chunk != of:
                    if of is not None:
                        yield done()
                    total, of = np.zeros(1 << chunk_bits, np.uint16), chunk
                raw = zlib.decompress(packed)
                n = len(raw) // 5
                cell = np.cumsum(np.frombuffer(raw, "<u4", n), dtype=np.int64)
                total[cell] = np.minimum(total[cell] + np.frombuffer(raw, np.uint8, n, 4 * n), HOT)
        if of is not None:
            yield done()

    parts = docs.select("text").mapInArrow(build, "chunk long, cells binary")
    merged = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merge, "chunk long, maps binary")
    maps = np.zeros((2, DEPTH * chunks, 1 << chunk_bits >> 3), np.uint8)
    for r in merged.collect():
        maps[:, r["chunk"]] = np.frombuffer(zlib.decompress(bytes(r["maps"])), np.uint8).reshape(2, -1)
    return maps.reshape(2, DEPTH, -1)


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns changes, with both ends."""
    turn = np.zeros(len(columns[0]) - 1, bool)
    for c in columns:
        turn |= c[1:] != c[:-1]
    return np.concatenate(([0], np.flatnonzero(turn) + 1, [len(columns[0])]))


class _Emitter:
    """Gathers candidate windows of many documents, and combines equal ones before they leave the task."""

    columns = ("k", "doc_id", "th", "begin", "n", "hashes")
    schema = "k long, doc_id long, th long, begin long, n long, hashes binary"

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, doc: int, at: np.ndarray, key: np.ndarray, h: np.ndarray) -> None:
        self.parts.append((np.full(len(at), doc, np.int64), at, key, h))
        self.held += len(at)

    def flush(self, ids: list[tuple[int, int]]) -> pa.RecordBatch:
        """Windows seen twice here are settled at once; one of each stays as a witness for other tasks."""
        doc, at, key, h = map(np.concatenate, zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        order = np.lexsort((h, key))
        same = (key[order][1:] == key[order][:-1]) & (h[order][1:] == h[order][:-1])
        again = np.zeros(len(order), bool)  # not the first of its kind
        again[order[1:]] = same
        settled = again.copy()
        settled[order[:-1]] |= same
        known, table = np.array(ids, np.int64).reshape(-1, 2), []
        for pick, sent in ((np.flatnonzero(settled), False), (np.flatnonzero(~again), True)):
            if not len(pick):
                continue
            d, a, k = doc[pick], at[pick], key[pick]
            step = a - np.arange(len(a))
            cut = _edges(d, step, k) if sent else _edges(d, step)
            first, n = cut[:-1], np.diff(cut)
            raw = memoryview(h[pick].tobytes())
            table.append(
                (
                    k[first].view(np.int64) if sent else _mixed((d[first] * 1_000_003 + a[first]).view(np.uint64)).view(np.int64),
                    known[d[first], 0],
                    known[d[first], 1],
                    a[first],
                    n,
                    [bytes(raw[8 * x : 8 * y]) for x, y in zip(first.tolist(), cut[1:].tolist(), strict=True)] if sent else [None] * len(n),
                )
            )
        joined = [np.concatenate([t[c] for t in table]) for c in range(5)]
        hashes = pa.array([x for t in table for x in t[5]], pa.binary())
        return pa.RecordBatch.from_arrays([*map(pa.array, joined), hashes], list(self.columns))


def _settle(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Candidate rows sorted by k -> covered words (doc_id, th, begin, end) of the windows that occur twice."""

    def of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        k, doc, th, begin, n = (rows.column(c).to_numpy() for c in range(5))
        hashes = rows.column(5)
        plain = hashes.is_null().to_numpy(zero_copy_only=False)
        out = [(doc[plain], th[plain], begin[plain], begin[plain] + n[plain] - 1)]
        if not plain.all():
            k, doc, th, begin, n = (x[~plain] for x in (k, doc, th, begin, n))
            h = np.frombuffer(b"".join(hashes.drop_null().to_pylist()), np.uint64)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((h, k[row]))
            same = (h[order][1:] == h[order][:-1]) & (k[row[order]][1:] == k[row[order]][:-1])
            hit = np.zeros(len(h), bool)
            hit[order[1:]] = same
            hit[order[:-1]] |= same
            pick = np.flatnonzero(hit)
            if len(pick):
                r = row[pick]
                at = begin[r] + pick - (np.cumsum(n) - n)[r]
                cut = _edges(r, at - np.arange(len(at)))
                first, last = cut[:-1], cut[1:] - 1
                out.append((doc[r[first]], th[r[first]], at[first], at[last]))
        doc, th, begin, last = map(np.concatenate, zip(*out, strict=True))
        if len(doc):
            yield pa.RecordBatch.from_arrays([*map(pa.array, (doc, th, begin, last + size))], ["doc_id", "th", "begin", "end"])

    rest = None
    for b in batches:
        rows = pa.Table.from_batches([b])
        if rest is not None:
            rows = pa.concat_tables([rest, rows]).combine_chunks()
        if not rows.num_rows:
            continue
        k = rows.column(0).to_numpy()
        last = int(np.searchsorted(k, k[-1], "left"))  # its group may go on; it has few rows, see HOT
        if last:
            yield from of(rows.slice(0, last).combine_chunks())
        rest = rows.slice(last)
    if rest is not None and rest.num_rows:
        yield from of(rest.combine_chunks())


def _repeated_anchors(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, th, often, crowded): for documents with anchors that occur twice or more, their hashes, and those that
    occur HOT times or more.  Exact counts by shuffle; nothing is broadcast."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for b in batches:
            for doc_id, th, raw in zip(*(b.column(c).to_pylist() for c in (0, 1)), b.column(2).cast(pa.binary()), strict=True):
                words = _words(raw.as_py())
                if len(words) >= size:
                    places, grams = anchors(known.of(words)[0], size)
                    h, n = np.unique(grams[np.unique(places)], return_counts=True)
                    same = (pa.array(np.full(len(h), x)) for x in (doc_id, th))
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *same, pa.array(n)], ["h", "doc_id", "th", "n"])

    every = materialize(docs.mapInArrow(listed, "h long, doc_id long, th long, n long"), "anchors")
    counts = every.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h", (F.col("n") >= HOT).alias("crowd"))
    return every.join(counts, "h").groupBy("doc_id", "th").agg(F.collect_set("h").alias("often"), F.collect_set(F.when(F.col("crowd"), F.col("h"))).alias("crowded"))


def repeated_spans(docs: DataFrame, size: int = WINDOW, max_width_bits: int = MAX_WIDTH_BITS) -> DataFrame:
    """(doc_id, th, begin, end): word ranges covered by windows whose word sequence also starts elsewhere.

    docs is (doc_id, th, text) with doc_id not null; th tells apart rows that share a doc_id.
    Candidate rows are shuffled by their anchor, so that neighbours travel packed.  An anchor
    estimated to be frequent (HOT) is dealt by window instead, and equal windows of one task
    travel once: no key's rows exceed a few hundred or the number of tasks."""
    bits = _width_bits(docs)
    if bits <= max_width_bits + 2:  # up to some four anchors to five cells, the sketch still rules most out
        bits = min(bits, max_width_bits)
        shared = docs.sparkSession.sparkContext.broadcast(_sketch(docs, size, bits))  # 4 x 2^max_width_bits bits at most
    else:
        docs = docs.join(_repeated_anchors(docs, size), ["doc_id", "th"])
        shared = None

    def repeated(grams: np.ndarray, row: list) -> list[np.ndarray]:
        """Which anchors may occur twice or more, and which HOT times or more."""
        if shared is None:
            return [np.isin(grams, np.array(own, np.int64).view(np.uint64)) for own in row]
        cells = _cells(grams, bits)
        return [
            np.logical_and.reduce([(m[c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1 for m, c in zip(level, cells, strict=True)])
            for level in shared.value
        ]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out = _Hashes(), _Emitter()
        ids: list[tuple[int, int]] = []
        for b in batches:
            for doc_id, th, raw, *row in zip(*(b.column(c).to_pylist() for c in (0, 1)), b.column(2).cast(pa.binary()), *b.columns[3:], strict=True):
                words = _words(raw.as_py())
                if len(words) < size:
                    continue
                low, high = known.of(words)
                places, grams = anchors(low, size)
                of = np.unique(places)
                may, hot = repeated(grams[of], [x.as_py() for x in row])
                if not may.any():
                    continue
                where = np.searchsorted(of, places)
                at = np.flatnonzero(may[where])
                window = _rolled(high, size, _B1)[at]
                gram = grams[places[at]]
                key = np.where(hot[where[at]], _mixed(gram ^ window), gram)
                out.add(len(ids), at, key, window)
                ids.append((doc_id, th))
                if out.held >= _FLUSH:
                    yield out.flush(ids)
                    ids = []
        if out.held:
            yield out.flush(ids)

    return (
        docs.mapInArrow(emit, _Emitter.schema)
        .repartition("k")
        .sortWithinPartitions("k")
        .mapInArrow(lambda batches: _settle(batches, size), "doc_id long, th long, begin long, end long")
    )


def remove_repeats(docs: DataFrame, size: int = WINDOW, max_width_bits: int = MAX_WIDTH_BITS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words outside every repeated window, joined by one space.

    Words are split at ASCII white space and compared unchanged.  A window repeats if its
    word sequence also starts anywhere else, in the same document or another; all of its
    occurrences go, the first included, judged on the input.  A null text has no words; a
    text shorter than the window loses none; repeated rows count as occurrences of their own.
    Other columns of docs are not read; an empty table gives an empty result.
    """
    text = F.col("text").cast("string")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keyed = base.select(
        F.coalesce("doc_id", F.lit(-1)).cast("long").alias("doc_key"), F.xxhash64("doc_id", "text").alias("th"), "doc_id", "text"
    )
    spans = repeated_spans(keyed.select(F.col("doc_key").alias("doc_id"), "th", "text"), size, max_width_bits)
    runs = spans.groupBy("doc_id", "th").agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends"))
    joined = keyed.join(runs.withColumnRenamed("doc_id", "doc_key"), ["doc_key", "th"], "left").select("doc_id", "text", "begins", "ends")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept = [], [], []
            for text, begins, ends in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2), b.column(3), strict=True):
                words = _words(text)
                left = words
                if begins.is_valid:
                    turn = np.zeros(len(words) + 1, np.int64)
                    np.add.at(turn, begins.values.to_numpy(), 1)
                    np.add.at(turn, ends.values.to_numpy(), -1)
                    left = [words[i] for i in np.flatnonzero(np.cumsum(turn[:-1]) == 0).tolist()]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(read_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
win as (select doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) h
        from (select doc_id, w, unnest(range(1, len(w) - 33)) i from d where len(w) >= 35)),
rep as (select doc_id, i from win join (select h from win group by h having count(*) > 1) using (h)),
gone as (select doc_id, list_sort(list_distinct(list(p))) p from (select doc_id, unnest(range(i, i + 35)) p from rep) group by doc_id),
kept as (
  select d.doc_id, len(w) n, coalesce(len(p), 0) gone_n,
    case when p is null then array_to_string(w, ' ') else k.t end t
  from d left join gone using (doc_id)
  left join (select doc_id, coalesce(string_agg(x, ' ' order by i), '') t
             from (select doc_id, unnest(w) x, unnest(range(1, len(w) + 1)) i from d where doc_id in (select doc_id from gone)) u
             where not exists (select 1 from (select doc_id, unnest(p) q from gone) g where g.doc_id = u.doc_id and g.q = u.i)
             group by doc_id) k using (doc_id))
select doc_id, cast(n as bigint) n_words, cast(gone_n as bigint) n_removed, sha256(coalesce(t, '')) kept_sha256 from kept
"""
