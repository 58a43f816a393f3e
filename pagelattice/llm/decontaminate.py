"""Benchmark decontamination: a hash set of normalised test n-grams against training token windows.

The set is broadcast after its rows and bytes have been counted; each window of a document is
looked up by a rolling 64-bit hash and every hit is verified word by word.  A test set over
the bounds takes the other way: the documents send 64-bit hashes of their windows, those
that a benchmark window shares are read again, and joined with the windows on their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpoint, fresh, read_table, with_row_id

#: Word bytes: digits, a-z and every byte of a non-ASCII character; A-Z is lower-cased, the rest separates.
NORMALISE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def normal_words(text: bytes | None) -> list[bytes]:
    return text.translate(NORMALISE).split() if text else []


def item_windows(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    """All windows of n words; a shorter item, unless wordless, is one window."""
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


class WindowSet:
    """The distinct windows of a benchmark, by length, with the items that hold each."""

    def __init__(self, windows: list[tuple[tuple[bytes, ...], list[str]]]) -> None:
        vocabulary = sorted({w for window, _ in windows for w in window})
        self.word = {w: i for i, w in enumerate(vocabulary)}
        rng = np.random.default_rng(20)
        self.code = rng.integers(1, 1 << 63, len(vocabulary) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, list[list[list[str]]]]] = {}
        for length in sorted({len(w) for w, _ in windows}):
            own = [(np.array([self.word[x] for x in w]), items) for w, items in windows if len(w) == length]
            hashes = np.array([int(self._rolled(ids, length)[0]) for ids, _ in own], np.uint64)
            order = np.argsort(hashes, kind="stable")
            self.by_length[length] = (
                hashes[order],
                np.stack([own[k][0] for k in order]),
                [own[k][1] for k in order],
            )

    def _rolled(self, ids: np.ndarray, length: int) -> np.ndarray:
        codes, out = self.code[ids], np.zeros(len(ids) - length + 1, np.uint64)
        for j in range(length):
            out = out * np.uint64(_BASE) + codes[j : j + len(out)]
        return out

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and the items of those windows."""
        n, get = len(words), self.word.get
        covered, items = np.zeros(n, bool), set()
        ids = np.fromiter((get(w, -1) for w in words), np.int64, n)
        known = np.concatenate(([0], np.cumsum(ids < 0)))
        for length, (hashes, windows, owners) in self.by_length.items():
            if n < length:
                continue
            starts = np.flatnonzero(known[length:] == known[:-length])  # windows of benchmark words alone
            if not len(starts):
                continue
            found = np.zeros(len(starts), np.uint64)
            for j in range(length):
                found = found * np.uint64(_BASE) + self.code[ids[starts + j]]
            at = np.searchsorted(hashes, found)
            may = np.flatnonzero((at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == found))
            for k in may.tolist():
                s, i = int(starts[k]), int(at[k])
                while i < len(hashes) and hashes[i] == found[k]:
                    if (windows[i] == ids[s : s + length]).all():
                        covered[s : s + length] = True
                        items.update(owners[i])
                        break
                    i += 1
        return covered, items


def benchmark_windows(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """(window, size, item): the distinct windows of each item, as words joined by one space; items are strings.
    Null texts and texts without a word give none; rows without item_id count together as one item, null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [
                (b" ".join(w).decode("utf-8", "replace"), len(w), None if item is None else str(item))
                for item, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True)
                for w in item_windows(normal_words(text), n)
            ]
            window, size, item = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(window, pa.string()), pa.array(size, pa.int32()), pa.array(item, pa.string())], ["w", "n", "i"]
            )

    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return items.mapInArrow(run, "window string, size int, item string").distinct()


def _digest(items: set[str | None]) -> str:
    return hashlib.sha256(",".join(sorted(i for i in items if i is not None)).encode()).hexdigest()


_SCAN = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _window_set(windows: DataFrame) -> WindowSet:
    """The windows on the driver: their number and bytes have been checked."""
    items: dict[str, list[str | None]] = {}
    for r in windows.collect():
        items.setdefault(r["window"], []).append(r["item"])
    return WindowSet([(tuple(w.encode().split(b" ")), own) for w, own in items.items()])


def _fits(windows: DataFrame, most: int, most_bytes: int) -> bool:
    size = windows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item"), F.lit(0))).alias("b")).first()
    return size["n"] <= most and (size["b"] or 0) <= most_bytes


def _scan_broadcast(docs: DataFrame, windows: DataFrame) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(_window_set(windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                words = normal_words(text)
                covered, items = shared.value.hits(words)
                hit = int(covered.sum())
                rows.append((len(words), hit, len(items), _digest(items), hit > 0))
            columns = zip(*rows, strict=True) if rows else ((),) * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return docs.mapInArrow(run, _SCAN)


def _positions(base: DataFrame, windows: DataFrame) -> DataFrame:
    """(row_id, at, size, window) of every occurrence of a window in base (row_id, text).  Nothing is broadcast:
    documents send 16 bytes a window, and texts move again only where a hash is shared."""
    lengths = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most n values

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = normal_words(text)
                for k in lengths:
                    n = max(0, len(words) - k + 1)
                    for at in range(0, n, 100_000):
                        h = {xxhash.xxh64_intdigest(b" ".join(words[i : i + k])) for i in range(at, min(n, at + 100_000))}
                        found = np.fromiter(h, np.uint64, len(h)).view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), row)), pa.array(found)], ["row_id", "h"])

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = [xxhash.xxh64_intdigest(w) for w in b.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(h, np.uint64).view(np.int64))], ["h"])

    sought = windows.select("window").distinct().mapInArrow(known, "h long").distinct()
    shared = base.select("row_id", "text").mapInArrow(hashed, "row_id long, h long").join(sought, "h", "left_semi")
    rows = checkpoint(shared.groupBy("row_id").agg(F.collect_set("h").alias("shared")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, text, own in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), strict=True):
                words, own = normal_words(text), {h % (1 << 64) for h in own}
                for k in lengths:
                    windows = ((i, b" ".join(words[i : i + k])) for i in range(len(words) - k + 1))
                    got = [(i, w.decode("utf-8", "replace")) for i, w in windows if xxhash.xxh64_intdigest(w) in own]
                    if got:
                        at, texts = zip(*got, strict=True)
                        columns = [pa.array([row] * len(got), pa.int64()), pa.array(at, pa.int64()), pa.array([k] * len(got), pa.int32()), pa.array(texts, pa.string())]
                        yield pa.RecordBatch.from_arrays(columns, ["row_id", "at", "size", "window"])

    met = base.select("row_id", "text").join(rows, "row_id").mapInArrow(read, "row_id long, at long, size int, window string")
    return checkpoint(met.join(windows.select("window").distinct(), "window", "left_semi").select("row_id", "at", "size", "window"))


def _scan_joined(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """The way for a large benchmark: no side is broadcast."""
    base, key = with_row_id(docs)
    base = base.select(F.col(key).alias("row_id"), "doc_id", "text")
    found = _positions(base, windows)
    before = Window.partitionBy("row_id").orderBy("at", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("size")
    reach = F.coalesce(F.max(end).over(before), F.lit(0))
    hit = (
        found.select("row_id", (F.greatest(end, reach) - F.greatest("at", reach)).alias("new"))
        .groupBy("row_id")
        .agg(F.sum("new").alias("n_hit"))
    )
    items = (
        found.select("row_id", "window")
        .distinct()
        .join(windows.select("window", "item"), "window")
        .select("row_id", "item")
        .distinct()
        .groupBy("row_id")
        .agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("listed"))
    )
    n_words = F.coalesce(
        F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0)
    ).cast("long")
    return (
        base.select("row_id", "doc_id", n_words.alias("n_words"))
        .join(hit, "row_id", "left")
        .join(items, "row_id", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).alias("n_items"),
            F.sha2(F.coalesce("listed", F.lit("")), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_broadcast_windows: int = 500_000, max_broadcast_bytes: int = 1 << 27) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null text has no words and no hit.  Repeated rows are scanned each; an empty benchmark
    hits nothing; items with equal texts all count.  A benchmark of more windows (counted by
    item) or bytes than the bounds is joined by shuffle instead of broadcast, with the same
    result.  Other columns of either table are not read.
    """
    windows = checkpoint(benchmark_windows(benchmark, n))
    small = _fits(windows, max_broadcast_windows, max_broadcast_bytes)
    return (_scan_broadcast if small else _scan_joined)(_narrow(docs), windows)


def remove(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    what: str = "documents",
    max_broadcast_windows: int = 500_000,
    max_broadcast_bytes: int = 1 << 27,
) -> DataFrame:
    """The documents without benchmark passages, columns as they come.

    what="documents" drops every row with a hit; what="spans" cuts the hit words out of the
    text (from the first to the last byte of each run of hit words) and keeps the row.  Each
    row is judged by its own text, whatever its doc_id: rows without one, or that share one
    with others, are told apart.  Null and empty texts have no hit and stay.  Both ways, for
    benchmarks within the bounds and over them, return the same rows.
    """
    if what not in ("documents", "spans"):
        raise ValueError(what)
    windows, at = checkpoint(benchmark_windows(benchmark, n)), docs.columns.index("text")
    if not _fits(windows, max_broadcast_windows, max_broadcast_bytes):
        base, key = with_row_id(docs)
        found = _positions(base.select(F.col(key).alias("row_id"), F.col("text").cast("string").alias("text")), windows)
        if what == "documents":
            gone = found.select(F.col("row_id").alias(key)).distinct()
            return base.join(gone, key, "left_anti").select(*docs.columns)
        runs = fresh(docs, "runs")
        rows = found.groupBy(F.col("row_id").alias(key)).agg(F.collect_list(F.array("at", F.col("at") + F.col("size"))).alias(runs))
        joined = base.join(rows, key, "left").select(*docs.columns, runs)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                raw, done = b.column(at).cast(pa.binary()).to_pylist(), []
                for text, own in zip(raw, b.column(len(b.columns) - 1).to_pylist(), strict=True):
                    if own:
                        covered = np.zeros(len(normal_words(text)), bool)
                        for first, end in own:
                            covered[first:end] = True
                        text = cut_spans(text, covered)
                    done.append(text)
                yield _with_texts(pa.RecordBatch.from_arrays(b.columns[:-1], schema=pa.schema(list(b.schema)[:-1])), at, done)

        return joined.mapInArrow(cut, docs.schema)
    shared = docs.sparkSession.sparkContext.broadcast(_window_set(windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(at).cast(pa.binary()).to_pylist()
            hits = [shared.value.hits(normal_words(t))[0] for t in raw]
            if what == "documents":
                yield b.filter(pa.array([not h.any() for h in hits], pa.bool_()))
            else:
                yield _with_texts(b, at, [cut_spans(t, h) if h.any() else t for t, h in zip(raw, hits, strict=True)])

    return docs.mapInArrow(run, docs.schema)


def _with_texts(batch: pa.RecordBatch, at: int, texts: list[bytes | None]) -> pa.RecordBatch:
    text = pa.array([None if t is None else t.decode("utf-8", "replace") for t in texts], pa.string())
    columns = [text.cast(c.type) if i == at else c for i, c in enumerate(batch.columns)]
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def cut_spans(text: bytes, covered: np.ndarray) -> bytes:
    """The text without its covered words and what lies between neighbours among them."""
    plain = np.frombuffer(text.translate(NORMALISE), np.uint8) != 32
    edges = np.diff(np.concatenate(([False], plain, [False])).astype(np.int8))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    turn = np.diff(np.concatenate(([False], covered, [False])).astype(np.int8))
    out, last = [], 0
    for a, b in zip(np.flatnonzero(turn == 1).tolist(), (np.flatnonzero(turn == -1) - 1).tolist(), strict=True):
        out.append(text[last : begins[a]])
        last = int(ends[b])
    return b"".join([*out, text[last:]])


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP1_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
bw as (
  select distinct item_id, least(10, len(w)) size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') win
  from (select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) i from b where len(w) > 0)),
dw as (
  select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') win
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) i from d, (select distinct size from bw) where len(w) >= size)),
hit as (select doc_id, i, dw.size, item_id from dw join bw using (win)),
covered as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + size)) p from hit) group by doc_id),
items as (
  select doc_id, count(*) n_items, string_agg(item, ',' order by item) listed
  from (select distinct doc_id, cast(item_id as varchar) item from hit) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(listed, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join covered using (doc_id) left join items using (doc_id)
"""
