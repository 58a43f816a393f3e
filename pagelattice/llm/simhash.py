"""SimHash near-duplicate detection by meet-in-the-middle ball hashing.

Every distinct 64-bit fingerprint is masked in three ways (one third of its bits blanked)
and emits, for each masked form, all variants within radius 1.  Of three differing bits
one can always be blanked away, and the other two meet half way: two fingerprints at
distance 3 or less share a variant under some mask.  Emitting plain balls of radius 2
would do the same with 2,081 rows a fingerprint; the masks need 131.

Variants are shuffled, colliding fingerprints are verified bit by bit, and the surviving
links go through distributed connected components.  Exact copies share a fingerprint and
collapse before anything is emitted.

A variant shared by more than `cap` fingerprints is not compared pair by pair.  Its
members go to an exact second path: each emits its full ball of radius 2, and every
variant links all of them to one member that lies within radius 1 of it (1 + 2 = 3, so
those links need no check, and each pair at distance 3 or less meets at such a variant).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelattice.operators.components import connected_components

from .common import checkpoint, fresh, read_table, row_key

RADIUS = 3
#: Bits blanked by each mask.
BLOCKS = ((0, 22), (22, 43), (43, 64))
_CHUNK = 1 << 18


def text_fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash over the word shingles of a text, repeats included; 0 without words."""
    words = text.lower().split() if text else []  # bytes.lower() touches A-Z alone, bytes.split() splits at ASCII space
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[shingle - 1 :].tolist()
    starts = starts[: len(ends)].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(ends), _CHUNK):
        hashes = np.array(
            [digest(joined[a:b], seed) for a, b in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)],
            "<u8",
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(ends), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, more: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): one row per input row, fp as a signed long.  A null or wordless text has fp 0.
    `more` names long columns that go along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fps = np.fromiter((text_fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], ["doc_id", "fp", *more])

    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)
    return ids.mapInArrow(run, "doc_id long, fp long" + "".join(f", `{c}` long" for c in more))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masked_variants(fp) -> F.Column:
    out = []
    for low, high in BLOCKS:
        keep = ((1 << 64) - 1) ^ ((1 << high) - (1 << low))
        base = fp.bitwiseAND(F.lit(_signed(keep)))
        tag = 1 << low  # blanked bits tell the masks apart
        out += [base.bitwiseXOR(F.lit(_signed(tag | x))) for x in (0, *(1 << b for b in range(64) if not low <= b < high))]
    return F.array(*out)


def _components_of(linked: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component, for a stack of boolean adjacency matrices."""
    g, m, _ = linked.shape
    own = np.broadcast_to(np.arange(m, dtype=np.int32), (g, m)).copy()
    while True:
        new = np.where(linked, own[:, None, :], m).min(2)
        if (new == own).all():
            return own
        own = new


def _bucket_links(batches: Iterator[pa.RecordBatch], cap: int) -> Iterator[pa.RecordBatch]:
    """Batches of (key, fp) sorted by both; (a, b) for verified links, (a, null) for members of an over-full bucket."""

    def linked(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = members.shape[1]
        far = np.bitwise_count((members[:, :, None] ^ members[:, None, :]).view(np.uint64))
        root = _components_of((far <= RADIUS) | np.eye(m, dtype=bool))
        g, k = np.nonzero(root != np.arange(m))
        return members[g, root[g, k]], members[g, k]

    def flush(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        edge = np.flatnonzero(np.diff(keys)) + 1
        first = np.concatenate(([0], edge))
        count = np.diff(np.concatenate((first, [len(keys)])))
        got_a, got_b = [], []
        for m in np.unique(count[count > 1]).tolist():
            of = first[count == m]
            if m > cap:
                continue
            step = max(1, (1 << 20) // (m * m))
            for at in range(0, len(of), step):
                a, b = linked(fps[of[at : at + step, None] + np.arange(m)])
                got_a.append(a)
                got_b.append(b)
        if got_a and sum(map(len, got_a)):
            pairs = np.unique(np.stack((np.concatenate(got_a), np.concatenate(got_b))), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    def marks(fps: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(fps), pa.nulls(len(fps), pa.int64())], ["a", "b"])

    rest_k = rest_f = np.empty(0, np.int64)
    over = None  # key of an over-full bucket whose earlier members are marked
    for batch in batches:
        keys = np.concatenate((rest_k, batch.column(0).to_numpy(zero_copy_only=False)))
        fps = np.concatenate((rest_f, batch.column(1).to_numpy(zero_copy_only=False)))
        if over is not None:
            more = int(np.searchsorted(keys, over, "right"))
            if more:
                yield marks(fps[:more])
                keys, fps = keys[more:], fps[more:]
            if len(keys):
                over = None
        if not len(keys):
            rest_k = rest_f = np.empty(0, np.int64)
            continue
        sizes_at = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
        for i in np.flatnonzero(np.diff(sizes_at) > cap):
            yield marks(fps[sizes_at[i] : sizes_at[i + 1]])
        last = int(sizes_at[-2])  # the last bucket may go on in the next batch
        yield from flush(keys[:last], fps[:last]) if last else ()
        if len(keys) - last > cap:
            over, rest_k, rest_f = keys[-1], np.empty(0, np.int64), np.empty(0, np.int64)
        else:
            rest_k, rest_f = keys[last:], fps[last:]
    if len(rest_k):
        yield from flush(rest_k, rest_f)


def _full_ball_links(members: DataFrame) -> DataFrame:
    """Exact links among the members of over-full buckets, by stars: no pair is enumerated."""
    flips = [0, *(1 << i for i in range(64)), *((1 << i) | (1 << j) for i, j in combinations(range(64), 2))]
    near = 65  # the first 65 flips have radius 1 or less
    ball = members.select(
        "fp",
        F.posexplode(F.lit(np.array([_signed(x) for x in flips], np.int64))).alias("i", "flip"),
    ).select("fp", (F.col("i") < near).alias("inner"), F.col("fp").bitwiseXOR(F.col("flip")).alias("key"))
    hubs = (
        ball.groupBy("key")
        .agg(F.min(F.when(F.col("inner"), F.col("fp"))).alias("hub"), F.count(F.lit(1)).alias("n"))
        .where("hub is not null and n > 1")
    )
    return ball.join(hubs, "key").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()


def fingerprint_links(classes: DataFrame, cap: int = 256) -> DataFrame:
    """(a, b) links between distinct fingerprints; their components are those of all pairs within RADIUS bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _bucket_links(batches, cap)

    found = checkpoint(
        classes.select(F.explode(_masked_variants(F.col("fp"))).alias("key"), "fp")
        .repartition("key")
        .sortWithinPartitions("key", "fp")
        .mapInArrow(run, "a long, b long")
        .distinct()
    )
    links = found.where("b is not null")
    members = found.where("b is null").select(F.col("a").alias("fp"))
    return links if members.isEmpty() else links.unionByName(_full_ball_links(members))


def _rooted(fps: DataFrame) -> DataFrame:
    """(fp, rep, root): each distinct fingerprint with its smallest doc_id and the fingerprint that names its component."""
    classes = checkpoint(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    roots = connected_components(fingerprint_links(classes), "a", "b").withColumnRenamed("node", "fp")
    return checkpoint(classes.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id), one row per input row.

    component_id is the smallest doc_id reachable over links of RADIUS or fewer differing
    bits.  Null and wordless texts have fingerprint 0 and link like any other.  A row
    without doc_id keeps its place and never names a component, so a component of such rows
    alone has a null component_id.  Repeated rows are returned as often as they come; other
    columns of `docs`, whatever their names, are not touched.  An empty table gives an
    empty result.
    """
    fps = checkpoint(fingerprints(docs, id_col, text_col, shingle))
    rooted = _rooted(fps)
    named = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return fps.join(rooted.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, one row of each component, columns as they come: the row with the smallest doc_id.

    A row without doc_id stays only where no row of its component has one.  Of rows that
    share the doc_id, the smallest hash of the text decides, and of rows equal in both, the
    smallest JSON form of the row: reruns agree.  Every component keeps exactly one row, one
    without doc_id or text too.
    """
    key, text = F.col("doc_id"), F.col("text").cast("string")
    k, r = fresh(docs, "doc_key"), fresh(docs, "row_key")
    named = [c.alias(n) for c, n in zip(row_key(key, text), (k, r), strict=True)]
    fps = checkpoint(fingerprints(docs.select("doc_id", "text", *named), more=(k, r)))
    rooted = _rooted(fps).select("fp", "root")
    chosen = fps.join(rooted, "fp").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), k, r)).alias("of"))
    chosen = chosen.select(F.col(f"of.{k}").alias(k), F.col(f"of.{r}").alias(r))
    often = fresh(docs, "often")
    chosen = checkpoint(chosen.join(fps.groupBy(k, r).agg((F.count(F.lit(1)) > 1).alias(often)), [k, r]))
    found = docs.select("*", *named).join(chosen, [k, r])
    one = found.where(~F.col(often)).select(*docs.columns)
    if not chosen.where(often).head(1):
        return one
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    first = found.where(often).groupBy(k, r).agg(F.min_by(row, F.to_json(row)).alias(often)).select(f"{often}.*")
    return one.unionByName(first.select(*docs.columns))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
