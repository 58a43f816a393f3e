"""Prefix trie of conversations by distributed most-significant-digit radix partitioning.

A turn is a digit: the id of its (role, text) in a dictionary.  A bucket holds the conversations below
one node.  A round takes every bucket of more than `local_turns` turns along the turns that all its
conversations share, which become nodes without a branch, and deals it out by the first turn in which
they differ.  Buckets small enough go to one task each, where multikey quicksort finishes them and emits
their nodes; a bucket of one conversation is a chain and needs no task of its own.  Sums over subtrees go
up again a round at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc_mod, drop_table, materialize, read_table

#: Turns up to which a bucket is finished in one task.
LOCAL_TURNS = 4096
#: Conversations of a node whose ids are put together in one row before they are hashed.
CHUNK_IDS = 8192
#: The turn after the last one of every conversation.
END = -1
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()

NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
ROW = ["conv_id", "pos", "turn", "bytes", "len"]


# Encoding


def encode(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, turn, bytes) of every turn in its conversation's order, and (conv_id, n) of every conversation.

    Turns go by `turn` (null first), then role and the digest of role and text; a null role or text is an empty one;
    equal rows are turns of their own; rows without a conv_id belong to no conversation.  Turns with one role
    and text (by SHA-256) have one number.  A conversation may be of any length: places come from one global
    sort, not from a group.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    order = ["conv_id", "at", "role", "digest"]
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63))).alias("at"),
        role.alias("role"),
        digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    ).where("conv_id is not null")
    in_order = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row_id", F.monotonically_increasing_id())
    numbered = materialize(in_order.select("conv_id", "digest", "bytes", "row_id"), "turns")
    part, place = F.shiftright("row_id", 33), F.col("row_id").bitwiseAND((1 << 33) - 1)
    before = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    bases = numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = numbered.withColumn("part", part).join(F.broadcast(bases), "part").select("conv_id", "digest", "bytes", (F.col("base") + place).alias("place"))
    convs = materialize(placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), "convs")
    dictionary = materialize(numbered.select("digest").distinct().withColumn("turn", F.monotonically_increasing_id()), "dictionary")
    turns = placed.join(convs.select("conv_id", "first"), "conv_id").join(dictionary, "digest")
    return turns.select("conv_id", (F.col("place") - F.col("first")).alias("pos"), "turn", "bytes"), convs.select("conv_id", "n")


def rebuild(turns: DataFrame, convs: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """The conversations that begin with the first turns of their family's first one (conv_id - conv_id % family): as
    many as crc32(conv_id) % most, all if it has fewer, none if it is absent, and go on with their own turns after
    as many.  Returns turns and conversations as encode does; some of these may have no turn."""
    c, head = F.col("conv_id"), F.col("conv_id") - F.col("conv_id") % family
    h = crc_mod("conv_id", most)
    heads = convs.select(c.alias("head"), F.col("n").alias("head_n")).where(F.col("head") % family == 0)
    plan = convs.select(c, "n", head.alias("head"), h.alias("h")).join(heads, "head", "left")
    plan = plan.withColumn("given", F.least("h", F.coalesce("head_n", F.lit(0))))
    plan = materialize(plan.select("conv_id", "head", "h", "given", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")), "rebuilt")
    own = turns.join(plan, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "turn", "bytes")
    kin = F.filter(F.transform(F.sequence(F.lit(1 - family), F.lit(family - 1)), lambda k: F.try_add(c, k)), lambda x: x - x % family == c)
    lent = turns.where((c % family == 0) & (F.col("pos") < most - 1)).select(F.explode(kin).alias("conv_id"), "pos", "turn", "bytes")
    lent = lent.join(plan.select("conv_id", "given"), "conv_id").where("pos < given").select("conv_id", "pos", "turn", "bytes")
    return own.unionByName(lent), plan.select("conv_id", "n")


# Small buckets


def multikey_nodes(depth: int, members: list[tuple[int, list[int], list[int]]], parent: int | None, last: int) -> list[list]:
    """Rows (NODES, with ids for the digest) of the trie of (conv_id, turns, bytes), all below one node at `depth`
    whose last turn has `last` bytes.  Multikey quicksort: parted three ways by the turn at one place,
    where the equal ones go a turn deeper and the others stay."""
    # depth, smallest member, parent's row, members, bytes, members that end, children, leaves, saved
    nodes: list[list] = [[depth, min(m[0] for m in members), -1, len(members), last, [], 0, 0, 0]]
    work = [(0, members, 0)]
    while work:
        at, own, d = work.pop()
        pivot = own[len(own) // 2][1]
        key = pivot[d] if d < len(pivot) else END
        less, same, more = [], [], []
        for m in own:
            k = m[1][d] if d < len(m[1]) else END
            (same if k == key else less if k < key else more).append(m)
        work += [(at, rest, d) for rest in (less, more) if rest]
        if key == END:
            nodes[at][5] = [m[0] for m in same]
            continue
        nodes[at][6] += 1
        nodes.append([depth + d + 1, min(m[0] for m in same), at, len(same), same[0][2][d], [], 0, 0, 0])
        work.append((len(nodes) - 1, same, d + 1))
    for node in reversed(nodes):  # children stand behind their parents
        node[7] = node[7] or 1
        node[8] += (node[3] - 1) * node[4]
        if node[2] >= 0:
            nodes[node[2]][7] += node[7]
            nodes[node[2]][8] += node[8]
    return [[n[1], n[0], nodes[n[2]][1] if n[2] >= 0 else parent, n[3], n[6], n[7], n[8], ids_digest(n[5]), i == 0] for i, n in enumerate(nodes)]


def ids_digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def _finish_small(rows: DataFrame) -> DataFrame:
    """NODES and `top` of buckets that one task each can hold."""
    kinds = [pa.int64()] * 7 + [pa.string(), pa.bool_()]
    names = [x.split()[0] for x in NODES.split(", ")] + ["top"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, facts, members = None, (0, None, 0), []
        out: list[list] = []

        def flush() -> pa.RecordBatch:
            nonlocal out
            columns, out = list(zip(*out, strict=True)), []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for b in batches:
            for conv, turn, size, top, depth, parent, last in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if bucket != (top, depth):
                    if members:
                        out += multikey_nodes(facts[0], members, *facts[1:])
                        if len(out) >= LOCAL_TURNS:
                            yield flush()
                    bucket, facts, members = (top, depth), (depth, parent, last), []
                if not members or members[-1][0] != conv:
                    members.append((conv, [], []))
                if turn != END:
                    members[-1][1].append(turn)
                    members[-1][2].append(size)
        if members:
            out += multikey_nodes(facts[0], members, *facts[1:])
        if out:
            yield flush()

    dealt = rows.repartition("top", "depth").sortWithinPartitions("top", "depth", "conv_id", "pos")
    return dealt.select("conv_id", "turn", "bytes", "top", "depth", "parent", "last").mapInArrow(run, f"{NODES}, top boolean")


def _chains(rows: DataFrame) -> DataFrame:
    """NODES and `top` of buckets with one conversation: a node for each place from its top's to the end."""
    first, end = F.col("pos") == F.col("depth"), F.col("turn") == END
    return rows.select(
        "conv_id",
        F.col("pos").alias("depth"),
        F.when(first, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(end, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(EMPTY_DIGEST).alias("ends_sha256"),
        first.alias("top"),
    )


# Large buckets


def _ends(found: DataFrame, chunk: int = CHUNK_IDS) -> DataFrame:
    """(top, node_depth, ends_sha256) of (top, node_depth, conv_id): ids are sorted over all tasks, written in rows of up
    to `chunk` ids, and only those rows meet for the hash, which reads them one after the other."""
    keys = ["top", "node_depth"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            cuts = [i for i in range(b.num_rows) if not i or i % chunk == 0 or columns[0][i] != columns[0][i - 1] or columns[1][i] != columns[1][i - 1]]
            texts = [",".join(map(str, columns[2][a:z])) for a, z in zip(cuts, [*cuts[1:], b.num_rows], strict=True)]
            at = [[c[i] for i in cuts] for c in columns]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in at), pa.array(texts, pa.string())], [*keys, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        row = lambda: pa.RecordBatch.from_pylist([dict(zip(keys, node, strict=True), ends_sha256=state.hexdigest())])
        for b in batches:
            for top, depth, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if node == (top, depth):
                    state.update(b",")
                else:
                    if node:
                        yield row()
                    node, state = (top, depth), hashlib.sha256()
                state.update(ids.encode())
        if node:
            yield row()

    order = [*keys, "conv_id"]
    chunks = found.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, "top long, node_depth long, first long, ids string")
    met = chunks.repartition(*keys).sortWithinPartitions(*keys, "first").select(*keys, "ids")
    return met.mapInArrow(digest, "top long, node_depth long, ends_sha256 string")


def _round(rows: DataFrame, buckets: DataFrame, local_turns: int) -> dict[str, DataFrame]:
    """One radix pass over rows (ROW, top, depth) of buckets (top, depth, parent, n, last).

    spine: (top, depth, at, node_depth, parent, n, bytes) of the nodes down to where the bucket branches;
    dealt: rows below it, each with its new bucket; children: (top, depth, turn, child, n, last, rows)."""
    bucket = ["top", "depth"]
    levels = materialize(rows.groupBy(*bucket, "pos").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.min("bytes").alias("bytes")), "levels")
    forks = levels.where((F.col("lo") == END) | (F.col("lo") != F.col("hi"))).groupBy(*bucket).agg(F.min("pos").alias("at"))
    fork = materialize(buckets.join(forks, bucket), "forks")
    below = levels.join(fork, bucket).where("pos < at").select(*bucket, "at", (F.col("pos") + 1).alias("node_depth"), F.col("top").alias("parent"), "n", "bytes")
    spine = fork.select(*bucket, "at", F.col("depth").alias("node_depth"), "parent", "n", F.col("last").alias("bytes")).unionByName(below)
    there = rows.join(fork.select(*bucket, "at"), bucket).where("pos = at")
    rest = F.sum(F.col("len") - F.col("at")).alias("rows")
    children = materialize(there.groupBy(*bucket, "at", "turn").agg(F.min("conv_id").alias("child"), F.count(F.lit(1)).alias("n"), F.min("bytes").alias("last"), rest), "children")
    moved = there.where(F.col("turn") != END).select("conv_id", *bucket, "turn").join(children, [*bucket, "turn"])
    moved = moved.select("conv_id", F.col("top").alias("parent"), F.col("child").alias("new"), (F.col("at") + 1).alias("new_depth"), "n", "last", "rows")
    dealt = rows.select(*ROW).join(moved, "conv_id").where("pos >= new_depth")
    kind = F.when(F.col("n") == 1, "chain").when(F.col("rows") <= local_turns, "small").otherwise("large")
    dealt = dealt.select(*ROW, F.col("new").alias("top"), F.col("new_depth").alias("depth"), "parent", "n", "last", kind.alias("kind"))
    ends = there.where(F.col("turn") == END).select("top", F.col("at").alias("node_depth"), "conv_id")
    return {"spine": spine, "children": children, "ends": materialize(ends, "ends"), "dealt": materialize(dealt, "dealt")}


def _gathered(rounds: list[dict[str, DataFrame]]) -> DataFrame:
    """NODES of all rounds: small buckets and chains at once, then the spines from the last round to the first, each
    with the sums of what hangs below it."""
    finished = None
    for r in rounds:
        for part in (_chains(r["dealt"].where("kind = 'chain'")), _finish_small(r["dealt"].where("kind = 'small'"))):
            finished = part if finished is None else finished.unionByName(part)
    done = materialize(finished, "nodes")
    ended = None
    for r in rounds:
        drop_table(r["dealt"])
        ended = r["ends"] if ended is None else ended.unionByName(r["ends"])
    digests = materialize(_ends(ended), "digests")
    sums = ["parent_conv_id", "depth", "n_leaves", "saved_tokens"]
    out, tops = done, done.where("top").select(*sums)
    for r in reversed(rounds):
        hung = tops.groupBy(F.col("parent_conv_id").alias("top"), (F.col("depth") - 1).alias("at")).agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        kids = r["children"].where(F.col("turn") != END).groupBy("top", "depth").agg(F.count(F.lit(1)).alias("kids"))
        below = Window.partitionBy("top", "depth").orderBy(F.desc("node_depth"))
        nodes = r["spine"].join(hung, ["top", "at"], "left").join(kids, ["top", "depth"], "left").join(digests, ["top", "node_depth"], "left")
        nodes = nodes.select(
            F.col("top").alias("conv_id"),
            F.col("node_depth").alias("depth"),
            F.col("parent").alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.when(F.col("node_depth") < F.col("at"), 1).otherwise(F.coalesce("kids", F.lit(0))).cast("long").alias("n_children"),
            F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
            (F.coalesce("saved", F.lit(0)) + F.sum((F.col("n") - 1) * F.col("bytes")).over(below)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_DIGEST)).alias("ends_sha256"),
            (F.col("node_depth") == F.col("depth")).alias("top"),
        )
        nodes = materialize(nodes, "nodes")
        out, tops = out.unionByName(nodes), tops.unionByName(nodes.where("top").select(*sums))
    return out.drop("top")


def trie(turns: DataFrame, convs: DataFrame, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """One row a node (NODES) of the prefix trie over turns and conversations as encode gives them.

    A node is named by its depth and its smallest member; the root has depth 0, no parent and no text.  Equal
    conversations share all their nodes.  No conversation, no node.  A pass costs a few shuffles of the rows in
    large buckets, and there are as many as such buckets branch on the longest way down.
    """
    given = convs.select("conv_id", F.col("n").alias("len"))
    zero, root = F.lit(0).cast("long"), given.agg(F.min("conv_id").alias("top"), F.count(F.lit(1)).alias("n")).first()
    if not root["n"]:
        return turns.sparkSession.createDataFrame([], NODES)
    ended = given.select("conv_id", F.col("len").alias("pos"), F.lit(END).cast("long").alias("turn"), zero.alias("bytes"), "len")
    rows = turns.join(given, "conv_id").select(*ROW).unionByName(ended)
    first = rows = materialize(rows.select(*ROW, F.lit(root["top"]).cast("long").alias("top"), zero.alias("depth")), "rows")
    buckets = turns.sparkSession.createDataFrame([(root["top"], 0, None, root["n"], 0)], "top long, depth long, parent long, n long, last long")
    rounds: list[dict[str, DataFrame]] = []
    while not buckets.isEmpty():
        rounds.append(done := _round(rows, buckets, local_turns))
        large = done["children"].where((F.col("turn") != END) & (F.col("n") > 1) & (F.col("rows") > local_turns))
        buckets = large.select(F.col("child").alias("top"), (F.col("at") + 1).alias("depth"), F.col("top").alias("parent"), "n", "last")
        rows = done["dealt"].where("kind = 'large'").select(*ROW, "top", "depth")
    drop_table(first)
    return _gathered(rounds)


def prefix_trie(conversations: DataFrame, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are; other columns are not read."""
    return trie(*encode(conversations), local_turns)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all `conversations`, each rebuilt from its family's first one and its own turns."""
    return trie(*rebuild(*encode(read_table(spark, sf_dir, "conversations"))))


OP11_SQL = """
with recursive t as (select conv_id c, {'r': coalesce("role", ''), 'x': coalesce("text", '')} e,
    row_number() over (partition by conv_id order by turn nulls first, coalesce("role", ''), coalesce("text", '')) k from conversations where conv_id is not null),
v as (select c, list(e order by k) w from t group by c),
z(c, s, k, x) as (select c, cast(c as varchar), 0, cast(4294967295 as bigint) from v union all
  select c, s, k + 1, list_reduce([xor(x, cast(ascii(s[k + 1]) as bigint)), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1))) from z where k < length(s)),
h as (select c, xor(x, 4294967295) % 9 h from z where k = length(s)),
q as (select v.c, coalesce(f.w[1 : h], []) || v.w[h + 1 :] w from v join h using (c) left join v f on f.c = v.c - v.c % 5),
m as (select c, w[1 : d] p, d, d = len(w) ends from (select c, w, unnest(range(0, len(w) + 1)) d from q)),
n as (select p, d, min(c) c, count(*) n, coalesce(string_agg(case when ends then cast(c as varchar) end, ',' order by c), '') e from m group by p, d),
kids as (select p[1 : d - 1] p, count(*) k from n where d > 0 group by 1),
o as (select n.*, coalesce(k, 0) k, case when d > 0 then (n - 1) * octet_length(encode(p[d].x)) else 0 end s from n left join kids using (p)),
up as (select p[1 : j] p, cast(count(*) filter (where k = 0) as bigint) leaves, cast(sum(s) as bigint) saved from (select *, unnest(range(0, d + 1)) j from o) group by 1)
select o.c conv_id, cast(o.d as bigint) depth, parent.c parent_conv_id, o.n n_convs, o.k n_children, leaves n_leaves, saved saved_tokens, sha256(o.e) ends_sha256
from o join up using (p) left join n parent on o.d > 0 and parent.p = o.p[1 : o.d - 1]
"""
