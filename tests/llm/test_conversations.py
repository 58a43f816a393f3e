import hashlib
import zlib

import pytest

from pagelattice.llm import conversations as C

from .conftest import SF

#: (conv_id, turn, role, text, node): null and tied turns, null roles and texts, copies, prefixes of each other,
#: negative ids, a role and text that run together alike, and a column with a name the operator uses.
ROWS = [
    *[(c, t, "user" if t % 2 == 0 else "bot", f"shared {t}", 1) for c in (5, 6, 7, 8, 9, 25, 26) for t in range(5)],
    *[(c, t, "user", "same words", 1) for c in range(40, 60) for t in range(3)],
    *[(c, t, "user", f"mixed {(c * t) % 3}", 1) for c in range(60, 90) for t in range(1 + c % 6)],
    (-7, 0, "user", "é" * 9, 1),
    (-5, 0, "user", "é" * 9, 1),
    (-5, 1, None, None, 1),
    (-5, 1, "", "", 1),
    (-5, None, "user", "first", 1),
    (-3, 4, "us", "erx", 1),
    (-4, 4, "user", "x", 1),
    (0, 2, "b", "two", 1),
    (0, 2, "a", "two", 1),
    (0, 1, None, "one", 1),
    (3, 1, None, "one", 1),
    (4, 9, "user", "", 1),
    (1000, 0, "user", "alone", 1),
    (1003, 0, "user", "gone", 1),
    *[(1001, t, "user", f"long {t}", 1) for t in range(300)],
    *[(c, 0, "user", "short and without a family", 1) for c in range(2001, 2010)],
    (None, 0, "user", "nobody's", 1),
]


def sequences(rows, rebuilt):
    convs = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: (x[:3], hashlib.sha256(f"{len(x[2].encode())}:{x[2]}{x[3]}".encode()).digest()))] for c, v in convs.items()}
    if not rebuilt:
        return own
    out = {}
    for c, v in own.items():
        h, head = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(head, [])[:h] + v[h:]
    return out


def brute(seqs):
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for p, own in members.items():
        below = [q for q in members if q[: len(p)] == p]
        kids = lambda n: [q for q in members if len(q) == len(n) + 1 and q[:-1] == n]
        ends = ",".join(map(str, sorted(c for c in own if len(seqs[c]) == len(p))))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        leaves = sum(1 for q in below if not kids(q))
        out.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(kids(p)), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "conv_id long, turn int, role string, text string, top int").repartition(3)


@pytest.mark.parametrize("local", [0, 12, 4096])
def test_nodes_against_brute_force(spark, table, local):
    assert sorted(map(str, map(tuple, C.prefix_trie(table, local).collect()))) == brute(sequences(ROWS, False))


def test_rebuilt_conversations_against_brute_force(spark, table):
    seqs = sequences(ROWS, True)
    assert any(not s for s in seqs.values())
    turns, convs = C.rebuild(*C.encode(table))
    lengths = {r["conv_id"]: r["n"] for r in convs.collect()}
    assert lengths == {c: len(s) for c, s in seqs.items()}
    assert sorted((r["conv_id"], r["pos"]) for r in turns.collect()) == sorted((c, k) for c, s in seqs.items() for k in range(len(s)))
    assert sorted(map(str, map(tuple, C.trie(turns, convs, 20).collect()))) == brute(seqs)


def test_multikey_quicksort_alone():
    seqs = {c: [(c * k) % 4 for k in range(c % 7)] for c in range(60)}
    named = {c: [("", "x" * (t + 1)) for t in s] for c, s in seqs.items()}
    rows = C.multikey_nodes(0, [(c, s, [t + 1 for t in s]) for c, s in seqs.items()], None, 0)
    assert sorted(str(tuple(r[:-1])) for r in rows) == brute(named)
    assert [r[-1] for r in rows].count(True) == 1


def test_digest_of_a_node_where_many_end(spark):
    ids = sorted({(k * 7919) % 10_007 for k in range(5000)})
    found = spark.createDataFrame([(1, 2, i) for i in ids] + [(3, 0, 9)], "top long, node_depth long, conv_id long").repartition(7)
    got = {(r["top"], r["node_depth"]): r["ends_sha256"] for r in C._ends(found, 100).collect()}
    assert got == {(1, 2): C.ids_digest(ids), (3, 0): C.ids_digest([9])}


def test_one_conversation_and_none(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert C.prefix_trie(spark.createDataFrame([], kind)).count() == 0
    assert C.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], kind)).count() == 0
    one = [(4, 1, "user", "hi"), (4, 2, "bot", None)]
    assert sorted(map(str, map(tuple, C.prefix_trie(spark.createDataFrame(one, kind)).collect()))) == brute(sequences(one, False))


def test_query_equals_sql(spark, equals_sql):
    equals_sql(C.op11_prefix_trie(spark, SF), C.OP11_SQL, ["conversations"])
