import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelattice.llm import infilling as I

from .conftest import SF


def brute(doc_id, text, seed=1, fim=90, spm=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(deadline=None, max_examples=300)
@given(st.lists(st.sampled_from(["a", "Bc", "é", " ", "世界", "\U0001f600", "7", "\n", "<", "P>", "<S", ">"]), max_size=30).map("".join), st.integers(-3, 10**12))
def test_cuts_and_forms_against_tokens(text, doc_id):
    runs, units = I.ClassRuns(text.encode()), re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    assert len(runs) == len(units)
    for k in range(len(units) + 1):
        before = "".join(units[:k])
        assert runs.cut(k) == (len(before.encode()), len(before))
    out, *facts = I.infill(text.encode(), doc_id)
    assert (*facts, out.decode()) == brute(doc_id, text)


def test_runs_are_maximal_and_alternate():
    runs = I.ClassRuns("ab  cd!é".encode())
    assert runs.at.tolist() == [0, 2, 4, 6, 9] and runs.letters
    assert runs.units.tolist() == [0, 1, 3, 4, 6] and runs.chars.tolist() == [0, 2, 4, 6, 8]


def test_odd_rows_against_brute_force_and_back(spark, odd):
    done = I.transform(odd.withColumn("FIM", F.lit("clash")), seed=7)
    assert [c for c in done.columns if c != "fim"] == odd.columns
    rows = done.withColumn("again", I.restored(F.col("text"), F.col("fim.form"))).collect()
    given = sorted((str(r["doc_id"]), r["text"] or "") for r in odd.collect())
    assert sorted((str(r["doc_id"]), r["again"]) for r in rows) == given
    want = sorted((str(r["doc_id"]), *map(str, brute(r["doc_id"], r["text"], 7))) for r in odd.collect())
    assert sorted((str(r["doc_id"]), *map(str, (*r["fim"], r["text"]))) for r in rows) == want
    assert {r["score"] for r in rows} == {"x"} and {r["fp"] for r in rows} == {None}


def test_markers_and_rates(spark):
    texts = [(i, t) for i in range(40) for t in ("a <", "a < b", "S> x", "x <P> y", "<M>", "ab<S>")]
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    done = I.transform(docs, fim_rate=100, spm_rate=50).withColumn("again", I.restored(F.col("text"), F.col("fim.form"))).collect()
    assert sorted((r["doc_id"], r["again"]) for r in done) == sorted(texts)
    assert {r["fim"]["form"] for r in done if not re.search("<[PSM]>", r["again"])} == {"psm", "spm"}
    assert {r["fim"]["form"] for r in done if re.search("<[PSM]>", r["again"])} == {"plain"}
    assert {r["fim"]["form"] for r in I.transform(docs, fim_rate=0).collect()} == {"plain"}


def test_empty_table(spark, odd):
    assert I.transform(odd.limit(0)).count() == 0


def test_query_equals_sql(spark, equals_sql):
    equals_sql(I.op13_fill_in_middle(spark, SF), I.OP13_SQL, ["documents"])
