"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from pagelattice.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    got = sorted(tuple(map(norm, r)) for r in df.select(*columns).collect())
    assert got, "nothing to compare"
    assert got == sorted(tuple(map(norm, r)) for r in want.select(*(f'"{c}"' for c in columns)).fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_works_without_the_llm_subpackage(monkeypatch):
    import importlib.util

    import __spark_entry__

    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n.startswith("pagelattice.llm") else real(n, *a))
    assert set(__spark_entry__.queries()) == set(QUERIES)


def test_varied_pages_reach_every_state(duck):
    """The SQL of these queries equals them, so states that occur in it occur in both."""
    states = {s for (s,) in duck.sql(f"select state from ({SQL['u7_varied_coverage']})").fetchall()}
    assert states == {"auto", "review", "noprod", "nonspec", "image"}
    vanished, phantom, stuck, free = duck.sql(f"select sum(vanished), sum(phantom), count(*) filter (where stuck), count(*) filter (where not stuck) from ({SQL['a29_stale_queue']})").fetchall()[0]
    assert vanished > 0 and phantom > 0 and stuck > 0 and free > 0
    assert all(n > 0 for n in duck.sql(f"select sum(differ), sum(only_scanned), sum(only_extracted) from ({SQL['q9_frozen_agreement']})").fetchall()[0])
    counters = "code_name_bound", "code_icon_demoted", "code_block_bound", "code_needs_review", "code_x_aligned", "code_with_size", "sw_no_code"
    assert all(n > 0 for n in duck.sql(f"select {', '.join(f'sum({c})' for c in counters)} from ({SQL['q4_varied_pages_v7']})").fetchall()[0])
