"""Assembly on literal bindings: regimes, merging, conflicts, guards."""

import pytest

from pagelattice.config import RuleConfig
from pagelattice.operators import assemble as A

SCHEMA = "doc_id long, id string, page_no long, sw long, code string, color string, color_raw string"
ROWS = "doc_id long, id string, page_no long, code string, size string, surface string, price_band string"


def binds(spark, *rows):
    """rows: (code, sw, page, color[, raw])"""
    return spark.createDataFrame(
        [(1, f"b:{k:03d}", r[2], r[1], r[0], r[3], r[4] if len(r) > 4 else r[3]) for k, r in enumerate(rows)], SCHEMA
    )


def specs(spark, *rows):
    return spark.createDataFrame(
        [(1, f"s:{k:03d}", 1, r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None) for k, r in enumerate(rows)], ROWS
    )


def made(spark, bindings, rows, letters=(), areas=None, rules=RuleConfig()):
    letters = spark.createDataFrame([(1, x) for x in letters], "doc_id long, letter string")
    variants, queue = A.assemble(bindings, rows, letters, areas, rules)
    return sorted(variants.collect(), key=lambda v: v["cluster"]), queue.collect()


def sizes(variant):
    return {(s["size"], s["order_code"], s["claims"]) for s in variant["sizes"] or []}


def test_three_codes_of_one_swatch(spark):
    v, q = made(spark, binds(spark, ("C1", 1, 1, None), ("C2", 1, 1, None), ("C3", 1, 1, None)), specs(spark, ("C1", "60x60"), ("C2", "60x120"), ("C3", "30x60")))
    assert len(v) == 1 and v[0]["code"] is None and v[0]["regime"] == "A" and not q
    assert sizes(v[0]) == {("60x60", "C1", 1), ("60x120", "C2", 1), ("30x60", "C3", 1)}


def test_one_code_of_many_sizes(spark):
    v, _ = made(spark, binds(spark, ("C1", 1, 1, None)), specs(spark, ("C1", "60x60"), ("C1", "60x120"), ("C1", "30x60")))
    assert v[0]["code"] == "C1" and {s[1] for s in sizes(v[0])} == {None} and len(sizes(v[0])) == 3


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([("C1", "60x60")], {("60x60", "C1", 1)}),
        ([("C1", None), ("C1", "60x60")], {("60x60", "C1", 2)}),
        ([("C1", None)], {(None, "C1", 1)}),
        ([("C1", "60x60")] * 3, {("60x60", "C1", 3)}),
    ],
)
def test_single_code(spark, rows, want):
    v, q = made(spark, binds(spark, ("C1", 1, 1, None)), specs(spark, *rows))
    assert v[0]["code"] is None and sizes(v[0]) == want and not q


def test_mixed_signals_are_flagged(spark):
    v, _ = made(spark, binds(spark, ("C1", 1, 1, None), ("C2", 1, 1, None)), specs(spark, ("C1", "60x60"), ("C1", "60x120"), ("C2", "30x60")))
    assert v[0]["regime"] == "A" and v[0]["regime_conflict"] and len(sizes(v[0])) == 3


def test_same_code_merges_and_colours_conflict(spark):
    v, _ = made(spark, binds(spark, ("C1", 1, 3, "WHITE"), ("C1", 2, 5, "BLACK")), specs(spark))
    assert len(v) == 1 and v[0]["merged_from"] == ["b:000", "b:001"] and v[0]["color"] is None and v[0]["color_conflict"]
    v, _ = made(spark, binds(spark, ("C1", 1, 3, "WHITE"), ("C2", 2, 9, "WHITE")), specs(spark))
    assert len(v) == 2 and [x["color"] for x in v] == ["WHITE", "WHITE"]


def test_raw_witnesses_conflict(spark):
    v, _ = made(spark, binds(spark, ("C1", 1, 3, "WHITE", "WHITE A"), ("C1", 2, 5, "WHITE", "WHITE B")), specs(spark))
    assert v[0]["color"] is None and v[0]["color_conflict"]


def test_unanimous_or_null(spark):
    v, _ = made(spark, binds(spark, ("C1", 1, 1, None)), specs(spark, ("C1", "60x60", "MATT", "T31"), ("C1", "60x60", "MATT", "T14")))
    assert [(s["surface"], s["price_band"]) for s in v[0]["sizes"]] == [("MATT", None)]


def test_bridge_codes_do_not_merge(spark):
    b = binds(spark, ("A991", 1, 1, None), ("C1", 1, 1, None), ("A991", 2, 2, None), ("C2", 2, 2, None))
    v, q = made(spark, b, specs(spark), letters="A")
    assert sorted(x["reason"] for x in q) == ["merge_key_suspect"] * 2 and len(v) == 2
    v, q = made(spark, b, specs(spark))
    assert not q and len(v) == 1


def chain(n, pages, colors):
    """n bindings that share one code, over so many pages."""
    return [("C1", k, 1 + k % pages, colors[k % len(colors)]) for k in range(n)]


@pytest.mark.parametrize(
    ("n", "pages", "colors", "reason"),
    [
        (20, 2, ["WHITE", "BLACK"], "assembly_collapse_suspect"),
        (20, 2, ["WHITE"], None),
        (16, 2, ["WHITE", "BLACK"], None),
        (19, 2, ["WHITE", "BLACK"], "borderline_merge_suspect"),
        (18, 2, ["WHITE", "BLACK"], "borderline_merge_suspect"),
        (17, 2, ["WHITE", "BLACK"], None),
        (10, 6, ["WHITE"], "assembly_merge_radius_suspect"),
        (10, 5, ["WHITE"], None),
        (26, 2, ["WHITE"], "assembly_merge_radius_suspect"),
        (24, 2, ["WHITE"], None),
        (20, 1, ["WHITE"], None),
    ],
)
def test_guards(spark, n, pages, colors, reason):
    b = binds(spark, *chain(n, pages, colors))
    got = A.guard_reasons(A.clusters(b)).collect()
    assert [(r["n"], r["reason"]) for r in got] == [(n, reason)]


@pytest.mark.parametrize(("n", "area", "reason"), [(20, 10.0, "singlepage_overmerge_suspect"), (20, 0.4, None), (19, 10.0, None)])
def test_single_page_guard(spark, n, area, reason):
    b = binds(spark, *chain(n, 1, ["WHITE"]))
    areas = spark.createDataFrame([(1, k, area) for k in range(n)], "doc_id long, sw long, area_pct double")
    assert [r["reason"] for r in A.guard_reasons(A.clusters(b), areas).collect()] == [reason]


def test_conservation(spark):
    b = binds(spark, *chain(20, 2, ["WHITE", "BLACK"]), ("D9", 90, 1, None))
    variants, queue = A.assemble(b, specs(spark), spark.createDataFrame([], "doc_id long, letter string"))
    row = A.conservation(b, variants, queue).collect()[0]
    assert row["ok"] and (row["n_in"], row["n_merged"], row["n_demoted"]) == (21, 1, 20)
