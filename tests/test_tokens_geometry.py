"""Token and geometry functions on literals."""

import pytest
from pyspark.sql import functions as F

from pagelattice.config import RuleConfig
from pagelattice.functions import geometry as G
from pagelattice.functions import tokens as T
from pagelattice.operators import detect, layout
from pagelattice.operators.components import connected_components


def column(spark, values, f):
    rows = spark.createDataFrame(list(enumerate(values)), "k int, x string")
    return [r["y"] for r in rows.select("k", f(F.col("x")).alias("y")).orderBy("k").collect()]


def test_norm(spark):
    assert column(spark, ["(abc)", "x12,", "**Ä;", ""], T.norm) == ["ABC", "X12", "Ä", ""]


@pytest.mark.parametrize(
    ("version", "want"),
    [(3, ["60x60", None, "2,5 × 10 cm", None, "12x24", "60x 120"]), (4, ["60x60", "33x120", "2,5 × 10 cm", None, "12x24", "60x 120"])],
)
def test_sizes(spark, version, want):
    texts = ["60x60", "33x120x3", "2,5 × 10 cm", '12"x24"', '12x24"', "60x 120"]
    got = column(spark, texts, lambda x: T.size_of(x, version))
    assert [g if g is None else g.strip() for g in got] == want


def test_size_form_and_names(spark):
    assert column(spark, ["60 X 60", "2×3"], T.norm_size) == ["60x60", "2x3"]
    assert column(spark, ["White", "WHITE", "white", "Wh", "W1X", "Été"], T.is_name_shape) == [True, True, False, False, False, True]
    assert column(spark, ["WHITE", "ДЕКОРЫ", "Weiß", "Ω"], T.is_latin) == [True, False, True, False]
    assert column(spark, ["WHITE", "A B C D", "x" * 31, "ДЕКОРЫ", None], T.color_quality) == ["clean", "needs_review", "needs_review", "needs_review", None]
    assert column(spark, ["pz", "m²/box", "Kg.", "PZX"], T.pack_field) == ["pcsBox", "m2Box", "kgBox", None]
    assert column(spark, ["cat_2023-05.pdf", "a2019", "x99"], T.version_year) == ["2023-05", "2019", None]


def test_junk_order(spark):
    found = spark.createDataFrame([(1, t, 1) for t in ["A11", "A12", "A13", "H10", "CM2", "12MM", "33X120X5", "AB12"]], "doc_id long, token string, n int")
    got = {r["token"]: r["bucket"] for r in detect.route_junk(found).collect()}
    assert got == {"A11": "band", "A12": "band", "A13": "band", "H10": "kept", "CM2": "unit", "12MM": "thickness", "33X120X5": "size", "AB12": "kept"}


def test_medians(spark):
    rows = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, 4.0)], "x double")
    assert tuple(rows.agg(G.upper_median(F.col("x")), F.median("x")).first()) == (3.0, 2.5)


def test_geometry(spark):
    r = spark.createDataFrame([(0.0, 0.0, 10.0, 10.0, 5.0, 5.0, 15.0, 15.0)], "a_x0 double, a_y0 double, a_x1 double, a_y1 double, b_x0 double, b_y0 double, b_x1 double, b_y1 double")
    got = r.select(G.intersection("a_", "b_"), G.iou("a_", "b_"), G.cover("a_", "b_"), G.overlap_x("a_", "b_")).first()
    assert tuple(got) == (25.0, 25 / 175, 0.25, 5.0)
    folded = spark.createDataFrame([(1200.0, 800.0), (600.0, 800.0)], "w double, h double").select(G.fold(F.col("w"), F.col("h"))).collect()
    assert [x[0] for x in folded] == [600.0, None]


def words(spark, *rows):
    return spark.createDataFrame([(1, 1, k, *map(float, r[:4]), r[4]) for k, r in enumerate(rows)], "doc_id long, page_no long, word_no long, x0 double, y0 double, x1 double, y1 double, text string")


def swatches(spark, *rows):
    return spark.createDataFrame([(1, 1, k, *map(float, r)) for k, r in enumerate(rows)], "doc_id long, page_no long, sw_idx long, x0 double, y0 double, x1 double, y1 double")


@pytest.mark.parametrize(
    ("version", "want"),
    [
        (1, [("row", 0, 0.0), ("row", 0, 0.0), ("below", 0, 15.0), ("section", 0, 605.0)]),
        (3, [("row_x", 0, 0.0), ("row", 0, 0.0), ("below", 0, 15.0), ("section", 0, 605.0)]),
        (4, [("row_x", 0, 0.0), ("orphan", None, -1.0), ("below", 0, 15.0), ("orphan", None, -1.0)]),
    ],
)
def test_assignment_by_version(spark, version, want):
    w = words(spark, (20, 20, 40, 30, "in"), (300, 20, 340, 30, "aside"), (20, 110, 60, 120, "under"), (300, 700, 340, 710, "far"))
    got = layout.assign_words(w, swatches(spark, (10, 10, 90, 100)), RuleConfig(version)).orderBy("word_no").collect()
    assert [(r["rule"], r["sw_idx"], r["d"]) for r in got] == want


def test_ties_go_to_the_lower_index(spark):
    w = words(spark, (40, 20, 60, 30, "x"))
    got = layout.assign_words(w, swatches(spark, (0, 0, 100, 100), (0, 0, 100, 100))).first()
    assert got["sw_idx"] == 0


def test_suppression_keeps_first_and_is_idempotent(spark):
    r = swatches(spark, (0, 0, 100, 100), (10, 10, 90, 90), (95, 95, 200, 200), (300, 0, 400, 50)).withColumnRenamed("sw_idx", "rid")
    once = layout.suppress_overlaps(r)
    assert sorted(x["rid"] for x in once.collect()) == [0, 2, 3]
    assert sorted(x["rid"] for x in layout.suppress_overlaps(once).collect()) == [0, 2, 3]


def test_components_of_long_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(5000, 5000), (None, 3)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert {got[k] for k in range(201)} == {0} and {got[k] for k in range(1000, 1100)} == {1000} and 5000 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
