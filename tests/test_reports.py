"""Reports on literal rows: lifecycle, states, family ranges, provenance, formats, caption windows."""

import random

from pyspark.sql import functions as F

from pagelattice.operators import audit, pages, reports, scan

PAGES = "doc_id long, page_no long"
TOKENS = "doc_id long, token string"


def test_lifecycle_finds_what_is_lost_and_what_was_never_there(spark):
    found, product, review = (spark.createDataFrame([(1, t) for t in x], TOKENS) for x in ("abcd", "a", "bx"))
    row = audit.lifecycle(found, product, review).first()
    assert (row["n_detected"], row["vanished"], row["phantom"], row["stuck"]) == (4, 2, 1, False)


def test_states_in_their_order(spark):
    def some(*numbers):
        return spark.createDataFrame([(1, n) for n in numbers], PAGES)

    got = scan.dispositions(some(1, 2, 3, 4, 5), some(1), some(1, 2), some(1, 2, 3), some(1, 2, 3, 4)).collect()
    assert {r["page_no"]: r["state"] for r in got} == {1: "auto", 2: "review", 3: "noprod", 4: "nonspec", 5: "image"}


def test_family_ranges_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [(d, f"{rng.choice('ABCDEFGH')}{k}", rng.randrange(1, 12)) for d in (1, 2) for k in range(26)]
    got = reports.family_ranges(spark.createDataFrame(rows, "doc_id long, token string, page_no long"), F.substring("token", 1, 1), 2).collect()
    spans = {}
    for d, t, p in rows:
        spans.setdefault((d, t[0]), []).append((t, p))
    spans = {k: (min(p for _, p in v), max(p for _, p in v)) for k, v in spans.items() if len({t for t, _ in v}) >= 2}
    want = {
        (d, x): (lo, hi, sum(e == d and h < lo for (e, _), (_, h) in spans.items()), sum(e == d and a > hi for (e, _), (a, _) in spans.items()))
        for (d, x), (lo, hi) in spans.items()
    }
    assert {(r["doc_id"], r["prefix"]): (r["lo"], r["hi"], r["n_before"], r["n_after"]) for r in got} == want


def test_provenance_and_formats(spark):
    parts = spark.createDataFrame(
        [(1, "variant", "a", "v", "p", 1, [1.0], "m", None), (1, "variant", "b", "v", "", 0, [], "m", None), (1, "color", "c", None, None, None, None, None, None), (1, "swatch_crop", "d", "v", None, 1, [1.0], None, None)],
        "doc_id long, kind string, token string, value string, pdf string, page int, bbox array<double>, method string, crop string",
    )
    assert {r["token"]: r["missing"] for r in reports.provenance_gaps(parts).collect()} == {"b": "pdf,page,bbox", "d": "crop"}
    rows = spark.createDataFrame(
        [(1, "s1", "60x60", "MATT, GLOSS", "A105", {"pcsBox": "4.5"}), (1, "s2", None, "R10 GRIP", "AA1", {"kgBox": "heavy"}), (1, "s3", "wide", "", "", None), (1, "s4", None, None, None, {})],
        "doc_id long, id string, size string, surface string, price_band string, packing map<string,string>",
    )
    assert sorted((r["field"], r["value"]) for r in reports.format_defects(rows).collect()) == [("packing", "heavy"), ("price_band", "AA1"), ("surface", "R10 GRIP")]
    mixed = sorted((r["id"], r["field"]) for r in reports.mixed_fields(rows).collect())
    assert mixed == [("s1", "price_band"), ("s2", "packing"), ("s2", "price_band"), ("s2", "surface"), ("s3", "size")]
    rates = reports.extraction_rates(rows).first()
    assert tuple(rates)[1:] == (4, 2, 2, 2, 2, "kgBox=1,pcsBox=1")


def test_caption_windows_of_a_photo(spark):
    """On a swatch 200 points high, words count as its caption within 35 points of the top edge or 16 of the bottom."""
    swatch = spark.createDataFrame([(1, 1, 0, 0.0, 100.0, 80.0, 300.0)], "doc_id long, page_no long, sw_idx long, x0 double, y0 double, x1 double, y1 double")
    at = {"TOP": 130.0, "DEEP": 140.0, "LOW": 289.0, "HIGHER": 280.0, "AB12": 131.0, "far": 200.0}
    words = [(1, 1, 0, k, 0.0, y - 5, 20.0, y + 5, t) for k, (t, y) in enumerate(at.items())]
    schema = "doc_id long, page_no long, sw_idx long, word_no long, x0 double, y0 double, x1 double, y1 double, text string"
    found = pages.caption_windows(spark.createDataFrame(words, schema), swatch, spark.createDataFrame([(1, "AB12")], TOKENS))
    assert {r["text"]: r["window"] for r in found.collect()} == {"TOP": "caption", "DEEP": "excluded", "LOW": "caption", "HIGHER": "excluded", "AB12": "code", "far": "outside"}
    assert sorted(r["text"] for r in pages.excluded_tokens(found).collect()) == ["DEEP", "HIGHER"]
