import pytest

from pagelattice.config import RuleConfig
from pagelattice.operators import audit, detect, probes

BIND = "doc_id long, cluster string, id string, page_no long, sw long, code string, color string, color_raw string"
RULES = RuleConfig(collapse=4, borderline=3, merge_pages=2, merge_bindings=3, single_page_area=5.0)


def bindings(spark, *clusters):
    """(name, bindings (page, sw, code, color, raw)) of document 1."""
    return spark.createDataFrame([(1, name, f"{name}{i}", *b) for name, rows in clusters for i, b in enumerate(rows)], BIND)


@pytest.fixture
def clustered(spark):
    return bindings(
        spark,
        ("collapse", [(1 + k % 2, k, "A", "RED" if k else "BLUE", None) for k in range(4)]),
        ("single", [(1, 10 + k % 2, f"B{k}", "RED", None) for k in range(4)]),
        ("grey", [(1 + k % 2, 20 + k, "C", "RED", "RED" if k else "OLD") for k in range(3)]),
        ("wide", [(1 + k, 30 + k, "D", None, None) for k in range(3)]),
        ("plain", [(1, 40, "E", "RED", "RED"), (1, 40, "E", "RED", "PINK")]),
    )


@pytest.fixture
def areas(spark):
    return spark.createDataFrame([(1, 10, 6.0), (1, 11, 1.0), (1, 40, 0.5)], "doc_id long, sw long, area_pct double")


def test_replay_in_one_pass(clustered, areas):
    runs = [probes.Replay("base"), probes.Replay("off", False, False, False, False), probes.Replay("no_collapse", collapse=False), probes.Replay("clean", raw_witnesses=False)]
    replayed = probes.replay(clustered, areas, runs, RULES)
    got = {(r["run"], r["cluster"]): (r["reason"], r["color"]) for r in replayed.collect()}
    assert len(got) == 20
    assert {c: got["base", c][0] for c in ("collapse", "single", "grey", "wide", "plain")} == {
        "collapse": "assembly_collapse_suspect",
        "single": "singlepage_overmerge_suspect",
        "grey": "borderline_merge_suspect",
        "wide": "assembly_merge_radius_suspect",
        "plain": None,
    }
    assert all(got["off", c][0] is None for c in ("collapse", "single", "grey", "wide", "plain"))
    assert got["no_collapse", "collapse"][0] == "assembly_merge_radius_suspect" and got["clean", "grey"] == (None, "RED")
    assert got["base", "plain"][1] is None and got["clean", "plain"][1] == "RED"
    changes = {(r["run"], r["cluster"], r["change"]) for r in probes.replay_changes(replayed, "base").collect()}
    assert {c for run, _, c in changes if run == "off"} == {"new", "cross_page_new"}
    assert ("clean", "plain", "value") in changes and ("off", "single", "cross_page_new") not in changes
    gone = {(r["cluster"], r["change"]) for r in probes.replay_changes(replayed, "off").where("run = 'base'").collect()}
    assert gone == {(c, "disappeared") for c in ("collapse", "single", "grey", "wide")} | {(c, "cross_page_gone") for c in ("collapse", "grey", "wide")}


def test_fates_are_exclusive_and_whole(spark):
    box = "doc_id long, page_no long, word_no long, x0 double, y0 double, x1 double, y1 double, text string"
    rows = [(1, 1, k, 10.0 * k, 5.0, 10.0 * k + 8, 9.0, t) for k, t in enumerate(["AB1", "AB2", "AB3", "AB4", "AB5", "word", "60x60"])]
    rows.append((1, 1, 9, 0.01, 5.0, 8.0, 9.0, "AB9"))  # at the place of AB1
    words = spark.createDataFrame(rows, box)
    detected = spark.createDataFrame([(1, t) for t in ("AB1", "AB2", "AB3", "AB4", "AB9")], "doc_id long, token string")
    at = "doc_id long, page_no long, x0 double, y0 double"
    bound = spark.createDataFrame([(1, 1, 0.0, 5.0), (1, 1, 20.0, 5.0)], at)
    queued = spark.createDataFrame([(1, 1, 10.0, 5.0, "orphan"), (1, 1, 20.04, 5.0, "far")], f"{at}, reason string")
    fates = probes.code_word_fates(words, detected, bound, queued)
    assert {r["token"]: (r["state"], r["fates"]) for r in fates.collect()} == {"AB1": ("bound", 1), "AB2": ("queued:orphan", 1), "AB3": ("both", 2), "AB4": ("lost", 0), "AB5": ("undetected", 0)}
    assert [tuple(r) for r in probes.fate_equations(fates).collect()] == [(1, 5, 4, 1, 1, 2, False)]


def test_hubs_and_their_separation(spark, clustered, areas):
    hubs = probes.hub_swatches(clustered, areas)
    got = {r["cluster"]: r for r in hubs.collect()}
    assert set(got) == {"single", "plain"}
    one = got["single"]
    assert (one["n"], one["n_codes"], one["n_swatches"], one["hub_sw"], one["hub_codes"], one["hub_pct"], one["max_pct"], one["conflict"]) == (4, 4, 2, 10, 2, 6.0, 6.0, False)
    values = [(0.10, False), (0.12, False), (0.30, False), (4.0, True), (4.05, True), (90.0, True)]
    table = spark.createDataFrame(values, "max_pct double, conflict boolean")
    assert [tuple(r) for r in probes.separation(table).collect()] == [(4.05, 90.0, 85.95, 3, 1, False)]
    assert [tuple(r) for r in probes.separation(table.where("max_pct < 50")).collect()] == [(0.30, 4.0, 3.7, 3, 2, True)]
    assert probes.separation(table.where("max_pct > 50")).count() == 0


def test_medians(spark):
    box = "doc_id long, page_no long, sw_idx long, x0 double, y0 double, x1 double, y1 double"
    swatches = [(1, p, k, 0.0, 100.0 * k, 100.0, 100.0 * k + 10) for p in (1, 2) for k in range(3)] + [(1, p, 3, 0.0, 400.0, 500.0, 790.0) for p in (1, 2)] + [(1, 1, 4, 0.0, 700.0, 6.0, 706.0)]
    pages = spark.createDataFrame([(1, 1, 600.0, 800.0), (1, 2, 600.0, 800.0)], "doc_id long, page_no long, width double, height double")
    aligned = spark.createDataFrame([(1, 1, 4), (1, 1, 4), (1, 1, 0)], "doc_id long, page_no long, sw_idx long")
    (row,) = probes.median_probe(spark.createDataFrame(swatches, box), pages, aligned).collect()
    assert (row["n_sw"], row["n_large"], row["median_all"], row["median_small"], row["median_page"]) == (9, 2, 1000.0, 1000.0, 1000.0)
    assert (row["small_all"], row["small_small"], row["codes_all"], row["codes_small"], row["rescued"]) == (1, 1, 2, 2, 0)
    large = [(1, 1, k, 0.0, 10.0 * k, 500.0, 10.0 * k + 200) for k in range(3)] + [(1, 1, 5, 0.0, 700.0, 60.0, 750.0), (1, 1, 6, 0.0, 760.0, 60.0, 790.0)]
    (row,) = probes.median_probe(spark.createDataFrame(large, box), pages, spark.createDataFrame([(1, 1, 5)], "doc_id long, page_no long, sw_idx long")).collect()
    assert (row["median_all"], row["median_small"], row["small_all"], row["small_small"], row["rescued"]) == (100000.0, 2400.0, 2, 0, 1)


def column(spark, *words, rules=None, anchors=(), kept=()):
    """Verdicts of words (x0, y0, text) on one page of document 1, ten points high."""
    box = "doc_id long, page_no long, word_no long, x0 double, y0 double, x1 double, y1 double, text string"
    rows = [(1, 1, k, x, y, x + 30, y + 10, t) for k, (x, y, t) in enumerate(words)]
    pages = spark.createDataFrame([(1, 1, 600.0, 800.0)], "doc_id long, page_no long, width double, height double")
    token = lambda ts: spark.createDataFrame([(1, t) for t in ts], "doc_id long, token string")
    found = probes.unanchored_columns(spark.createDataFrame(rows, box), pages, token(kept), token(anchors), rules=rules or RuleConfig())
    return {r["token"]: r["verdict"] for r in found.collect()}


def test_columns_without_anchors(spark):
    run = [(100.0, 100.0, "60x60"), (100.0, 130.0, "ALPHA"), (100.0, 160.0, "BETA"), (100.0, 190.0, "GAMMA")]
    assert column(spark, *run) == {"ALPHA": "size", "BETA": "size", "GAMMA": "size"}
    assert column(spark, *run, kept=["BETA"])["BETA"] == "kept"
    assert set(column(spark, *run, (101.0, 400.0, "AB12"), anchors=["AB12"]).values()) == {"anchored"}
    assert column(spark, *run, (101.0, 600.0, "FARAWAY"))["FARAWAY"] == "break"
    assert column(spark, (100.0, 100.0, "ALONE"), (300.0, 100.0, "60x60")) == {"ALONE": "few"}
    side = column(spark, (100.0, 100.0, "ROWED"), (300.0, 100.0, "60x60"), (100.0, 130.0, "UNDER"))
    assert side == {"ROWED": "row", "UNDER": "member"}
    assert column(spark, (100.0, 100.0, "ONE"), (100.0, 130.0, "TWO"), (100.0, 160.0, "lower")) == {"ONE": "top", "TWO": "top"}
    assert column(spark, (100.0, 100.0, "ONE"), (101.0, 100.0, "TWO")) == {"ONE": "no_gap", "TWO": "no_gap"}


def test_caps_over_effective_anchors(spark):
    box = "doc_id long, page_no long, word_no long, x0 double, y0 double, x1 double, y1 double, text string"
    rows = [(d, 1, k, 0.0, 20.0 * k, 9.0, 20.0 * k + 9, t) for d in (1, 2) for k, t in enumerate(["AB12", "AB34", "AB34", "AB34", "NAME", "NAME", "NAME", "TRADE", "TRADE", "TRADE", "RARE"])]
    rows.append((1, 1, 90, 50.0, 0.0, 60.0, 9.0, "60x60"))
    words = spark.createDataFrame(rows, box)
    pages = spark.createDataFrame([(1, 1, 600.0, 800.0), (2, 1, 600.0, 800.0)], "doc_id long, page_no long, width double, height double")
    codes = spark.createDataFrame([(d, t) for d in (1, 2) for t in ("NAME", "TRADE", "RARE", "AB12", "AB34")], "doc_id long, token string")
    anchors, trade = codes.where("token like 'AB%'"), spark.createDataFrame([("TRADE",)], "token string")
    # only AB12 of document 1 stands beside a size: the median is 1, the cap 2; document 2 has no effective anchor
    assert [tuple(r) for r in detect.cap_suspects(codes, words, pages, anchors, trade).collect()] == [(1, "NAME")]


def test_batches_left_is_the_loop(spark):
    def loop(left, need):
        rem, n = [x - (1 if x else 0) for x in left], 0
        while sum(1 for x in rem if x > 0) >= need:
            rem, n = [x - 1 for x in rem], n + 1
        return n

    left = [9, 4, 4, 1, 7, 2, 12, 1]
    table = spark.createDataFrame([(str(k), x) for k, x in enumerate(left)], "vendor string, left long")
    got = {r["need"]: r["batches"] for r in audit.batches_left(table, "vendor", "left").collect()}
    assert {need: got.get(need, 0) for need in range(1, 9)} == {need: loop(left, need) for need in range(1, 9)}


def test_scores_need_the_name_beside_the_code(spark):
    texts = spark.createDataFrame(
        [(1, 1, 0, "AB1, (White)"), (1, 1, 0, "matt"), (1, 1, 1, "AB2 black"), (1, 1, 2, "AB2"), (1, 2, 0, "AB3")], "doc_id long, page_no long, sw_idx long, text string"
    )
    key = ["doc_id", "page_no", "code"]
    truth = spark.createDataFrame([(1, 1, "ab1", "WHITE matt"), (1, 1, "AB2", "black"), (1, 2, "AB3", "grey"), (1, 2, "AB9", "red")], "doc_id long, page_no long, code string, name string")
    got = {r["code"]: (r["code_hit"], r["full_hit"]) for r in audit.score_texts(texts, truth, key).collect()}
    assert got == {"ab1": (True, True), "AB2": (False, False), "AB3": (True, False), "AB9": (False, False)}
