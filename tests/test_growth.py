"""What must not grow faster than the input: pairs that are sorted, and plans that are computed several times."""

import pytest
from pyspark.sql import functions as F

from pagelattice.config import RuleConfig
from pagelattice.operators import assemble, detect, fields, layout, pages, scan
from pagelattice.plans.queries import Bridge

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("version", [1, 2, 3, 4])
def test_pairs_of_words_and_swatches_are_not_sorted(spark, version):
    b = Bridge(spark, SF)
    assert "SortAggregate" not in plan(layout.assign_words(b.words, b.rects, RuleConfig(version)))


def test_equal_keys_go_to_the_smallest_index_with_its_own_distance(spark):
    box = "doc_id long, page_no long, {} long, x0 double, y0 double, x1 double, y1 double"
    words = spark.createDataFrame([(1, 1, 0, 0.0, 100.0, 10.0, 110.0), (1, 2, 0, 0.0, 0.0, 9.0, 9.0), (None, None, 0, 0.0, 0.0, 9.0, 9.0)], box.format("word_no"))
    rects = spark.createDataFrame([(1, 1, 7, 50.0, 10.0, 60.0, 30.0), (1, 1, 3, 90.0, 10.0, 99.0, 20.0), (1, 1, 1, 90.0, 5.0, 99.0, 20.0)], box.format("sw_idx"))
    found = {(r.doc_id, r.page_no): (r.sw_idx, r.rule, r.d) for r in layout.assign_words(words, rects, RuleConfig(3)).collect()}
    assert found == {(1, 1): (3, "section", 85.0), (1, 2): (None, "orphan", -1.0), (None, None): (None, "orphan", -1.0)}


def test_bridge_words_and_rectangles_are_computed_once(spark):
    b = Bridge(spark, SF)
    for df in (b.words, b.rects, b.routed):
        assert "Exchange" not in plan(df) and "Window" not in plan(df)


def test_captions_are_read_once_for_the_index(spark, tmp_path):
    b = Bridge(spark, SF)
    fields.captions(b.words, layout.assign_words(b.words, b.rects, RuleConfig(3)), b.rects, b.pages).write.parquet(f"{tmp_path}/captions")
    index = fields.name_index(spark.read.parquet(f"{tmp_path}/captions"), b.rects, b.codes)
    assert plan(index).count(f"{tmp_path}/captions"[:40]) == 1


def test_index_is_computed_once_for_bound_names(spark, tmp_path):
    b = Bridge(spark, SF)
    spark.createDataFrame([(1, "ABC", 1, 0)], "doc_id long, token string, page_no long, sw_idx long").write.parquet(f"{tmp_path}/index")
    names = b.words.select("doc_id", "page_no", F.upper("text").alias("token"))
    bound = fields.bind_names(b.words, b.words, spark.read.parquet(f"{tmp_path}/index"), names, b.pages)
    assert not [f for f in bound.inputFiles() if "/index/" in f]


def test_names_are_sought_only_in_documents_with_open_codes(spark, monkeypatch):
    """Two equal pages of a table of codes under a swatch; in document 2 the codes are aligned, so nothing is open there."""
    box = "doc_id long, page_no long, {} long, x0 double, y0 double, x1 double, y1 double{}"
    codes = [(d, 1, k, 300.0, 400.0 + 30 * k, 340.0, 410.0 + 30 * k, f"AB{k}1") for d in (1, 2) for k in range(6)]
    names = [(d, 1, 10 + k, 350.0, 400.0 + 30 * k, 390.0, 410.0 + 30 * k, name) for d in (1, 2) for k, name in enumerate(("Rose", "Blue"))]
    titles = [(d, 1, 20 + k, 10.0 + 100 * k, 52.0, 50.0 + 100 * k, 60.0, name) for d in (1, 2) for k, name in enumerate(("Rose", "Blue"))]
    words = spark.createDataFrame(codes + names + titles, box.format("word_no", ", text string"))
    rects = [(d, 1, k, 10.0 + 100 * k, 10.0, 60.0 + 100 * k, 50.0) for d in (1, 2) for k in range(2)]
    swatches = spark.createDataFrame(rects, box.format("sw_idx", ""))
    sheet = words.select("doc_id", "page_no").distinct().withColumns({"width": F.lit(600.0), "height": F.lit(800.0)})
    judged = words.where("word_no < 10").select("doc_id", "page_no", "word_no", F.col("text").alias("token"), (F.col("doc_id") == 2).alias("aligned"), F.lit(False).alias("blocked"))
    read = []

    def counted(words, *more):
        read.append({r.doc_id for r in words.select("doc_id").collect()})
        return layout.assign_words(words, *more)

    monkeypatch.setattr(pages, "assign_words", counted)
    hints = pages.name_hints(judged, words, swatches, judged.select("doc_id", "token").distinct(), sheet, rules=RuleConfig(7))
    assert {tuple(r) for r in hints.collect()} == {(1, 1, 0, 1, 0), (1, 1, 1, 1, 1)}
    assert all(found == {1} for found in read)


def read(df, name: str) -> bool:
    return any(f"pagelattice-{name}-" in f for f in df.inputFiles())


@pytest.mark.parametrize("version", [4, 13])
def test_verdicts_seek_code_words_and_their_swatches_once(spark, version):
    b = Bridge(spark, SF)
    judged = scan.verdicts(b.words, b.rects, b.codes, b.pages, RuleConfig(version))
    assert read(judged, "code-words") and not read(judged, "routed") and read(judged, "assigned") == (version >= 7)


def test_demotion_asks_for_sizes_of_aligned_words_only(spark, monkeypatch):
    b, rules, asked = Bridge(spark, SF), RuleConfig(9), []

    def counted(words, *more):
        asked.append(words)
        return detect.in_row_with_size(words, *more)

    monkeypatch.setattr(scan, "in_row_with_size", counted)
    judged = scan.verdicts(b.words, b.rects, b.codes, b.pages, rules)
    demoted = scan.demote_photos(judged, b.words, b.rects, b.pages, rules, share=0.01)
    assert 0 < asked[0].count() <= judged.where("aligned").count() < b.words.count()
    assert demoted.count() == judged.count() and read(demoted, "before-demotion") and not read(demoted, "code-words")


def test_alphabetic_codes_ask_for_sizes_of_their_columns_only(spark, monkeypatch):
    b, asked = Bridge(spark, SF), []
    row_sizes = detect.in_row_with_size

    def counted(words, *more):
        asked.append(words.count())
        return row_sizes(words, *more)

    monkeypatch.setattr(detect, "in_row_with_size", counted)
    found = detect.detect_codes(b.words, b.pages, rules=RuleConfig(12))
    anchors = b.code_words.count()
    members = detect.column_members(b.words, b.codes, b.pages).count()
    assert asked == [anchors + members] and asked[0] < b.words.count()
    assert read(found, "routed") and read(found, "vouched")


def test_clusters_are_sought_over_numbers(spark, monkeypatch):
    rows = [(1, "b:2", 1, 1, "X"), (1, "b:10", 1, 1, "Y"), (1, "b:3", 2, 2, "Y"), (1, "b:1", 2, 3, "Z"), (2, "b:2", 1, 1, "X"), (None, "b:9", 1, 1, "X"), (None, "b:8", 1, 1, "X")]
    bindings = spark.createDataFrame(rows, "doc_id long, id string, page_no long, sw long, code string").withColumn("Node", F.lit(7))
    seen, components = [], assemble.connected_components

    def counted(edges, *more):
        seen.append({f.dataType.typeName() for f in edges.schema})
        return components(edges, *more)

    monkeypatch.setattr(assemble, "connected_components", counted)
    got = assemble.clusters(bindings)
    assert seen == [{"long"}] and got.columns == [*bindings.columns, "cluster"]
    assert {(r.doc_id, r.id, r.cluster) for r in got.collect()} == {
        (1, "b:2", "b:10"), (1, "b:10", "b:10"), (1, "b:3", "b:10"), (1, "b:1", "b:1"), (2, "b:2", "b:2"), (None, "b:9", "b:9"), (None, "b:8", "b:8")
    }


def test_dense_bindings_are_computed_once(spark):
    assert read(Bridge(spark, SF).dense, "dense")
