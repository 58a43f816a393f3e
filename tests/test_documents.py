import json

import pytest
from pyspark.sql import functions as F

from pagelattice.operators import products, reports
from pagelattice.sources import documents, readers

WORD = "doc_id long, page_no long, word_no long, x0 double, y0 double, x1 double, y1 double, text string"
WORDS = [(1, 1, 0, 0.0, 0.0, 9.0, 9.0, "AB12"), (1, 1, 1, 10.0, 0.0, 30.0, 9.0, "60x60"), (1, 3, 0, 0.0, 0.0, 5.0, 5.0, 'a "quoted"\nword'), (2, 1, 0, 0.0, 0.0, 1.0, 1.0, None)]


@pytest.fixture
def folder(spark, tmp_path):
    words = spark.createDataFrame(WORDS, WORD)
    pages = spark.createDataFrame([(1, 1, 600.0, 800.0), (1, 2, 600.0, 800.0), (1, 3, 600.0, 800.0), (2, 1, 1200.0, 800.0)], "doc_id long, page_no long, width double, height double")
    brands = spark.createDataFrame([(1, "acme"), (2, "be ta")], "doc_id long, brand string")
    documents.write_documents(documents.page_lines(words, pages, brands), str(tmp_path / "in"))
    return tmp_path / "in"


def test_words_come_back_with_pruned_columns(spark, folder):
    got = documents.read_documents(spark, str(folder)).drop("brand", "file", "width", "height", "error").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, WORDS))
    pruned = documents.read_documents(spark, str(folder), schema="text string, doc_id long")
    assert pruned.columns == ["text", "doc_id"]
    assert sorted(map(str, map(tuple, pruned.collect()))) == sorted(str((w[7], w[0])) for w in WORDS)


@pytest.mark.parametrize("split", [1, 1 << 20])
def test_pages_and_packing_of_files(spark, folder, split):
    pages = documents.read_documents(spark, str(folder), "page", splitBytes=split)
    assert pages.rdd.getNumPartitions() == (2 if split == 1 else 1)
    got = {(r["doc_id"], r["page_no"]): (r["width"], r["n_words"], r["text"]) for r in pages.collect()}
    assert got == {(1, 1): (600.0, 2, "AB12 60x60"), (1, 2): (600.0, 0, ""), (1, 3): (600.0, 1, 'a "quoted"\nword'), (2, 1): (1200.0, 1, "")}


def test_a_bad_file_is_a_row_and_stops_nothing(spark, folder):
    for name, lines in {
        "empty": "",
        "nothead": '{"pages": 3}\n',
        "cut": '{"doc_id": 7, "pages": 2}\n{"page_no": 1, "width": 1, "height": 1, "words": []}\n{"page_no": 2, "wid',
        "short": '{"doc_id": 8, "pages": 2}\n{"page_no": 1, "width": 1, "height": 1, "words": [{"text": "60x60 70x70 80x80"}]}\n',
    }.items():
        at = folder / "brand=bad" / f"doc_id={name}"
        at.mkdir(parents=True)
        (at / "part.txt").write_text(lines)
    (folder / "brand=bad" / "_hidden.txt").write_text("x")
    got = sorted((str(r["doc_id"]), r["pages"], r["text_pages"], r["spec_pages"], r["error"]) for r in documents.census(spark, str(folder)).collect())
    assert got == [
        ("1", 3, 2, 0, None),
        ("2", 1, 0, 0, None),
        ("7", 0, 0, 0, "unreadable page after 1 of 2"),
        ("8", 0, 0, 0, "1 of 2 pages"),
        ("None", 0, 0, 0, "unreadable header"),
        ("None", 0, 0, 0, "unreadable header"),
    ]


def test_rows_of_a_document_come_page_by_page():
    lines = iter([b'{"doc_id": 1, "pages": 9}', b'{"page_no": 1, "width": 1, "height": 2, "words": [{"word_no": 0, "text": "a"}]}', b"[1, 2]"])
    rows = documents.document_rows(lines, {"file": "f"})
    assert next(rows)["text"] == "a"
    assert [r["error"] for r in rows] == ["unreadable page after 1 of 9"]


def _nested(doc):
    """A whole product document around what a case needs."""
    p = {"pdf": "x.pdf", "page": 1, "bbox": [0.0, 0.0, 10.0, 10.0], "method": "t"}
    doc = json.loads(json.dumps(doc))
    for s in doc["series"]:
        for r in (*s.get("specByCode", []), *s.get("variants", []), *s.get("allSizes", []), *(x for v in s.get("variants", []) for x in v.get("variantSizes", []))):
            r.setdefault("prov", p)
    return doc


@pytest.fixture
def read(spark, tmp_path):
    def run(*docs):
        at = tmp_path / "products" / "brand=acme"
        at.mkdir(parents=True)
        (at / "all.json").write_text("".join(json.dumps(_nested({"doc_id": k, **d})) + "\n" for k, d in enumerate(docs)))
        return readers.read_products(spark, str(tmp_path / "products"))

    return run


def test_risks_of_nested_documents(spark, read):
    spec = lambda **k: {"id": "s", "code": "AB1", **k}
    far = {"pdf": "x.pdf", "page": 2, "bbox": [50.0, 50.0, 90.0, 60.0], "method": "t"}
    made = read(
        {"series": [{"specByCode": [spec(code="A102"), *(spec(priceBand=f"A{k}") for k in (1, 2))], "variants": [{"id": "v", "variantSizes": [{"size": "60x60", "orderCode": "AB1", "priceBand": "A33"}]}]}]},
        {"series": [{"variants": [{"id": "v", "code": "LONGCODE", "pseudoCodeSuspect": ["ZZ9"]}, {"id": "w", "code": "LISTED7", "pseudoCodeSuspect": []}]}]},
        {"series": [{"specByCode": [spec(size="circa 60", surface="MATT 10", priceBand="N/A", packing={"pcsBox": "x"})], "variants": [{"id": "v", "variantSizes": [{"size": "circa 60", "finish": "10MM"}]}]}]},
        {"series": [{"specByCode": [spec(size="60x60"), spec(size="60x60", prov=far)], "variants": [{"id": "v", "variantSizes": [{"size": "600x600"}, {"size": "60x60"}]}]}]},
        {"series": [{"specByCode": [spec(code="MATT"), spec(code="T1")], "variants": [{"id": "v", "variantSizes": [{"finish": "MATT", "priceBand": "T1"}]}]}]},
        {"series": [{}]},
    )
    words = spark.createDataFrame([(3, 1, 0, 1.0, 1.0, 9.0, 9.0, "60 x 60 cm"), (3, 2, 0, 60.0, 51.0, 80.0, 59.0, "60X60"), (3, 2, 1, 200.0, 51.0, 210.0, 59.0, "1x1")], WORD)
    stems = spark.createDataFrame([(1, "my-listed7-longcode")], "doc_id long, stem string")
    got = sorted(tuple(r) for r in products.document_risks(made, words, stems).collect())
    assert got == sorted(
        [
            (0, "F1_code_price_swap", "code", "A102"),
            (1, "F1b_pseudo_code", "code", "LISTED7"),
            (1, "F1b_pseudo_code", "code", "ZZ9"),
            (2, "F2_field_mixing", "size", "circa 60"),
            (2, "F2_field_mixing", "surface", "MATT 10"),
            (2, "F2_field_mixing", "price_band", "N/A"),
            (2, "F2_field_mixing", "packing", '{"pcsBox":"x"}'),
            (3, "F4_unit_collision", "size", "60x60"),
            (3, "F4_unit_alias", "size", "600x600|60x60"),
            (4, "F5_multi_role", "code+surface", "MATT"),
            (4, "F5_multi_role", "code+price_band", "T1"),
        ]
    )
    raw = {(r["source"], r["id"], r["size"], r["raw"]) for r in products.printed_values(products.field_values(made), words).where("doc_id = 3").collect()}
    assert ("spec", "s", "60x60", "60 x 60 cm") in raw


def test_parts_owe_provenance(spark, read):
    bare = {"pdf": "", "page": None, "bbox": [], "method": None}
    made = read(
        {"series": [{"allSizes": [{"size": "60x60", "prov": bare}], "specByCode": [{"id": "s1", "prov": bare}], "variants": [{"id": "v", "color": None, "mergedFrom": [{"id": "b", "prov": bare}], "prov": bare, "variantSizes": [{"size": "60x60", "prov": bare}], "swatchCrop": {"png": None, "prov": bare}}]}]},
        {"series": [{"variants": [{"id": "w", "color": "RED", "swatchCrop": {"png": "a.png", "prov": {"pdf": "x", "page": 1, "bbox": [0.0]}}}]}]},
    )
    reviews = spark.createDataFrame([("acme", 0, "v12", [(1, 2, "C", "orphan", None, ("x.pdf", 1, None, "t"))], [])], readers.REVIEW_SCHEMA)
    got = {(r["doc_id"], r["kind"], r["token"]): r["missing"] for r in reports.provenance_gaps(products.product_parts(made, reviews)).collect()}
    assert got == {
        (0, "variant", "v"): "pdf,page,bbox,method",
        (0, "swatch_crop", "v"): "crop,page,bbox",
        (0, "merged_from", "v|b"): "page,bbox",
        (0, "variant_size", "v|60x60|"): "page,bbox",
        (0, "all_size", "60x60"): "pdf,page",
        (0, "spec_row", "s1"): "pdf,page,bbox,method",
        (0, "review", "1|2"): "bbox",
        (1, "color", "w"): "pdf",
    }


def test_a_document_with_swatches_and_no_binding_is_a_skeleton(spark):
    docs = spark.createDataFrame([(1, "acme", "a.pdf", "a", 2), (2, "acme", "b.pdf", "b", 0)], "doc_id long, brand string, file_name string, stem string, n_swatches long")
    box = "x0 double, y0 double, x1 double, y1 double"
    empty = lambda schema: spark.createDataFrame([], schema)
    queue = spark.createDataFrame([(2, 1, 4, "C1", "orphan", 0.0, 0.0, 1.0, 1.0, 3, 0)], f"doc_id long, page_no long, word_no long, code string, reason string, {box}, hint_page long, hint_sw long")
    made = products.product_documents(
        docs,
        empty("doc_id long, cluster string, color string, merged_from array<string>"),
        empty(f"doc_id long, id string, code string, page_no long, sw long, {box}, sw_x0 double, sw_y0 double, sw_x1 double, sw_y1 double"),
        empty(f"doc_id long, id string, code string, size string, surface string, price_band string, packing map<string,string>, page_no long, {box}, method string"),
        queue,
        empty("doc_id long, sw long, png string"),
        empty("doc_id long, code string"),
    )
    assert {r["doc_id"]: (r["seriesSkeleton"], r["needsReviewCount"], r["series"][0]["variants"]) for r in made.collect()} == {1: (True, 0, []), 2: (False, 1, [])}
    swatches = spark.createDataFrame([(1, 1, 0, 0.0, 0.0, 5.0, 5.0), (1, 2, 0, 1.0, 0.0, 5.0, 5.0), (2, 1, 0, 0.0, 0.0, 5.0, 5.0)], f"doc_id long, page_no long, sw_idx long, {box}")
    reviews = {r["doc_id"]: r for r in products.review_documents(docs, made, queue, swatches).collect()}
    assert [len(reviews[k]["skeletonSwatches"]) for k in (1, 2)] == [2, 0]
    assert [(i["code"], i["nameHint"]["page"], i["prov"]["pdf"]) for i in reviews[2]["items"]] == [("C1", 3, "b.pdf")]


def test_schemas_read_what_is_written(spark):
    assert spark.createDataFrame([], readers.PRODUCT_SCHEMA).select(F.explode("series")).count() == 0
