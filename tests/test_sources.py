import hashlib

import pytest

from pagelattice.operators import detect
from pagelattice.sources import readers
from pagelattice.streaming.incremental import append_once, judge_arrivals, queue_arrivals


def test_scan_files(spark, tmp_path):
    for name, data in {"acme/a.pdf": b"1", "acme/._a.pdf": b"2", "beta/sub/b.pdf": b"3", "beta/c.txt": b"4"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    got = {r["file_name"]: (r["vendor"], r["stem"], r["md5"]) for r in readers.scan_files(spark, str(tmp_path)).collect()}
    assert got == {"a.pdf": ("acme", "a", hashlib.md5(b"1").hexdigest()), "b.pdf": ("beta", "b", hashlib.md5(b"3").hexdigest())}


def test_counts_round_trip_and_unique_key(spark, tmp_path):
    rows = [("d", 1, 0, 1, 0, 0, 1, 0, 0, 1, 0, "standard"), ("d", 2, 0, 1, 0, 0, 1, 0, 0, 1, 0, "vector")]
    df = spark.createDataFrame(rows, readers.COUNT_SCHEMA)
    readers.write_counts(df, str(tmp_path / "ok"))
    assert sorted(map(tuple, readers.read_counts(spark, str(tmp_path / "ok")).collect())) == rows
    readers.write_counts(df.union(df), str(tmp_path / "twice"))
    with pytest.raises(ValueError, match="occurs twice"):
        readers.read_counts(spark, str(tmp_path / "twice"))


def test_products_round_trip(spark, tmp_path):
    df = spark.sql("select 'acme' brand, 7L doc_id, array(struct('S' as seriesName)) series")
    readers.write_products(df, str(tmp_path / "out"))
    (tmp_path / "out" / "brand=acme" / "x.review.json").write_text('{"doc_id": 9}\n')
    got = readers.read_products(spark, str(tmp_path / "out")).collect()
    assert [(r["brand"], r["doc_id"], r["series"][0]["seriesName"]) for r in got] == [("acme", 7, "S")]


def test_reviews_round_trip(spark, tmp_path):
    rows = [("acme", 7, "v12", [(1, 3, "AB12", "orphan", (2, 0), ("a.pdf", 1, [0.0, 0.0, 1.0, 1.0], "geom")), (1, 5, "AB13", "icon_demoted", None, None)], []), ("beta", 8, "v12", [], [(1, 0, [1.0, 2.0, 3.0, 4.0])])]
    readers.write_reviews(spark.createDataFrame(rows, readers.REVIEW_SCHEMA), str(tmp_path / "reviews"))
    got = readers.read_reviews(spark, str(tmp_path / "reviews")).orderBy("doc_id").collect()
    assert [(r["brand"], r["doc_id"], len(r["items"]), len(r["skeletonSwatches"])) for r in got] == [("acme", 7, 2, 0), ("beta", 8, 0, 1)]
    assert got[0]["items"][0]["nameHint"]["page"] == 2 and got[0]["items"][1]["nameHint"] is None


def test_census_keeps_failures(spark):
    pages = spark.createDataFrame([(1, 1, "60x60", 3), (1, 2, " ", 0), (2, 1, "x", 1)], "doc_id long, page_no long, text string, size_hits long")
    errors = spark.createDataFrame([(3, "broken"), (2, "half read")], "doc_id long, error string")
    got = {r["doc_id"]: (r["pages"], r["text_pages"], r["spec_pages"], r["error"]) for r in readers.census(pages, errors).collect()}
    assert got == {1: (2, 1, 1, None), 2: (0, 0, 0, "half read"), 3: (0, 0, 0, "broken")}


def test_arrivals(spark, tmp_path):
    schema = "doc_id long, page_no long, word_no long, text string"
    spark.createDataFrame([(1, 1, 0, "AB12"), (1, 1, 1, "word")], schema).write.parquet(str(tmp_path / "in" / "a"))
    query = judge_arrivals(spark, schema, str(tmp_path / "in" / "*"), detect.candidates, str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination(120)
    assert [(r["doc_id"], r["token"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(1, "AB12")]


def test_queue_stays_the_same_when_files_or_batches_come_again(spark, tmp_path):
    schema, key, out = "doc_id long, word_no long, text string", ["doc_id", "word_no"], str(tmp_path / "queue")
    one, two = [(1, 0, "AB12"), (1, 1, "x"), (None, 0, "y")], [(2, 0, "CD34")]

    def send(name, rows):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in" / name))

    def run():
        queue = queue_arrivals(spark, schema, str(tmp_path / "in" / "*"), lambda b: b, key, out, str(tmp_path / "state"), files=1)
        queue.awaitTermination(180)
        assert queue.exception() is None
        return sorted(map(str, (tuple(r)[:3] for r in spark.read.parquet(out).select("doc_id", "word_no", "text").collect())))

    send("a", one)
    send("b", one + one)
    want = sorted(map(str, one))
    assert run() == want
    send("c", two + one)
    send("d", two)
    want = sorted(map(str, one + two))
    assert run() == want == run()
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "queue").glob("batch=*"))
    before = {p.name: spark.read.parquet(str(p)).count() for p in (tmp_path / "queue").glob("batch=*")}
    append_once(spark.createDataFrame(two, schema), last, out, key)  # the last batch again
    assert {p.name: spark.read.parquet(str(p)).count() for p in (tmp_path / "queue").glob("batch=*")} == before
