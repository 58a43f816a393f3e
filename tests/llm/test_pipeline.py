"""The pipeline against plain versions of its decisions, stage by stage."""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pagelattice.llm.common import materialize, read_table
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_mixing import brute as mixture
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], SF), f"test-{name}"))
    assert all(d.columns == columns for d in seen[:-1])
    rows = [{r["doc_id"]: r for r in d.collect()} for d in seen[:-1]]
    assert all(r["text"] and any(c.isalpha() for c in r["text"]) for r in rows[1].values()) and len(rows[1]) >= 0.98 * len(rows[0])
    components = plain_components({i: plain_fingerprint(r["text"]) for i, r in rows[1].items()})
    assert set(rows[2]) == set(components.values())
    bench = [tuple(r) for r in read_table(spark, SF, "benchmark").select("item_id", "text").collect()]
    found = hits([(i, r["text"]) for i, r in rows[2].items()], bench)
    assert set(rows[3]) == {i for i, x in found.items() if not x[-1]}
    want = mixture([(i, r["text"], r["source"]) for i, r in rows[3].items()])
    copies = {i: t // z for i, (z, _, _, t) in want.items() if t}
    got = {r["doc_id"]: r["count"] for r in seen[4].groupBy("doc_id").count().collect()}
    assert got == copies
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    at, last = 0, []
    for i in sorted(copies):
        ids = [*encode(rows[3][i]["text"], add_special_tokens=False).ids, 2]
        for _ in range(copies[i]):
            last.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
    assert sorted(tuple(r) for r in seen[5].select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == last


def _folder(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for table in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    return str(tmp_path)


def test_nulls_empties_and_extra_columns(spark, tmp_path, odd, documents):
    """Rows without an id, shared ids, blanks and columns named as the stages' own: no clean row is lost before the mix."""
    columns = {c: "own" for c in ("copies", "row_key", "row_id", "finish")}
    docs = documents.limit(60).unionByName(odd.select(*documents.columns)).withColumns({c: F.lit(v) for c, v in columns.items()})
    folder = _folder(spark, tmp_path, docs)
    rows = read_table(spark, folder, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        rows = materialize(stage(spark, rows, folder), f"test-{name}")
        assert rows.columns == docs.columns
        kept[name] = {(r["doc_id"], r["text"]) for r in rows.collect()}
    assert (None, "a row without an id") in kept["decontaminate"]
    assert not any(t is None or not any(map(str.isalpha, t)) for _, t in kept["language_id"])
    last = corpus_pipeline.STAGES[4][1](spark, rows, folder)
    assert last.count() == rows.count() > 0


def test_empty_table(spark, tmp_path, documents):
    assert corpus_pipeline.run(spark, _folder(spark, tmp_path, documents.where(F.lit(False)))).count() == 0
