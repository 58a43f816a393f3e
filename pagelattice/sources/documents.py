"""Pre-extracted documents as files, and a data source that reads them.

A document is a file of JSON lines below a folder for its brand: a header (doc_id, pages), then a line a page
(page_no, width, height, words).  A reader takes one page at a time, so a document may be of any length; whatever is
wrong with a file becomes one row with an error after the pages that could be read, and no other file suffers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from pagelattice.functions import tokens as T

from .paths import files_below, filesystem, split_bytes

BOX = ("x0", "y0", "x1", "y1")
#: Columns of either grain: one row a word, or one row a page with its text.
WORDS = "brand string, file string, doc_id long, page_no long, width double, height double, word_no long, x0 double, y0 double, x1 double, y1 double, text string, error string"
PAGES = "brand string, file string, doc_id long, page_no long, width double, height double, n_words long, text string, error string"
#: Rows handed on at once.
BATCH_ROWS = 20_000


def page_lines(words: DataFrame, pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(brand, doc_id, page_no, line): the lines of every document, the header as page 0.  A page's words are in one row;
    documents is (doc_id, brand)."""
    word = F.struct("word_no", *BOX, "text")
    held = words.groupBy("doc_id", "page_no").agg(F.sort_array(F.collect_list(word)).alias("words"))
    body = pages.join(held, ["doc_id", "page_no"], "left")
    line = F.to_json(F.struct("page_no", "width", "height", F.coalesce("words", F.array().cast(held.schema["words"].dataType)).alias("words")))
    heads = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pages")).select("doc_id", F.lit(0).cast("long").alias("page_no"), F.to_json(F.struct("doc_id", "pages")).alias("line"))
    return body.select("doc_id", "page_no", line.alias("line")).unionByName(heads).join(documents.select("doc_id", "brand"), "doc_id")


def write_documents(lines: DataFrame, path: str) -> None:
    """One file a document (brand=…/doc_id=…), its lines in page order."""
    placed = lines.repartition("brand", "doc_id").sortWithinPartitions("brand", "doc_id", "page_no")
    placed.select("brand", "doc_id", "line").write.partitionBy("brand", "doc_id").text(path)


@dataclass
class Files(InputPartition):
    """Whole files of some size together."""

    files: list[str]


def _page_rows(page: dict, known: dict, grain: str) -> Iterator[dict]:
    base = known | {"page_no": int(page["page_no"]), "width": page.get("width"), "height": page.get("height"), "error": None}
    if grain == "page":
        yield base | {"n_words": len(page["words"]), "text": " ".join(w.get("text") or "" for w in page["words"])}
    else:
        for w in page["words"]:
            yield base | w


def document_rows(lines: Iterator[bytes], known: dict, grain: str = "word") -> Iterator[dict]:
    """The rows of one document, and a row with an error if its header or a page cannot be read or pages are missing."""
    done = 0
    try:
        header = json.loads(next(lines, b""))
        known, expected = known | {"doc_id": int(header["doc_id"])}, int(header["pages"])
    except (ValueError, KeyError, TypeError):
        yield known | {"error": "unreadable header"}
        return
    try:
        for line in lines:
            yield from list(_page_rows(json.loads(line), known, grain))
            done += 1
    except (ValueError, KeyError, TypeError):
        yield known | {"error": f"unreadable page after {done} of {expected}"}
        return
    if done != expected:
        yield known | {"error": f"{done} of {expected} pages"}


class DocumentReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, options: dict[str, str]):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.path, self.grain = path, options.get("grain", "word")
        self.split, self.schema = int(options.get("splitbytes", 1 << 27)), to_arrow_schema(schema)

    def partitions(self) -> Sequence[InputPartition]:
        """Files in path order, as many together as fit the size of a split; a larger file stands alone."""
        out, held = [Files([])], 0
        for name, size in files_below(self.path):
            if out[-1].files and held + size > self.split:
                out.append(Files([]))
                held = 0
            out[-1].files.append(name)
            held += size
        return out

    def read(self, part: Files) -> Iterator[pa.RecordBatch]:
        fs, rows = filesystem(self.path)[0], []
        batch = lambda: pa.RecordBatch.from_pylist(rows, schema=self.schema)  # noqa: E731  columns that are not asked for end here
        for name in part.files:
            brand = re.search(r"/brand=([^/]*)/", name)
            known = {"file": name, "brand": brand[1] if brand else None}
            with fs.open_input_stream(name) as f:
                for row in document_rows(_lines(f), known, self.grain):
                    rows.append(row)
                    if len(rows) >= BATCH_ROWS:
                        yield batch()
                        rows = []
        if rows:
            yield batch()


def _lines(f, size: int = 1 << 20) -> Iterator[bytes]:
    rest = b""
    while chunk := f.read(size):
        *whole, rest = (rest + chunk).split(b"\n")
        yield from whole
    if rest:
        yield rest


class DocumentSource(DataSource):
    """spark.read.format("documents").schema(…).load(folder): columns of WORDS, or of PAGES with option grain=page, as many
    as the schema names.  Option splitBytes: the size of files that one task reads."""

    @classmethod
    def name(cls) -> str:
        return "documents"

    def schema(self) -> str:
        return PAGES if self.options.get("grain") == "page" else WORDS

    def reader(self, schema: StructType) -> DocumentReader:
        return DocumentReader(self.options["path"], schema, {k.lower(): v for k, v in self.options.items()})


def read_documents(spark: SparkSession, path: str, grain: str = "word", schema: str | None = None, **options: object) -> DataFrame:
    """The words (or pages) of the documents below path; only the columns that `schema` names are made."""
    spark.dataSource.register(DocumentSource)
    known = {"splitBytes": split_bytes(spark), "grain": grain, **options}
    return spark.read.format("documents").schema(schema or (PAGES if grain == "page" else WORDS)).options(**known).load(path)


def census(spark: SparkSession, path: str) -> DataFrame:
    """(brand, doc_id, pages, text_pages, words, size_hits, spec_pages, error): one row a file; a file with an error has no
    counts.  A file whose header cannot be read has no doc_id."""
    wanted = "brand string, file string, doc_id long, n_words long, text string, error string"
    pages = read_documents(spark, path, "page", wanted).withColumn("hits", T.size_hits(F.coalesce("text", F.lit(""))))
    good = F.max("error").isNull()
    sums = (
        ("pages", F.count("n_words")),
        ("text_pages", F.count_if(F.trim(F.coalesce("text", F.lit(""))) != "")),
        ("words", F.coalesce(F.sum("n_words"), F.lit(0))),
        ("size_hits", F.sum("hits")),
        ("spec_pages", F.count_if(F.col("hits") >= 3)),
    )
    counts = [F.when(good, x).otherwise(0).cast("long").alias(n) for n, x in sums]
    return pages.groupBy("brand", "file").agg(F.max("doc_id").alias("doc_id"), *counts, F.max("error").alias("error")).drop("file")
