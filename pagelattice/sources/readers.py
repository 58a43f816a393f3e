"""Sources and sinks: file scans, frozen counts, product trees.

Documents arrive as tables of pages, words and rectangles (see bridge.py for their columns) that a
document reader outside this package has extracted; here are the scans around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COUNT_SCHEMA = (
    "doc string, page int, n_sw int, n_codes int, code_orphan int, code_far int, code_x_aligned int, code_name_bound int, "
    "code_needs_review int, code_with_size int, sw_no_code int, ptype string"
)
PROV = "struct<pdf:string,page:long,bbox:array<double>,method:string>"
PRODUCT_SCHEMA = (
    f"brand string, doc_id long, bindingVersion string, seriesSkeleton boolean, needsReviewCount long, series array<struct<seriesName:string,seriesProv:{PROV},"
    f"allSizes:array<struct<size:string,prov:{PROV}>>,"
    f"specByCode:array<struct<id:string,code:string,size:string,surface:string,priceBand:string,packing:map<string,string>,prov:{PROV}>>,"
    f"variants:array<struct<id:string,code:string,color:string,colorProv:{PROV},regime:string,swatch:struct<page:long,bbox:array<double>>,swatchCrop:struct<png:string,prov:{PROV}>,"
    f"mergedFrom:array<struct<id:string,code:string,prov:{PROV}>>,"
    f"variantSizes:array<struct<size:string,finish:string,orderCode:string,priceBand:string,derivedFrom:array<string>,prov:{PROV}>>,pseudoCodeSuspect:array<string>,prov:{PROV}>>>>"
)

REVIEW_SCHEMA = (
    "brand string, doc_id long, bindingVersion string, "
    f"items array<struct<page_no:long,word_no:long,code:string,reason:string,nameHint:struct<page:long,swatchIdx:long>,prov:{PROV}>>, "
    "skeletonSwatches array<struct<page_no:long,sw_idx:long,bbox:array<double>>>"
)


def scan_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, vendor, file_name, stem, bytes, md5) of every file below folder, hidden resource files (._*) left out,
    in path order when collected by it.  vendor is the first part of the path below `folder`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    below = F.regexp_extract("path", rf"(?:^|/)\Q{folder.strip('/')}\E/+([^/]+)", 1)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(
        "path", below.alias("vendor"), name.alias("file_name"), F.regexp_replace(name, r"\.[^.]+$", "").alias("stem"), "length", F.md5("content").alias("md5")
    ).where(~F.col("file_name").startswith("._"))


def read_counts(spark: SparkSession, path: str, schema: str = COUNT_SCHEMA, key: tuple[str, ...] = ("doc", "page")) -> DataFrame:
    """Frozen page counts; raises if the key is not unique (one small aggregation)."""
    counts = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    twice = counts.groupBy(*key).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{path}: {tuple(twice[0][:-1])} occurs twice")
    return counts


def write_counts(counts: DataFrame, path: str) -> None:
    counts.write.mode("overwrite").option("header", True).csv(path)


def write_products(products: DataFrame, path: str) -> None:
    """One folder a brand, one JSON object a document; the brand is read back from the folder."""
    products.write.mode("overwrite").partitionBy("brand").json(path)


def write_reviews(reviews: DataFrame, path: str) -> None:
    """Review documents (brand, doc_id, bindingVersion, items, skeletonSwatches), as write_products does."""
    reviews.write.mode("overwrite").partitionBy("brand").json(path)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REVIEW_SCHEMA).json(path)


def read_products(spark: SparkSession, path: str, schema: str = PRODUCT_SCHEMA) -> DataFrame:
    """Product documents below path, without review and side-car files, under a declared schema."""
    found = spark.read.schema(schema).json(path)
    file = F.col("_metadata.file_name")
    side = file.endswith(".review.json") | file.endswith(".capcodes.json") | file.startswith("._")
    return found.withColumn("file", file).where(~side)


def census(pages: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """(doc_id, pages, text_pages, size_hits, spec_pages, error), one row a document.

    pages is (doc_id, page_no, text, size_hits); a document that could not be read is a row of errors (doc_id, error)
    and gets counts of 0 instead of stopping the run."""
    found = pages.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.trim(F.coalesce("text", F.lit(""))) != "").alias("text_pages"),
        F.sum("size_hits").alias("size_hits"),
        F.count_if(F.col("size_hits") >= 3).alias("spec_pages"),
    )
    found = found.withColumn("error", F.lit(None).cast("string"))
    if errors is None:
        return found
    zero = F.lit(0).cast("long")
    failed = errors.select("doc_id", *(zero.alias(c) for c in ("pages", "text_pages", "size_hits", "spec_pages")), "error")
    return found.join(failed, "doc_id", "left_anti").unionByName(failed)
