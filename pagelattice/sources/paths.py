"""File systems for Python data sources, whose tasks read byte ranges that Spark's own readers do not offer."""

from __future__ import annotations

import re

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path on it) of a local path or a URI (file, hdfs, s3, gs)."""
    local = re.sub(r"^file:/+", "/", path)
    if "://" not in local:
        return pafs.LocalFileSystem(), local.rstrip("/")
    fs, at = pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", local))
    return fs, at.rstrip("/")


def files_below(path: str, suffix: str = "") -> list[tuple[str, int]]:
    """(path, bytes) of the files below a folder, or of one file, in path order; names that begin with _ or . are left out."""
    fs, root = filesystem(path)
    info = fs.get_file_info(root)
    found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(root, recursive=True))
    hidden = re.compile(r"(?:^|/)[_.]")
    return sorted((f.path, f.size) for f in found if f.is_file and f.path.endswith(suffix) and not hidden.search(f.path[len(root) :]))


def split_bytes(spark: SparkSession) -> int:
    """The size in which the session cuts files (spark.sql.files.maxPartitionBytes)."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
