"""A training-corpus pipeline over the operators of pagelattice.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as
Parquet and read again as the next stage's docs.  All but the last return the columns of
`documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagelattice.llm import decontaminate, language, mixing, simhash, tokens
from pagelattice.llm.common import materialize, read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language stay; null, letterless and undecided texts go."""
    return language.keep_identified(docs, language.fit(language.training_rows(docs)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (at most twice)."""
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in wavelet-matrix shards, and what reading them back gives for each document."""
    return tokens.token_table(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix_sources", mix_sources),
    ("token_ids", write_token_ids),
]

#: Language identification and tokenisation have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
