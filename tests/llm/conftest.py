import duckdb
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

#: Texts that every operator has to take: nulls, blanks, odd white space, ties, repeats and other scripts.
ODD = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n\x0b ", None, None),
    (4, "one", "en", "b"),
    (5, "one", "en", "b"),
    (5, "one", "en", "b"),
    (6, "the cat  sat\n\non the\tmat   and  slept.\n", "en", None),
    (7, "12345 !!! ###", "en", "c"),
    (8, "你好 世界 Жук \U0001f600 été", "xx", "\U0001f600"),
    (9, "word " * 30_000, "en", "a"),
    (None, "a row without an id", "en", "a"),
    (10, "a<|endoftext|>b don't it's\r\n  x", "en", "d"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with columns whose names the operators use themselves."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("score", T.StringType()),
            T.StructField("key", T.IntegerType()),
            T.StructField("fp", T.BooleanType()),
            T.StructField("size", T.StringType()),
        ]
    )
    rows = [(i, t, g, s, None if t is None else len(t), "x", 1, None, "big") for i, t, g, s in ODD]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def equals_sql():
    """Asserts that a DataFrame has the rows of DuckDB SQL over the smallest tables."""

    def check(df, sql, tables):
        con = duckdb.connect()
        for t in tables:
            con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
        columns = sorted(df.columns)
        want = con.sql(sql)
        assert sorted(want.columns) == columns
        got = sorted(map(str, map(tuple, df.select(*columns).collect())))
        assert got == sorted(map(str, want.select(*(f'"{c}"' for c in columns)).fetchall()))

    return check
