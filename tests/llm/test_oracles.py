"""The training-data queries that SQL can express equal their SQL; all of them run on the smallest tables."""

import os

import duckdb
import pytest

from cohortloom.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = QUERIES[name](spark, DATA).toPandas(), con.execute(ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda d: sorted(map(str, d[columns].astype(object).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", ["op1_language_id", "op3_byte_bpe", "op5_sharding", "op6_quality_classifier", "op8_token_counts", "op9_jaccard_join"])
def test_one_row_per_document(spark, name):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = QUERIES[name](spark, DATA)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
