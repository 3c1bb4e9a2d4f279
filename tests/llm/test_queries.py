"""Registered queries of the training-data operators on the smallest tables."""

from __future__ import annotations

import duckdb

import corpus_pipeline
from sparksignal.llm import queries

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_line_dedup_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(queries.ORACLE["op3_line_dedup"])
    got = queries.QUERIES["op3_line_dedup"](spark, SF).select(*rel.columns).collect()
    assert sorted(map(tuple, got)) == sorted(rel.fetchall())


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = corpus_pipeline.chunks.write_table(docs, "stage")
        assert 0 < docs.count() <= n
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == n
