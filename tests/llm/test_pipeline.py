"""Registered queries, and the pipeline as its stages one after another."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.conftest import TEXTS
from viewflow.llm.queries import LLM_ORACLES, LLM_QUERIES

DATA = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the generated tables")


def test_every_operator_has_a_query():
    names = [re.match(r"op(\d+)_", name) for name in LLM_QUERIES]
    assert sorted(int(m[1]) for m in names if m) == list(range(1, 14)) and "pipeline" in LLM_QUERIES
    assert LLM_QUERIES.items() <= contract.queries().items()
    assert set(LLM_ORACLES) <= set(LLM_QUERIES)


@given
@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_oracles(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = LLM_QUERIES[name](spark, DATA).toArrow()
    wanted = connection.sql(LLM_ORACLES[name]).to_arrow_table()
    assert {f.name: f.type for f in found.schema} == {f.name: f.type for f in wanted.schema}
    names = sorted(found.column_names)
    rows = [sorted(zip(*[t[n].to_pylist() for n in names])) for t in (found, wanted)]
    assert rows[0] == rows[1] and rows[0]


@given
@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_rows_and_schema(spark, name):
    table = {1: "pages", 4: "embeddings", 12: "conversations"}.get(int(m[1]) if (m := re.match(r"op(\d+)", name)) else 0, "documents")
    n = spark.read.parquet(f"{DATA}/{table}.parquet").count()
    out = LLM_QUERIES[name](spark, DATA)
    if name in ("op4_top_k", "op6_packing", "op12_conversation_repair", "pipeline"):
        assert out.count() > 0
    else:
        assert out.count() == n


@given
def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == columns and out.schema == docs.schema
        assert 0 < out.count() <= docs.count()
        docs = out.checkpoint()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_stages_on_odd_rows(spark, docs, empty, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for start in (docs, empty):
        left = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, start, str(tmp_path))
            assert out.columns == start.columns
            assert out.count() <= start.count()
            left = stage(spark, left, str(tmp_path)).checkpoint()
        assert corpus_pipeline.STAGES[-1][1](spark, left, str(tmp_path)).count() >= left.count()
    kept = {r.doc_id for r in corpus_pipeline.STAGES[2][1](spark, docs, str(tmp_path)).collect()}
    assert 1 in kept and 2 not in kept
    texts = {r.text for r in corpus_pipeline.STAGES[3][1](spark, docs, str(tmp_path)).collect()}
    assert {t for i, t in TEXTS if i in (1, 2, 3)} <= texts
