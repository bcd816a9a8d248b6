"""Registered queries against their SQL, and the pipeline."""

import duckdb
import pytest

import corpus_pipeline
from tests.llm import cases
from turnmill.llm.queries import ORACLES, REGISTRY

SF = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations", "events")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = REGISTRY[name](spark, SF)
    assert sorted(columns) == sorted(got.columns)
    key = lambda row: tuple(str(x) for x in row)
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(map(tuple, want.fetchall()), key=key)


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in REGISTRY} == {f"op{i}" for i in range(1, 14)}
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


def test_stages_on_odd_documents(spark):
    docs = cases.documents(spark)
    columns = docs.columns
    from turnmill.scratch import stage
    kept = None
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), "stage")
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "token ids":
            assert docs.columns == columns
        assert kept is None or ids <= kept
        kept = ids
    assert 8 in kept and 0 not in kept and 9 not in kept


def test_stages_on_an_empty_table(spark):
    docs = cases.empty(spark)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
        assert docs.count() == 0


def test_pipeline_rows(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and out.count() > 500
