"""The pipeline's stages in order, and every query of the subpackage at the smallest scale."""

import duckdb
import pytest

import corpus_pipeline
from check import rows_sorted
from tessella.fixtures import TABLES
from tessella.llm import quality
from tessella.llm.registry import load
from tests.conftest import SF
from tests.llm.cases import documents, empty
from tests.llm.test_near_copies import first_ids

QUERIES, ORACLES = load()


def test_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    frame = QUERIES[name](spark, SF)
    result = con.execute(ORACLES[name])
    assert rows_sorted(frame.columns, frame.collect()) == rows_sorted([d[0] for d in result.description], result.fetchall())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        rows[name] = docs.collect()
        assert (docs.columns == columns) == (i < 4) and rows[name]
    ids = lambda name: {r["doc_id"] for r in rows[name]}
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    scored = quality.score_documents(whole, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids("quality classifier") == {r["doc_id"] for r in scored.where("predicted = 1").collect()}
    kept = whole.where(whole["doc_id"].isin(*ids("quality classifier")))
    assert ids("near duplicates") == set(first_ids([(r["doc_id"], r["text"]) for r in kept.collect()]))
    assert len(rows["near duplicates"]) == len(ids("near duplicates"))
    assert len(rows["token files"]) == len(rows["source mix"])


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


@pytest.mark.parametrize("make", [documents, empty])
def test_stages_stand_odd_rows(spark, make, tmp_path):
    docs = make(spark)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    assert docs.count() >= 0
