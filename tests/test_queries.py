"""Every registered query against its SQL, on the smallest data."""

import os
import pytest

import __spark_entry__ as contract
from check import compare, oracle_connection
from conftest import SF, plan_of
from passagemill.plans import catalogue, lifecycle, oracle, retrieval, retrieval_oracle

OWN = catalogue.QUERIES | lifecycle.QUERIES | retrieval.QUERIES
ORACLE = oracle.ORACLE | retrieval_oracle.ORACLE
#: Sketches, and figures of an index that SQL can't follow: tested by themselves (test_progress, test_cells).
WITHOUT_SQL = {"duration_quantiles", "ivf_pruned_share", "ivf_upkeep_recall"}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_sql():
    assert set(ORACLE) == set(OWN) - WITHOUT_SQL


@pytest.mark.parametrize("name", list(OWN))
def test_query(spark, con, name):
    verdict, _, _ = compare(spark, con, SF, name)
    assert verdict.startswith("rows" if name in WITHOUT_SQL else "ok"), verdict


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["qid", "question", "answer", "n_sources", "prompt"] and df.count() == 40


def test_flagship_plan(spark):
    plan = plan_of(contract.entry(spark))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    # chunks are stored once; the search reads them once, and the winners' texts are joined
    assert plan.count("MapInArrow") == 1 and "aggregate(" not in plan
    assert plan.count("ReadSchema: struct<source_file:bigint,chunk_index:bigint,text:string>") == 2


def test_chunking_needs_no_shuffle(spark):
    docs = spark.read.parquet(os.path.join(SF, "documents.parquet"))
    from passagemill.plans.catalogue import packed

    plan = plan_of(packed(docs.select("doc_id", "text")).select("doc_id", "chunks"))
    assert "Exchange" not in plan
    assert plan.count("aggregate(") == 2  # the fold over pages and the one in it, each once
