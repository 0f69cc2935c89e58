"""Registered queries agree with their SQL twins on the smallest data."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from tools.check import TABLES, compare

FAST = [
    "cap_with_qrel_coverage", "corpus_pipeline", "bm25_topk", "dense_topk", "hybrid_search",
    "ir_metrics_domain", "latency_stats", "class_balance", "condition_passages", "grounding_rows",
    "grounding_summary", "ab_metric_stats", "ingest_stream",
]


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return c


def test_every_sql_twin_belongs_to_a_query():
    queries, oracle = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracle) <= set(queries)
    own = {q for q in queries if q != "pipeline" and not re.match(r"op\d+_", q)}
    assert len(own) == 83
    assert own == set(oracle) & own


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, data, con, name):
    got = entry_module.queries()[name](spark, data).toPandas()
    assert compare(got, con.execute(entry_module.oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["domain", "n_queries", "ndcg_10", "rr_10", "r_100", "r_1000"]


def test_no_cross_join_in_any_plan(spark, data):
    for name in ("hybrid_search", "ablation_table", "condition_passages", "cross_domain_metrics"):
        plan = entry_module.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
