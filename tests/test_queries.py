"""Every registered query against its SQL on the smallest dataset, and rules on every plan."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
PYTHON_STAGES = {  # queries whose operator applies a model or a matrix product in Python workers
    "score_prompts", "topk_categories", "topk_blocked", "zero_shot_accuracy", "embed_batches", "detect_batches", "score_head",
    "extract_embeddings",  # and those that only read what such a stage wrote have no Python in their own plan
    "hybrid_predict", "score_linear_head", "train_head",
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


LIBRARY = sorted(name for name, query in queries().items() if query.__module__.startswith("sightline.catalog"))


@pytest.mark.parametrize("name", LIBRARY)
def test_query(spark, db, name):
    df = queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in PYTHON_STAGES:
        assert "InPandas" not in plan and "ArrowEvalPython" not in plan
    rows = df.collect()
    assert rows
    if name in oracle_sql():
        cursor = db.execute(oracle_sql()[name])
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows_of(df.columns, rows) == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 1


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
