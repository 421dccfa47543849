"""Queries with SQL against it; whole results of the others have a stable shape."""

import os

import pytest

import __spark_entry__ as registered
from checks.compare import difference, duck
from comanda.llm.queries import QUERIES, SQL

FOLDER = os.environ.get("COMANDA_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    with duck(FOLDER) as open_connection:
        yield open_connection


def test_registered():
    names = registered.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(SQL) <= set(registered.oracle_sql())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", SQL)
def test_same_result(spark, connection, name):
    assert difference(QUERIES[name](spark, FOLDER), connection, SQL[name]) is None


TABLES = {"page_id": "pages", "doc_id": "documents", "conv_id": "conversations"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_one_row_for_each_input_row(spark, name):
    rows = QUERIES[name](spark, FOLDER)
    key = next(k for k in TABLES if k in rows.columns)
    given = spark.read.parquet(f"{FOLDER}/{TABLES[key]}.parquet").select(key)
    if key == "conv_id":
        given = given.distinct()
    if name.startswith("op5"):
        rows = rows.where("piece = 0")
    assert sorted(r[0] for r in rows.select(key).collect()) == sorted(r[0] for r in given.select(key).collect())


NATIVE = ("op3_decontaminate", "op4_url_filter")


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
