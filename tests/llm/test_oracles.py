"""Every query of the subpackage against its SQL, and the ones without Python code."""

import duckdb
import pytest

import __spark_entry__
from marketpulse.llm import catalog
from tests.test_plans_oracle import SF_SMALL, TABLES, duck_rows, spark_rows

NATIVE = [n for n in catalog.QUERIES if n.split("_")[0] in ("op1", "op2", "op6", "op9")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_all_are_registered():
    assert [n.split("_")[0] for n in catalog.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(catalog.ORACLE) <= set(catalog.QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert spark_rows(catalog.QUERIES[name](spark, SF_SMALL)) == duck_rows(duck.sql(catalog.ORACLE[name]))


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in ("EvalPython", "InPandas", "InArrow", "PythonRDD") if op in plan]
