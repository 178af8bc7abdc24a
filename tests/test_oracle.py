"""Every registered query runs; those with SQL give the same columns, types and rows."""

import pytest

import __spark_entry__ as contract
from ebbtide.plans import catalog, catalog_sql
from oracle import canonical, connect, run_sql

SF_DIR = "/root/testdata/sf0.01"
ORACLE = catalog_sql.oracle_sql()
QUERIES = catalog.queries()
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {
        "logistic_regression",
        "decision_tree",
        "random_forest",
        "model_comparison",
        "feature_importance",
    }


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = [tuple(row) for row in df.collect()]
    columns, types, expected = run_sql(duck, ORACLE[name])
    assert sorted(df.columns) == sorted(columns)
    want = dict(zip(columns, types))
    assert {c: SAME_TYPE[t] for c, t in df.dtypes} == want
    assert canonical(df.columns, rows) == canonical(columns, expected)


def test_entry_runs(spark):
    rows = contract.entry(spark).collect()
    assert [row.model for row in rows] == ["Logistic Regression", "Decision Tree", "Random Forest"]
