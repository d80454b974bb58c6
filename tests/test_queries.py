import duckdb
import pytest

from __spark_entry__ import entry, queries
from affinis.workloads import ORACLE, QUERIES
from check import TABLES, rows

from .conftest import SF


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES) <= set(queries())
    assert {n for n in QUERIES if n not in ORACLE} == {
        "als_predictions", "als_predictions_scaled", "als_cold_start_filled", "als_error_report"
    }


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sql, name):
    result = queries()[name](spark, SF)
    answer = sql.execute(ORACLE[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(result.columns)
    assert rows(result.columns, result.collect()) == rows(columns, answer.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 4
