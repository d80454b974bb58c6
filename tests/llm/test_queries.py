import re

import duckdb

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from affinis.llm.queries import ORACLE, QUERIES
from check import TABLES, rows
from tests.conftest import SF


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert queries()["pipeline"] is corpus_pipeline.run


def test_queries_equal_their_sql(spark):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for name, sql in ORACLE.items():
        result, answer = QUERIES[name](spark, SF), connection.execute(sql)
        assert rows(result.columns, result.collect()) == rows([c[0] for c in answer.description], answer.fetchall())
