"""Every query against its oracle on the smallest tables."""

import duckdb
import pytest

from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def sorted_rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in data), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    types = {d[0]: str(d[1]) for d in answer.description}
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    expected = sorted_rows(columns, answer.fetchall())
    assert sorted_rows(df.columns, df.collect()) == expected
    assert expected
