"""Compares one registered query with its SQL on DuckDB."""

from collections import Counter

import duckdb

import oracle_queries
from provider_analytics.plans import workload

TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
QUERIES = workload.QUERIES
ORACLE = oracle_queries.oracle_sql()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def assert_matches(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = Counter(tuple(row) for row in df.select(*columns).collect())

    answer = duck.execute(ORACLE[name])
    described = {d[0]: str(d[1]) for d in answer.description}
    rows = answer.fetchall()
    order = [list(described).index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in rows)

    assert {c: TYPES[t] for c, t in df.dtypes} == described
    assert sum(found.values()) == sum(expected.values()) > 0
    assert found == expected
