"""Order-insensitive comparison of a Spark result with DuckDB SQL."""

import math

import duckdb

TABLES = ("region", "nation", "customer", "events")


def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _key(row):
    return tuple((v is None, str(type(v)), "" if v is None else str(v)) for v in row)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=_key)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


SQL_TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


def assert_equal(df, connection, sql):
    relation = connection.sql(sql)
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {name: SQL_TYPES[kind] for name, kind in df.dtypes} == types
    expected = sorted_rows(relation.columns, relation.fetchall())
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    for mine, theirs in zip(got[1], expected[1]):
        assert all(same(a, b) for a, b in zip(mine, theirs)), (mine, theirs)
