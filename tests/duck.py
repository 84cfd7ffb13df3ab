"""DuckDB side of the comparison."""

import glob
import os

import duckdb

DUCK_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return connection


def assert_equal(df, connection, sql):
    """Same column names, types and rows, to the last bit."""
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert {n: DUCK_TYPE[t] for n, t in df.dtypes} == types
    names = sorted(types)
    places = [columns.index(n) for n in names]
    expected = sorted(repr(tuple(row[i] for i in places)) for row in result.fetchall())
    assert sorted(repr(tuple(row[n] for n in names)) for row in df.collect()) == expected
    assert expected
