"""The registered queries against their SQL, and which there are."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from flightloom.llm import workload

SQL = workload.sql()
KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "array<double>": "DOUBLE[]",
}


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield con
    con.close()


def normal(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, sf_dir, db):
    found = workload.registry()[name](spark, sf_dir)
    expected = db.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    right = table(columns, expected.fetchall())
    described = {r[0]: r[1] for r in db.execute("DESCRIBE " + SQL[name]).fetchall()}
    assert {f.name: KINDS[f.dataType.simpleString()] for f in found.schema.fields} == described
    left = table(found.columns, found.collect())
    assert len(left) == len(right) > 0
    different = [(a, b) for a, b in zip(left, right) if a != b]
    assert not different, different[:3]


def test_one_query_per_operator():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in contract.queries() and "pipeline" not in contract.oracle_sql()
