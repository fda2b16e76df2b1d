"""Every query against its SQL on the test tables, at two scales."""

from pathlib import Path

import duckdb
import pytest

from clickpulse.registry.oracles import ORACLES
from clickpulse.registry.queries import QUERIES

TABLES = "events customer nation region part".split()

# How DuckDB names the types of the results.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}


def database(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, name):
    check(spark, sf_dir, name)


@pytest.mark.parametrize("name", [name for name in QUERIES if "stream" not in name])
def test_query_equals_sql_small(spark, sf_dir, name):
    check(spark, str(Path(sf_dir).parent / "sf0.001"), name)


def check(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    relation = database(sf_dir).sql(ORACLES[name])
    columns = sorted(result.columns)
    assert columns == sorted(relation.columns)
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in result.dtypes} == types
    actual = sorted((tuple(r) for r in result.select(*columns).collect()), key=repr)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(relation.project(quoted).fetchall(), key=repr)
    assert actual == expected
