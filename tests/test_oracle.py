"""Every registered query against its DuckDB oracle (the driver's gate),
on the smallest driver tables."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from quillstream.plans.catalog import ORACLES as BASE_ORACLES
from quillstream.plans.catalog import QUERIES as BASE_QUERIES
from quillstream.sources.tables import DRIVER_TABLES
from tests.conftest import SMALL

# Spark simple type -> DuckDB type name
TYPE_MAP = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "array<string>": "VARCHAR[]",
}

E.queries()
QUERIES = dict(BASE_QUERIES)
ORACLES = dict(BASE_ORACLES)


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLES[name])
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: TYPE_MAP.get(t, t) for c, t in stypes.items()} == otypes
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "id" in df.columns
