"""Every registered query of the library against its SQL on the smallest tables (the text subpackage has its own
tests)."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from tidemark.plans import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(
        shown,
        key=lambda r: [
            (x is None, round(x, 3) if isinstance(x, float) else x, "")
            if not isinstance(x, (str, bool))
            else (x is None, 0, str(x))
            for x in r
        ],
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, df.collect())
    if name not in ORACLE_SQL:
        assert df.columns
        return
    answer = duck.sql(ORACLE_SQL[name])
    assert sorted(answer.columns) == sorted(df.columns)
    want = rows(answer.columns, answer.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            assert x == y or (
                isinstance(x, (int, float))
                and isinstance(y, (int, float))
                and math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-6)
            ), (a, b)


def test_entry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
