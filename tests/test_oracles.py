"""Every registered query against its SQL oracle, values and types."""

import datetime
import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from workload.oracles import ORACLES
from workload.registry import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def tidy(value):
    assert not isinstance(value, (Decimal, datetime.date)), "give money as double, dates as text"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(tidy(row[i]) for i in order) for row in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(columns)
    want = rows(columns, expected.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert want, "an oracle without rows tests nothing"
    assert got == want


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


FOUND_IN_FAULTY = [name for name in sorted(ORACLES) if name.endswith("_faulty")]


@pytest.mark.parametrize("name", FOUND_IN_FAULTY)
def test_every_faulty_check_finds_something(duck, name):
    """Each row of each check over the faulty tables is red."""
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    rows = [dict(zip(columns, r)) for r in result.fetchall()]
    assert rows
    for row in rows:
        if "passou" in row:
            assert row["passou"] is False, row
            assert row["valor"] != "0" or row["esperado"] != "0", row
        elif "violacoes" in row:
            assert row["violacoes"] > 0, row
        else:
            assert row["total"] == 9 and row["falhas"].count(",") == 8, row
