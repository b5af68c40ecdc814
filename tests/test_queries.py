"""Every query beside its SQL on the smallest tables."""

from __future__ import annotations

import importlib
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from tools.compare import TABLES, rows

CORE = {n: q for m in entry_points.PLANS for n, q in importlib.import_module(f"colloquy.plans.{m}").QUERIES.items()}


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, con, data, name):
    df = CORE[name](spark, data)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert got[1]
        return
    relation = con.execute(sql)
    assert got == rows([x[0] for x in relation.description], relation.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).columns


def test_core_stands_alone():
    root = Path(entry_points.__file__).parent / "colloquy"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "colloquy.llm" not in path.read_text()
