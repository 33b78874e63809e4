"""The driver contract: every registered query runs, and matches its DuckDB
oracle (row set, column names and Arrow types) on the small test data."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from quarry.plans import registry
from quarry.tables import TABLES, table_path

def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracles())
    assert set(registry.queries()) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "active_1996" in df.columns


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return str(v) if hasattr(v, "isoformat") else v


def _table_rows(tbl):
    names = sorted(tbl.column_names)
    return sorted((tuple(_norm(r[n]) for n in names) for r in tbl.to_pylist()), key=repr)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, sf_dir, con, name):
    got = registry.queries()[name](spark, sf_dir).toArrow()
    want = con.sql(registry.oracles()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    assert _table_rows(got) == _table_rows(want)
