"""Every registered query against its DuckDB oracle (the driver's gate)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from relayline.plans.catalog import QUERIES  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

SF = os.environ.get("RELAYLINE_ORACLE_SF", "/root/testdata/sf0.001")
NAMES = sorted(QUERIES)
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield c
    c.close()


def test_every_query_has_oracle_or_is_rows_only():
    assert set(NAMES) <= set(SQL) and set(NAMES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["plataforma", "qualidade_match", "qtd"] and 1 <= len(rows) <= 9


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    table = rel.to_arrow_table()
    spark_types = {f.name: str(f.type) for f in df.toArrow().schema}
    duck_types = {f.name: str(f.type) for f in table.schema}
    assert spark_types == duck_types
    d_cols = table.column_names
    a, ac = rows_of(df.columns, s_rows)
    b, bc = rows_of(d_cols, [tuple(r.values()) for r in table.to_pylist()])
    assert ac == bc
    assert len(a) == len(b)
    assert a == b
