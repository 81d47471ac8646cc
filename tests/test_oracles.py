"""Every registered query of the engine against DuckDB on the same tables."""

import duckdb
import pandas as pd
import pytest

from tributary.plans import catalog
from tributary.session import TABLES

ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype(str)
        elif pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].astype(float).round(9)
        else:
            df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, sf_dir, duck):
    got = normal(catalog.queries()[name](spark, sf_dir).toPandas())
    want = normal(duck.execute(ORACLES[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_every_query_is_registered_once():
    names = [n for m in catalog.MODULES for n in m.QUERIES]
    assert len(names) == len(set(names)) and len(names) > 90
