"""Every registered query against its SQL, over whole tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from cartwheel.plans.queries import BATCH
from cartwheel.plans.stream_queries import STREAM
from tests.conftest import DATA

SF = DATA / "sf0.001"
TABLES = [p.stem for p in SF.glob("*.parquet")]
QUERIES, ORACLE = {n: q for n, q in contract.queries().items() if n in {**BATCH, **STREAM}}, contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        column = df[name]
        if pd.api.types.is_bool_dtype(column):
            df[name] = column.astype(str)
        elif pd.api.types.is_numeric_dtype(column):
            df[name] = column.astype(float).map(lambda x: "" if x != x else repr(round(x, 6) + 0.0))
        elif pd.api.types.is_datetime64_any_dtype(column):
            df[name] = column.astype("datetime64[us]").astype(str)
        else:
            df[name] = column.map(lambda x: "" if x is None or x != x else str(x))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE)
    assert set(ORACLE) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    ours = QUERIES[name](spark, str(SF)).toPandas()
    theirs = db.execute(ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    pd.testing.assert_frame_equal(comparable(ours), comparable(theirs))


def test_entry(spark):
    assert contract.entry(spark).columns == ["name", "emit_ts", "ttl_seconds", "number", "words"]
