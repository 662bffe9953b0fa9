"""The driver contract: the smoke entry and every registered job against
its SQL check on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from ripplekit import jobs
from ripplekit.sources.tables import TABLES
from tools.oracle_compare import rows_of


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["usr", "n"]
    assert df.count() > 0


def test_every_job_has_a_check():
    assert set(jobs.JOBS) <= set(entry.queries()) and set(jobs.JOBS) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(jobs.JOBS))
def test_job_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    srows = [r.asDict() for r in df.collect()]
    drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert rows_of(srows, cols) == rows_of(drows, cols)
