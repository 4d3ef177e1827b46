"""Every registered query against its DuckDB oracle at sf0.001; rows-only queries run."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import DUCK_TO_SPARK, TABLES, rows_of

SQL = E.oracle_sql()
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(cols) > 0
        return
    rel = con.sql(SQL[name])
    assert sorted(cols) == sorted(rel.columns)
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert stypes == {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    drows = rel.fetchall()
    assert len(rows) == len(drows)
    assert rows_of(cols, rows) == rows_of(rel.columns, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["opinion_id", "cluster_id", "case_name", "court", "year", "opinion_type",
                          "chunk_index", "text", "citation"]
    assert df.count() > 0
