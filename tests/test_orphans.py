"""Every query equals its SQL on tables in which orders, customers, suppliers and zones are missing."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from meterstar.plans import registry
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

registry.load_all()
# keep nine of ten keys of each referenced table
KEEP = {"orders": "o_orderkey % 10 <> 3", "customer": "c_custkey % 10 <> 4", "supplier": "s_suppkey % 5 <> 2", "nation": "n_nationkey <> 7"}


@pytest.fixture(scope="module")
def orphaned(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("orphans"))
    con = duckdb.connect()
    for t in TABLES:
        source = f"read_parquet('{SF_SMALL}/{t}.parquet')"
        con.execute(f"COPY (SELECT * FROM {source} WHERE {KEEP.get(t, 'true')}) TO '{os.path.join(path, t)}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(path, t)}.parquet')")
    return path, con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql_with_orphans(spark, orphaned, name):
    path, con = orphaned
    df = E.queries()[name](spark, path)
    rel = con.sql(E.oracle_sql()[name])
    rows, want = [tuple(r) for r in df.collect()], rel.fetchall()
    assert len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(rel.columns, want)[0]
