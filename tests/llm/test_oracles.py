"""Queries with SQL against DuckDB; the rest of the contract columns on the smallest tables."""

import duckdb
import pytest

from meterstar.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(Q.ORACLE[name])
    cols = [c[0] for c in want.description]
    df = Q.QUERIES[name](spark, SF)
    assert sorted(cols) == sorted(df.columns)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, df.select(*cols).collect()), key=key) == sorted(want.fetchall(), key=key)


@pytest.mark.parametrize("name, columns", [
    ("op1_toxicity", "doc_id held_out score predicted"), ("op3_ngram_join", "doc_id n_shingles component_id"),
    ("op4_quality", "doc_id held_out score predicted"), ("op6_mix_sources", "doc_id size source_size target taken"),
    ("op7_nearest", "query_id rank vec_id score"), ("op10_url_filter", "page_id host path rule verdict"),
    ("op11_merkle_manifest", "doc_id leaf subroot root proof_sha256 folded_root verified"),
    ("op12_prefix_trie", "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"),
    ("op13_exact_dedup", "doc_id keep_id group_size kept text_sha256")])
def test_contract_columns_first(spark, name, columns):
    df = Q.QUERIES[name](spark, SF)
    assert df.columns[: len(columns.split())] == columns.split() and df.count() > 0


def test_all_are_registered():
    assert [n.split("_")[0] for n in Q.QUERIES] == [f"op{i}" for i in range(1, 14)]
