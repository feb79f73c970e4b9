"""Data-quality checks and nested document loads on inline frames."""
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.operators import quality as Q
from meterstar.sources import nested as N


def report(df):
    return {(r.check, r.column): (r.failing_rows, r.passed) for r in df.collect()}


def test_row_level_and_keyed_checks(spark):
    df = spark.createDataFrame([(1, "Green", 0, 5), (1, "Blue", None, -1), (None, None, 6, 2), (3, "Yellow", 1, 0)],
                               "id int, svc string, pay int, amt int")
    parent = spark.createDataFrame([(1,), (3,)], "id int")
    r = report(Q.run_checks(df, [
        Q.not_null("id"), Q.unique("id"), Q.accepted_values("svc", ["Green", "Yellow"]),
        Q.accepted_values("pay", [1, 2, 3, 4, 5]), Q.non_negative("amt"), Q.positive("amt"),
        Q.expression_is_true("amt < 10"), Q.relationships("id", parent, "id"),
        Q.unique_combination(["id", "svc"]), Q.row_count(4),
    ]))
    assert r[("not_null", "id")] == (1, False)
    assert r[("unique", "id")] == (1, False)                  # id 1 twice; NULL ignored
    assert r[("accepted_values", "svc")] == (1, False)        # Blue; NULL ignored
    assert r[("accepted_values", "pay")] == (2, False)        # 0 and 6 (coalesced 0 is reported, not dropped)
    assert r[("non_negative", "amt")] == (1, False)
    assert r[("positive", "amt")] == (2, False)
    assert r[("expression_is_true", "amt < 10")] == (0, True)
    assert r[("relationships", "id")] == (0, True)            # NULL child key ignored
    assert r[("unique_combination", "id,svc")] == (0, True)
    assert r[("row_count", "*")] == (0, True)


def test_enforce_and_scalar(spark):
    df = spark.createDataFrame([(1,)], "x int")
    ok = Q.run_checks(df, [Q.scalar(Q.flag_any(df, F.lit(True)), 1, "row_count_greater_than_zero")])
    Q.enforce(ok)
    bad = Q.run_checks(df.limit(0), [Q.scalar(Q.flag_any(df.limit(0), F.lit(True)), 1, "row_count_greater_than_zero")])
    with pytest.raises(Q.QualityError):
        Q.enforce(bad)


def test_freshness_and_contract(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0),)], "ts timestamp_ntz")
    status = lambda run_at: Q.freshness(df, "ts", run_at).first().status
    assert (status("2024-01-01 12:00:00"), status("2024-01-02 06:00:00"), status("2024-01-03 06:00:00")) == \
        ("pass", "warn", "error")
    want = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("x", T.IntegerType())])
    assert Q.contract_violations(df, want) == ["missing column x"]


def test_keyed_document_and_child_table(spark):
    doc = {"ISBN:1": {"url": "u1", "authors": [{"name": "A"}, {"name": "B"}]},
           "ISBN:2": {"url": "u2", "authors": []}}
    schema = T.StructType([T.StructField("url", T.StringType()),
                           T.StructField("authors", T.ArrayType(T.StructType([T.StructField("name", T.StringType())])))])
    books = N.explode_keyed_document(spark.createDataFrame([(json.dumps(doc),)], "value string"), schema)
    assert {r.doc_key for r in books.collect()} == {"ISBN:1", "ISBN:2"}
    child = N.child_table(books, "authors", "doc_key")
    assert sorted((r.doc_key, r._list_idx, r.name) for r in child.collect()) == [("ISBN:1", 0, "A"), ("ISBN:1", 1, "B")]


def test_paged_records_stop_at_first_empty_page(spark, tmp_dir):
    pages = {1: [{"trip_id": 1}, {"trip_id": 2}], 2: [{"trip_id": 3}], 3: [], 4: [{"trip_id": 99}]}
    for p, recs in pages.items():
        d = os.path.join(tmp_dir, "pages")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"page_{p}.json"), "w") as f:
            f.write(json.dumps(recs))
    schema = T.StructType([T.StructField("trip_id", T.LongType())])
    got = N.read_paged_records(spark, os.path.join(tmp_dir, "pages"), schema)
    assert sorted(r.trip_id for r in got.collect()) == [1, 2, 3]


def test_malformed_page_or_document_fails_the_read(spark, tmp_dir):
    d = os.path.join(tmp_dir, "bad")
    os.makedirs(d)
    for p, text in {1: '[{"trip_id": 1}]', 2: "[{oops", 3: '[{"trip_id": 3}]', 4: "[]", 5: '[{"trip_id": 5}]'}.items():
        with open(os.path.join(d, f"page_{p}.json"), "w") as f:
            f.write(text)
    schema = T.StructType([T.StructField("trip_id", T.LongType())])
    with pytest.raises(Exception):
        N.read_paged_records(spark, d, schema).collect()
    skipped = N.read_paged_records(spark, d, schema, mode="PERMISSIVE")
    assert sorted(r.trip_id for r in skipped.collect()) == [1, 3]
    docs = spark.createDataFrame([('{"a": {"trip_id": 1}}',), ("{oops",)], "value string")
    with pytest.raises(Exception):
        N.explode_keyed_document(docs, schema).collect()
    assert N.explode_keyed_document(docs, schema, mode="PERMISSIVE").count() == 1


def test_replace_with_children(spark, tmp_dir):
    parent = spark.createDataFrame([("k1",)], "doc_key string")
    child = spark.createDataFrame([("k1", 0, "A")], "doc_key string, _list_idx int, name string")
    t = N.replace_with_children(spark, tmp_dir, "books", parent, {"authors": child})
    assert {n: x.read().count() for n, x in t.items()} == {"books": 1, "books__authors": 1}
    # an error in one table leaves all of them as they were
    bad = child.withColumn("name", F.raise_error(F.lit("simulated")).cast("string"))
    with pytest.raises(Exception):
        N.replace_with_children(spark, tmp_dir, "books", parent.limit(0), {"authors": bad})
    assert {n: x.read().count() for n, x in t.items()} == {"books": 1, "books__authors": 1}
    t = N.replace_with_children(spark, tmp_dir, "books", parent, {"authors": child.limit(0)})
    assert {n: x.read().count() for n, x in t.items()} == {"books": 1, "books__authors": 0}


def test_fact_table_meets_contract_and_checks_enforce(spark):
    from pyspark.sql.types import _parse_datatype_string

    from meterstar.plans import quality_checks, warehouse
    from tests.conftest import SF_SMALL
    fct = warehouse.fct_trips(spark, SF_SMALL)
    assert Q.contract_violations(fct, _parse_datatype_string(warehouse.FCT_CONTRACT)) == []
    report = quality_checks.dq_fct_trips(spark, SF_SMALL)
    Q.enforce(report)                     # every reference test passes on the driver data
    broken = fct.withColumn("service_type", F.lit("Blue"))
    with pytest.raises(Q.QualityError):
        Q.enforce(Q.run_checks(broken, [Q.accepted_values("service_type", ["Green", "Yellow"])]))
