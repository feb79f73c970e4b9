"""Nested document loads (Q-DLT-top, SRC-16/17).

Binding: every order is published as one keyed book document
``{"ORDER:<o_orderkey>": {"url": "/orders/<o_orderkey>", "title": <o_orderpriority>,
"authors": [{"name": "Customer#<o_custkey>"}, {"name": <o_orderpriority>}]}}`` -- built per row,
no grouping. The load explodes the keyed object into book rows and the author list into the
``books__authors`` child table; the report counts books per author (top 10).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.operators import dedup
from meterstar.plans.registry import query
from meterstar.session import scratch_path
from meterstar.sources import catalog as C
from meterstar.sources import driver_tables as D
from meterstar.sources import nested as N

BOOK_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("authors", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
])
TOP = 10


def book_documents(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    o = D.table(spark, sf_dir, "orders")
    o = o if where is None else o.where(where)
    key = F.concat(F.lit("ORDER:"), F.col("o_orderkey").cast("string"))
    entry = F.struct(
        F.concat(F.lit("/orders/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.col("o_orderpriority").alias("title"),
        F.array(F.struct(F.concat(F.lit("Customer#"), F.col("o_custkey").cast("string")).alias("name")),
                F.struct(F.col("o_orderpriority").alias("name"))).alias("authors"))
    return o.select(F.to_json(F.create_map(key, entry)).alias("value"))


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.explode_keyed_document(book_documents(spark, sf_dir), BOOK_SCHEMA)


def books_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.child_table(books(spark, sf_dir), "authors", "doc_key")


def top_authors(authors: DataFrame, n: int = TOP) -> DataFrame:
    counts = authors.groupBy(F.col("name").alias("author")).agg(F.count(F.lit(1)).alias("book_count"))
    return dedup.top_n(counts, [F.col("book_count").desc(), F.col("author").asc()], n)


_AUTHORS_SQL = """WITH books__authors AS (
  SELECT 'ORDER:' || CAST(o_orderkey AS VARCHAR) AS doc_key, CAST(0 AS INTEGER) AS _list_idx,
         'Customer#' || CAST(o_custkey AS VARCHAR) AS name FROM orders
  UNION ALL
  SELECT 'ORDER:' || CAST(o_orderkey AS VARCHAR), CAST(1 AS INTEGER), o_orderpriority FROM orders)
"""


@query("dlt_books_authors_child", covers="SRC-16 SRC-17 FN-19", sql=_AUTHORS_SQL + "SELECT * FROM books__authors")
def dlt_books_authors_child(spark, sf_dir):
    return books_authors(spark, sf_dir)


@query("dlt_top_authors", covers="Q-DLT-top AG-9 SRT-4", sql=_AUTHORS_SQL + f"""
SELECT name AS author, count(*) AS book_count FROM books__authors
GROUP BY name ORDER BY book_count DESC, author ASC LIMIT {TOP}""")
def dlt_top_authors(spark, sf_dir):
    return top_authors(books_authors(spark, sf_dir))


@query("dlt_books_replaced_with_children", covers="SNK-14 SNK-2 SRC-18", sql="""
SELECT 'ORDER:' || CAST(o_orderkey AS VARCHAR) AS doc_key, o_orderpriority AS title, CAST(0 AS INTEGER) AS _list_idx,
       'Customer#' || CAST(o_custkey AS VARCHAR) AS name FROM orders WHERE o_orderstatus <> 'F'
UNION ALL
SELECT 'ORDER:' || CAST(o_orderkey AS VARCHAR), o_orderpriority, CAST(1 AS INTEGER), o_orderpriority
FROM orders WHERE o_orderstatus <> 'F'""")
def dlt_books_replaced_with_children(spark, sf_dir):
    """All books are loaded, then a later load without finished orders replaces parent and child tables; both are
    read by name, and no child row of the first load is left."""
    import uuid

    name = f"books_{uuid.uuid4().hex[:12]}"
    later = book_documents(spark, sf_dir, F.col("o_orderstatus") != "F")
    for docs in (book_documents(spark, sf_dir), later):
        loaded = N.explode_keyed_document(docs, BOOK_SCHEMA)
        N.replace_with_children(spark, scratch_path(spark, "catalog"), name, loaded.drop("authors"),
                                {"authors": N.child_table(loaded, "authors", "doc_key")}, catalog=True)
    parent = C.named(spark, name).select("doc_key", "title")
    return C.named(spark, f"{name}__authors").join(parent, "doc_key", "left").select("doc_key", "title", "_list_idx", "name")
