"""Nested JSON landing (SRC-15/16/17, SNK-14).

* ``read_paged_records``: pages of records landed as one JSON array per page file; the feed ends at
  the first empty page, so pages after it are ignored. Page numbers come from the file names;
  the first empty page is a one-row aggregate, everything else is distributed.
* ``explode_keyed_document``: a JSON object keyed by id (``{"ISBN:1": {...}, "ISBN:2": {...}}``)
  becomes one row per entry (data selector ``*``) with the entry key kept.
* ``child_table``: a nested list becomes a child table ``parent__child`` carrying the parent key
  and the list position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.operators import load


def read_paged_records(spark: SparkSession, path: str, record_schema: T.StructType,
                       page_pattern: str = r"page[_=-]?(\d+)", base_page: int = 1, mode: str = "FAILFAST") -> DataFrame:
    """All records of pages ``base_page, base_page+1, ...`` up to (not including) the first empty page.

    Page numbers stand in the file's path (``page_7.json``, ``page=7/...``). Only an empty array (or an empty file) ends the feed. A page that is no array of such records
    fails the read; ``mode="PERMISSIVE"`` skips it and goes on with the pages after it.
    """
    raw = (spark.read.option("wholetext", True).text(path)
           .select(F.regexp_extract(F.col("_metadata.file_path"), page_pattern, 1).cast("int").alias("page"), "value",
                   F.from_json("value", T.ArrayType(record_schema), {"mode": mode}).alias("records")))
    raw = raw.where(F.col("page") >= base_page)
    empty = (F.size("records") == 0) | (F.trim("value") == "")
    stop = raw.where(empty).agg(F.min("page").alias("p")).scalar()
    kept = raw.where(stop.isNull() | (F.col("page") < stop))
    return kept.select("page", F.inline("records"))


def explode_keyed_document(docs: DataFrame, entry_schema: T.DataType, value_col: str = "value",
                           key_name: str = "doc_key", mode: str = "FAILFAST") -> DataFrame:
    """SRC-16: ``{key: entry, ...}`` JSON text -> one row per entry with its key.

    A document that does not parse fails the read; ``mode="PERMISSIVE"`` drops it.
    """
    m = F.from_json(F.col(value_col), T.MapType(T.StringType(), entry_schema), {"mode": mode})
    return docs.select(F.explode(m).alias(key_name, "entry")).select(key_name, "entry.*")


def child_table(parent: DataFrame, list_col: str, parent_key: str | Sequence[str]) -> DataFrame:
    """SRC-17: ``parent.list_col`` (array of struct) -> child rows with the parent key and the
    list position ``_list_idx``. An empty or NULL list yields no child rows."""
    keys = [parent_key] if isinstance(parent_key, str) else list(parent_key)
    return (parent.select(*keys, F.posexplode(list_col).alias("_list_idx", "_item"))
            .select(*keys, "_list_idx", "_item.*"))


def replace_with_children(spark: SparkSession, root: str, name: str, parent: DataFrame, children: dict[str, DataFrame],
                          catalog: bool = False) -> dict[str, load.TableFolder]:
    """SNK-14: replace-load a parent and its child tables (``name__child``), so no child keeps rows of
    an earlier load.

    All new versions are written beside the tables before the first one is switched in: an error in any of
    them leaves all as they were. With ``catalog`` the tables have names in the session catalog and a switch is
    one ``ALTER TABLE`` each; else they are folders under ``root`` and a switch is a rename.
    """
    contents = {name: parent, **{f"{name}__{child}": df for child, df in children.items()}}
    tables = {n: load.CatalogTable(spark, n, root) if catalog else load.TableFolder(spark, f"{root}/{n}") for n in contents}
    ready = {n: tables[n].prepare(df) for n, df in contents.items()}
    for n, version in ready.items():
        tables[n].switch(version)
    return tables
