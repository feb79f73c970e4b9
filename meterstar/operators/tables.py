"""Parquet tables that loads extend and replace: plain folders, and named tables of the session catalog.

Both write with Spark's own writers and switch a whole new version in by one step at the end: a
folder by renames, a named table by ``ALTER TABLE ... SET LOCATION``. A write that fails before that
leaves the table as it was.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.session import delete_path, drop_materialized, materialized

PART = "_part"
MOST_FOLDERS = 1000   # folder names that a plan lists as a static filter; above it they are joined


class TableFolder:
    """A Parquet table in a folder. One writer at a time, any number of readers.

    ``partition_by`` names a column whose text form is the partition folder (``_part=<text>``; NULL
    and '' share Spark's default folder). The column itself stays in the files, so its type and
    value come back as they were. ``read`` hides the folder column.

    The table's schema lies beside its files (``_schema``), so that no read merges footers; a folder
    without one (written by others) is read by merging them.

    A failed write raises and changes nothing that was committed: appends and dynamic overwrites are
    committed by Spark at the end of the job. A replacement is written beside the table and then takes
    its place by two renames; a break between them leaves the old version, which readers find and the
    next writer puts back. No error is ever read as "no table".
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: str | None = None):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), partition_by

    # --- where it lies

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _there(self, path: str) -> bool:
        return self._fs().exists(self._hadoop(path))

    def _rename(self, a: str, b: str) -> None:
        if not self._fs().rename(self._hadoop(a), self._hadoop(b)):
            raise OSError(f"could not rename {a} to {b}")

    @property
    def _next(self) -> str:
        return f"{self.path}.__next"

    @property
    def _old(self) -> str:
        return f"{self.path}.__old"

    def location(self) -> str | None:
        """The folder that holds the current version; None before the first load."""
        return next((p for p in (self.path, self._old) if self._there(p)), None)

    def exists(self) -> bool:
        return self.location() is not None

    def _mend(self) -> None:
        """Writers first undo a switch that broke off."""
        if not self._there(self.path) and self._there(self._old):
            self._rename(self._old, self.path)

    # --- its columns

    def _kept_schema(self, folder: str) -> T.StructType | None:
        file = f"{folder}/_schema"
        if not self._there(file):
            return None
        stream = self._fs().open(self._hadoop(file))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return T.StructType.fromJson(json.loads(text))

    def _keep_schema(self, folder: str, schema: T.StructType) -> None:
        stream = self._fs().create(self._hadoop(f"{folder}/_schema"), True)
        try:
            stream.write(bytearray(schema.json().encode()))
        finally:
            stream.close()

    def schema(self) -> T.StructType:
        """Columns of the files (without the folder column)."""
        folder = self.location()
        kept = self._kept_schema(folder)
        if kept is None:
            found = self.spark.read.option("mergeSchema", True).parquet(folder).schema
            kept = T.StructType([f for f in found.fields if f.name != PART])
        return kept

    def _wider(self, new: T.StructType) -> T.StructType:
        """The table's columns and those that ``new`` adds; a column never changes its type."""
        known = {f.name: f.dataType.simpleString() for f in self.schema().fields}
        for f in new.fields:
            if f.name in known and known[f.name] != f.dataType.simpleString():
                raise ValueError(f"column {f.name} is {known[f.name]} in the table, {f.dataType.simpleString()} in the load")
        return T.StructType(self.schema().fields + [f for f in new.fields if f.name not in known])

    # --- reading

    def scan(self) -> DataFrame:
        """The table with its folder column ``_part`` (text: '01' is not 1), if it is partitioned."""
        fields = self.schema().fields + ([T.StructField(PART, T.StringType())] if self.partition_by else [])
        return self.spark.read.schema(T.StructType(fields)).parquet(self.location())

    def read(self) -> DataFrame | None:
        """The table, or None before its first load."""
        return self.scan().drop(PART) if self.exists() else None

    def folder_of(self, column: Column) -> Column:
        text = column.cast("string")
        return F.when(text != "", text)

    def touched(self, parts: DataFrame | Sequence[str | None]) -> DataFrame:
        """Rows of the table in the folders ``parts``, the NULL folder included.

        Names in a list become a static filter, so only those folders are listed and read; a frame (one
        column ``_part``, for more names than a plan should carry) is joined.
        """
        rows = self.scan()
        if not isinstance(parts, DataFrame):
            return rows.where(self.among(parts)).drop(PART)
        some = parts.where(F.col(PART).isNotNull()).distinct()
        null_part = parts.where(F.col(PART).isNull()).limit(1).select(F.lit(1).alias("_one"))
        null_rows = rows.where(F.col(PART).isNull()).withColumn("_one", F.lit(1)).join(null_part, "_one", "left_semi").drop("_one")
        return rows.join(some, PART, "left_semi").unionByName(null_rows).drop(PART)

    @staticmethod
    def among(names: Sequence[str | None]) -> Column:
        named = [n for n in names if n is not None]
        hit = F.col(PART).isin(named) if named else F.lit(False)
        return hit | F.col(PART).isNull() if None in names else hit

    @staticmethod
    def names(parts: DataFrame) -> list[str | None] | None:
        """Distinct folder names of ``parts`` if a plan can list them, else None."""
        found = parts.select(PART).distinct().limit(MOST_FOLDERS + 1).collect()
        return [r[PART] for r in found] if len(found) <= MOST_FOLDERS else None

    def newest(self) -> DataFrame:
        """Rows of the last folder by name: where folders are named by a period of a time column, the ones with
        its maximum. Folders are listed, not read; a table without a named folder is returned whole."""
        folder, cut = self.location(), len(PART) + 1
        decode = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        found = [f.getPath().getName() for f in self._fs().listStatus(self._hadoop(folder)) if f.isDirectory()]
        named = [decode(n[cut:]) for n in found if n.startswith(f"{PART}=") and "__HIVE_DEFAULT_PARTITION__" not in n]
        return self.scan().where(F.col(PART) == max(named)).drop(PART) if named else self.read()

    # --- writing

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, self.folder_of(F.col(self.partition_by))) if self.partition_by else df

    def _writer(self, df: DataFrame, mode: str, dynamic: bool = False):
        if not self.partition_by:
            return df.write.mode(mode)
        # rows of one folder may spread over tasks (hash of the row), so a hot folder is no hot task
        salt = F.xxhash64(*[F.col(c) for c in df.columns])
        placed = self._placed(df).repartitionByRange(F.col(PART), salt).sortWithinPartitions(PART)
        return placed.write.mode(mode).partitionBy(PART).option("partitionOverwriteMode", "dynamic" if dynamic else "static")

    def append(self, df: DataFrame) -> None:
        if not self.exists():
            self.replace(df)
            return
        self._mend()
        wider = self._wider(df.schema)
        if wider != self.schema():
            self._keep_schema(self.path, wider)   # older files give NULL, also if the write fails
        self._writer(df, "append").parquet(self.path)

    def prepare(self, df: DataFrame) -> str:
        """Write a whole new version beside the table; ``df`` may read the table itself."""
        self._mend()
        delete_path(self.spark, self._next)
        self._writer(df, "error").parquet(self._next)
        self._keep_schema(self._next, df.schema)
        return self._next

    def switch(self, ready: str) -> None:
        """Make a prepared version the table."""
        delete_path(self.spark, self._old)
        if self._there(self.path):
            self._rename(self.path, self._old)
        self._rename(ready, self.path)
        delete_path(self.spark, self._old)

    def replace(self, df: DataFrame) -> None:
        self.switch(self.prepare(df))

    def replace_folders(self, df: DataFrame, parts: DataFrame | Sequence[str | None]) -> None:
        """New contents for the folders in ``parts``; all other folders stay as they are.

        Spark commits the written folders together. Those of ``parts`` that have no rows any more are
        deleted after that; a break in between is mended by repeating the load.
        """
        self._mend()
        done = materialized(df, "folders")
        if self._wider(df.schema) != self.schema():
            self._keep_schema(self.location(), self._wider(df.schema))
        self._writer(done, "overwrite", dynamic=True).parquet(self.location())
        now = self._placed(done).select(PART).distinct()
        if isinstance(parts, DataFrame):
            gone = [r[PART] for r in parts.distinct().join(now, parts[PART].eqNullSafe(now[PART]), "left_anti").toLocalIterator()]
        else:
            gone = set(parts) - {r[PART] for r in now.collect()}
        names = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        for name in gone:
            delete_path(self.spark, f"{self.location()}/{names.getPartitionPathString(PART, name)}")
        drop_materialized(done)


class CatalogTable(TableFolder):
    """A Parquet table under a name of the session catalog, its versions in folders under ``root``.

    The first load is a ``saveAsTable`` with a location. A replacement is written to a fresh folder and one
    ``ALTER TABLE ... SET LOCATION`` switches to it, on any file system. New columns are added before
    that; a version with dropped or retyped columns is registered anew. The version before the
    current one is kept for readers that began on it, older ones are deleted.

    Partition folders are found by listing the location (not kept one by one in the catalog), so the
    switch takes all of them along.
    """

    def __init__(self, spark: SparkSession, name: str, root: str, partition_by: str | None = None):
        super().__init__(spark, os.path.join(root, name), partition_by)
        self.name = name

    def _run(self, command: str) -> DataFrame:
        return self.spark.sql(command)

    def location(self) -> str | None:
        if not self.spark.catalog.tableExists(self.name):
            return None
        found = self._run(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Location'").first()
        return found["data_type"]

    def schema(self) -> T.StructType:
        return T.StructType([f for f in self.spark.table(self.name).schema.fields if f.name != PART])

    def scan(self) -> DataFrame:
        return self.spark.table(self.name)

    def _mend(self) -> None:
        """A switch is one catalog step: nothing can be half done."""

    def _keep_schema(self, folder: str, schema: T.StructType) -> None:
        known = set(self.schema().names)
        new = [f for f in schema.fields if f.name not in known]
        if new:
            self._run(f"ALTER TABLE {self.name} ADD COLUMNS ({_ddl(new)})")

    def prepare(self, df: DataFrame) -> str:
        fresh = f"{self.path}/{uuid.uuid4().hex}"
        if self.exists():
            self._writer(df, "error").parquet(fresh)
            self._coming = df.schema
        else:
            self._untracked(lambda: self._writer(df, "error").format("parquet").option("path", fresh).saveAsTable(self.name))
        return fresh

    def _untracked(self, create) -> None:
        key = "spark.sql.hive.manageFilesourcePartitions"
        before = self.spark.conf.get(key, "true")
        self.spark.conf.set(key, "false")
        try:
            create()
        finally:
            self.spark.conf.set(key, before)

    def switch(self, ready: str) -> None:
        before = self.location()
        if self._hadoop(before).getName() == self._hadoop(ready).getName():
            return  # the first load, registered by its own write
        now, coming = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (self.schema(), self._coming))
        if all(coming.get(c) == t for c, t in now.items()):
            self._keep_schema(ready, self._coming)
            self._run(f"ALTER TABLE {self.name} SET LOCATION '{ready}'")
        else:
            by = f" PARTITIONED BY ({PART})" if self.partition_by else ""
            part = [T.StructField(PART, T.StringType())] if self.partition_by else []
            self._run(f"DROP TABLE {self.name}")
            self._untracked(lambda: self._run(
                f"CREATE TABLE {self.name} ({_ddl([*self._coming.fields, *part])}) USING parquet{by} LOCATION '{ready}'"))
        self.spark.catalog.refreshTable(self.name)
        kept = {self._hadoop(before).getName(), self._hadoop(ready).getName()}
        for f in self._fs().listStatus(self._hadoop(self.path)):
            if f.getPath().getName() not in kept:
                delete_path(self.spark, f.getPath().toString())

    def append(self, df: DataFrame) -> None:
        if not self.exists():
            self.replace(df)
            return
        self._keep_schema("", self._wider(df.schema))
        self._writer(df, "append").parquet(self.location())
        self.spark.catalog.refreshTable(self.name)

    def replace_folders(self, df: DataFrame, parts: DataFrame | Sequence[str | None]) -> None:
        super().replace_folders(df, parts)
        self.spark.catalog.refreshTable(self.name)


def _ddl(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
