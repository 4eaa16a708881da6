"""Sinks (S17-S22).

* ``write_parquet``: overwrite a folder (never the folder being read).
* ``replace_table``: replace a catalog table (the warehouse "truncate" load);
  the table changes over to a written version, so a failed load changes nothing.
* ``append_day``: rerun-safe append: the table is partitioned by load
  day and the day's partition is overwritten, so a rerun replaces its own
  day (also with no rows at all) instead of adding the rows again.
* ``write_csv``: header CSV for hand-off files.
* ``merge_into_folder``: existing rows plus new rows, deduplicated on keys,
  written to a new folder version (``merge_append`` in ``incremental``).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.operators.incremental import merge_append
from reviewlake.sources.versions import commit_note, file_system, publish


#: Files that a task of ``write_named_csv`` has open at once, and the setting for it; beyond them it sorts what is left.
NAMES_AT_ONCE, OPEN_FILES = 64, "spark.sql.maxConcurrentOutputFileWriters"


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """S17."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_table(df: DataFrame, table: str, path: str | None = None) -> int:
    """Replace the contents of the catalog table ``table`` (schema taken from ``df``); the number of the version.

    The rows are written as a new version (``versions.publish``) under ``path`` (default: beside the warehouse's tables) and
    then the table is pointed at it, which is a change of the catalog only. Readers that started before go on
    with the version they read; a load that fails half-way leaves the table as it was. ``df`` may read the table.
    """
    spark = df.sparkSession
    path = path or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), f"{table.split('.')[-1].lower()}__versions")
    version = publish(df, path)
    folder = f"{path}/data/{commit_note(spark, path, version)['folder']}".replace("'", "''")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    if spark.catalog.tableExists(table):
        same = [(f.name, f.dataType) for f in spark.table(table).schema.fields] == [(f.name, f.dataType) for f in df.schema.fields]
        if same and spark.catalog.getTable(table).tableType == "EXTERNAL":
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
            return version
        spark.sql(f"DROP TABLE {table}")  # other columns: the versions' files stay
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{folder}'")
    return version


def append_day(df: DataFrame, path: str, load_date, day_col: str = "load_date") -> None:
    """Idempotent append of one load day to a day-partitioned folder.

    The day's own partition folder is overwritten, so a rerun replaces its
    day also where it has fewer rows or none.
    """
    day = str(load_date)[:10]
    df.drop(day_col).write.mode("overwrite").parquet(os.path.join(path, f"{day_col}={day}"))


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, quotes doubled inside fields, text kept byte for byte
    (no trimming of leading or trailing spaces)."""
    (df.write.mode("overwrite").option("header", "true").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


def write_named_csv(df: DataFrame, path: str, name_col: str) -> int:
    """S21 for hand-off: one CSV file per value of ``name_col``, named ``<value>.csv``; how many.

    The rows of a name are written by one task, as one file asks for, row by row as they come. Files appear one by one under their names
    after all of them are written; the names (not the rows) pass through the driver.
    """
    spark = df.sparkSession
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    rows = df.repartition(name_col).withColumn("_name", F.col(name_col)).drop(name_col)
    before = spark.conf.get(OPEN_FILES, None)
    spark.conf.set(OPEN_FILES, str(NAMES_AT_ONCE))  # a task's files are open side by side, so that it need not sort its rows by name
    try:
        (rows.write.partitionBy("_name").option("header", "true").option("escape", '"')
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(draft))
    finally:
        spark.conf.unset(OPEN_FILES) if before is None else spark.conf.set(OPEN_FILES, before)
    fs, root = file_system(spark, draft)
    names = 0
    for folder in fs.listStatus(root):
        if not folder.isDirectory():
            continue
        name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.getPath().getName().partition("=")[2])
        parts = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
        for part in parts:
            fs.rename(part, spark._jvm.org.apache.hadoop.fs.Path(path, f"{name}.csv"))
            names += 1
    fs.delete(root, True)
    return names


def merge_into_folder(spark, existing_path: str, new: DataFrame, keys: Sequence[str], out_path: str) -> DataFrame:
    """Merge ``new`` into the Parquet folder at ``existing_path`` and
    write the result to ``out_path`` (a new version; the input folder is
    never overwritten while it is read)."""
    existing = spark.read.parquet(existing_path)
    merged = merge_append(existing, new.select(*existing.columns), keys)
    merged.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)
