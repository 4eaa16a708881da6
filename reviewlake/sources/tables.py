"""Catalog and folder tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from reviewlake.operators.incremental import date_bound


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None, since=None,
               until=None, date_col: str = "date") -> DataFrame:
    """S12 (whole table) or S11 (column list and day bound).

    ``name`` is a catalog table or a Parquet folder path. The column list
    and the bound reach the scan as pruning and pushed filters.
    """
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    if since is not None:
        return date_bound(df, list(columns or df.columns), since, until, date_col)
    return df.select(*columns) if columns else df
