"""Daily increments.

The crawlers keep per-film high-water marks and merge new rows into
existing files; here both are joins and aggregates over tables, so a
rerun of the same day gives the same table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.dates import parse_review_date
from reviewlake.operators.skew import keep_first, key_digest


def latest_per_movie(stored: DataFrame, date_col: str = "date") -> DataFrame:
    """Latest review day per film; unparseable days are ignored
    (a film with none gets null)."""
    d = F.col(date_col)
    day = d if dict(stored.dtypes)[date_col] == "date" else parse_review_date(d)
    return stored.groupBy("movieNm").agg(F.max(day).alias("latest_date"))


def new_since_latest(new: DataFrame, latest: DataFrame, date_col: str = "date") -> DataFrame:
    """J3 + F15: new rows strictly after their film's latest stored day.

    Films never seen and rows whose day cannot be read are kept. The
    latest table has one row per film; the planner broadcasts it when its
    measured size allows.
    """
    d = F.col(date_col)
    day = d if dict(new.dtypes)[date_col] == "date" else parse_review_date(d)
    joined = new.withColumn("_day", day).join(latest, "movieNm", "left")
    keep = F.col("latest_date").isNull() | F.col("_day").isNull() | (F.col("_day") > F.col("latest_date"))
    return joined.where(keep).select(*new.columns)


def merge_append(existing: DataFrame, new: DataFrame, keys: Sequence[str], texts: Sequence[str] = ("context",)) -> DataFrame:
    """Existing rows plus new rows, one row per ``keys``; an existing
    row wins over a new one (the reference's ``drop_duplicates`` keeps the
    first, and existing rows come first). Long key columns (``texts``) are
    grouped by their digest. This rewrites the history; a table that grows
    is better kept by ``sources.keyindex.merge_into``."""
    both = existing.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)))
    return keep_first(both, keys, order=["_src"], digest=[k for k in keys if k in texts]).drop("_src")


def append_new(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """S22, append form: only the new rows whose keys are not stored yet
    (null keys compare equal, as in the merge). Keys meet by their digest,
    so neither side moves its texts to find out."""
    stored = existing.select(key_digest(keys).alias("_key")).distinct()  # hot keys collapse map-side
    return new.withColumn("_key", key_digest(keys)).join(stored, "_key", "left_anti").drop("_key")


def date_bound(df: DataFrame, columns: Sequence[str], lo: _dt.date | str,
               hi: _dt.date | str | None = None, date_col: str = "date") -> DataFrame:
    """S11 + F6: column list and day bound, ``lo <= day (< hi)``.

    Written as plain column predicates so the Parquet scan receives them as
    pushed filters and reads only the listed columns.
    """
    t = dict(df.dtypes)[date_col]  # bound in the column's own type: stays pushable
    cond = F.col(date_col) >= F.lit(str(lo)).cast(t)
    if hi is not None:
        cond = cond & (F.col(date_col) < F.lit(str(hi)).cast(t))
    return df.where(cond).select(*columns)
