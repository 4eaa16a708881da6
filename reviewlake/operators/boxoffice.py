"""Box-office operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.functions.casts import BOXOFFICE_TYPES, REGION_TYPES, cast_declared
from reviewlake.functions.text import strip_ws
from reviewlake.operators.skew import share_of_group, top_n

GENRE_COLUMNS = ["boxoffice_date", "movieNm", "genre", "salesAmt", "audiCnt", "openDt"]


def cast_boxoffice(df: DataFrame) -> DataFrame:
    """Daily chart columns to their declared types; absent columns skipped."""
    return cast_declared(df, BOXOFFICE_TYPES)


def cast_region_boxoffice(df: DataFrame) -> DataFrame:
    """Regional chart columns to their declared types."""
    return cast_declared(df, REGION_TYPES)


def genre_explode(df: DataFrame) -> DataFrame:
    """``analysis_genre``: one row per chart row and genre.

    Null genre lists are dropped first (F8) and blank genres after the
    split (SURVEY D23).
    """
    rows = df.where(F.col("genreNm").isNotNull()).select(
        *[c for c in GENRE_COLUMNS if c != "genre"],
        F.explode(F.split(F.col("genreNm").cast("string"), ",")).alias("genre"),
    )
    return rows.withColumn("genre", strip_ws("genre")).where(F.length("genre") > 0).select(*GENRE_COLUMNS)


def movie_list(charts: Iterable[DataFrame]) -> DataFrame:
    """A18 + U-3: distinct (movieNm, openDt), trimmed, over the charts that
    carry both columns (SURVEY D19)."""
    parts = [
        c.select(strip_ws(F.col("movieNm").cast("string")).alias("movieNm"),
                 strip_ws(F.col("openDt").cast("string")).alias("openDt"))
        for c in charts if {"movieNm", "openDt"} <= set(c.columns)
    ]
    return reduce(lambda a, b: a.union(b), parts).distinct()


def fill_open_dates(charts: DataFrame, daily: DataFrame) -> DataFrame:
    """``charts`` (with movieNm and boxoffice_date) with the ``openDt`` of the film's last daily chart at or before the row's day.

    An as-of join as one sorted pass: both sides are reduced to one row per film and day, so a film with a third of all
    rows is a few thousand days; the opening day is carried forward over them and joined back. Charts that give
    several opening days on one day count with the earliest; no daily chart so far, or no film, gives null.
    """
    known = daily.where(F.col("openDt").isNotNull() & F.col("movieNm").isNotNull()).groupBy("movieNm", "boxoffice_date").agg(F.min("openDt").alias("openDt"))
    asked = charts.where("movieNm is not null and boxoffice_date is not null").select("movieNm", "boxoffice_date").distinct()
    days = known.withColumn("_ask", F.lit(0)).unionByName(asked.withColumn("openDt", F.lit(None).cast(known.schema["openDt"].dataType)).withColumn("_ask", F.lit(1)))
    so_far = Window.partitionBy("movieNm").orderBy("boxoffice_date", "_ask").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = days.withColumn("openDt", F.last("openDt", ignorenulls=True).over(so_far)).where("_ask = 1").drop("_ask")
    return charts.drop("openDt").join(filled, ["movieNm", "boxoffice_date"], "left").select(*[c for c in charts.columns if c != "openDt"], "openDt")


def movies_to_collect(candidates: DataFrame, charts: DataFrame, key: str = "movieNm") -> DataFrame:
    """Candidates whose title appears in the charts (semi join).

    The chart side is reduced to distinct titles first: the partial
    aggregate collapses a title that holds a third of the chart rows before
    the shuffle, and its output partitioning is the join's, so no extra
    exchange is added.
    """
    return candidates.join(charts.select(key).distinct(), key, "left_semi")


def region_attach(rows: DataFrame, region_codes: DataFrame) -> DataFrame:
    """Stamp region name on chart rows by region code (inner equi-join).

    The code table is a short dimension; the planner broadcasts it when its
    measured size allows and shuffles otherwise.
    """
    codes = region_codes.select(F.col("fullCd").alias("region_code"), F.col("korNm").alias("region_name"))
    return rows.join(codes, "region_code", "inner")


def monthly_sales(df: DataFrame) -> DataFrame:
    """B1: sales and audience per month."""
    return (
        df.groupBy(F.trunc("boxoffice_date", "month").alias("month"))
        .agg(F.sum("salesAmt").alias("sales"), F.sum("audiCnt").alias("audience"))
        .orderBy("month")
    )


def yoy_sales(monthly: DataFrame) -> DataFrame:
    """B2: sales against the same month a year earlier.

    Each month's total is emitted for its own month and as "a year earlier"
    for the month twelve later, and one small aggregate by month puts the
    two side by side: the charts are read once, there is no join, and gaps
    in the calendar give null instead of a wrong neighbour.
    """
    both = F.inline(F.array(
        F.struct(F.col("month"), F.col("sales").alias("own"), F.lit(None).cast("bigint").alias("prev"), F.lit(True).alias("_is")),
        F.struct(F.add_months("month", 12).alias("month"), F.lit(None).cast("bigint").alias("own"), F.col("sales").alias("prev"),
                 F.lit(False).alias("_is"))))
    per = monthly.select("month", F.col("sales").cast("bigint").alias("sales")).select(both).groupBy("month").agg(
        F.max("own").alias("sales"), F.max("prev").alias("sales_prev_year"), F.max("_is").alias("_is"))
    change = F.try_divide((F.col("sales") - F.col("sales_prev_year")).cast("double"),
                          F.col("sales_prev_year").cast("double"))
    return (
        per.where("_is and month is not null")
        .select("month", "sales", "sales_prev_year", F.round(change, 6).alias("yoy_change"))
        .orderBy("month")
    )


def genre_share(genre_rows: DataFrame) -> DataFrame:
    """Each genre's share of a month's sales."""
    per = genre_rows.groupBy(F.trunc("boxoffice_date", "month").alias("month"), "genre").agg(
        F.sum("salesAmt").alias("sales"))
    return share_of_group(per, ["month"], "sales", "share").orderBy("month", F.desc("sales"), "genre")


def region_audience(region_rows: DataFrame) -> DataFrame:
    """Audience per region."""
    return (
        region_rows.groupBy("region_name").agg(F.sum("audiCnt").alias("audience"))
        .orderBy(F.desc("audience"), "region_name")
    )


def region_top10(region_rows: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` films with the largest audience in each region."""
    per = region_rows.groupBy("region_name", "movieNm").agg(F.sum("audiCnt").alias("audience"))
    return top_n(per, ["region_name"], [F.desc("audience"), F.asc("movieNm")], n, rank_col="rank").orderBy(
        "region_name", "rank")
