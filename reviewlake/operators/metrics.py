"""Review metrics.

All are ``groupBy`` aggregates: Spark adds the partial (map-side)
aggregate, so a film with a third of all reviews costs one row per map
task in the shuffle. Averages are rounded to 6 digits so results compare
across engines. Every sort, on one column (O1) or several with mixed
directions (O2), carries a full tie-break (SURVEY D20). Rated-only
metrics use a not-null filter (F4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.operators.skew import share_of_total

DIGITS = 6


def _avg(c: str):
    return F.round(F.avg(c), DIGITS)


def platform_rating(df: DataFrame) -> DataFrame:
    """A1: average star and count per platform, rated rows only."""
    return (
        df.where(F.col("star").isNotNull())
        .groupBy("platform")
        .agg(_avg("star").alias("avg_star"), F.count(F.lit(1)).alias("review_count"))
        .orderBy(F.desc("avg_star"), "platform")
    )


def daily_counts(df: DataFrame) -> DataFrame:
    """A2: reviews per day (null day kept as its own row)."""
    return df.groupBy("date").agg(F.count(F.lit(1)).alias("count")).orderBy(F.asc_nulls_first("date"))


def movie_platform_counts(df: DataFrame) -> DataFrame:
    """A3: reviews per film and platform, largest first."""
    return (
        df.groupBy("movieNm", "platform").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "movieNm", "platform")
    )


def movie_counts(df: DataFrame) -> DataFrame:
    """Reviews per film, largest first."""
    return (
        df.groupBy("movieNm").agg(F.count(F.lit(1)).alias("review_count"))
        .orderBy(F.desc("review_count"), "movieNm")
    )


def review_pace(df: DataFrame) -> DataFrame:
    """First and last review day, count, active days and reviews per day
    (C12: ``datediff + 1``, never below 1, ratio as double)."""
    if "date" not in df.columns:
        return movie_counts(df)
    g = df.groupBy("movieNm").agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count(F.lit(1)).alias("review_count"),
    )
    days = F.datediff("max_date", "min_date") + 1
    return (
        g.withColumn("days_active", days)
        .withColumn("avg_reviews_per_day",
                    F.round(F.col("review_count").cast("double") / F.col("days_active"), DIGITS))
        .orderBy(F.desc_nulls_last("avg_reviews_per_day"), "movieNm")
    )


def rating_summary(df: DataFrame) -> DataFrame:
    """Rated reviews per film: count, mean, sample standard deviation."""
    return (
        df.where(F.col("star").isNotNull())
        .groupBy("movieNm")
        .agg(
            F.count("star").alias("rating_count"),
            _avg("star").alias("avg_rating"),
            F.round(F.stddev_samp("star"), DIGITS).alias("stddev_rating"),
        )
        .orderBy(F.desc("avg_rating"), "movieNm")
    )


def platform_summary(df: DataFrame) -> DataFrame:
    """Reviews and mean star per platform."""
    return (
        df.groupBy("platform")
        .agg(F.count(F.lit(1)).alias("review_count"), _avg("star").alias("avg_rating"))
        .orderBy(F.desc("review_count"), "platform")
    )


def movie_summary(df: DataFrame) -> DataFrame:
    """Non-null texts and mean star per film (without the text column every cleaned review counts: it has one)."""
    return (
        df.groupBy("movieNm")
        .agg(F.count("context" if "context" in df.columns else F.lit(1)).alias("review_count"), _avg("star").alias("avg_rating"))
        .orderBy(F.desc("review_count"), "movieNm")
    )


def half_star(c="star"):
    """Round to the nearest half star (half-up)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 2) / 2


def rating_histogram(df: DataFrame) -> DataFrame:
    """Reviews per film and half-star bin; null star is its own bin."""
    return (
        df.withColumn("round_rating", half_star("star"))
        .groupBy("movieNm", "round_rating").agg(F.count(F.lit(1)).alias("count"))
        .orderBy("movieNm", F.asc_nulls_first("round_rating"))
    )


def movie_trend(df: DataFrame) -> DataFrame:
    """Reviews per film per day."""
    return (
        df.withColumn("review_date", F.col("date").cast("date"))
        .groupBy("movieNm", "review_date").agg(F.count(F.lit(1)).alias("count"))
        .orderBy("movieNm", F.asc_nulls_first("review_date"))
    )


def movie_card(df: DataFrame) -> DataFrame:
    """One row per film: reviews, rated reviews, mean star, first and last day."""
    return (
        df.groupBy("movieNm")
        .agg(
            F.count(F.lit(1)).alias("review_count"),
            F.count("star").alias("rating_count"),
            _avg("star").alias("avg_rating"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
        .orderBy(F.desc("review_count"), "movieNm")
    )


def platform_share(df: DataFrame) -> DataFrame:
    """Reviews per platform and their share of all reviews (the total is
    a scalar subquery over the aggregated table)."""
    per = df.groupBy("platform").agg(F.count(F.lit(1)).alias("review_count"))
    return share_of_total(per, "review_count", "share", DIGITS).orderBy(F.desc("review_count"), "platform")


def star_distribution(df: DataFrame) -> DataFrame:
    """B7 (first half): reviews per half-star bin over all films."""
    return (
        df.withColumn("round_rating", half_star("star"))
        .groupBy("round_rating").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.asc_nulls_first("round_rating"))
    )


def review_texts(df: DataFrame) -> DataFrame:
    """The review texts (word-cloud feed) as a table, not a driver list."""
    return df.where(F.col("context").isNotNull()).select("movieNm", "platform", "context")


def top_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """O3: the first ``n`` rows by a total order (planned as
    ``TakeOrderedAndProject``: each task keeps its own top ``n``)."""
    return df.orderBy(*order).limit(n)
