"""End-to-end jobs: the reference's batch notebook and daily jobs as Spark jobs.

Each job writes its intermediate tables once under ``out`` (a shared
folder) and reads them back, so every derived table starts from Parquet
rather than from the whole upstream plan: lineage is cut at a written
table, a lost executor recomputes from it, and each metric scans only
the columns it uses. The driver only builds plans.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions.dates import yesterday
from reviewlake.functions.text import STOPWORDS_KO, STOPWORDS_KO_LONG
from reviewlake.operators import boxoffice as bo
from reviewlake.operators import keywords as kw
from reviewlake.operators import metrics as m
from reviewlake.operators import sentiment as se
from reviewlake.operators.clean import BATCH_KEYS, clean_reviews
from reviewlake.operators.incremental import append_new
from reviewlake.session import checkpoint_dir
from reviewlake.sources import files as src
from reviewlake.sources.sinks import append_day, write_parquet
from reviewlake.sources.tables import read_table
from reviewlake.streaming.daily import table_or_none


def _path(out: str, name: str) -> str:
    return os.path.join(out, name)


def _write_all(spark: SparkSession, out: str, tables: dict[str, DataFrame]) -> dict[str, str]:
    paths = {}
    for name, df in tables.items():
        paths[name] = _path(out, name)
        write_parquet(df, paths[name])
    return paths


def review_batch_job(spark: SparkSession, folders: dict[str, str], out: str, *, charset: str = "hangul+jamo",
                     stopwords: Sequence[str] = STOPWORDS_KO, lexicon: Sequence[tuple] = se.LEXICON_KO,
                     tag_platform: str = "megabox") -> dict[str, str]:
    """The batch notebook: merge every platform's files, clean, and derive
    the rating, trend, tag, keyword and sentiment tables."""
    paths = {"merged_reviews": _path(out, "merged_reviews"), "cleaned_reviews": _path(out, "cleaned_reviews")}
    write_parquet(src.read_all_reviews(spark, folders), paths["merged_reviews"])
    write_parquet(clean_reviews(spark.read.parquet(paths["merged_reviews"])), paths["cleaned_reviews"])
    cleaned = spark.read.parquet(paths["cleaned_reviews"])
    paths |= _write_all(spark, out, {
        "platform_rating": m.platform_rating(cleaned),
        "daily_counts": m.daily_counts(cleaned),
        "movie_platform_counts": m.movie_platform_counts(cleaned),
        "review_pace": m.review_pace(cleaned),
        "rating_summary": m.rating_summary(cleaned),
        "platform_summary": m.platform_summary(cleaned),
        "movie_summary": m.movie_summary(cleaned),
        "rating_histogram": m.rating_histogram(cleaned),
        "movie_trend": m.movie_trend(cleaned),
        "tag_counts": kw.tag_counts(cleaned),
        "tag_counts_by_movie": kw.tag_counts_by_movie(cleaned),
        "megabox_keywords": kw.platform_tag_counts(cleaned, tag_platform),
        "movie_keywords": kw.movie_keywords(cleaned, charset, stopwords),
        "review_sentiment": se.score_lexicon(cleaned, lexicon, charset),
        "movie_counts": m.movie_counts(cleaned),
        "review_texts": m.review_texts(cleaned),
        "movie_card": m.movie_card(cleaned),
        "star_distribution": m.star_distribution(cleaned),
        "platform_share": m.platform_share(cleaned),
    })
    scored = spark.read.parquet(paths["review_sentiment"])
    paths |= _write_all(spark, out, {
        "review_sentiment_wordcloud": se.sentiment_words(scored, charset, STOPWORDS_KO_LONG),
        "sentiment_by_platform": se.sentiment_by_platform(scored),
        "sentiment_by_day": se.sentiment_by_day(scored),
        "sentiment_top10": se.sentiment_top10(scored, 10, charset, STOPWORDS_KO_LONG),
        "sentiment_platform_counts": se.sentiment_platform_counts(scored),
    })
    return paths


def review_daily_job(spark: SparkSession, folders: dict[str, str], out: str, run_date: _dt.date | str,
                     keys: Sequence[str] = BATCH_KEYS) -> dict[str, str]:
    """The daily jobs for one day: that day's files appended to the raw
    table, cleaned, and merged into the cleaned table without repeating
    rows stored on earlier days (SURVEY D8). Both tables are partitioned by
    load day, so a rerun of the day replaces its own partition."""
    day = _dt.date.fromisoformat(run_date) if isinstance(run_date, str) else run_date
    raw_path, clean_path = _path(out, "review_data"), _path(out, "cleaned_reviews")
    append_day(src.read_all_reviews(spark, folders, day=day), raw_path, day)
    todays = spark.read.parquet(raw_path).where(F.col("load_date") == F.lit(day)).drop("load_date")
    cleaned = clean_reviews(todays, keys)
    stored = table_or_none(spark, clean_path)
    if stored is not None:  # else the first day
        cleaned = append_new(stored.where(F.col("load_date") != F.lit(day)).drop("load_date"), cleaned, keys)
    # the day's rows depend on the table they are written to: checkpoint them
    # to the shared folder first, so the write no longer reads that table
    checkpoint_dir(spark)
    append_day(cleaned.checkpoint(), clean_path, day)
    return {"review_data": raw_path, "cleaned_reviews": clean_path}


def boxoffice_job(spark: SparkSession, daily_folder: str, out: str, *, region_folder: str | None = None,
                  legacy: bool = False) -> dict[str, str]:
    """The chart jobs: typed daily charts, genre rows and monthly / genre
    tables; with ``region_folder``, regional charts and their rollups."""
    paths = {"merged_boxoffice": _path(out, "merged_boxoffice")}
    write_parquet(src.read_boxoffice_csv(spark, daily_folder, legacy=legacy), paths["merged_boxoffice"])
    daily = spark.read.parquet(paths["merged_boxoffice"])
    tables = {"monthly_sales": bo.monthly_sales(daily)}
    if "genreNm" in daily.columns:
        tables["analysis_genre"] = bo.genre_explode(daily)
    paths |= _write_all(spark, out, tables)
    if "analysis_genre" in paths:
        paths |= _write_all(spark, out, {"genre_share": bo.genre_share(spark.read.parquet(paths["analysis_genre"]))})
    if region_folder is not None:
        paths["merged_regions_boxoffice"] = _path(out, "merged_regions_boxoffice")
        write_parquet(src.read_region_csv(spark, region_folder, legacy=legacy), paths["merged_regions_boxoffice"])
        regional = spark.read.parquet(paths["merged_regions_boxoffice"])
        paths |= _write_all(spark, out, {"region_audience": bo.region_audience(regional),
                                         "region_top10": bo.region_top10(regional)})
    return paths


def _day(run_date: _dt.date | str) -> _dt.date:
    return _dt.date.fromisoformat(run_date) if isinstance(run_date, str) else run_date


def review_analysis_daily_job(spark: SparkSession, cleaned: str, out: str, run_date: _dt.date | str, *, charset: str = "hangul",
                              stopwords: Sequence[str] = STOPWORDS_KO, lexicon: Sequence[tuple] = se.LEXICON_KO,
                              tag_platform: str = "megabox") -> dict[str, str]:
    """The daily analysis of the reviews dated the day before ``run_date``: keywords, one platform's tags, sentiment.

    The cleaned table is read by day bound (S11). Each derived table is
    partitioned by that day and the day's partition is replaced, so a rerun
    changes nothing and the days together are the batch tables.
    """
    day = yesterday(run_date)
    rows = read_table(spark, cleaned, since=day, until=day + _dt.timedelta(days=1))
    tables = {
        "daily_keywords": kw.movie_keywords(rows, charset, stopwords),
        "daily_tags": kw.platform_tag_counts(rows, tag_platform),
        "daily_sentiment": se.score_lexicon(rows, lexicon, charset),
    }
    for name, df in tables.items():
        append_day(df, _path(out, name), day, "review_date")
    return {name: _path(out, name) for name in tables}


def boxoffice_daily_job(spark: SparkSession, out: str, run_date: _dt.date | str, daily_json: str, *,
                        region_json: str | None = None, region_codes: DataFrame | None = None) -> dict[str, str]:
    """The daily charts from landed API responses: typed daily rows, their genre rows, and regional rows with
    the region's name (J1 where the responses carry codes only). Every table replaces the chart day's partition."""
    day = _day(run_date)
    chart_day = F.col("boxoffice_date") == F.lit(day)
    daily = bo.cast_boxoffice(src.read_boxoffice_json(spark, daily_json)).where(chart_day)
    tables = {"boxoffice": daily}
    if "genreNm" in daily.columns:
        tables["analysis_genre"] = bo.genre_explode(daily)
    if region_json is not None:
        regional = bo.cast_region_boxoffice(src.read_region_json(spark, region_json)).where(chart_day)
        tables["region_boxoffice"] = regional if region_codes is None else bo.region_attach(regional.drop("region_name"), region_codes)
    for name, df in tables.items():
        append_day(df.drop("boxoffice_date"), _path(out, name), day, "boxoffice_date")
    return {name: _path(out, name) for name in tables}
