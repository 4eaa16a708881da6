"""Readers for landed review and chart files.

Every reader takes an explicit schema: no inference pass over the data,
and a header that disagrees with the schema raises instead of silently
shifting columns (``enforceSchema=False``). Day and film selection are
``pathGlobFilter`` globs, applied while listing, before any file is opened.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlake.functions.dates import day_from_name
from reviewlake.functions.files import decode_name, source_file_name, title_from_file
from reviewlake.operators.unify import normalize_platform, union_platforms
from reviewlake.sources import schemas

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",      # quoted fields may hold line breaks
    "escape": '"',            # quotes are doubled inside fields
    "encoding": "UTF-8",      # a leading BOM is dropped by the reader
    "enforceSchema": "false",
    "mode": "PERMISSIVE",
}


def glob_escape(s: str) -> str:
    """Escape glob metacharacters in a literal file-name part (``[`` etc.)."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", s)


def _day(d: _dt.date | str) -> str:
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return d.strftime("%Y%m%d")


def read_csv(spark: SparkSession, path: str, schema: StructType, *, glob: str | None = None,
             recursive: bool = True, modified_after: str | None = None, modified_before: str | None = None,
             **options) -> DataFrame:
    """CSV with header, explicit schema, multi-line quoted fields.

    ``modified_after`` is inclusive and ``modified_before`` exclusive, so
    that every file belongs to exactly one day, also one stamped midnight.
    """
    r = spark.read.schema(schema).options(**CSV_OPTIONS).option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.csv(path)
    stamp = F.col("_metadata.file_modification_time")  # prunes files before they are opened
    if modified_after:
        df = df.where(stamp >= F.lit(modified_after).cast("timestamp"))
    if modified_before:
        df = df.where(stamp < F.lit(modified_before).cast("timestamp"))
    return df


def review_glob(platform: str, day=None, movie: str | None = None) -> str:
    """The file-name glob for one day's and/or one film's files."""
    head = glob_escape(movie) + "_" if movie is not None else ""
    if day is not None:
        return f"{head}{_day(day)}_{platform}_reviews.csv" if head else f"*_{_day(day)}_{platform}_reviews.csv"
    return f"{head}*{platform}_reviews.csv" if head else f"*_{platform}_reviews.csv"


def read_reviews(spark: SparkSession, path: str, platform: str, *, day=None, movie: str | None = None,
                 recursive: bool = True, modified_after: str | None = None,
                 modified_before: str | None = None) -> DataFrame:
    """One platform's landed review files, with the source file name."""
    df = read_csv(spark, path, schemas.REVIEW_SCHEMAS[platform], glob=review_glob(platform, day, movie),
                  recursive=recursive, modified_after=modified_after, modified_before=modified_before)
    df = df.withColumn("file_name", source_file_name())
    if movie is not None:  # the glob prunes; "A_*" also names films that begin with "A_"
        df = df.where(title_from_file("file_name", platform) == decode_name(F.lit(movie)))
    return df


def read_all_reviews(spark: SparkSession, folders: dict[str, str], *, day=None,
                     who: str | None = None) -> DataFrame:
    """S1 + P1-P7 + U-1: every platform's files as one ``reviews_raw`` table.

    ``folders`` maps platform to its folder. Undated files (one platform
    writes no day in the name) are picked for a day by modification time
    (SURVEY D6).
    """
    frames = []
    for platform, folder in folders.items():
        if day is not None and platform in schemas.UNDATED_PLATFORMS:
            d = _dt.date.fromisoformat(day) if isinstance(day, str) else day
            nxt = d + _dt.timedelta(days=1)
            raw = read_reviews(spark, folder, platform, modified_after=f"{d.isoformat()}T00:00:00",
                               modified_before=f"{nxt.isoformat()}T00:00:00")
        else:
            raw = read_reviews(spark, folder, platform, day=day)
        frames.append(normalize_platform(raw, platform, file_col="file_name", who=who))
    return union_platforms(frames)


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files under a prefix with size and modification time.

    The binary-file source prunes the unread ``content`` column, so only
    the listing is done.
    """
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        .load(path).select("path", "length", "modificationTime")
    )


def read_boxoffice_csv(spark: SparkSession, path: str, *, legacy: bool = False, day=None) -> DataFrame:
    """S3: daily chart CSVs, typed, with ``boxoffice_date`` from the name."""
    from reviewlake.operators.boxoffice import cast_boxoffice

    schema = schemas.BOXOFFICE_CSV_LEGACY if legacy else schemas.BOXOFFICE_CSV
    glob = f"daily_box_office_{_day(day)}.csv" if day is not None else "daily_box_office_*.csv"
    df = read_csv(spark, path, schema, glob=glob, multiLine="false")
    df = df.withColumn("boxoffice_date", day_from_name(source_file_name(), "daily_box_office_"))
    return cast_boxoffice(df)


def read_region_csv(spark: SparkSession, path: str, *, legacy: bool = False, day=None) -> DataFrame:
    """Regional chart CSVs, typed."""
    from reviewlake.operators.boxoffice import cast_region_boxoffice

    schema = schemas.REGION_CSV_LEGACY if legacy else schemas.REGION_CSV
    glob = f"daily_region_box_office_{_day(day)}.csv" if day is not None else "daily_region_box_office_*.csv"
    df = read_csv(spark, path, schema, glob=glob, multiLine="false")
    df = df.withColumn("boxoffice_date", day_from_name(source_file_name(), "daily_region_box_office_"))
    return cast_region_boxoffice(df)


def _show_day(c):
    d = F.regexp_extract(c, "^(\\d{8})", 1)
    return F.try_to_date(F.when(F.length(d) == 8, d), "yyyyMMdd")


def read_boxoffice_json(spark: SparkSession, path: str, *, strict: bool = True,
                        multi_line: bool = True) -> DataFrame:
    """Landed API responses to chart rows (17 string columns + day).

    Strict, as the daily job: a response without the list fails the job.
    ``multi_line``: one pretty-printed response per file (as landed);
    false for JSON Lines (one response per line).
    """
    raw = spark.read.schema(schemas.BOXOFFICE_JSON).option("multiLine", str(multi_line).lower()).json(path)
    lst = F.col("boxOfficeResult.dailyBoxOfficeList")
    if strict:
        lst = F.when(lst.isNull(), F.raise_error(F.lit("response without boxOfficeResult.dailyBoxOfficeList"))
                     ).otherwise(lst)
    return raw.select(_show_day(F.col("boxOfficeResult.showRange")).alias("boxoffice_date"),
                      F.inline(lst)).select("boxoffice_date", *schemas.BOXOFFICE_FIELDS)


def read_region_json(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Landed regional responses, lenient: a missing or empty list gives
    no rows; each row is stamped with its region code and name."""
    raw = spark.read.schema(schemas.REGION_JSON).option("multiLine", str(multi_line).lower()).json(path)
    return raw.select(
        _show_day(F.col("data.boxOfficeResult.showRange")).alias("boxoffice_date"),
        "region_code", "region_name",
        F.inline(F.col("data.boxOfficeResult.dailyBoxOfficeList")),
    ).select("boxoffice_date", *schemas.REGION_FIELDS)


def read_region_codes(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Region-code table (fullCd, korNm) from the API payload or its CSV."""
    if fmt == "csv":
        return read_csv(spark, path, schemas.REGION_CODES_CSV, multiLine="false")
    raw = spark.read.schema(schemas.REGION_CODES_JSON).option("multiLine", "true").json(path)
    return raw.select(F.inline("codes")).select("fullCd", "korNm")


def read_csv_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with header; explicit schema when given, else inferred. Quoted fields may hold commas, doubled
    quotes and line breaks, so the reader takes back whatever ``write_csv`` (S21) wrote."""
    r = spark.read.options(**CSV_OPTIONS)
    if schema is None:
        return r.option("enforceSchema", "true").option("inferSchema", "true").csv(path)
    return r.schema(schema).csv(path)
