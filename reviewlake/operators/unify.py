"""Merge the review platforms into one table (P1-P9, F17, U-1, U-2).

Each platform's landed rows have their own columns (name vs id,
review_date vs date, rating vs star, optional who / recommend_tags);
``normalize_platform`` maps them onto the seven ``reviews_raw`` columns,
all strings, and ``union_platforms`` stacks them by name.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.casts import to_star
from reviewlake.functions.files import title_from_file
from reviewlake.functions.text import has_reviewer

# Column renames across platforms.
RENAMES = {"name": "id", "review_date": "date", "rating": "star"}
# The reviews_raw column order.
RAW_COLUMNS = ["movieNm", "id", "context", "star", "date", "platform", "recommend_tags"]


def normalize_platform(df: DataFrame, platform: str, *, file_col: str | None = None,
                       title_col: str | None = None, who: str | None = None,
                       lower_names: bool = True, require_reviewer: bool = True,
                       star_divisor: float | None = None) -> DataFrame:
    """One platform's rows as ``reviews_raw``.

    The title comes from ``title_col`` when given, else from the landed
    file name in ``file_col`` (C1 + C2). ``who`` keeps only expert or
    netizen rows (F17) before the column is dropped (P4). Rows without a
    reviewer id are dropped (F14), as the crawlers never stored them.
    ``star_divisor`` rescales a source's stars (C21, e.g. ten-point expert
    ratings halved; SURVEY D25), read from the text, bad text giving null.
    """
    keep = {title_col, file_col} - {None}
    if lower_names:  # P3, file columns only
        df = df.toDF(*[c if c in keep else c.lower() for c in df.columns])
    df = df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns and v not in df.columns})
    if who is not None and "who" in df.columns:
        df = df.where(F.col("who") == who)
    if title_col is not None:
        title = F.col(title_col).cast("string")
    elif file_col is not None:
        title = title_from_file(F.col(file_col), platform)
    else:
        raise ValueError("need title_col or file_col")
    cols = {
        "movieNm": title,
        "platform": F.lit(platform),  # P6 / C25: constant column
    }
    for c in ("id", "context", "star", "date", "recommend_tags"):
        cols[c] = F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    if star_divisor is not None and "star" in df.columns:
        cols["star"] = (to_star("star") / F.lit(float(star_divisor))).cast("string")
    out = df.select(*[cols[c].alias(c) for c in RAW_COLUMNS])
    return out.where(has_reviewer("id")) if require_reviewer else out


def union_platforms(frames: Iterable[DataFrame]) -> DataFrame:
    """U-1: union by name; a column missing on one side becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
