"""Clean merged reviews.

Rule order (SURVEY D28): filters first, dedup last, so a bad copy can
never win over a good one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.casts import to_star
from reviewlake.functions.dates import parse_review_date
from reviewlake.functions.text import strip_ws
from reviewlake.operators.skew import keep_first

# Dedup keys: batch rule (default) and daily rule.
BATCH_KEYS = ("id", "context", "movieNm")
DAILY_KEYS = ("movieNm", "id", "context", "date")


def star_in_range(c="star", lo: float = 0.0, hi: float = 5.0):
    """keep null stars and stars within ``[lo, hi]``."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | c.between(lo, hi)


REVIEW_COLUMNS = ("movieNm", "id", "context", "star", "date", "platform", "recommend_tags")


def clean_reviews(raw: DataFrame, keys: Sequence[str] = BATCH_KEYS, min_len: int = 10,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """``reviews_raw`` to ``cleaned_reviews``.

    context present and at least ``min_len`` characters after stripping;
    star parsed (bad text such as ``None`` becomes null) and null or
    within 0..5; date parsed from ``yyyy.MM.dd`` or ``yyyy-MM-dd``; then
    one row per ``keys``, the earliest date winning (then star, platform).

    ``columns`` (all by default) are the columns the caller reads. Texts are
    compared by digest, so without ``context`` among them no text is
    shuffled; the rows kept are the same.
    """
    wanted = [c for c in REVIEW_COLUMNS if columns is None or c in columns]
    # at least one character is left after stripping iff the text is present (F1), so F2 tests both
    typed = raw.select(
        "movieNm", "id", strip_ws("context").alias("context"), to_star("star").alias("star"),
        parse_review_date("date").alias("date"), "platform", "recommend_tags",
    ).where((F.length("context") >= max(min_len, 1)) & star_in_range("star"))
    order = ["date", "star", "platform"]
    narrow = [k if k != "context" else "_sha_context" for k in keys]
    hashed = typed.withColumn("_sha_context", F.unhex(F.sha2(F.col("context"), 256)))
    carried = [c for c in REVIEW_COLUMNS if c in wanted or c in narrow or c in order]
    return keep_first(hashed.select(*carried, "_sha_context"), narrow, order=order).select(*wanted)


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Repeatable ``dropDuplicates(keys)``."""
    return keep_first(df, keys, order)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct."""
    return df.distinct()
