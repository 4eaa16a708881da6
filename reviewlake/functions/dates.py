"""Date expressions.

Spark 4 runs in ANSI mode, so every parse uses the ``try_`` form: a bad
value becomes null instead of failing the job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlake.functions.text import col_, strip_ws

# Review date formats seen in the landed files
# ("2025.03.19" from the sites, "2025-03-19" from table exports).
# One-letter month/day fields accept both padded and unpadded numbers.
DATE_PATTERNS = ("yyyy.M.d", "yyyy-M-d")


def parse_review_date(c) -> Column:
    """Text date to DATE; blank, unknown format or impossible day gives null."""
    s = strip_ws(col_(c))
    s = F.when(F.length(s) > 0, s)
    return F.coalesce(*[F.try_to_date(s, p) for p in DATE_PATTERNS])


def day_from_name(c, stem: str) -> Column:
    """``{stem}{yyyymmdd}.csv`` in a file name to DATE."""
    digits = F.regexp_extract(col_(c), f"{stem}(\\d{{8}})\\.csv$", 1)
    return F.try_to_date(F.when(F.length(digits) == 8, digits), "yyyyMMdd")


# Relative time phrases on the review sites.
REL_MINUTES = "분전"   # n minutes ago
REL_HOURS = "시간전"   # n hours ago
REL_DAYS = "일전"      # n days ago
REL_NOW = "방금"       # just now
REL_ONE_DAY = "하루전"  # a day ago


def relative_to_date_text(c, as_of) -> Column:
    """C19 (the reference's U4 helper): relative time text to ``yyyy.MM.dd``
    as seen at ``as_of``; a C6 ``when`` chain without ``otherwise``.

    Dated text (``yyyy.MM.dd`` prefix) passes through unchanged; unknown
    text gives null. ``as_of`` is a timestamp column or a literal; the
    reference used the crawl clock, we take it as a parameter.
    """
    t = col_(c)
    ts = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    n = F.regexp_extract(t, "(\\d+)", 1).try_cast("int")
    fmt = "yyyy.MM.dd"

    def ago(unit: str) -> Column:
        return F.date_format(F.timestamp_add(unit, -n, ts), fmt)

    return (
        F.when(t.rlike("^\\d{4}\\.\\d{2}\\.\\d{2}"), t)
        .when(t.contains(REL_MINUTES) & n.isNotNull(), ago("MINUTE"))
        .when(t.contains(REL_HOURS) & n.isNotNull(), ago("HOUR"))
        .when(t.contains(REL_ONE_DAY), F.date_format(F.timestamp_add("DAY", F.lit(-1), ts), fmt))
        .when(t.contains(REL_DAYS) & n.isNotNull(), ago("DAY"))
        .when(t.contains(REL_NOW), F.date_format(ts, fmt))
    )


def yesterday(run_date: str | _dt.date | None = None) -> _dt.date:
    """C20: the day before ``run_date`` (today when not given)."""
    if run_date is None:
        run_date = _dt.date.today()
    elif isinstance(run_date, str):
        run_date = _dt.date.fromisoformat(run_date)
    return run_date - _dt.timedelta(days=1)


def year_of(c) -> Column:
    """Year of a date or of ``yyyy-...`` text."""
    c = col_(c)
    return F.coalesce(F.year(F.try_to_date(c.cast("string"))),
                      F.split_part(c.cast("string"), F.lit("-"), F.lit(1)).try_cast("int"))


def first_token(c) -> Column:
    """First whitespace-separated token."""
    return F.split(strip_ws(col_(c)), "[ \\t\\n\\u00a0\\u3000]+").getItem(0)


def to_day(c) -> Column:
    """Truncate a timestamp or date to its day."""
    return col_(c).cast("date")
