"""File-name expressions.

Landed review files are named ``{title}_{yyyymmdd}_{platform}_reviews.csv``
(undated for one platform); the title is percent-encoded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlake.functions.text import col_


def decode_name(c) -> Column:
    """Percent-decode a title.

    A literal ``+`` stays a plus (it is escaped before decoding); a
    malformed escape such as a lone ``%`` keeps the raw text.
    """
    c = col_(c)
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def source_file_name() -> Column:
    """The file a row came from, as the folder lists it (the hidden ``_metadata`` column has the name as in a URI)."""
    return decode_name(F.col("_metadata.file_name"))


def title_from_file(c, platform: str) -> Column:
    """Film title from a review file name, dated or undated, decoded."""
    raw = F.regexp_extract(col_(c), f"^(.+?)(?:_(\\d{{8}}))?_{platform}_reviews\\.csv$", 1)
    return decode_name(raw)


def day_in_review_file(c, platform: str) -> Column:
    """The ``yyyymmdd`` day of a dated review file name, else null."""
    d = F.regexp_extract(col_(c), f"_(\\d{{8}})_{platform}_reviews\\.csv$", 1)
    return F.try_to_date(F.when(F.length(d) == 8, d), "yyyyMMdd")
