"""Typed casts by declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.text import col_, strip_ws

# Declared types of the daily box-office columns
# (rank and counts int, money and cumulative counts long, shares double).
BOXOFFICE_TYPES = {
    "rank": "int", "rankInten": "int", "salesAmt": "bigint", "salesShare": "double",
    "salesInten": "bigint", "salesChange": "double", "salesAcc": "bigint",
    "audiCnt": "int", "audiInten": "int", "audiChange": "double", "audiAcc": "bigint",
    "scrnCnt": "int", "showCnt": "int", "prdtYear": "int", "showTm": "int",
    "openDt": "date",
}
# Declared types of the regional box-office columns.
REGION_TYPES = {
    "rank": "int", "rankInten": "int", "salesAmt": "bigint", "salesAcc": "bigint",
    "audiCnt": "int", "audiAcc": "bigint", "scrnCnt": "int", "showCnt": "int",
    "prdtYear": "int", "showTm": "int",
}


def try_typed(c, type_name: str) -> Column:
    """C14: string to the declared type; a bad value gives null."""
    c = col_(c)
    if type_name == "date":
        s = strip_ws(c.cast("string"))
        return F.coalesce(F.try_to_date(s, "yyyy-M-d"), F.try_to_date(s, "yyyyMMdd"))
    return c.try_cast(type_name)


def cast_declared(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """P10: cast only the columns present, each to its declared type.

    One ``select``, so the plan holds a single projection.
    """
    return df.select(*[
        try_typed(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns
    ])


def to_star(c) -> Column:
    """C4: star text (possibly ``None`` or junk) to double."""
    return strip_ws(col_(c).cast("string")).try_cast("double")


def ten_point_to_five(c) -> Column:
    """A ten-point rating to five points."""
    return col_(c).try_cast("int") / F.lit(2)
