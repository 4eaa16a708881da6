"""Explicit schemas for every landed input (no inference pass)."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Review CSV columns per platform, in file order.
REVIEW_SCHEMAS = {
    "watcha": strings("id", "star", "context"),
    "megabox": strings("id", "context", "star", "review_date", "recommend_tags"),
    "cgv": strings("id", "context", "date"),
    "cine": strings("who", "name", "context", "star", "date"),
}

# The 17 fields of a daily box-office entry, in API order.
BOXOFFICE_FIELDS = [
    "rank", "rankInten", "rankOldAndNew", "movieCd", "movieNm", "openDt", "salesAmt", "salesShare",
    "salesInten", "salesChange", "salesAcc", "audiCnt", "audiInten", "audiChange", "audiAcc",
    "scrnCnt", "showCnt",
]
# Columns of older daily files, appended after the current ones.
BOXOFFICE_LEGACY_EXTRA = ["prdtYear", "showTm", "genreNm"]

# Regional chart CSV columns, in file order.
REGION_FIELDS = [
    "region_code", "region_name", "rank", "rankInten", "rankOldAndNew", "movieCd", "movieNm",
    "salesAmt", "salesAcc", "audiCnt", "audiAcc", "scrnCnt", "showCnt",
]
REGION_LEGACY_EXTRA = ["prdtYear", "showTm"]

BOXOFFICE_CSV = strings(*BOXOFFICE_FIELDS)
BOXOFFICE_CSV_LEGACY = strings(*BOXOFFICE_FIELDS, *BOXOFFICE_LEGACY_EXTRA)
REGION_CSV = strings(*REGION_FIELDS)
REGION_CSV_LEGACY = strings(*REGION_FIELDS, *REGION_LEGACY_EXTRA)
REGION_CODES_CSV = strings("fullCd", "korNm")

# The API payload: {"boxOfficeResult": {"showRange": ..., "dailyBoxOfficeList": [{...}]}}
BOXOFFICE_ENTRY = strings(*BOXOFFICE_FIELDS)
BOXOFFICE_JSON = StructType([
    StructField("boxOfficeResult", StructType([
        StructField("boxofficeType", StringType(), True),
        StructField("showRange", StringType(), True),
        StructField("dailyBoxOfficeList", ArrayType(BOXOFFICE_ENTRY), True),
    ]), True),
])
# A landed regional response: the payload stamped with its region.
REGION_JSON = StructType([
    StructField("region_code", StringType(), True),
    StructField("region_name", StringType(), True),
    StructField("data", BOXOFFICE_JSON, True),
])
# The region-code API payload: {"codes": [{"fullCd": ..., "korNm": ...}]}
REGION_CODES_JSON = StructType([
    StructField("codes", ArrayType(strings("fullCd", "korNm")), True),
])

# Fixed value: platforms whose review files carry no day in their name (FIXTURES.md §1).
UNDATED_PLATFORMS = {"watcha"}
