"""Column rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewlake.functions import casts, dates, files, tags, text
from reviewlake.operators.keywords import tokens


def one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("y")).first().y


@pytest.mark.parametrize("txt,expected", [
    ("50분전", "2025.03.19"),        # crosses midnight
    ("3시간전", "2025.03.19"),
    ("3일전", "2025.03.17"),
    ("하루전", "2025.03.19"),        # named in the reference's doc, unhandled there (D24)
    ("방금", "2025.03.20"),
    ("2025.03.01", "2025.03.01"),
    ("어제쯤", None),
    ("분전", None),
])
def test_relative_dates(spark, txt, expected):
    assert one(spark, dates.relative_to_date_text("x", "2025-03-20 00:30:00"), txt) == expected


@pytest.mark.parametrize("raw,expected", [
    ("2025.03.19", "2025-03-19"), ("2025-03-19", "2025-03-19"), ("2025.3.9", "2025-03-09"),
    ("2025.13.01", None), ("", None), ("  ", None), (None, None), (" 2025.03.19 ", "2025-03-19"),
])
def test_parse_review_date(spark, raw, expected):
    got = one(spark, dates.parse_review_date("x"), raw)
    assert (got.isoformat() if got else None) == expected


@pytest.mark.parametrize("name,platform,title", [
    ("Dune%20%5BIMAX%5D%2C%20Part%20Two_20250319_megabox_reviews.csv", "megabox", "Dune [IMAX], Part Two"),
    ("Tom%20%26%20Jerry+_20250320_megabox_reviews.csv", "megabox", "Tom & Jerry+"),
    ("100%_20250319_cgv_reviews.csv", "cgv", "100%"),
    ("My_Movie_20250319_cine_reviews.csv", "cine", "My_Movie"),
    ("Undated%20Film_watcha_reviews.csv", "watcha", "Undated Film"),
])
def test_title_from_file(spark, name, platform, title):
    assert one(spark, files.title_from_file("x", platform), name) == title


def test_day_from_name(spark):
    assert one(spark, dates.day_from_name("x", "daily_box_office_"), "daily_box_office_20250319.csv").isoformat() \
        == "2025-03-19"
    assert one(spark, dates.day_from_name("x", "daily_box_office_"), "daily_box_office_2025.csv") is None


@pytest.mark.parametrize("raw,expected", [
    ("['연출', '배우']", ["연출", "배우"]), ('["연출", "배우"]', ["연출", "배우"]), ("[]", []),
    ("broken", None), (None, None),
])
def test_parse_tags(spark, raw, expected):
    assert one(spark, tags.parse_tags("x"), raw) == expected


def test_clean_tags(spark):
    got = one(spark, tags.clean_tags(F.col("x")), ["연출 외", "+2", "", " 배우 ", "OST"], "x array<string>")
    assert got == ["배우", "OST"]


def test_strip_and_presence(spark):
    assert one(spark, text.strip_ws("x"), " 　 a b \t\n") == "a b"
    assert one(spark, text.is_present("x"), "　 ") is False
    assert one(spark, text.min_length("x", 10), "  123456789  ") is False


LATIN_SAMPLES = [
    "Héllo, wörld! ª µ º × ÷ ﬁ Ωmega Привет 漢字 😀 ſ ĳ ɏɐ",
    "tab\there nbsp　ideo  x",
    "ÀÖØöøÿĀɏ 123 _-",
]


@pytest.mark.parametrize("s", LATIN_SAMPLES)
def test_latin_two_pass_equals_single_class(spark, s):
    single = F.regexp_replace("x", f"[^{text.CHARSETS['latin']} \\t\\n\\x0B\\f\\r\\u00a0\\u3000]", "")
    assert one(spark, text.keep_charset("x", "latin"), s) == one(spark, single, s)


def test_hangul_tokens(spark):
    df = spark.createDataFrame([("m", "ㅋㅋ 영화 정말 재밌어요!! 최고 A 좋아요ㅠㅠ 감")], "movieNm string, context string")
    words = [r.word for r in tokens(df).collect()]
    assert words == ["ㅋㅋ", "재밌어요", "최고", "좋아요"]  # vowel jamo ㅠ is outside ㄱ-ㅎ
    daily = [r.word for r in tokens(df, charset="hangul").collect()]
    assert daily == ["재밌어요", "최고", "좋아요"]


def test_cast_declared_skips_absent_columns(spark):
    df = spark.createDataFrame([("1", "3000000000", "x", "2025-02-26")], "rank string, salesAcc string, audiCnt string, openDt string")
    out = casts.cast_declared(df, casts.BOXOFFICE_TYPES).first()
    assert (out["rank"], out.salesAcc, out.audiCnt, out.openDt.isoformat()) == (1, 3000000000, None, "2025-02-26")


def test_small_helpers(spark):
    assert one(spark, casts.ten_point_to_five("x"), "9") == 4.5
    assert one(spark, casts.to_star("x"), "None") is None
    assert one(spark, dates.first_token("x"), "2025.03.19 12:30") == "2025.03.19"
    assert one(spark, dates.year_of("x"), "2025-02-26") == 2025
    assert one(spark, text.text_prefix("x", 3), "abcdef") == "abc"
    assert dates.yesterday("2025-03-20").isoformat() == "2025-03-19"
