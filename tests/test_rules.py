"""One test per rule taken where the reference disagrees with itself."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from reviewlake.operators import boxoffice as bo
from reviewlake.operators import incremental as inc
from reviewlake.operators import sentiment as se
from reviewlake.operators.clean import DAILY_KEYS, clean_reviews
from reviewlake.operators.keywords import tokens
from reviewlake.operators.metrics import review_pace
from reviewlake.operators.unify import RAW_COLUMNS, normalize_platform, union_platforms
from reviewlake.sources import files as src
from tests import fixtures as fx

RAW = ", ".join(f"{c} string" for c in RAW_COLUMNS)


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_d1_dedup_keys_are_a_parameter(spark):
    df = raw(spark, [("m", "1", "같은 리뷰 텍스트입니다", "4", "2025.03.18", "p", None),
                     ("m", "1", "같은 리뷰 텍스트입니다", "4", "2025.03.19", "p", None)])
    assert clean_reviews(df).count() == 1
    assert clean_reviews(df, keys=DAILY_KEYS).count() == 2


def test_d2_d9_length_on_stripped_text_null_test_first(spark):
    df = raw(spark, [("m", "1", "   123456789   ", None, None, "p", None),
                     ("m", "2", None, None, None, "p", None),
                     ("m", "3", " 1234567890 ", None, None, "p", None)])
    assert [r.id for r in clean_reviews(df).collect()] == ["3"]


def test_d3_both_date_patterns(spark):
    df = raw(spark, [("m", "1", "리뷰 텍스트 하나입니다", None, "2025.03.19", "p", None),
                     ("m", "2", "리뷰 텍스트 둘입니다요", None, "2025-03-19", "p", None)])
    assert {r.date for r in clean_reviews(df).collect()} == {dt.date(2025, 3, 19)}


def test_d4_hangul_class_parameter(spark):
    df = spark.createDataFrame([("m", "ㅋㅋ 재밌다")], "movieNm string, context string")
    assert [r.word for r in tokens(df, charset="hangul+jamo").collect()] == ["ㅋㅋ", "재밌다"]
    assert [r.word for r in tokens(df, charset="hangul").collect()] == ["재밌다"]


def test_d5_d16_missing_columns_null_filled_and_renamed_first(spark):
    cgv = spark.createDataFrame([("c1", "리뷰 텍스트입니다", "2025.03.19", "T")], "id string, context string, date string, t string")
    cine = spark.createDataFrame([("netizen", "n1", "리뷰 텍스트입니다", "3", "", "T")],
                                 "who string, name string, context string, star string, date string, t string")
    u = union_platforms([normalize_platform(cgv, "cgv", title_col="t"), normalize_platform(cine, "cine", title_col="t")])
    rows = {r.id: r for r in u.collect()}
    assert rows["c1"].star is None and rows["n1"].star == "3"
    assert u.columns == RAW_COLUMNS


def test_d6_undated_files_chosen_by_modification_time(spark, tmp):
    folder = os.path.join(tmp, "watcha_reviews")
    fx.write_csv(os.path.join(folder, "Old_watcha_reviews.csv"), ["id", "star", "context"], [["o", "3", "오래된 리뷰 텍스트"]])
    fx.write_csv(os.path.join(folder, "New_watcha_reviews.csv"), ["id", "star", "context"], [["n", "4", "새로운 리뷰 텍스트"]])
    old = time.mktime(dt.datetime(2025, 3, 1).timetuple())
    os.utime(os.path.join(folder, "Old_watcha_reviews.csv"), (old, old))
    new = time.mktime(dt.datetime(2025, 3, 19, 12).timetuple())
    os.utime(os.path.join(folder, "New_watcha_reviews.csv"), (new, new))
    fx.write_csv(os.path.join(folder, "Later_watcha_reviews.csv"), ["id", "star", "context"], [["l", "4", "다음날 리뷰 텍스트"]])
    later = time.mktime(dt.datetime(2025, 3, 20, 12).timetuple())
    os.utime(os.path.join(folder, "Later_watcha_reviews.csv"), (later, later))
    got = src.read_all_reviews(spark, {"watcha": folder}, day="2025-03-19").collect()
    assert [(r.movieNm, r.id) for r in got] == [("New", "n")]


def test_d7_title_rule_same_everywhere(spark, tmp):
    folders = fx.write_reviews(tmp)
    one = src.read_all_reviews(spark, {"megabox": folders["megabox"]}).select("movieNm").distinct()
    day = src.read_all_reviews(spark, {"megabox": folders["megabox"]}, day="2025-03-19").select("movieNm").distinct()
    assert {r.movieNm for r in day.collect()} <= {r.movieNm for r in one.collect()}
    assert {r.movieNm for r in day.collect()} == {"Dune [IMAX], Part Two"}


def test_d10_d11_cast_by_declared_type_optional_columns(spark):
    df = spark.createDataFrame([("1", "x", "2025-02-26")], "rank string, showTm string, openDt string")
    out = bo.cast_boxoffice(df)
    assert dict(out.dtypes) == {"rank": "int", "showTm": "int", "openDt": "date"}


def test_d12_genre_day_bound_on_boxoffice_date(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 18), "A", "드라마,액션", 1, 1, None),
                                (dt.date(2025, 3, 19), "B", "드라마", 1, 1, None)],
                               "boxoffice_date date, movieNm string, genreNm string, salesAmt long, audiCnt int, openDt date")
    g = bo.genre_explode(inc.date_bound(df, df.columns, "2025-03-19", date_col="boxoffice_date"))
    assert [(r.movieNm, r.genre) for r in g.collect()] == [("B", "드라마")]


def test_d18_sentiment_labels_and_raw_label(spark):
    df = raw(spark, [("m", "1", "최고 감동 연기", None, "2025.03.19", "p", None),
                     ("m", "2", "최악 지루 실망", None, "2025.03.19", "p", None)])
    out = {r.id: (r.raw_label, r.sentiment) for r in se.score_lexicon(clean_reviews(df, min_len=1)).collect()}
    assert out == {"1": ("LABEL_1", "positive"), "2": ("LABEL_0", "negative")}
    ko = spark.createDataFrame([("LABEL_0",), ("LABEL_1",), ("LABEL_9",)], "x string")
    assert [r.y for r in ko.select(se.value_map("x", se.LABELS_KO).alias("y")).collect()] == ["부정", "긍정", None]


def test_d19_regional_charts_without_open_day_do_not_feed_the_list(spark):
    daily = spark.createDataFrame([(" A ", "2025-02-26")], "movieNm string, openDt string")
    regional = spark.createDataFrame([("B", "0105001000")], "movieNm string, region_code string")
    assert [tuple(r) for r in bo.movie_list([daily, regional]).collect()] == [("A", "2025-02-26")]


def test_d20_total_order_in_dedup(spark):
    df = raw(spark, [("m", "1", "같은 리뷰 텍스트입니다", "4", "2025.03.19", "b", None),
                     ("m", "1", "같은 리뷰 텍스트입니다", "4", "2025.03.19", "a", None)])
    assert [r.platform for r in clean_reviews(df.repartition(2)).collect()] == ["a"]


def test_d23_blank_genres_dropped(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 19), "A", "드라마, ,액션,", 1, 1, None),
                                (dt.date(2025, 3, 19), "B", None, 1, 1, None)],
                               "boxoffice_date date, movieNm string, genreNm string, salesAmt long, audiCnt int, openDt date")
    assert sorted(r.genre for r in bo.genre_explode(df).collect()) == ["드라마", "액션"]


def test_d15_latest_day_uses_the_column_present(spark):
    stored = raw(spark, [("m", "1", "t", None, "2025.03.18", "p", None), ("m", "2", "t", None, "bad", "p", None)])
    new = raw(spark, [("m", "3", "t", None, "2025.03.18", "p", None), ("m", "4", "t", None, "2025.03.19", "p", None),
                      ("m", "5", "t", None, None, "p", None), ("n", "6", "t", None, "2025.01.01", "p", None)])
    kept = inc.new_since_latest(new, inc.latest_per_movie(stored))
    assert sorted(r.id for r in kept.collect()) == ["4", "5", "6"]


def test_d28_filters_before_dedup(spark):
    df = raw(spark, [("m", "1", "같은 리뷰 텍스트입니다", "9", "2025.03.18", "p", None),
                     ("m", "1", "같은 리뷰 텍스트입니다", "4", "2025.03.19", "p", None)])
    got = clean_reviews(df).collect()
    assert [(r.star, r.date) for r in got] == [(4.0, dt.date(2025, 3, 19))]


def test_pace_days_active_at_least_one(spark):
    df = raw(spark, [("m", "1", "리뷰 텍스트 하나입니다", None, "2025.03.19", "p", None)])
    r = review_pace(clean_reviews(df)).first()
    assert (r.days_active, r.avg_reviews_per_day) == (1, 1.0)


def test_reviews_of_one_reviewer_stay_apart(spark):
    """A reviewer's id is no review key: scores and word counts are per review."""
    df = raw(spark, [("A", "u1", "최고 최고 감동 입니다 정말로", None, "2025.03.18", "p", None),
                     ("A", "u1", "지루 최악 실망 이었습니다 정말", None, "2025.03.18", "p", None),
                     ("A", "u1", "최고 연기 였다고 생각합니다", None, "2025.03.18", "p", None)])
    cleaned = clean_reviews(df)
    literal = {r.context: r.score for r in se.score_lexicon(cleaned).collect()}
    lexicon = spark.createDataFrame([(w, x) for w, x, _ in se.LEXICON_KO], "word string, weight int")
    table = se.score_lexicon_table(cleaned, lexicon)
    assert {r.context: r.score for r in table.collect()} == literal
    assert sorted(literal.values()) == [-6, 3, 6]
    words = se.sentiment_words(table)
    assert sorted(r["count"] for r in words.where("word = '최고'").collect()) == [1, 2]


def test_a_review_is_keyed_once_not_once_a_word(spark):
    """The digest of a text stands below the explode of its words; above it, it is taken again for every word."""
    df = raw(spark, [("A", "u1", "최고 감동 입니다 정말로", None, "2025.03.18", "p", None)])
    lexicon = spark.createDataFrame([("최고", 2)], "word string, weight int")
    scored = se.score_lexicon_table(clean_reviews(df), lexicon)
    plan = scored._jdf.queryExecution().optimizedPlan().toString().splitlines()
    above = [plan[i - 1] for i, line in enumerate(plan) if "Generate explode" in line]
    assert above and not any("sha2(" in line for line in above)
    assert [r.score for r in scored.collect()] == [2]


def test_trained_models_read_hangul(spark):
    rows = [("최고 감동 영화 추천", 1), ("감동 최고 연기 추천", 1), ("최악 지루 영화 실망", 0), ("지루 실망 최악 별로", 0)]
    labelled = spark.createDataFrame(rows, "context string, label int")
    df = spark.createDataFrame([("A", "u1", "감동 최고 였어요 추천", "p", dt.date(2025, 3, 18)), ("A", "u2", "최악 실망 지루 했어요", "p", dt.date(2025, 3, 18))],
                               "movieNm string, id string, context string, platform string, date date")
    want = {"u1": "positive", "u2": "negative"}
    assert {r.id: r.sentiment for r in se.score_model(df, se.fit_sentiment_model(labelled)).collect()} == want
    assert {r.id: r.sentiment for r in se.score_lexicon_table(df, se.fit_naive_bayes(labelled)).collect()} == want


def test_checkpoint_dir_must_be_shared_off_local_mode():
    from types import SimpleNamespace

    from reviewlake.session import checkpoint_dir

    away = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(away)


def test_narrow_clean_keeps_the_same_rows(spark):
    rows = [("m", "1", "같은 리뷰 텍스트입니다", "4", "2025.03.19", "p", "a"), ("m", "1", "같은 리뷰 텍스트입니다", "3", "2025.03.18", "q", "b"),
            ("m", None, "같은 리뷰 텍스트입니다", None, None, "q", "b"), ("m", None, "같은 리뷰 텍스트입니다", None, None, "p", None),
            ("n", "1", "다른 리뷰 텍스트입니다", "5", "2025.03.18", "p", None)]
    cols = ["movieNm", "id", "star", "date", "platform"]
    whole = sorted(map(str, clean_reviews(raw(spark, rows)).select(*cols).collect()))
    narrow = clean_reviews(raw(spark, rows), columns=cols)
    assert sorted(map(str, narrow.select(*cols).collect())) == whole and len(whole) == 3
    assert narrow.columns == cols


def test_f7_any_null_rows_dropped_before_scoring(spark):
    df = raw(spark, [("m", "1", "최고 감동", None, None, "p", None), (None, "2", "최고 감동", None, "2025.03.19", "p", None)])
    assert se.review_inputs(df.withColumn("date", F.col("date"))).count() == 0


def test_d25_star_scale_per_source(spark):
    experts = spark.createDataFrame([("expert", "critic", "평론가 리뷰 텍스트입니다", "8", "", "T"),
                                     ("expert", "other", "평론가 리뷰 텍스트입니다", "별점없음", "", "T")],
                                    "who string, name string, context string, star string, date string, t string")
    out = {r.id: r.star for r in normalize_platform(experts, "cine", title_col="t", who="expert",
                                                     star_divisor=2).collect()}
    assert out == {"critic": "4.0", "other": None}


def test_stem_counts_go_through_the_texts_once(spark):
    """What follows the words' counts reads the counts, not the texts again."""
    from reviewlake.operators.stems import stem_keywords

    df = raw(spark, [("A", "u1", "영화관에서 영화관을 영화관은", None, "2025.03.18", "p", None), ("B", "u2", "영화관에서", None, "2025.03.18", "p", None)])
    got = stem_keywords(df)
    assert "Generate explode(split" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sum(r["count"] for r in got.collect()) == 4


def test_word_counts_of_a_review_need_no_group_by_word(spark):
    """Words are counted inside their review; equal reviews add up, and a part-of-speech table keeps the columns."""
    cols = "movieNm string, id string, context string, platform string, date date, sentiment string"
    day = dt.date(2025, 3, 18)
    rows = [("A", "u1", "최고 최고 감동", "p", day, "positive")] * 2 + [("A", "u1", "최고", "p", day, "positive"), ("A", None, "감동", None, day, None)]
    scored = spark.createDataFrame(rows, cols)
    words = se.sentiment_words(scored)
    plan = words._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("word#" in line for line in plan if "Aggregate [" in line)
    assert words.columns == ["movieNm", "platform", "date", "sentiment", "word", "count"]
    assert sorted((r.word, r["count"]) for r in words.collect()) == [("감동", 1), ("감동", 2), ("최고", 1), ("최고", 4)]
    nouns = spark.createDataFrame([("감동", "Noun")], "word string, pos string")
    kept = se.sentiment_words(scored, pos_lexicon=nouns)
    assert kept.columns == words.columns and sorted(r["count"] for r in kept.collect()) == [1, 2]


def test_a_fitted_lexicon_knows_its_size(spark):
    """The lexicon is written once, so a small one is broadcast to the texts' words, which then need no shuffle."""
    labelled = spark.createDataFrame([("최고 연기", 1), ("지루 연기", 0)], "context string, label int")
    df = spark.createDataFrame([("m", "최고 최고", "p", "2024-01-01", "1")], "movieNm string, context string, platform string, date string, id string")
    scored = se.score_lexicon_table(df, se.fit_naive_bayes(labelled))
    plan = scored._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin [word" in plan and "SortMergeJoin [word" not in plan
    assert [r.sentiment for r in scored.collect()] == ["positive"]


def test_a_join_deals_its_rows_over_tasks_of_bounded_size(spark, monkeypatch):
    """The rows of a join's task do not grow with the tables; small tables are left to the planner."""
    from reviewlake.sources import testdata as td

    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) + 3
    big = spark.range(parts * 10).select(F.col("id").alias("a"), F.lit(None).cast("long").alias("x")).unionByName(spark.sql("SELECT 1L AS a, 2L AS x"))
    small = spark.range(20).select(F.col("id").alias("b"))
    assert td.spread_join(big, "a", small, "b") == (big, small)
    monkeypatch.setattr(td, "JOIN_ROWS", 10)
    left, right = td.spread_join(big, "a", small, "b")
    assert left.rdd.getNumPartitions() == right.rdd.getNumPartitions() == parts
    assert sorted(r.a for r in left.join(right, left.a == right.b).collect()) == sorted([1, *range(20)])


def test_charts_are_joined_by_dealt_rows(spark, tmp_path, monkeypatch):
    from reviewlake.sources import testdata as td

    path = str(tmp_path)
    spark.sql("SELECT id AS o_orderkey, timestamp'1996-04-05' AS o_orderdate, 10.5D AS o_totalprice FROM range(5)").write.parquet(path + "/orders.parquet")
    spark.sql("SELECT id % 6 AS l_orderkey, id AS l_partkey, 3L AS l_suppkey, cast(id % 7 + 1 AS int) AS l_linenumber, 4D AS l_quantity, 7.5D AS l_extendedprice, "
              "0.1D AS l_discount, 0.2D AS l_tax FROM range(400)").write.parquet(path + "/lineitem.parquet")
    want = sorted(td.raw_chart_strings(spark, path).collect())
    monkeypatch.setattr(td, "JOIN_ROWS", 1)
    rows = td.raw_chart_strings(spark, path)
    assert rows._jdf.queryExecution().analyzed().toString().count("RepartitionByExpression") == 2
    assert len(want) == 334 and sorted(rows.collect()) == want
