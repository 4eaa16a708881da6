"""Properties and plan shapes that matter at scale."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from reviewlake.operators import boxoffice as bo
from reviewlake.operators import incremental as inc
from reviewlake.operators import sentiment as se
from reviewlake.operators.clean import clean_reviews
from reviewlake.operators.skew import keep_first, share_of_group, top_n
from reviewlake.plans import queries as q
from reviewlake.sources import testdata as td
from tests.conftest import SF001, SF01


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_clean_is_idempotent(spark):
    once = clean_reviews(td.reviews_rt(spark, SF001))
    again = clean_reviews(once.withColumn("star", F.col("star").cast("string"))
                          .withColumn("date", F.date_format("date", "yyyy.MM.dd")))
    assert rows(once) == rows(again)


def test_kept_stars_in_range(spark):
    c = clean_reviews(td.reviews_rt(spark, SF01))
    assert c.where(F.col("star").isNotNull() & ~F.col("star").between(0, 5)).count() == 0
    assert c.where(F.length("context") < 10).count() == 0


def test_keep_first_idempotent_and_skew(spark):
    # one key holds a third of the rows
    data = [("hot" if i % 3 == 0 else f"k{i}", i % 7, f"v{i}") for i in range(3000)]
    df = spark.createDataFrame(data, "k string, o int, v string")
    once = keep_first(df, ["k"], ["o"])
    assert rows(keep_first(once, ["k"], ["o"])) == rows(once)
    hot = once.where("k = 'hot'").first()
    assert (hot.o, hot.v) == (0, "v0")
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # map-side combine before the shuffle


def test_merge_append_twice_is_once(spark):
    ex = td.reviews_rt(spark, SF001, before=q.EXISTING_BEFORE)
    new = td.reviews_rt(spark, SF001, since=q.NEW_SINCE)
    once = inc.merge_append(ex, new, q.MERGE_KEYS)
    assert rows(inc.merge_append(once, new, q.MERGE_KEYS)) == rows(once)
    # the append form adds exactly the missing keys
    added = inc.append_new(ex, new, q.MERGE_KEYS)
    assert once.count() == inc.merge_append(ex, ex, q.MERGE_KEYS).count() + added.dropDuplicates(
        list(q.MERGE_KEYS)).count()


def test_shares_sum_to_one(spark):
    g = q.genre_share(spark, SF001)
    sums = g.groupBy("month").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-4 for r in sums)
    p = q.sentiment_by_platform(spark, SF001)
    assert all(abs(r.s - 1) < 1e-4 for r in p.groupBy("platform").agg(F.sum("ratio").alias("s")).collect())


def test_union_count_is_sum_of_parts(spark):
    u = q.unify_platforms(spark, SF001)
    assert u.count() == td.table(spark, SF001, "events").count() + td.table(spark, SF001, "documents").count()


def test_top_n_plans_partial_group_limit(spark):
    per = td.region_chart_rows(spark, SF001).groupBy("region_code", "movieNm").agg(F.sum("audiCnt").alias("a"))
    out = top_n(per, ["region_code"], [F.desc("a"), F.asc("movieNm")], 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert out.groupBy("region_code").count().where("count > 3").count() == 0


def test_date_bound_is_pushed_down(spark):
    ev = td.table(spark, SF001, "events")
    out = inc.date_bound(ev, ["event_id", "ts"], "2024-01-20", "2024-01-25", date_col="ts")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_lexicon_table_path_equals_literal_path(spark):
    cleaned = q._cleaned_tx(spark, SF001)
    lit = se.score_lexicon(cleaned, se.LEXICON_LATIN, "latin").select("id", "score", "sentiment")
    lex = spark.createDataFrame([(w, wt) for w, wt, _ in se.LEXICON_LATIN], "word string, weight int")
    tab = se.score_lexicon_table(cleaned, lex, "latin").select("id", "score", "sentiment")
    assert rows(lit) == rows(tab)


def test_pos_filter(spark):
    words = spark.createDataFrame([("최고",), ("연기",), ("졸려요",), ("그냥",)], "word string")
    pos = spark.createDataFrame([(w, wt, p) for w, wt, p in se.LEXICON_KO], "word string, weight int, pos string")
    kept = {r.word for r in se.pos_filter(words, pos, ("Noun",)).collect()}
    assert kept == {"최고", "연기"}


def test_region_top10_is_total_order(spark):
    a = rows(q.region_top10(spark, SF01))
    b = rows(q.region_top10(spark, SF01))
    assert a == b and len(a) == 50


def test_yoy_has_null_without_prior_year(spark):
    y = q.yoy_sales(spark, SF001).orderBy("month").collect()
    assert y[0].sales_prev_year is None and y[0].yoy_change is None
    assert any(r.sales_prev_year is not None for r in y)


def test_movie_list_skips_charts_without_open_day(spark):
    ml = bo.movie_list([td.region_chart_rows(spark, SF001)] * 1 + [td.boxoffice_rows(spark, SF001)])
    assert ml.count() == td.table(spark, SF001, "part").select("p_brand").distinct().count()


def test_random_partitions_do_not_change_dedup(spark):
    data = [(random.Random(i).choice("abc"), i % 5, str(i)) for i in range(500)]
    df = spark.createDataFrame(data, "k string, o int, v string")
    assert rows(keep_first(df.repartition(7), ["k", "o"])) == rows(keep_first(df.coalesce(1), ["k", "o"]))


def test_share_of_group_columns(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "g string, v long")
    got = {(r.g, r.v): r.share for r in share_of_group(df, ["g"], "v").collect()}
    assert got == {("a", 1): 0.25, ("a", 3): 0.75, ("b", 2): 1.0}


def test_pos_plugin_then_filter(spark):
    words = spark.createDataFrame([("최고",), ("연기",), ("졸려요",), ("그냥",)], "word string")
    verbs = {"졸려요"}

    def make():
        return lambda s: s.map(lambda w: "Verb" if w in verbs else "Noun")

    tagged = se.tag_with_plugin(words, make)
    assert {(r.word, r.pos) for r in tagged.collect()} == {("최고", "Noun"), ("연기", "Noun"), ("졸려요", "Verb"),
                                                           ("그냥", "Noun")}
    kept = {r.word for r in se.pos_filter(words, tagged, ("Verb",)).collect()}
    assert kept == {"졸려요"}


def test_share_of_group_keeps_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("b", 2)], "g string, v long")
    got = sorted((r.g or "", r.v, r.share) for r in share_of_group(df, ["g"], "v").collect())
    assert got == [("", 1, 0.25), ("", 3, 0.75), ("b", 2, 1.0)]


def test_share_of_total_has_no_single_partition_window(spark):
    from reviewlake.operators.skew import share_of_total

    df = spark.createDataFrame([("a", 1), ("b", 3)], "g string, v long")
    out = share_of_total(df, "v")
    assert sorted((r.g, r.share) for r in out.collect()) == [("a", 0.25), ("b", 0.75)]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
