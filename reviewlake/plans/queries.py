"""The registered queries: each ``(spark, sf_dir) -> DataFrame``.

Each query is the library's operator chain over the driver's test tables,
mapped onto films and reviews by ``sources.testdata``. Names follow
SURVEY §7.4; ``plans.oracle`` holds the same query in DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions.casts import to_star
from reviewlake.functions.dates import parse_review_date, relative_to_date_text
from reviewlake.functions.tags import clean_tags, parse_tags
from reviewlake.functions.text import STOPWORDS_KO, STOPWORDS_LATIN
from reviewlake.operators import boxoffice as bo
from reviewlake.operators import incremental as inc
from reviewlake.operators import keywords as kw
from reviewlake.operators import metrics as m
from reviewlake.operators import sentiment as se
from reviewlake.operators.clean import clean_reviews, distinct_rows, keep_first
from reviewlake.operators.matching import candidate_match
from reviewlake.operators.unify import normalize_platform, union_platforms
from reviewlake.plans import landing
from reviewlake.sources import testdata as td
from reviewlake.sources.pages import extract_reviews

# Fixed parameters of the registered queries.
TAG_PLATFORM = "PROMO"            # A4: the one platform with tags
STORED_BEFORE = "2024-01-16"      # A15/J3: reviews stored before this day
NEW_SINCE = "2024-01-10"          # J3/S22: the new batch starts here
EXISTING_BEFORE = "2024-01-20"    # S22: the existing file holds days before this
DATE_BOUND = "2024-01-20"         # S11/F6: lower bound of the bounded scan
AS_OF = "2024-02-01 00:30:00"     # C19: crawl clock (just after midnight)
CHART_DAY = "1996-06-01"          # J2: the chart day that picks films
MERGE_KEYS = ("id", "context", "date")

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------ reviews (events)
def _typed_raw(spark, d):
    rt = td.reviews_rt(spark, d)
    return rt.select("movieNm", "id", "platform", to_star("star").alias("star"),
                     parse_review_date("date").alias("date"))


#: What the metrics read of a review; the text stays out of their shuffles.
NARROW = ("movieNm", "id", "star", "date", "platform")


def _cleaned_rt(spark, d, columns=NARROW):
    return clean_reviews(td.reviews_rt(spark, d), columns=columns)


def _cleaned_tx(spark, d):
    return clean_reviews(td.reviews_tx(spark, d))


def unify_platforms(spark, d):
    ev = td.table(spark, d, "events")
    mega = ev.select(
        F.col("user_id").cast("string").alias("ID"),
        F.concat_ws(" ", "event_type", "props").alias("context"),
        F.format_string("%.4f", F.col("value") / 20).alias("rating"),
        F.date_format("ts", "yyyy.MM.dd").alias("review_date"),
        F.lit(None).cast("string").alias("recommend_tags"),
        F.concat(F.lit("movie_"), (F.col("user_id") % 20).cast("string")).alias("title"),
    )
    doc = td.table(spark, d, "documents").select(
        F.when(F.col("doc_id") % 5 == 0, F.lit("expert")).otherwise(F.lit("netizen")).alias("who"),
        F.col("doc_id").cast("string").alias("name"),
        F.col("text").alias("context"),
        F.col("source").alias("title"),
    )
    return union_platforms([
        normalize_platform(mega, "megabox", title_col="title"),
        normalize_platform(doc, "cine", title_col="title"),
    ])


def clean_reviews_q(spark, d):
    return _cleaned_rt(spark, d, None)


def dedup_keys(spark, d):
    docs = td.table(spark, d, "documents").select("lang", "text", "doc_id", "source")
    kept = keep_first(docs, ["lang", "text"], order=["doc_id"], digest=["text"])
    return kept.select("lang", "doc_id", "source", F.length("text").alias("n_chars"))


def distinct_rows_q(spark, d):
    tx = td.reviews_tx(spark, d).select("platform", "context")
    return distinct_rows(tx).select("platform", F.md5("context").alias("text_md5"),
                                    F.length("context").alias("n_chars"))


def platform_rating(spark, d):
    return m.platform_rating(_typed_raw(spark, d))


def daily_counts(spark, d):
    return m.daily_counts(_typed_raw(spark, d))


def movie_platform_counts(spark, d):
    return m.movie_platform_counts(_typed_raw(spark, d))


def platform_summary(spark, d):
    return m.platform_summary(_cleaned_rt(spark, d))


def movie_counts(spark, d):
    return m.movie_counts(_cleaned_rt(spark, d))


def review_pace(spark, d):
    return m.review_pace(_cleaned_rt(spark, d))


def rating_summary(spark, d):
    return m.rating_summary(_cleaned_rt(spark, d))


def movie_summary(spark, d):
    return m.movie_summary(_cleaned_rt(spark, d))


def rating_histogram(spark, d):
    return m.rating_histogram(_cleaned_rt(spark, d))


def movie_trend(spark, d):
    return m.movie_trend(_cleaned_rt(spark, d))


def movie_card(spark, d):
    return m.movie_card(_cleaned_rt(spark, d))


def platform_share(spark, d):
    return m.platform_share(_cleaned_rt(spark, d))


def star_distribution(spark, d):
    return m.star_distribution(_cleaned_rt(spark, d))


def review_texts(spark, d):
    return m.review_texts(_cleaned_rt(spark, d, None))


def top_movies_report(spark, d):
    """O3: the ten most reviewed films (the limit is the report)."""
    return m.top_rows(m.movie_counts(_cleaned_rt(spark, d)), 10, F.desc("review_count"), F.asc("movieNm"))


# ------------------------------------------------------------ tags (part)
def tag_counts(spark, d):
    return kw.tag_counts(td.tag_reviews(spark, d))


def tag_counts_by_movie(spark, d):
    return kw.tag_counts_by_movie(td.tag_reviews(spark, d))


def platform_tag_counts(spark, d):
    return kw.platform_tag_counts(td.tag_reviews(spark, d), TAG_PLATFORM)


def clean_tags_q(spark, d):
    raw = td.raw_tags_with_noise(spark, d)
    tags = clean_tags(parse_tags("recommend_tags"))
    return raw.select("id", "movieNm", F.array_join(tags, "|").alias("tags"), F.size(tags).alias("n_tags"))


# ------------------------------------------------------------ keywords (documents)
def movie_keywords(spark, d):
    return kw.movie_keywords(_cleaned_tx(spark, d), charset="latin", stopwords=STOPWORDS_LATIN)


def movie_keywords_hangul(spark, d):
    """A5 in Hangul (syllables only, the daily rule)."""
    return kw.movie_keywords(clean_reviews(td.reviews_ko(spark, d)), "hangul", STOPWORDS_KO)


def movie_keywords_hangul_jamo(spark, d):
    """A5 in Hangul (syllables and jamo, the batch rule)."""
    return kw.movie_keywords(clean_reviews(td.reviews_ko(spark, d)), "hangul+jamo", STOPWORDS_KO)


def stopword_antijoin(spark, d):
    words = kw.tokens(td.reviews_tx(spark, d), charset="latin", stopwords=(), keep=("platform",))
    stop = spark.createDataFrame([(w,) for w in STOPWORDS_LATIN], "word string")
    return kw.drop_stopwords(words, stop).groupBy("platform", "word").agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------------ box office
def cast_boxoffice(spark, d):
    return bo.cast_boxoffice(td.raw_chart_strings(spark, d))


def genre_explode(spark, d):
    return bo.genre_explode(td.boxoffice_rows(spark, d))


def movie_list(spark, d):
    daily = td.boxoffice_rows(spark, d)
    regional = td.region_chart_rows(spark, d)  # no openDt: does not feed the list (SURVEY D19)
    return bo.movie_list([daily, regional])


def movies_to_collect(spark, d):
    films, _ = td.search_hits(spark, d)
    charts = td.boxoffice_rows(spark, d).where(F.col("boxoffice_date") == F.lit(CHART_DAY).cast("date"))
    return bo.movies_to_collect(films, charts)


def _region_rows(spark, d):
    return bo.region_attach(td.region_chart_rows(spark, d), td.region_codes(spark, d))


def region_attach(spark, d):
    return _region_rows(spark, d)


def monthly_sales(spark, d):
    return bo.monthly_sales(td.boxoffice_rows(spark, d))


def yoy_sales(spark, d):
    return bo.yoy_sales(bo.monthly_sales(td.boxoffice_rows(spark, d)))


def genre_share(spark, d):
    return bo.genre_share(bo.genre_explode(td.boxoffice_rows(spark, d)))


def region_audience(spark, d):
    return bo.region_audience(_region_rows(spark, d))


def region_top10(spark, d):
    return bo.region_top10(_region_rows(spark, d))


# ------------------------------------------------------------ increments
def latest_per_movie(spark, d):
    return inc.latest_per_movie(td.reviews_rt(spark, d, before=STORED_BEFORE))


def new_since_latest(spark, d):
    latest = inc.latest_per_movie(td.reviews_rt(spark, d, before=STORED_BEFORE))
    return inc.new_since_latest(td.reviews_rt(spark, d, since=NEW_SINCE), latest)


def merge_append(spark, d):
    existing = td.reviews_rt(spark, d, before=EXISTING_BEFORE)
    new = td.reviews_rt(spark, d, since=NEW_SINCE)
    return inc.merge_append(existing, new, MERGE_KEYS)


def date_bound_scan(spark, d):
    ev = td.table(spark, d, "events")
    out = inc.date_bound(ev, ["event_id", "user_id", "event_type", "ts"], DATE_BOUND, date_col="ts")
    return out.select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("date"))


def relative_dates(spark, d):
    ev = td.table(spark, d, "events")
    k = F.col("event_id") % 7
    txt = (F.when(k == 0, F.concat((F.col("event_id") % 60).cast("string"), F.lit("분전")))
           .when(k == 1, F.concat((F.col("event_id") % 24).cast("string"), F.lit("시간전")))
           .when(k == 2, F.concat((F.col("event_id") % 30).cast("string"), F.lit("일전")))
           .when(k == 3, F.lit("방금"))
           .when(k == 4, F.lit("하루전"))
           .when(k == 5, F.date_format("ts", "yyyy.MM.dd"))
           .otherwise(F.lit("어제쯤")))
    out = ev.select("event_id", txt.alias("rel_text"))
    day_text = relative_to_date_text("rel_text", AS_OF)
    return out.select("event_id", "rel_text", day_text.alias("review_date"),
                      parse_review_date(day_text).alias("date"))


# Fixed parameter: event types mapped to display names ('error' left unmapped).
EVENT_NAMES = {"click": "클릭", "view": "조회", "purchase": "구매", "signup": "가입"}


def value_map_q(spark, d):
    ev = td.table(spark, d, "events")
    return ev.select("event_id", "event_type", se.value_map("event_type", EVENT_NAMES).alias("label"))


# ------------------------------------------------------------ sentiment (documents)
def _scored(spark, d):
    return se.score_lexicon(_cleaned_tx(spark, d), se.LEXICON_LATIN, "latin")


def sentiment_lexicon(spark, d):
    return _scored(spark, d).select("id", "movieNm", "platform", "date", "score", "raw_label", "sentiment")


# A lexicon over words that the reviews of repeated reviewers hold, and over Hangul spellings.
LEXICON_EVENTS = [("click", 1), ("view", 2), ("error", -3), ("purchase", 4), ("k", -1)]
LEXICON_HANGUL = [("러사마", 1), ("카너", -1), ("가카라", 2), ("하바", -2), ("라마", 3), ("파가", -1)]


def sentiment_table(spark, d):
    """U1(a), lexicon table, over reviews whose reviewers repeat."""
    lexicon = spark.createDataFrame(LEXICON_EVENTS, "word string, weight int")
    out = se.score_lexicon_table(_cleaned_rt(spark, d, None), lexicon, "latin")
    return out.select("id", "movieNm", "platform", "date", "context", "score", "sentiment")


def sentiment_words_reviews(spark, d):
    """A20 over reviews whose reviewers repeat."""
    lexicon = spark.createDataFrame(LEXICON_EVENTS, "word string, weight int")
    return se.sentiment_words(se.score_lexicon_table(_cleaned_rt(spark, d, None), lexicon, "latin"), "latin", STOPWORDS_LATIN)


def sentiment_lexicon_hangul(spark, d):
    """U1(a) in Hangul."""
    out = se.score_lexicon(clean_reviews(td.reviews_ko(spark, d)), LEXICON_HANGUL, "hangul")
    return out.select("id", "movieNm", "platform", "date", "score", "raw_label", "sentiment")


def sentiment_nb(spark, d):
    """U1(b), exact form: naive Bayes learnt from the labelled documents, scored as a lexicon table."""
    labelled = (td.table(spark, d, "documents").join(td.table(spark, d, "labels"), "doc_id")
                .select(F.col("text").alias("context"), F.col("quality").alias("label")))
    out = se.score_lexicon_table(_cleaned_tx(spark, d), se.fit_naive_bayes(labelled, charset="latin"), "latin")
    return out.select("id", "movieNm", "platform", "date", "raw_label", "sentiment")


def sentiment_words(spark, d):
    return se.sentiment_words(_scored(spark, d), "latin", STOPWORDS_LATIN)


def sentiment_top10(spark, d):
    return se.sentiment_top10(_scored(spark, d), 10, "latin", STOPWORDS_LATIN)


def sentiment_by_platform(spark, d):
    return se.sentiment_by_platform(_scored(spark, d))


def sentiment_by_day(spark, d):
    return se.sentiment_by_day(_scored(spark, d))


def sentiment_platform_counts(spark, d):
    return se.sentiment_platform_counts(_scored(spark, d))


def sentiment_plugin(spark, d):
    out = se.score_with_plugin(_cleaned_tx(spark, d), se.pandas_lexicon_scorer(se.LEXICON_LATIN, "latin"))
    return out.select("id", "movieNm", "platform", "date", "raw_label", "sentiment")


def sentiment_ml(spark, d):
    labelled = (td.table(spark, d, "documents").join(td.table(spark, d, "labels"), "doc_id")
                .select(F.col("text").alias("context"), F.col("quality").alias("label")))
    model = se.fit_sentiment_model(labelled, charset="latin")
    return se.score_model(_cleaned_tx(spark, d), model, "latin").select("id", "movieNm", "platform", "date", "raw_label",
                                                               "sentiment")


# ------------------------------------------------------------ files and tables
LOAD_DAY, NEXT_DAY, EMPTY_DAY = "2024-02-01", "2024-02-02", "2024-02-03"


def _scratch(spark, tag):
    import os
    import uuid

    from reviewlake.session import checkpoint_dir

    return os.path.join(checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex[:12]}")


def file_ingest(spark, d):
    """S21 then S1/S5: whole documents as review rows written through the CSV
    sink (quotes, line breaks) and read back with the explicit-schema reader."""
    from reviewlake.operators.unify import RAW_COLUMNS
    from reviewlake.sources.files import read_csv
    from reviewlake.sources.schemas import strings
    from reviewlake.sources.sinks import write_csv

    out = _scratch(spark, "file-ingest")
    write_csv(td.reviews_tx(spark, d), out)
    return read_csv(spark, out, strings(*RAW_COLUMNS), glob="*.csv")


def api_json_ingest(spark, d):
    """Chart rows landed as API responses (one response per line, one
    entry each) and read back through the strict nested reader."""
    from reviewlake.sources.files import read_boxoffice_json
    from reviewlake.sources.schemas import BOXOFFICE_FIELDS

    raw = td.raw_chart_strings(spark, d)
    day = F.regexp_replace("openDt", "-", "")
    doc = F.to_json(F.struct(F.struct(
        F.concat(day, F.lit("~"), day).alias("showRange"),
        F.array(F.struct(*[F.col(c) for c in BOXOFFICE_FIELDS])).alias("dailyBoxOfficeList"),
    ).alias("boxOfficeResult")))
    out = _scratch(spark, "api-json")
    raw.select(doc.alias("value")).write.mode("overwrite").text(out, compression=landing.LANDED)
    return read_boxoffice_json(spark, out, multi_line=False)


def region_json_ingest(spark, d):
    """Regional chart rows landed as region-stamped API responses (one
    per line) and read back through the lenient reader."""
    from reviewlake.sources.files import read_region_json
    from reviewlake.sources.schemas import REGION_FIELDS

    raw = td.raw_region_strings(spark, d)
    entry = F.struct(*[F.col(c) for c in REGION_FIELDS if c not in ("region_code", "region_name")])
    doc = F.to_json(F.struct(
        "region_code", "region_name",
        F.struct(F.struct(F.concat("day", F.lit("~"), "day").alias("showRange"),
                          F.array(entry).alias("dailyBoxOfficeList")).alias("boxOfficeResult")).alias("data"),
    ))
    out = _scratch(spark, "region-json")
    raw.select(doc.alias("value")).write.mode("overwrite").text(out, compression=landing.LANDED)
    return read_region_json(spark, out, multi_line=False)


def table_sinks(spark, d):
    """The cleaned reviews appended twice for the same load day to a
    day-partitioned folder; the rerun replaces the day instead of adding."""
    from reviewlake.sources.sinks import append_day

    out = _scratch(spark, "table-sinks")
    cleaned = _cleaned_rt(spark, d, None).persist()
    append_day(cleaned, out, LOAD_DAY)
    append_day(cleaned, out, LOAD_DAY)
    cleaned.unpersist()
    return spark.read.parquet(out)


def append_day_rerun(spark, d):
    """A rerun with fewer rows and a rerun with none replace their day; the other days stay."""
    from reviewlake.sources.sinks import append_day

    out = _scratch(spark, "append-day-rerun")
    cleaned = _cleaned_rt(spark, d, None).persist()
    for day, kept in ((LOAD_DAY, "true"), (LOAD_DAY, "star >= 2"), (NEXT_DAY, "star < 2"), (EMPTY_DAY, "star < 2"), (EMPTY_DAY, "false")):
        append_day(cleaned.where(kept), out, day)
    cleaned.unpersist()
    return spark.read.parquet(out)


def daily_keywords(spark, d):
    """C20 + S11 + A5 + S19: the daily keyword job over two days, the second of them run twice."""
    from reviewlake.plans.jobs import review_analysis_daily_job

    cleaned, out = _scratch(spark, "daily-cleaned"), _scratch(spark, "daily-keywords")
    _cleaned_tx(spark, d).write.parquet(cleaned)
    for run_date in ("2024-01-06", "2024-01-07", "2024-01-07"):
        paths = review_analysis_daily_job(spark, cleaned, out, run_date, charset="latin", stopwords=STOPWORDS_LATIN,
                                          lexicon=se.LEXICON_LATIN, tag_platform="en")
    return spark.read.parquet(paths["daily_keywords"])


def file_titles(spark, d):
    """C1 + C2 + C3: titles and days from review file names, dated and not, with escapes, brackets and a lone percent sign."""
    from reviewlake.functions.files import day_in_review_file, title_from_file

    k = F.col("doc_id") % 4
    tail = F.when(k == 0, "%20%5BIMAX%5D").when(k == 1, "+1").when(k == 2, " 100%").otherwise("_2")
    name = F.concat(F.lit("Film "), "source", tail, F.when(F.col("doc_id") % 3 > 0, "_20240115").otherwise(""), F.lit("_megabox_reviews.csv"))
    docs = td.table(spark, d, "documents").select("doc_id", name.alias("name"))
    return docs.select("doc_id", title_from_file("name", "megabox").alias("title"), day_in_review_file("name", "megabox").alias("day"))


def expert_reviews(spark, d):
    """F17 + C21: one kind of reviewer only, ten-point stars halved."""
    doc = td.table(spark, d, "documents").select(
        F.when(F.col("doc_id") % 5 == 0, F.lit("expert")).otherwise(F.lit("netizen")).alias("who"),
        F.col("doc_id").cast("string").alias("name"), F.md5("text").alias("context"), F.col("source").alias("title"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("none yet")).otherwise((F.col("doc_id") % 11).cast("string")).alias("star"))
    return normalize_platform(doc, "cine", title_col="title", who="expert", star_divisor=2)


def pos_words(spark, d):
    """F16: words of allowed parts of speech per film."""
    words = kw.tokens(_cleaned_tx(spark, d), charset="latin", stopwords=())
    pos = spark.createDataFrame([(w, p) for w, _, p in se.LEXICON_LATIN], "word string, pos string")
    return se.pos_filter(words, pos, ("Noun", "Verb")).groupBy("movieNm", "word").agg(F.count(F.lit(1)).alias("count"))


def chart_union(spark, d):
    """A18 + U-3: films of two charts that both carry an opening day and overlap."""
    daily = td.boxoffice_rows(spark, d)
    other = daily.where("audiCnt >= 25").select(F.concat(F.lit(" "), "movieNm", F.lit("\t")).alias("movieNm"),
                                                F.date_add("openDt", F.col("audiCnt") % 3).alias("openDt"))
    return bo.movie_list([daily, other])


def csv_table(spark, d):
    """S20 + S21 + S2: a table through the CSV sink and back by an explicit schema."""
    from reviewlake.sources.files import read_csv_table
    from reviewlake.sources.sinks import write_csv

    out = _scratch(spark, "csv-table")
    part = td.table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    write_csv(part, out)
    return read_csv_table(spark, out, part.schema)


def region_cast(spark, d):
    """P11, regional half."""
    return bo.cast_region_boxoffice(td.raw_region_strings(spark, d))


def date_parts(spark, d):
    """C22 + C23 + C26: year, first token, day."""
    from reviewlake.functions.dates import first_token, to_day, year_of

    ev = td.table(spark, d, "events")
    text = F.concat(F.lit(" \u3000"), F.date_format("ts", "yyyy-MM-dd"), F.lit("\t"), "event_type")
    return ev.select("event_id", first_token(text).alias("first"), year_of(first_token(text)).alias("year"), to_day("ts").alias("day"))


# ------------------------------------------------------------ streaming (events)
# Fixed parameters of the drops: late by more than a year, dateless, and repeated events.
LATE, DATELESS, REPEATED = "event_id % 50 = 7", "event_id % 97 = 5", "event_id % 10 = 0"


def _drops(spark, d):
    """Three landings of the events as reviews: some very late, some without a day, some landed again."""
    ev = td.table(spark, d, "events")
    ts = (F.when(F.expr(DATELESS), F.lit(None).cast("timestamp_ntz"))
          .when(F.expr(LATE), F.col("ts") - F.expr("interval 400 days")).otherwise(F.col("ts")))
    ev = ev.withColumn("ts", ts)
    part = lambda cond: td.reviews_from_events(ev.where(cond)).select("movieNm", "id", "context", "date")
    return [part("event_id % 3 = 0"), part("event_id % 3 = 1"), part("event_id % 3 = 2").unionByName(part(REPEATED))]


def _stream_drops(spark, d, tag, prepare, **how):
    """Lands the drops one by one and runs the stream after each; returns the table behind the last run."""
    from reviewlake.streaming.daily import parquet_stream, run_to_table, with_review_day

    land, out, ckpt = (_scratch(spark, f"{tag}-{x}") for x in ("land", "table", "ckpt"))
    for drop in _drops(spark, d):
        drop.write.mode("append").parquet(land)
        stream = prepare(with_review_day(parquet_stream(spark, land, drop.schema)))
        result = run_to_table(spark, stream, out, ckpt, **how)
    return result


def stream_daily_counts(spark, d):
    """R1 + R3: reviews per film and day over three landings."""
    return _stream_drops(spark, d, "daily-counts", lambda s: s, mode="counts")


def stream_dedup(spark, d):
    """R1 + R2 + R4: distinct review keys over three landings, merged by key and day."""
    return _stream_drops(spark, d, "dedup", lambda s: s.select("id", "context", "review_date"), mode="upsert",
                         keys=("id", "context", "review_date"), partition_col="review_date")


# ------------------------------------------------------------ pages, matching
def page_extract(spark, d):
    return extract_reviews(td.table(spark, d, "pages"))


def candidate_match_q(spark, d):
    films, hits = td.search_hits(spark, d)
    return candidate_match(films, hits)


QUERIES: dict[str, Query] = {
    **landing.QUERIES,
    "unify_platforms": unify_platforms,
    "clean_reviews": clean_reviews_q,
    "dedup_keys": dedup_keys,
    "distinct_rows": distinct_rows_q,
    "platform_rating": platform_rating,
    "daily_counts": daily_counts,
    "movie_platform_counts": movie_platform_counts,
    "platform_summary": platform_summary,
    "movie_counts": movie_counts,
    "review_pace": review_pace,
    "rating_summary": rating_summary,
    "movie_summary": movie_summary,
    "rating_histogram": rating_histogram,
    "movie_trend": movie_trend,
    "movie_card": movie_card,
    "platform_share": platform_share,
    "star_distribution": star_distribution,
    "review_texts": review_texts,
    "top_movies_report": top_movies_report,
    "tag_counts": tag_counts,
    "tag_counts_by_movie": tag_counts_by_movie,
    "platform_tag_counts": platform_tag_counts,
    "clean_tags": clean_tags_q,
    "movie_keywords": movie_keywords,
    "movie_keywords_hangul": movie_keywords_hangul,
    "movie_keywords_hangul_jamo": movie_keywords_hangul_jamo,
    "sentiment_table": sentiment_table,
    "sentiment_words_reviews": sentiment_words_reviews,
    "sentiment_lexicon_hangul": sentiment_lexicon_hangul,
    "sentiment_nb": sentiment_nb,
    "append_day_rerun": append_day_rerun,
    "daily_keywords": daily_keywords,
    "file_titles": file_titles,
    "expert_reviews": expert_reviews,
    "pos_words": pos_words,
    "chart_union": chart_union,
    "csv_table": csv_table,
    "region_cast": region_cast,
    "date_parts": date_parts,
    "stopword_antijoin": stopword_antijoin,
    "cast_boxoffice": cast_boxoffice,
    "genre_explode": genre_explode,
    "movie_list": movie_list,
    "movies_to_collect": movies_to_collect,
    "region_attach": region_attach,
    "monthly_sales": monthly_sales,
    "yoy_sales": yoy_sales,
    "genre_share": genre_share,
    "region_audience": region_audience,
    "region_top10": region_top10,
    "latest_per_movie": latest_per_movie,
    "new_since_latest": new_since_latest,
    "merge_append": merge_append,
    "date_bound_scan": date_bound_scan,
    "relative_dates": relative_dates,
    "value_map": value_map_q,
    "sentiment_lexicon": sentiment_lexicon,
    "sentiment_words": sentiment_words,
    "sentiment_top10": sentiment_top10,
    "sentiment_by_platform": sentiment_by_platform,
    "sentiment_by_day": sentiment_by_day,
    "sentiment_platform_counts": sentiment_platform_counts,
    "sentiment_plugin": sentiment_plugin,
    "sentiment_ml": sentiment_ml,
    "file_ingest": file_ingest,
    "api_json_ingest": api_json_ingest,
    "region_json_ingest": region_json_ingest,
    "table_sinks": table_sinks,
    "stream_daily_counts": stream_daily_counts,
    "stream_dedup": stream_dedup,
    "page_extract": page_extract,
    "candidate_match": candidate_match_q,
}
