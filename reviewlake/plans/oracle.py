"""DuckDB SQL for every registered query, over the driver's tables.

Built from shared CTE snippets that restate the adapters of
``sources.testdata`` and the rules of the operators in SQL. Types are cast
to Spark's (``INTEGER`` for lengths, row numbers and sizes; ``BIGINT`` for
sums) so schemas compare. ``sentiment_ml`` has no SQL form (a trained
model).
"""

from __future__ import annotations

from reviewlake.functions.text import STOPWORDS_KO, STOPWORDS_LATIN
from reviewlake.operators.sentiment import LEXICON_LATIN
from reviewlake.plans import queries as q
from reviewlake.sources.pages import ENTITIES
from reviewlake.sources.testdata import HANGUL_LETTERS

# RE2 spellings of the Java classes in functions.text.
WS = r"[ \t\n\x0B\f\r\x{00a0}\x{3000}]"
LATIN = r"A-Za-z\x{00c0}-\x{00d6}\x{00d8}-\x{00f6}\x{00f8}-\x{024f}"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def strip_tags(x: str) -> str:
    """Breaks and block ends to line feeds, other tags away, named references decoded, ``&amp;`` last."""
    brk = "(?i)<(?:br|/p|/div|/li|/tr|/h[1-6])(?:[ \\t\\n\\x0B\\f\\r][^>]*|/)?>"
    out = f"regexp_replace(regexp_replace({x}, '{brk}', chr(10), 'g'), '<[^>]*>', '', 'g')"
    for name, char in [*ENTITIES, ("&amp;", "&")]:
        out = f"replace({out}, {sql_list([name])}, {sql_list([char])})"
    return strip(out)


def parse_date(x: str) -> str:
    s = strip(x)
    return f"CAST(coalesce(try_strptime({s}, '%Y.%m.%d'), try_strptime({s}, '%Y-%m-%d')) AS DATE)"


def clean_latin(x: str) -> str:
    inner = f"regexp_replace(coalesce({x}, ''), '[^{LATIN} \\t\\n\\x0B\\f\\r\\x{{00a0}}\\x{{3000}}]', '', 'g')"
    return strip(f"lower({inner})")


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOP = sql_list(STOPWORDS_LATIN)
LEX_VALUES = ", ".join(f"('{w}', {int(wt)})" for w, wt, *_ in LEXICON_LATIN)


def rt(where: str = "") -> str:
    return f"""SELECT 'movie_' || CAST(user_id % 20 AS VARCHAR) AS movieNm,
        CAST(user_id AS VARCHAR) AS id,
        concat_ws(' ', event_type, props) AS context,
        CASE WHEN event_type <> 'view' THEN printf('%.4f', value / 20) END AS star,
        strftime(ts, '%Y.%m.%d') AS date,
        event_type AS platform,
        CAST(NULL AS VARCHAR) AS recommend_tags
    FROM events {where}"""


TX = """SELECT source AS movieNm, CAST(doc_id AS VARCHAR) AS id, text AS context,
        CAST(NULL AS VARCHAR) AS star,
        strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER), '%Y.%m.%d') AS date,
        lang AS platform, CAST(NULL AS VARCHAR) AS recommend_tags
    FROM documents"""


def cleaned_ctes(src: str, name: str = "cleaned") -> str:
    """CTEs ``{name}_t``, ``{name}_f``, ``{name}`` cleaning the CTE ``src``."""
    return f"""{name}_t AS (
    SELECT movieNm, id, {strip('context')} AS context,
           TRY_CAST({strip('star')} AS DOUBLE) AS star, {parse_date('date')} AS date,
           platform, recommend_tags
    FROM {src} WHERE context IS NOT NULL AND length({strip('context')}) > 0),
{name}_f AS (SELECT * FROM {name}_t WHERE length(context) >= 10 AND (star IS NULL OR (star >= 0 AND star <= 5))),
{name} AS (
    SELECT movieNm, id, context, star, date, platform, recommend_tags FROM (
        SELECT *, row_number() OVER (PARTITION BY id, context, movieNm
            ORDER BY date ASC NULLS FIRST, star ASC NULLS FIRST, platform ASC NULLS FIRST,
                     recommend_tags ASC NULLS FIRST) AS rn
        FROM {name}_f) WHERE rn = 1)"""


WITH_CLEAN_RT = f"WITH rt AS ({rt()}),\n{cleaned_ctes('rt')}\n"
WITH_TYPED_RAW = f"""WITH rt AS ({rt()}),
tr AS (SELECT movieNm, id, platform, TRY_CAST({strip('star')} AS DOUBLE) AS star, {parse_date('date')} AS date FROM rt)
"""
WITH_CLEAN_TX = f"WITH tx AS ({TX}),\n{cleaned_ctes('tx')}\n"

SCORED = f"""{WITH_CLEAN_TX.rstrip()},
base AS (SELECT movieNm, context, platform, date, id FROM cleaned
         WHERE movieNm IS NOT NULL AND context IS NOT NULL AND platform IS NOT NULL AND date IS NOT NULL),
lex(word, weight) AS (VALUES {LEX_VALUES}),
sw AS (SELECT id, unnest(string_split_regex({clean_latin('context')}, '{WS}+')) AS w FROM base),
sc AS (SELECT sw.id, sum(lex.weight) AS s FROM sw JOIN lex ON sw.w = lex.word GROUP BY sw.id),
scored AS (
    SELECT b.*, CAST(coalesce(sc.s, 0) AS BIGINT) AS score,
           CASE WHEN coalesce(sc.s, 0) > 0 THEN 'LABEL_1' ELSE 'LABEL_0' END AS raw_label,
           CASE WHEN coalesce(sc.s, 0) > 0 THEN 'positive' ELSE 'negative' END AS sentiment
    FROM base b LEFT JOIN sc ON b.id = sc.id)
"""

SENT_WORDS = f"""{SCORED.rstrip()},
tok AS (SELECT id, movieNm, platform, date, sentiment,
               unnest(string_split_regex({clean_latin('context')}, '{WS}+')) AS word FROM scored),
words AS (SELECT movieNm, platform, date, sentiment, word, count(*) AS count FROM tok
          WHERE word <> '' AND regexp_full_match(word, '[{LATIN}]{{2,}}') AND word NOT IN ({STOP})
          GROUP BY id, movieNm, platform, date, sentiment, word)
"""

# The three drops of the streaming queries: very late and dateless events, and events landed again.
DROPS = f"""ev2 AS (
    SELECT * REPLACE (CASE WHEN {q.DATELESS} THEN NULL WHEN {q.LATE} THEN ts - INTERVAL 400 DAY ELSE ts END AS ts) FROM events),
landed AS (SELECT * FROM ev2 UNION ALL SELECT * FROM ev2 WHERE {q.REPEATED}),
rt AS ({rt().replace("FROM events", "FROM landed")})"""

HANGUL, HANGUL_JAMO = "\\x{ac00}-\\x{d7a3}", "\\x{3131}-\\x{314e}\\x{ac00}-\\x{d7a3}"
KO = TX.replace("text AS context", f"translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', '{HANGUL_LETTERS}') AS context")


def clean_set(x: str, cls: str) -> str:
    inner = f"regexp_replace(coalesce({x}, ''), '[^{cls} \\t\\n\\x0B\\f\\r\\x{{00a0}}\\x{{3000}}]', '', 'g')"
    return strip(f"lower({inner})")


HANGUL_KEYWORDS = f"""WITH tx AS ({KO}),
{cleaned_ctes('tx')},
tok AS (SELECT movieNm, unnest(string_split_regex({clean_set('context', '@SET@')}, '{WS}+')) AS word FROM cleaned)
SELECT movieNm, word AS keyword, count(*) AS count FROM tok
WHERE length(word) >= 2 AND word NOT IN ({sql_list(STOPWORDS_KO)}) GROUP BY 1, 2"""

HANGUL_SCORED = f"""WITH tx AS ({KO}),
{cleaned_ctes('tx')},
base AS (SELECT movieNm, context, platform, date, id FROM cleaned
         WHERE movieNm IS NOT NULL AND context IS NOT NULL AND platform IS NOT NULL AND date IS NOT NULL),
lex(word, weight) AS (VALUES {", ".join(f"('{w}', {wt})" for w, wt in q.LEXICON_HANGUL)}),
sw AS (SELECT id, unnest(string_split_regex({clean_set('context', HANGUL)}, '{WS}+')) AS w FROM base),
sc AS (SELECT sw.id, sum(lex.weight) AS s FROM sw JOIN lex ON sw.w = lex.word GROUP BY sw.id),
scored AS (
    SELECT b.*, CAST(coalesce(sc.s, 0) AS BIGINT) AS score,
           CASE WHEN coalesce(sc.s, 0) > 0 THEN 'LABEL_1' ELSE 'LABEL_0' END AS raw_label,
           CASE WHEN coalesce(sc.s, 0) > 0 THEN 'positive' ELSE 'negative' END AS sentiment
    FROM base b LEFT JOIN sc ON b.id = sc.id)
"""

EVENT_SCORED = f"""{WITH_CLEAN_RT.rstrip()},
base AS (SELECT movieNm, context, platform, date, id FROM cleaned
         WHERE movieNm IS NOT NULL AND context IS NOT NULL AND platform IS NOT NULL AND date IS NOT NULL),
lex(word, weight) AS (VALUES {", ".join(f"('{w}', {wt})" for w, wt in q.LEXICON_EVENTS)}),
sw AS (SELECT id, context, movieNm, unnest(string_split_regex({clean_latin('context')}, '{WS}+')) AS w FROM base),
sc AS (SELECT sw.id, sw.context, sw.movieNm, sum(lex.weight) AS s FROM sw JOIN lex ON sw.w = lex.word GROUP BY 1, 2, 3),
scored AS (
    SELECT b.*, CAST(coalesce(sc.s, 0) AS BIGINT) AS score,
           CASE WHEN coalesce(sc.s, 0) > 0 THEN 'positive' ELSE 'negative' END AS sentiment
    FROM base b LEFT JOIN sc ON b.id = sc.id AND b.context = sc.context AND b.movieNm = sc.movieNm)
"""

BO = """WITH bo AS (
    SELECT CAST(o.o_orderdate AS DATE) AS boxoffice_date, p.p_brand AS movieNm,
           replace(p.p_name, ' ', ', ') AS genreNm,
           CAST(round(l.l_extendedprice * 100) AS BIGINT) AS salesAmt,
           CAST(l.l_quantity AS INTEGER) AS audiCnt,
           DATE '1994-12-01' + CAST(split_part(p.p_brand, '#', 2) AS INTEGER) * 7 AS openDt
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)
"""

GENRE = f"""{BO.rstrip()},
g AS (SELECT boxoffice_date, movieNm, {strip('gg')} AS genre, salesAmt, audiCnt, openDt
      FROM (SELECT *, unnest(string_split(genreNm, ',')) AS gg FROM bo WHERE genreNm IS NOT NULL)
      WHERE length({strip('gg')}) > 0)
"""

MONTHLY = f"""{BO.rstrip()},
m AS (SELECT CAST(date_trunc('month', boxoffice_date) AS DATE) AS month,
             CAST(sum(salesAmt) AS BIGINT) AS sales, CAST(sum(audiCnt) AS BIGINT) AS audience
      FROM bo GROUP BY 1)
"""

REGION = """WITH ra AS (
    SELECT CAST(o.o_orderdate AS DATE) AS boxoffice_date, CAST(n.n_regionkey AS VARCHAR) AS region_code,
           p.p_brand AS movieNm, CAST(round(l.l_extendedprice * 100) AS BIGINT) AS salesAmt,
           CAST(l.l_quantity AS INTEGER) AS audiCnt, r.r_name AS region_name
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN part p ON l.l_partkey = p.p_partkey
    JOIN region r ON CAST(n.n_regionkey AS VARCHAR) = CAST(r.r_regionkey AS VARCHAR))
"""

FILMS = """films AS (SELECT p_brand AS movieNm, CAST(1990 + min(p_size) % 30 AS VARCHAR) AS open_year
           FROM part GROUP BY p_brand)"""

RAW_CHART = """WITH raw AS (
    SELECT CAST(l_linenumber AS VARCHAR) AS rank,
           CASE WHEN l_linenumber = 7 THEN 'x' ELSE CAST(l_linenumber - 4 AS VARCHAR) END AS rankInten,
           CASE WHEN l_linenumber = 1 THEN 'NEW' ELSE 'OLD' END AS rankOldAndNew,
           CAST(l_partkey AS VARCHAR) AS movieCd,
           'movie_' || CAST(l_partkey AS VARCHAR) AS movieNm,
           strftime(o_orderdate, '%Y-%m-%d') AS openDt,
           CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS salesAmt,
           CAST(l_discount * 100 AS VARCHAR) AS salesShare,
           CAST(CAST(round(l_tax * 10000) AS BIGINT) AS VARCHAR) AS salesInten,
           CAST(l_tax * 100 AS VARCHAR) AS salesChange,
           CAST(CAST(round(o_totalprice * 100) AS BIGINT) * 1000 AS VARCHAR) AS salesAcc,
           CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS audiCnt,
           ' ' || CAST(CAST(l_quantity AS BIGINT) - 25 AS VARCHAR) || ' ' AS audiInten,
           CAST(l_discount AS VARCHAR) AS audiChange,
           CAST(CAST(l_quantity AS BIGINT) * 1000 + l_linenumber AS VARCHAR) AS audiAcc,
           CAST(l_suppkey AS VARCHAR) AS scrnCnt,
           CAST(l_linenumber * 3 AS VARCHAR) AS showCnt
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

TAGS = "SELECT p_brand AS movieNm, p_type AS platform, unnest(string_split(p_name, ' ')) AS tag FROM part"


def _tokens(src: str, keep: str, stop: bool) -> str:
    cond = f"word <> '' AND regexp_full_match(word, '[{LATIN}]{{2,}}')"
    if stop:
        cond += f" AND word NOT IN ({STOP})"
    return f"""SELECT {keep}, word FROM (
        SELECT {keep}, unnest(string_split_regex({clean_latin('context')}, '{WS}+')) AS word FROM {src})
    WHERE {cond}"""


def _rel(unit_expr: str) -> str:
    return f"strftime(TIMESTAMP '{q.AS_OF}' - {unit_expr}, '%Y.%m.%d')"


ORACLE: dict[str, str] = {
    "unify_platforms": f"""
SELECT 'movie_' || CAST(user_id % 20 AS VARCHAR) AS movieNm, CAST(user_id AS VARCHAR) AS id,
       concat_ws(' ', event_type, props) AS context, printf('%.4f', value / 20) AS star,
       strftime(ts, '%Y.%m.%d') AS date, 'megabox' AS platform, CAST(NULL AS VARCHAR) AS recommend_tags
FROM events
UNION ALL
SELECT source, CAST(doc_id AS VARCHAR), text, NULL, NULL, 'cine', NULL FROM documents""",

    "clean_reviews": WITH_CLEAN_RT + "SELECT * FROM cleaned",

    "dedup_keys": """
SELECT lang, doc_id, source, CAST(length(text) AS INTEGER) AS n_chars FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id, source) AS rn FROM documents)
WHERE rn = 1""",

    "distinct_rows": """
SELECT DISTINCT lang AS platform, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS n_chars FROM documents""",

    "platform_rating": WITH_TYPED_RAW + """
SELECT platform, round(avg(star), 6) AS avg_star, count(*) AS review_count
FROM tr WHERE star IS NOT NULL GROUP BY platform""",

    "daily_counts": WITH_TYPED_RAW + "SELECT date, count(*) AS count FROM tr GROUP BY date",

    "movie_platform_counts": WITH_TYPED_RAW + """
SELECT movieNm, platform, count(*) AS count FROM tr GROUP BY movieNm, platform""",

    "platform_summary": WITH_CLEAN_RT + """
SELECT platform, count(*) AS review_count, round(avg(star), 6) AS avg_rating FROM cleaned GROUP BY platform""",

    "movie_counts": WITH_CLEAN_RT + "SELECT movieNm, count(*) AS review_count FROM cleaned GROUP BY movieNm",

    "review_pace": WITH_CLEAN_RT + """
SELECT movieNm, min_date, max_date, review_count, days_active,
       round(CAST(review_count AS DOUBLE) / days_active, 6) AS avg_reviews_per_day
FROM (SELECT movieNm, min(date) AS min_date, max(date) AS max_date, count(*) AS review_count,
             CAST(date_diff('day', min(date), max(date)) + 1 AS INTEGER) AS days_active
      FROM cleaned GROUP BY movieNm)""",

    "rating_summary": WITH_CLEAN_RT + """
SELECT movieNm, count(star) AS rating_count, round(avg(star), 6) AS avg_rating,
       round(stddev_samp(star), 6) AS stddev_rating
FROM cleaned WHERE star IS NOT NULL GROUP BY movieNm""",

    "movie_summary": WITH_CLEAN_RT + """
SELECT movieNm, count(context) AS review_count, round(avg(star), 6) AS avg_rating FROM cleaned GROUP BY movieNm""",

    "rating_histogram": WITH_CLEAN_RT + """
SELECT movieNm, round(star * 2) / 2 AS round_rating, count(*) AS count FROM cleaned GROUP BY 1, 2""",

    "movie_trend": WITH_CLEAN_RT + """
SELECT movieNm, date AS review_date, count(*) AS count FROM cleaned GROUP BY 1, 2""",

    "movie_card": WITH_CLEAN_RT + """
SELECT movieNm, count(*) AS review_count, count(star) AS rating_count, round(avg(star), 6) AS avg_rating,
       min(date) AS first_date, max(date) AS last_date
FROM cleaned GROUP BY movieNm""",

    "platform_share": WITH_CLEAN_RT + """
SELECT platform, review_count, round(CAST(review_count AS DOUBLE) / sum(review_count) OVER (), 6) AS share
FROM (SELECT platform, count(*) AS review_count FROM cleaned GROUP BY platform)""",

    "star_distribution": WITH_CLEAN_RT + """
SELECT round(star * 2) / 2 AS round_rating, count(*) AS count FROM cleaned GROUP BY 1""",

    "review_texts": WITH_CLEAN_RT + "SELECT movieNm, platform, context FROM cleaned",

    "top_movies_report": WITH_CLEAN_RT + """
SELECT movieNm, count(*) AS review_count FROM cleaned GROUP BY movieNm
ORDER BY review_count DESC, movieNm ASC LIMIT 10""",

    "tag_counts": f"SELECT tag, count(*) AS count FROM ({TAGS}) GROUP BY tag",

    "tag_counts_by_movie": f"SELECT movieNm, tag, count(*) AS count FROM ({TAGS}) GROUP BY movieNm, tag",

    "platform_tag_counts": f"""
SELECT movieNm, tag AS keyword, count(*) AS count FROM ({TAGS}) WHERE platform = '{q.TAG_PLATFORM}'
GROUP BY movieNm, tag""",

    "clean_tags": f"""
SELECT id, movieNm, array_to_string(tags, '|') AS tags, CAST(len(tags) AS INTEGER) AS n_tags FROM (
    SELECT p_partkey AS id, p_brand AS movieNm,
           list_filter(list_transform(
               string_split(p_name, ' ') || ['+' || CAST(p_size % 4 AS VARCHAR), p_type || ' 외', ''],
               lambda x: {strip('x')}),
               lambda x: x IS NOT NULL AND length(x) > 0 AND NOT contains(x, '+') AND NOT contains(x, '외')) AS tags
    FROM part)""",

    "movie_keywords": WITH_CLEAN_TX + f"""
SELECT movieNm, word AS keyword, count(*) AS count FROM ({_tokens('cleaned', 'movieNm', True)})
GROUP BY movieNm, word""",

    "stopword_antijoin": f"""WITH tx AS ({TX})
SELECT platform, word, count(*) AS count FROM ({_tokens('tx', 'platform', True)}) GROUP BY platform, word""",

    "cast_boxoffice": f"""
{RAW_CHART}
SELECT TRY_CAST(rank AS INTEGER) AS rank, TRY_CAST(rankInten AS INTEGER) AS rankInten, rankOldAndNew,
       movieCd, movieNm, TRY_CAST(openDt AS DATE) AS openDt, TRY_CAST(salesAmt AS BIGINT) AS salesAmt,
       TRY_CAST(salesShare AS DOUBLE) AS salesShare, TRY_CAST(salesInten AS BIGINT) AS salesInten,
       TRY_CAST(salesChange AS DOUBLE) AS salesChange, TRY_CAST(salesAcc AS BIGINT) AS salesAcc,
       TRY_CAST(trim(audiCnt) AS INTEGER) AS audiCnt, TRY_CAST(trim(audiInten) AS INTEGER) AS audiInten,
       TRY_CAST(audiChange AS DOUBLE) AS audiChange, TRY_CAST(audiAcc AS BIGINT) AS audiAcc,
       TRY_CAST(scrnCnt AS INTEGER) AS scrnCnt, TRY_CAST(showCnt AS INTEGER) AS showCnt
FROM raw""",

    "genre_explode": GENRE + "SELECT * FROM g",

    "movie_list": BO + f"""
SELECT DISTINCT {strip('movieNm')} AS movieNm, {strip('CAST(openDt AS VARCHAR)')} AS openDt FROM bo""",

    "movies_to_collect": BO.rstrip() + f""",
{FILMS}
SELECT f.movieNm, f.open_year FROM films f
WHERE EXISTS (SELECT 1 FROM bo WHERE bo.movieNm = f.movieNm AND bo.boxoffice_date = DATE '{q.CHART_DAY}')""",

    "region_attach": REGION + "SELECT * FROM ra",

    "monthly_sales": MONTHLY + "SELECT * FROM m",

    "yoy_sales": MONTHLY + """
SELECT a.month, a.sales, b.sales AS sales_prev_year,
       round(CAST(a.sales - b.sales AS DOUBLE) / CAST(b.sales AS DOUBLE), 6) AS yoy_change
FROM m a LEFT JOIN m b ON a.month = CAST(b.month + INTERVAL 12 MONTH AS DATE)""",

    "genre_share": GENRE + """
SELECT month, genre, sales, round(CAST(sales AS DOUBLE) / CAST(sum(sales) OVER (PARTITION BY month) AS DOUBLE), 6) AS share
FROM (SELECT CAST(date_trunc('month', boxoffice_date) AS DATE) AS month, genre,
             CAST(sum(salesAmt) AS BIGINT) AS sales FROM g GROUP BY 1, 2)""",

    "region_audience": REGION + """
SELECT region_name, CAST(sum(audiCnt) AS BIGINT) AS audience FROM ra GROUP BY region_name""",

    "region_top10": REGION + """
SELECT * FROM (
    SELECT region_name, movieNm, audience,
           CAST(row_number() OVER (PARTITION BY region_name ORDER BY audience DESC, movieNm ASC) AS INTEGER) AS rank
    FROM (SELECT region_name, movieNm, CAST(sum(audiCnt) AS BIGINT) AS audience FROM ra GROUP BY 1, 2))
WHERE rank <= 10""",

    "latest_per_movie": f"""WITH rt AS ({rt(f"WHERE ts < TIMESTAMP '{q.STORED_BEFORE}'")})
SELECT movieNm, max({parse_date('date')}) AS latest_date FROM rt GROUP BY movieNm""",

    "new_since_latest": f"""WITH stored AS ({rt(f"WHERE ts < TIMESTAMP '{q.STORED_BEFORE}'")}),
latest AS (SELECT movieNm, max({parse_date('date')}) AS latest_date FROM stored GROUP BY movieNm),
nw AS ({rt(f"WHERE ts >= TIMESTAMP '{q.NEW_SINCE}'")})
SELECT n.movieNm, n.id, n.context, n.star, n.date, n.platform, n.recommend_tags
FROM nw n LEFT JOIN latest l ON n.movieNm = l.movieNm
WHERE l.latest_date IS NULL OR {parse_date('n.date')} IS NULL OR {parse_date('n.date')} > l.latest_date""",

    "merge_append": f"""WITH ex AS ({rt(f"WHERE ts < TIMESTAMP '{q.EXISTING_BEFORE}'")}),
nw AS ({rt(f"WHERE ts >= TIMESTAMP '{q.NEW_SINCE}'")}),
allrows AS (SELECT *, 0 AS _src FROM ex UNION ALL SELECT *, 1 AS _src FROM nw)
SELECT movieNm, id, context, star, date, platform, recommend_tags FROM (
    SELECT *, row_number() OVER (PARTITION BY id, context, date
        ORDER BY _src, movieNm NULLS FIRST, star NULLS FIRST, platform NULLS FIRST, recommend_tags NULLS FIRST) AS rn
    FROM allrows) WHERE rn = 1""",

    "date_bound_scan": f"""
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS date FROM events
WHERE ts >= TIMESTAMP '{q.DATE_BOUND}'""",

    "relative_dates": f"""
WITH t AS (
    SELECT event_id, CASE event_id % 7
        WHEN 0 THEN CAST(event_id % 60 AS VARCHAR) || '분전'
        WHEN 1 THEN CAST(event_id % 24 AS VARCHAR) || '시간전'
        WHEN 2 THEN CAST(event_id % 30 AS VARCHAR) || '일전'
        WHEN 3 THEN '방금'
        WHEN 4 THEN '하루전'
        WHEN 5 THEN strftime(ts, '%Y.%m.%d')
        ELSE '어제쯤' END AS rel_text
    FROM events),
p AS (SELECT event_id, rel_text, TRY_CAST(regexp_extract(rel_text, '(\\d+)', 1) AS INTEGER) AS n FROM t),
r AS (SELECT event_id, rel_text, CASE
        WHEN regexp_matches(rel_text, '^\\d{{4}}\\.\\d{{2}}\\.\\d{{2}}') THEN rel_text
        WHEN contains(rel_text, '분전') AND n IS NOT NULL THEN {_rel('to_minutes(n)')}
        WHEN contains(rel_text, '시간전') AND n IS NOT NULL THEN {_rel('to_hours(n)')}
        WHEN contains(rel_text, '하루전') THEN {_rel('INTERVAL 1 DAY')}
        WHEN contains(rel_text, '일전') AND n IS NOT NULL THEN {_rel('to_days(n)')}
        WHEN contains(rel_text, '방금') THEN strftime(TIMESTAMP '{q.AS_OF}', '%Y.%m.%d')
      END AS review_date FROM p)
SELECT event_id, rel_text, review_date, {parse_date('review_date')} AS date FROM r""",

    "value_map": """
SELECT event_id, event_type, CASE event_type WHEN 'click' THEN '클릭' WHEN 'view' THEN '조회'
    WHEN 'purchase' THEN '구매' WHEN 'signup' THEN '가입' END AS label FROM events""",

    "sentiment_lexicon": SCORED + "SELECT id, movieNm, platform, date, score, raw_label, sentiment FROM scored",

    "sentiment_words": SENT_WORDS + "SELECT * FROM words",

    "sentiment_top10": SENT_WORDS + """
SELECT * FROM (
    SELECT sentiment, word, count,
           CAST(row_number() OVER (PARTITION BY sentiment ORDER BY count DESC, word ASC) AS INTEGER) AS rank
    FROM (SELECT sentiment, word, CAST(sum(count) AS BIGINT) AS count FROM words GROUP BY 1, 2))
WHERE rank <= 10""",

    "sentiment_by_platform": SCORED + """
SELECT platform, sentiment, count,
       round(CAST(count AS DOUBLE) / CAST(sum(count) OVER (PARTITION BY platform) AS DOUBLE), 6) AS ratio
FROM (SELECT platform, sentiment, count(*) AS count FROM scored GROUP BY 1, 2)""",

    "sentiment_by_day": SCORED + "SELECT date, sentiment, count(*) AS count FROM scored GROUP BY 1, 2",

    "sentiment_platform_counts": SCORED + """
SELECT platform, count(*) AS review_count, count_if(sentiment = 'positive') AS positive_count,
       count_if(sentiment = 'negative') AS negative_count
FROM scored GROUP BY platform""",

    "sentiment_plugin": SCORED + "SELECT id, movieNm, platform, date, raw_label, sentiment FROM scored",

    "file_ingest": f"WITH tx AS ({TX}) SELECT * FROM tx",

    "api_json_ingest": f"""
{RAW_CHART}
SELECT CAST(strptime(openDt, '%Y-%m-%d') AS DATE) AS boxoffice_date, rank, rankInten, rankOldAndNew, movieCd,
       movieNm, openDt, salesAmt, salesShare, salesInten, salesChange, salesAcc, audiCnt, audiInten,
       audiChange, audiAcc, scrnCnt, showCnt
FROM raw""",

    "region_json_ingest": """
SELECT CAST(o.o_orderdate AS DATE) AS boxoffice_date, CAST(n.n_regionkey AS VARCHAR) AS region_code,
       r.r_name AS region_name, CAST(l.l_linenumber AS VARCHAR) AS rank,
       CAST(l.l_linenumber - 4 AS VARCHAR) AS rankInten,
       CASE WHEN l.l_linenumber = 1 THEN 'NEW' ELSE 'OLD' END AS rankOldAndNew,
       CAST(l.l_partkey AS VARCHAR) AS movieCd, 'movie_' || CAST(l.l_partkey AS VARCHAR) AS movieNm,
       CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS salesAmt,
       CAST(CAST(round(o.o_totalprice * 100) AS BIGINT) * 1000 AS VARCHAR) AS salesAcc,
       CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) AS audiCnt,
       CAST(CAST(l.l_quantity AS BIGINT) * 1000 + l.l_linenumber AS VARCHAR) AS audiAcc,
       CAST(l.l_suppkey AS VARCHAR) AS scrnCnt, CAST(l.l_linenumber * 3 AS VARCHAR) AS showCnt
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",

    "table_sinks": WITH_CLEAN_RT + f"SELECT *, DATE '{q.LOAD_DAY}' AS load_date FROM cleaned",

    "append_day_rerun": WITH_CLEAN_RT + f"""SELECT *, DATE '{q.LOAD_DAY}' AS load_date FROM cleaned WHERE star >= 2
UNION ALL SELECT *, DATE '{q.NEXT_DAY}' AS load_date FROM cleaned WHERE star < 2""",

    "stream_daily_counts": f"""WITH {DROPS}
SELECT movieNm, {parse_date('date')} AS review_date, count(*) AS count FROM rt GROUP BY 1, 2""",

    "stream_dedup": f"""WITH {DROPS}
SELECT DISTINCT id, context, {parse_date('date')} AS review_date FROM rt""",

    "daily_keywords": f"""{WITH_CLEAN_TX.rstrip()},
tok AS ({_tokens('(SELECT movieNm, date, context FROM cleaned)', 'movieNm, date', True)})
SELECT movieNm, word AS keyword, count(*) AS count, date AS review_date FROM tok
WHERE date IN (DATE '2024-01-05', DATE '2024-01-06') GROUP BY movieNm, word, date""",

    "file_titles": """
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Film ' || source || ' [IMAX]' WHEN 1 THEN 'Film ' || source || '+1'
       WHEN 2 THEN 'Film ' || source || ' 100%' ELSE 'Film ' || source || '_2' END AS title,
       CASE WHEN doc_id % 3 > 0 THEN DATE '2024-01-15' END AS day FROM documents""",

    "expert_reviews": """
SELECT source AS movieNm, CAST(doc_id AS VARCHAR) AS id, md5(text) AS context,
       CASE WHEN doc_id % 7 <> 0 THEN CAST((doc_id % 11) / CAST(2 AS DOUBLE) AS VARCHAR) END AS star,
       CAST(NULL AS VARCHAR) AS date, 'cine' AS platform, CAST(NULL AS VARCHAR) AS recommend_tags
FROM documents WHERE doc_id % 5 = 0""",

    "pos_words": f"""{WITH_CLEAN_TX.rstrip()},
tok AS ({_tokens('cleaned', 'movieNm', False)})
SELECT movieNm, word, count(*) AS count FROM tok
WHERE word IN ({sql_list([w for w, _, p in LEXICON_LATIN if p in ("Noun", "Verb")])}) GROUP BY 1, 2""",

    "chart_union": BO + f"""
SELECT {strip('movieNm')} AS movieNm, CAST(openDt AS VARCHAR) AS openDt FROM bo
UNION SELECT {strip('movieNm')}, CAST(CAST(openDt + CAST(audiCnt % 3 AS INTEGER) AS DATE) AS VARCHAR) FROM bo WHERE audiCnt >= 25""",

    "csv_table": "SELECT p_partkey, p_name, p_brand, p_size FROM part",

    "region_cast": """
SELECT strftime(o.o_orderdate, '%Y%m%d') AS day, CAST(n.n_regionkey AS VARCHAR) AS region_code,
       r.r_name AS region_name, CAST(l.l_linenumber AS INTEGER) AS rank, CAST(l.l_linenumber - 4 AS INTEGER) AS rankInten,
       CASE WHEN l.l_linenumber = 1 THEN 'NEW' ELSE 'OLD' END AS rankOldAndNew,
       CAST(l.l_partkey AS VARCHAR) AS movieCd, 'movie_' || CAST(l.l_partkey AS VARCHAR) AS movieNm,
       CAST(round(l.l_extendedprice * 100) AS BIGINT) AS salesAmt,
       CAST(round(o.o_totalprice * 100) AS BIGINT) * 1000 AS salesAcc,
       CAST(l.l_quantity AS INTEGER) AS audiCnt, CAST(l.l_quantity AS BIGINT) * 1000 + l.l_linenumber AS audiAcc,
       CAST(l.l_suppkey AS INTEGER) AS scrnCnt, CAST(l.l_linenumber * 3 AS INTEGER) AS showCnt
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",

    "date_parts": """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS first, CAST(year(ts) AS INTEGER) AS year, CAST(ts AS DATE) AS day FROM events""",

    "movie_keywords_hangul": HANGUL_KEYWORDS.replace("@SET@", HANGUL),

    "movie_keywords_hangul_jamo": HANGUL_KEYWORDS.replace("@SET@", HANGUL_JAMO),

    "sentiment_table": EVENT_SCORED + "SELECT id, movieNm, platform, date, context, score, sentiment FROM scored",

    "sentiment_words_reviews": EVENT_SCORED.rstrip() + f""",
tok AS (SELECT id, context, movieNm, platform, date, sentiment,
               unnest(string_split_regex({clean_latin('context')}, '{WS}+')) AS word FROM scored)
SELECT movieNm, platform, date, sentiment, word, count(*) AS count FROM tok
WHERE word <> '' AND regexp_full_match(word, '[{LATIN}]{{2,}}') AND word NOT IN ({STOP})
GROUP BY id, context, movieNm, platform, date, sentiment, word""",

    "sentiment_lexicon_hangul": HANGUL_SCORED + "SELECT id, movieNm, platform, date, score, raw_label, sentiment FROM scored",

    "sentiment_nb": f"""{WITH_CLEAN_TX.rstrip()},
base AS (SELECT movieNm, context, platform, date, id FROM cleaned
         WHERE movieNm IS NOT NULL AND context IS NOT NULL AND platform IS NOT NULL AND date IS NOT NULL),
lw AS (SELECT quality, unnest(string_split_regex({clean_latin('text')}, '{WS}+')) AS word
       FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL AND quality IS NOT NULL),
cnt AS (SELECT word, count_if(quality > 0) AS pos, count_if(NOT quality > 0) AS neg FROM lw WHERE length(word) > 0 GROUP BY word),
tot AS (SELECT CAST(sum(pos) AS BIGINT) AS tp, CAST(sum(neg) AS BIGINT) AS tn, count(*) AS v FROM cnt),
lex AS (SELECT word, CAST(round((ln((pos + 1) / CAST(tp + v AS DOUBLE)) - ln((neg + 1) / CAST(tn + v AS DOUBLE))) * 1000000) AS BIGINT) AS weight
        FROM cnt, tot),
sw AS (SELECT id, unnest(string_split_regex({clean_latin('context')}, '{WS}+')) AS w FROM base),
sc AS (SELECT sw.id, sum(lex.weight) AS s FROM sw JOIN lex ON sw.w = lex.word GROUP BY sw.id)
SELECT b.id, b.movieNm, b.platform, b.date,
       CASE WHEN coalesce(sc.s, 0) > 0 THEN 'LABEL_1' ELSE 'LABEL_0' END AS raw_label,
       CASE WHEN coalesce(sc.s, 0) > 0 THEN 'positive' ELSE 'negative' END AS sentiment
FROM base b LEFT JOIN sc ON b.id = sc.id""",

    "page_extract": f"""
WITH b AS (
    SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1) AS domain,
           {strip_tags("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")} AS title,
           string_split_regex(regexp_extract(html, '(?s)<article[^>]*>(.*)</article>', 1), '<p[^>]*>') AS blocks
    FROM pages),
x AS (SELECT page_id, domain, title, unnest(generate_series(0, len(blocks) - 1)) AS pos,
             unnest(blocks) AS block FROM b),
y AS (SELECT page_id, domain, title, CAST(pos AS INTEGER) AS pos,
             {strip_tags("block")} AS context FROM x WHERE pos > 0)
SELECT page_id, domain, title, pos, context, CAST(length(context) AS INTEGER) AS n_chars
FROM y WHERE length(context) > 0""",

    "candidate_match": f"""
WITH {FILMS},
hits AS (SELECT p_brand AS movieNm, p_partkey AS hit_id,
                CASE WHEN p_size % 4 = 0 THEN p_brand ELSE concat_ws(' ', p_brand, p_type) END AS title,
                CAST(1990 + p_size % 30 AS VARCHAR) AS open_year, p_partkey AS position,
                (p_size % 3 = 0) AS has_image FROM part),
pr AS (SELECT h.movieNm, h.hit_id, h.position,
              CASE WHEN h.title = h.movieNm AND h.open_year = f.open_year THEN 0 WHEN h.has_image THEN 1 END AS prio
       FROM hits h JOIN films f ON h.movieNm = f.movieNm),
best AS (SELECT movieNm, hit_id, position, CASE WHEN prio = 0 THEN 'exact' ELSE 'image' END AS match FROM (
            SELECT *, row_number() OVER (PARTITION BY movieNm ORDER BY prio, position, hit_id) AS rn
            FROM pr WHERE prio IS NOT NULL) WHERE rn = 1)
SELECT f.movieNm, f.open_year, b.hit_id, b.position, b.match FROM films f LEFT JOIN best b ON f.movieNm = b.movieNm""",
}
