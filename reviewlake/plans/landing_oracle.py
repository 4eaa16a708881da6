"""DuckDB SQL for the queries of ``landing``: what their landed files, tables and streams must come to, straight from the driver's tables."""

from __future__ import annotations

from reviewlake.functions.text import STOPWORDS_KO
from reviewlake.operators.evaluation import BINS
from reviewlake.operators.stems import MAX_STEM, MIN_STEM
from reviewlake.plans import landing as q
from reviewlake.plans.oracle import (BO, HANGUL, KO, RAW_CHART, REGION, WITH_CLEAN_RT, WS, clean_latin, clean_set, cleaned_ctes, parse_date, rt, sql_list, strip,
                                     strip_tags)

_REGION_RAW = """FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""
_FIRST_LANDING, _SECOND_LANDING, _THIRD_LANDING = q.WATERMARKS
_REJECT = f"CASE WHEN {q.SHORT} THEN 'short' WHEN {q.LONG} THEN 'long' END"
_STATUS = """CASE mcd % 8 WHEN 0 THEN 'empty' WHEN 1 THEN 'mistyped' WHEN 2 THEN 'single' WHEN 3 THEN 'absent' WHEN 4 THEN 'unparsed' ELSE 'ok' END"""

ORACLE: dict[str, str] = {
    "merge_bucketed": f"""WITH r AS ({rt()}),
t AS (SELECT *, CASE WHEN {parse_date('date')} < DATE '{q.FIRST_END}' THEN 0 WHEN {parse_date('date')} < DATE '{q.SECOND_END}' THEN 1 ELSE 2 END AS batch FROM r)
SELECT movieNm, id, context, star, date, platform, recommend_tags FROM (
    SELECT *, row_number() OVER (PARTITION BY id, context, date
        ORDER BY batch, movieNm NULLS FIRST, star NULLS FIRST, platform NULLS FIRST, recommend_tags NULLS FIRST) AS rn FROM t) WHERE rn = 1""",

    "page_reviews_nested": f"""
WITH b AS (SELECT page_id, string_split_regex(regexp_extract(html, '(?s)<article[^>]*>(.*)</article>', 1), '<p[^>]*>')[2:] AS blocks FROM pages),
x AS (SELECT page_id, unnest(generate_series(0, len(blocks) - 1)) AS i, unnest(blocks) AS block FROM b),
t AS (SELECT page_id, i, regexp_replace(block, '<[^>]*>', '', 'g') AS text FROM x),
c AS (SELECT page_id, i, {strip_tags("CASE WHEN i % 3 = 0 THEN '<div><div>' || text || '</div></div> tail' ELSE text END")} AS context FROM t)
SELECT page_id, 'netizen' AS who, 'user ' || i AS name, context, '4.0' AS star, '2025.03.18' AS date FROM c WHERE length(context) > 0""",

    "csv_rejects": f"""
WITH d AS (SELECT *, {_REJECT} AS bad, '"' || replace(text, '"', '""') || '"' AS quoted FROM documents)
SELECT 'row' AS kind, CAST(doc_id AS VARCHAR) AS doc_id, source, md5(text) AS md5, NULL AS problem FROM d WHERE bad IS NULL
UNION ALL SELECT 'reject', CAST(doc_id AS VARCHAR), NULL, md5(doc_id || ',' || quoted || CASE WHEN bad = 'long' THEN ',' || source || ',more' ELSE '' END), 'fields'
FROM d WHERE bad IS NOT NULL
UNION ALL SELECT 'count', CAST(count(*) AS VARCHAR), NULL, NULL, CAST(count(bad) AS VARCHAR) FROM d""",

    "csv_table_quoted": """
WITH d AS (SELECT doc_id, lang, 'he said "' || text || '", ok' || chr(10) || 'next' AS text FROM documents)
SELECT doc_id, lang, md5(text) AS md5, CAST(length(text) AS INTEGER) AS n_chars FROM d""",

    "chart_csv_ingest": f"""
{RAW_CHART},
t AS (SELECT CAST(date_trunc('quarter', CAST(openDt AS DATE)) AS DATE) AS boxoffice_date, CAST(salesAmt AS BIGINT) AS sales, TRY_CAST(rankInten AS INTEGER) AS shift,
             CAST(openDt AS DATE) AS first FROM raw)
SELECT boxoffice_date, count(*) AS n, CAST(sum(sales) AS BIGINT) AS sales, CAST(sum(shift) AS BIGINT) AS shift, min(first) AS first FROM t GROUP BY 1
UNION ALL SELECT NULL, count(DISTINCT boxoffice_date), NULL, NULL, NULL FROM t
UNION ALL SELECT DATE '1900-01-01', count(*), CAST(sum(sales) AS BIGINT), NULL, NULL FROM t WHERE boxoffice_date = DATE '1996-04-01'""",

    "region_csv_ingest": f"""
SELECT CAST(date_trunc('year', o.o_orderdate) AS DATE) AS boxoffice_date, CAST(n.n_regionkey AS VARCHAR) AS region_code, r.r_name AS region_name, count(*) AS n,
       CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT) * 1000) AS BIGINT) AS acc, CAST(sum(l.l_linenumber - 4) AS BIGINT) AS shift
{_REGION_RAW} GROUP BY 1, 2, 3""",

    "review_files": """
WITH t AS (SELECT 'A ' || source AS title, DATE '2024-01-10' + CAST(doc_id % 3 AS INTEGER) AS day, source, length(text) AS c FROM documents)
SELECT 'all' AS kind, title, day, count(*) AS n, CAST(sum(c) AS BIGINT) AS n_chars FROM t GROUP BY title, day
UNION ALL SELECT 'day', title, day, count(*), CAST(sum(c) AS BIGINT) FROM t WHERE day = DATE '2024-01-11' GROUP BY title, day
UNION ALL SELECT 'film', title, day, count(*), CAST(sum(c) AS BIGINT) FROM t WHERE source = 'src1' GROUP BY title, day""",

    "json_drift": f"""
{RAW_CHART},
p AS (SELECT openDt, salesAcc, list({{'cd': CAST(movieCd AS BIGINT), 'amt': CAST(salesAmt AS BIGINT)}} ORDER BY rank, CAST(movieCd AS BIGINT)) AS es, min(CAST(movieCd AS BIGINT)) AS mcd
      FROM raw GROUP BY 1, 2),
j AS (SELECT CAST(openDt AS DATE) AS day, {_STATUS} AS status, CASE {_STATUS} WHEN 'ok' THEN es WHEN 'single' THEN es[1:1] ELSE [] END AS es FROM p),
e AS (SELECT day, unnest(es, recursive := true) FROM j)
SELECT CASE WHEN status <> 'unparsed' THEN day END AS boxoffice_date, status, count(*) AS responses, CAST(sum(len(es)) AS BIGINT) AS entries,
       CAST(sum(len(list_filter(es, lambda x: x.cd % 5 = 0))) AS BIGINT) AS unknown, CAST(0 AS BIGINT) AS missing,
       CAST(sum(len(list_filter(es, lambda x: x.cd % 5 = 0))) AS BIGINT) AS mistyped, CAST(NULL AS BIGINT) AS sales FROM j GROUP BY 1, 2
UNION ALL SELECT day, 'rows', NULL, count(*), NULL, count_if(cd % 5 = 0), NULL, CAST(sum(amt) AS BIGINT) FROM e GROUP BY 1""",

    "table_replace": WITH_CLEAN_RT + """
SELECT movieNm, id, star, date, platform, 1 AS version FROM cleaned WHERE star >= 2
UNION ALL SELECT movieNm, id, star, date, platform, 0 FROM cleaned""",

    "file_ledger": """
WITH t AS (SELECT source, length(text) AS c, CASE WHEN source IN ('src1', 'src2') THEN '4' ELSE '1' END AS run FROM documents
           UNION ALL SELECT source, length(text), '3' FROM documents WHERE source IN ('src3', 'src4') AND doc_id % 2 = 0)
SELECT run, source, count(*) AS n, CAST(sum(c) AS BIGINT) AS n_chars FROM t GROUP BY 1, 2""",

    "stream_counts_compacted": f"""WITH rt AS ({rt()})
SELECT movieNm, {parse_date('date')} AS review_date, count(*) AS count, TRUE AS within FROM rt GROUP BY 1, 2""",

    "stream_new_since_latest": f"""WITH t AS (SELECT * EXCLUDE (recommend_tags), {parse_date('date')} AS day FROM ({rt()})),
a AS (SELECT * FROM t WHERE day < DATE '{_FIRST_LANDING[1]}'),
la AS (SELECT movieNm, max(day) AS latest FROM a GROUP BY 1),
b AS (SELECT * FROM t WHERE movieNm <> 'movie_7' AND day >= DATE '{_SECOND_LANDING[0]}' AND day < DATE '{_SECOND_LANDING[1]}'),
lb AS (SELECT movieNm, max(latest) AS latest FROM (SELECT * FROM la UNION ALL SELECT movieNm, day FROM b) GROUP BY 1),
c AS (SELECT * FROM t WHERE movieNm <> 'movie_7' AND day >= DATE '{_THIRD_LANDING[0]}')
SELECT * EXCLUDE (day) FROM a
UNION ALL SELECT b.* EXCLUDE (day) FROM b LEFT JOIN la USING (movieNm) WHERE latest IS NULL OR day IS NULL OR day > latest
UNION ALL SELECT c.* EXCLUDE (day) FROM c LEFT JOIN lb USING (movieNm) WHERE latest IS NULL OR day IS NULL OR day > latest""",

    "stem_keywords_hangul": f"""WITH tx AS ({KO}),
{cleaned_ctes('tx')},
tok AS (SELECT movieNm, unnest(string_split_regex({clean_set('context', HANGUL)}, '{WS}+')) AS word FROM cleaned),
fw AS (SELECT movieNm, word, count(*) AS count FROM tok WHERE length(word) >= 2 AND word NOT IN ({sql_list(STOPWORDS_KO)}) GROUP BY 1, 2),
w AS (SELECT word, CAST(sum(count) AS BIGINT) AS n FROM fw GROUP BY 1),
nx AS (SELECT substr(word, 1, k) AS prefix, substr(word, k + 1, 1) AS nxt, sum(n) AS n
       FROM (SELECT word, n, unnest(range(1, least(length(word), {MAX_STEM}) + 1)) AS k FROM w) GROUP BY 1, 2),
st AS (SELECT prefix, sum(n) AS c, round(log2(CAST(sum(n) AS DOUBLE)) - sum(n * log2(CAST(n AS DOUBLE))) / CAST(sum(n) AS DOUBLE), 6) AS entropy FROM nx GROUP BY 1),
sc AS (SELECT word, k, round(st.entropy * pow(CAST(st.c AS DOUBLE) / CAST(h.c AS DOUBLE), 1.0::DOUBLE / (k - 1)), 6) AS score
       FROM (SELECT word, unnest(range({MIN_STEM}, least(length(word), {MAX_STEM}) + 1)) AS k FROM w WHERE length(word) >= {MIN_STEM}) u
       JOIN st ON st.prefix = substr(word, 1, k) JOIN st h ON h.prefix = substr(word, 1, 1)),
best AS (SELECT word, k FROM sc WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY word ORDER BY score DESC, k) = 1)
SELECT movieNm, CASE WHEN k IS NULL THEN fw.word ELSE substr(fw.word, 1, k) END AS keyword, CAST(sum(count) AS BIGINT) AS count, count(*) AS spellings
FROM fw LEFT JOIN best ON fw.word = best.word GROUP BY 1, 2""",

    "movie_list_asof": BO.rstrip() + ",\n" + REGION.removeprefix("WITH ").rstrip() + f""",
daily AS (SELECT boxoffice_date, movieNm, CAST(openDt + CAST(audiCnt % 3 AS INTEGER) AS DATE) AS openDt FROM bo WHERE audiCnt >= 48),
known AS (SELECT movieNm, boxoffice_date, min(openDt) AS openDt FROM daily GROUP BY 1, 2),
asked AS (SELECT DISTINCT movieNm, boxoffice_date FROM ra),
filled AS (SELECT a.movieNm, k.openDt FROM asked a ASOF LEFT JOIN known k ON a.movieNm = k.movieNm AND a.boxoffice_date >= k.boxoffice_date)
SELECT {strip('movieNm')} AS movieNm, CAST(openDt AS VARCHAR) AS openDt FROM daily UNION SELECT {strip('movieNm')}, CAST(openDt AS VARCHAR) FROM filled""",

    "sentiment_eval": f"""WITH lab AS (SELECT CAST(doc_id AS VARCHAR) AS id, text, quality AS label, CASE WHEN md5(text) >= '8' THEN 'held_out' ELSE 'fitted' END AS part
       FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL AND quality IS NOT NULL),
lw AS (SELECT id, part, label, unnest(string_split_regex({clean_latin('text')}, '{WS}+')) AS word FROM lab),
cnt AS (SELECT word, count_if(label > 0) AS pos, count_if(NOT label > 0) AS neg FROM lw WHERE part = 'fitted' AND length(word) > 0 GROUP BY word),
tot AS (SELECT CAST(sum(pos) AS BIGINT) AS tp, CAST(sum(neg) AS BIGINT) AS tn, count(*) AS v FROM cnt),
lex AS (SELECT word, CAST(round((ln((pos + 1) / CAST(tp + v AS DOUBLE)) - ln((neg + 1) / CAST(tn + v AS DOUBLE))) * 1000000) AS BIGINT) AS weight FROM cnt, tot),
sc AS (SELECT id, sum(weight) AS s FROM lw JOIN lex USING (word) GROUP BY id),
r AS (SELECT part, label, CAST(coalesce(s, 0) AS BIGINT) AS s FROM lab LEFT JOIN sc USING (id)),
per AS (SELECT part, s, count_if(label > 0) AS pos, count_if(NOT label > 0) AS neg FROM r GROUP BY 1, 2),
k AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS pb, coalesce(sum(neg) OVER w, 0) AS nb, sum(pos) OVER (PARTITION BY part) AS p, sum(neg) OVER (PARTITION BY part) AS n
      FROM per WINDOW w AS (PARTITION BY part ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT part, any_value(p) AS p, any_value(n) AS n, sum(pos * (2 * nb + neg)) AS u, coalesce(sum(pos) FILTER (s > 0), 0) AS tp, coalesce(sum(neg) FILTER (s > 0), 0) AS fp FROM k GROUP BY part),
v AS (SELECT part, CAST(p + n AS BIGINT) AS rows, unnest(['auc', 'accuracy', 'precision', 'recall']) AS metric,
      unnest([u / CAST(p * n * 2 AS DOUBLE), (tp + n - fp) / CAST(p + n AS DOUBLE), tp / CAST(tp + fp AS DOUBLE), tp / CAST(p AS DOUBLE)]) AS value FROM m)
SELECT part, metric, CAST(NULL AS INTEGER) AS bin, rows AS n, round(value, 9) AS value FROM v
UNION ALL SELECT part, 'bin_positive', CAST(floor((pb + nb) * {BINS} / CAST(p + n AS DOUBLE)) AS INTEGER), CAST(sum(pos + neg) AS BIGINT),
       round(sum(pos) / CAST(sum(pos + neg) AS DOUBLE), 9) FROM k GROUP BY 1, 2, 3""",
}
