"""Readers and sinks over small landed files."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from reviewlake.operators.clean import clean_reviews
from reviewlake.operators.keywords import platform_tag_counts
from reviewlake.sources import files as src
from reviewlake.sources import sinks
from reviewlake.sources.pages import extract_reviews
from tests import fixtures as fx


@pytest.fixture()
def landed(tmp):
    return fx.write_reviews(tmp)


def test_merge_all_platforms(spark, landed):
    raw = src.read_all_reviews(spark, landed)
    assert raw.columns == ["movieNm", "id", "context", "star", "date", "platform", "recommend_tags"]
    rows = raw.collect()
    assert len(rows) == sum(len(r) for _, _, _, r in fx.REVIEW_FILES)
    titles = {r.movieNm for r in rows}
    assert titles == {"Dune [IMAX], Part Two", "Tom & Jerry+", "100% Love", "My_Movie", "Undated Film"}
    # a quoted field with a line break and doubled quotes stays one row
    m2 = [r for r in rows if r.id == "m2"][0]
    assert m2.context == '두 줄\n리뷰 입니다 "인용" 포함 최고'
    # BOM dropped: the first header column bound by name
    assert {r.id for r in rows if r.platform == "watcha"} == {"w1", "w2"}
    # cine: name -> id, who dropped; cgv: no star column
    assert {r.id for r in rows if r.platform == "cine"} == {"critic", "n1"}
    assert all(r.star is None for r in rows if r.platform == "cgv")


def test_expert_split(spark, landed):
    raw = src.read_all_reviews(spark, {"cine": landed["cine"]}, who="netizen")
    assert [r.id for r in raw.collect()] == ["n1"]


def test_clean_rules_on_landed_rows(spark, landed):
    cleaned = clean_reviews(src.read_all_reviews(spark, landed))
    by_id = {r.id: r for r in cleaned.collect()}
    assert "m3" not in by_id                 # shorter than 10
    assert "m4" not in by_id                 # star 5.1 out of range
    assert "m5" not in by_id                 # star -1
    assert "c3" not in by_id                 # blank text
    assert by_id["m2"].star == 2.25 and by_id["m2"].date == dt.date(2025, 3, 9)
    assert by_id["m1"].date == dt.date(2025, 3, 18)   # duplicate: earliest day wins
    assert by_id["w1"].star is None                   # "None" star
    assert by_id["c2"].date is None                   # impossible day
    assert by_id["c1"].date == dt.date(2025, 3, 19)   # yyyy-MM-dd
    assert by_id["n1"].context == "일반 관객 리뷰 텍스트　입니다"
    assert by_id["critic"].star == 3.0


def test_day_and_movie_selection(spark, landed):
    day = src.read_reviews(spark, landed["megabox"], "megabox", day="2025-03-20").collect()
    assert {r.id for r in day} == {"t1"}
    movie = src.read_reviews(spark, landed["megabox"], "megabox", movie="Dune [IMAX], Part Two").collect()
    assert {r.id for r in movie} == {"m1", "m2", "m3", "m4", "m5"}


def test_megabox_tag_counts(spark, landed):
    raw = src.read_all_reviews(spark, {"megabox": landed["megabox"]})
    got = {(r.movieNm, r.keyword): r["count"] for r in platform_tag_counts(raw, "megabox").collect()}
    assert got == {("Dune [IMAX], Part Two", "연출"): 3, ("Dune [IMAX], Part Two", "배우"): 1,
                   ("Dune [IMAX], Part Two", "OST"): 1, ("Tom & Jerry+", "스토리"): 1}


def test_file_inventory(spark, landed):
    inv = src.file_inventory(spark, os.path.dirname(landed["megabox"]), "*.csv").collect()
    assert len(inv) == len(fx.REVIEW_FILES)
    assert all(r.length > 0 for r in inv)


def test_boxoffice_csv(spark, tmp):
    folder = fx.write_box_csv(tmp)
    df = src.read_boxoffice_csv(spark, folder)
    rows = {(r.boxoffice_date, r.movieNm): r for r in df.collect()}
    assert dict(df.dtypes)["salesAcc"] == "bigint" and dict(df.dtypes)["rank"] == "int"
    assert rows[(dt.date(2025, 3, 19), "Dune")].salesAcc == 3_000_000_000
    assert rows[(dt.date(2025, 3, 19), "Tom & Jerry")].salesAmt is None     # 'x'
    assert rows[(dt.date(2025, 3, 20), "Dune")].openDt == dt.date(2025, 2, 26)
    one_day = src.read_boxoffice_csv(spark, folder, day="2025-03-20")
    assert one_day.count() == 1


def test_api_json(spark, tmp):
    daily, bad, region = fx.write_box_json(tmp)
    d = src.read_boxoffice_json(spark, daily).collect()
    assert [r.movieNm for r in sorted(d, key=lambda r: r["rank"])] == ["Dune", "Wicked"]
    assert d[0].boxoffice_date == dt.date(2025, 3, 19)
    with pytest.raises(Exception):
        src.read_boxoffice_json(spark, bad).collect()
    r = src.read_region_json(spark, region).collect()
    assert sorted((x.region_name, x.movieNm) for x in r) == [("경기도", "Dune"), ("서울시", "Dune"), ("서울시", "Wicked")]


def test_region_codes(spark, tmp):
    codes = src.read_region_codes(spark, fx.write_region_codes(tmp)).collect()
    assert sorted((c.fullCd, c.korNm) for c in codes) == [("0105001000", "서울시"), ("0105002000", "경기도")]


def test_append_day_is_rerun_safe(spark, tmp):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    out = os.path.join(tmp, "t")
    sinks.append_day(df, out, "2025-03-19")
    sinks.append_day(df, out, "2025-03-19")
    sinks.append_day(df.limit(1), out, "2025-03-20")
    got = spark.read.parquet(out)
    assert got.count() == 3
    assert got.where(F.col("load_date") == "2025-03-19").count() == 2


def test_merge_into_folder(spark, tmp):
    old = spark.createDataFrame([("1", "x", "2025.03.18", "old")], "id string, context string, date string, v string")
    p0 = os.path.join(tmp, "v0")
    old.write.parquet(p0)
    new = spark.createDataFrame([("1", "x", "2025.03.18", "new"), ("2", "y", None, "new")],
                                "id string, context string, date string, v string")
    merged = sinks.merge_into_folder(spark, p0, new, ["id", "context", "date"], os.path.join(tmp, "v1"))
    assert sorted((r.id, r.v) for r in merged.collect()) == [("1", "old"), ("2", "new")]


def test_csv_sink_roundtrip(spark, tmp):
    df = spark.createDataFrame([("a,b", 'say "hi"\nbye')], "a string, b string")
    out = os.path.join(tmp, "csv")
    sinks.write_csv(df, out)
    back = src.read_csv(spark, out, df.schema, glob="*.csv").collect()
    assert back[0].a == "a,b" and back[0].b == 'say "hi"\nbye'


def test_review_page_extract(spark):
    html = ("<html><head><script>var t=\"</p>\";</script></head><body><article><h1>T <b>1</b></h1>"
            "<p><b>first</b> review<br><p class=r>second review</p><p>   </p></article></body></html>")
    pages = spark.createDataFrame([(1, "https://www.example.com/x?y=1", html)], "page_id long, url string, html string")
    rows = extract_reviews(pages).orderBy("pos").collect()
    assert [(r.pos, r.context) for r in rows] == [(1, "first review"), (2, "second review")]
    assert rows[0].domain == "www.example.com" and rows[0].title == "T 1"


def test_replace_table_twice_is_once(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    sinks.replace_table(df, "reviewlake_test_replace")
    sinks.replace_table(df, "reviewlake_test_replace")
    from reviewlake.sources.tables import read_table
    assert read_table(spark, "reviewlake_test_replace").count() == 2
    assert read_table(spark, "reviewlake_test_replace", ["k"]).columns == ["k"]


def test_csv_table_with_and_without_schema(spark, tmp):
    path = os.path.join(tmp, "codes")
    fx.write_csv(os.path.join(path, "region_codes.csv"), ["fullCd", "korNm"], [["0105001000", "서울시"]])
    typed = src.read_csv_table(spark, path, src.schemas.REGION_CODES_CSV).first()
    inferred = src.read_csv_table(spark, path)
    assert typed.fullCd == "0105001000"            # explicit schema keeps the leading zero
    assert dict(inferred.dtypes)["fullCd"] in ("int", "bigint")
    codes = src.read_region_codes(spark, path, fmt="csv").first()
    assert (codes.fullCd, codes.korNm) == ("0105001000", "서울시")


MEGABOX_PAGE = """<html><body><div class="movie-idv-story"><ul>
<li class="type01 oneContentTag"><div class="user-id">ab**12</div>
  <div class="story-area"><div class="story-txt">연출이 정말 좋았어요 최고</div>
  <div class="story-point"><span>9</span></div>
  <div class="story-recommend"><em>연출</em><em>배우</em><em>+2</em></div></div>
  <div class="story-date"><div><span>50분전</span></div></div></li>
<li class="type01 oneContentTag"><div class="user-id">cd**34</div>
  <div class="story-area"><div class="story-txt">스토리가 아쉬워요</div>
  <div class="story-point"><span>4</span></div>
  <div class="story-recommend"><em>스토리 외</em></div></div>
  <div class="story-date"><div><span>2025.03.18</span></div></div></li>
<li class="type01 oneContentTag"><div class="user-id"> </div>
  <div class="story-area"><div class="story-txt">작성자 없는 리뷰</div></div></li>
</ul></div></body></html>"""


def test_megabox_page_rows(spark):
    """Fields are read within each review block, so every row has its own
    reviewer id (SURVEY D26), with C19, C21, F13 and F14 applied."""
    from reviewlake.sources.pages import megabox_review_rows

    pages = spark.createDataFrame([(1, "https://www.example.com/movie/1", MEGABOX_PAGE)],
                                  "page_id long, url string, html string")
    rows = megabox_review_rows(pages, "2025-03-20 00:30:00").orderBy("id").collect()
    assert [(r.id, r.context, r.star, r.review_date, r.recommend_tags) for r in rows] == [
        ("ab**12", "연출이 정말 좋았어요 최고", "4.5", "2025.03.19", "['연출', '배우']"),
        ("cd**34", "스토리가 아쉬워요", "2.0", "2025.03.18", "[]"),
    ]


def _hit(title, year, img):
    pic = '<img src="x.jpg">' if img else ""
    return (f'<li class="zK9dEEA5"><a title="{title}" href="#">{pic}<div class="bVUVO8nJ">'
            f'<div class="qz_zPMlN RiDHrQhO">{year} ・ 한국</div></div></a></li>')


def test_search_pages_to_matches(spark):
    from reviewlake.operators.matching import candidate_match
    from reviewlake.sources.pages import search_hits

    p1 = "<ul>" + _hit("파묘", "2019", True) + _hit("파묘", "2024", False) + _hit("파묘 2", "2024", True) + "</ul>"
    p2 = "<ul>" + _hit("Other", "2020", False) + _hit("Dune: Part Two", "2023", True) + "</ul>"
    pages = spark.createDataFrame([(1, "https://search.example/ko?query=%ED%8C%8C%EB%AC%98&x=1", p1),
                                   (2, "https://search.example/ko?query=Dune%20Part%20Two", p2)],
                                  "page_id long, url string, html string")
    films = spark.createDataFrame([("파묘", "2024"), ("Dune Part Two", "2024"), ("None Found", "2020")],
                                  "movieNm string, open_year string")
    got = {r.movieNm: (r.position, r.match) for r in candidate_match(films, search_hits(pages)).collect()}
    assert got == {"파묘": (2, "exact"), "Dune Part Two": (2, "image"), "None Found": (None, None)}


def test_append_day_rerun_without_rows_clears_the_day(spark, tmp):
    out = os.path.join(tmp, "table")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    sinks.append_day(df, out, "2025-03-19")
    sinks.append_day(df, out, dt.date(2025, 3, 20))
    sinks.append_day(df.where("id > 5"), out, "2025-03-19")
    assert sorted((r.id, str(r.load_date)) for r in spark.read.parquet(out).collect()) == [(1, "2025-03-20"), (2, "2025-03-20")]


def test_s9_one_film_of_dated_and_undated_files(spark, tmp):
    header = ["id", "context", "star", "review_date", "recommend_tags"]
    for film in ("A", "A_B"):
        fx.write_csv(os.path.join(tmp, "megabox_reviews", f"{film}_20250311_megabox_reviews.csv"), header, [[film, "리뷰", "4", "2025.03.11", "[]"]])
        fx.write_csv(os.path.join(tmp, "watcha_reviews", f"{film}_watcha_reviews.csv"), ["id", "star", "context"], [[film, "4", "리뷰"]])
    for platform in ("megabox", "watcha"):
        rows = src.read_reviews(spark, os.path.join(tmp, f"{platform}_reviews"), platform, movie="A")
        assert [r.id for r in rows.collect()] == ["A"]
    dated = src.read_reviews(spark, os.path.join(tmp, "megabox_reviews"), "megabox", movie="A", day="2025-03-11")
    assert [r.id for r in dated.collect()] == ["A"]


def test_page_text_breaks_and_references(spark):
    from reviewlake.sources.pages import strip_tags

    df = spark.createDataFrame([("좋아요<br>최고 &amp; 감동 &#39;굿&#39; &#xAC00;&lt;b&gt; &amp;lt;<p>둘</p>셋<br/>넷",), ("&#0; &#x110000; &#128512;",), (None,)], "h string")
    got = [r[0] for r in df.select(strip_tags(F.col("h"))).collect()]
    assert got == ["좋아요\n최고 & 감동 '굿' 가<b> &lt;둘\n셋\n넷", "\ufffd \ufffd 😀", None]


def test_review_pages_of_the_other_sites(spark):
    from reviewlake.sources import pages as pg

    cine = ('<ul class="expert_rating"><li><div><div class="star_area"><span>8</span></div><div class="comment_area"><a href="#"><span>평론가</span></a>'
            '<span>좋은 &amp; 깊은<br>영화</span></div></div></li></ul><ul class="reply_box"><li><div class="id">관객</div><div class="date">2025.03.18 10:20</div>'
            '<div class="star"><span>7</span></div><div class="comment ellipsis_3">재미있는 <b>영화</b></div></li>'
            '<li><div class="id"></div><div class="date"></div><div><span>2</span></div><div class="comment">이름 없음</div></li></ul>')
    cgv = ('<ul id="movie_point_list_container"><li class="x"><div class="a">img</div><div class="b"><ul><li>nick</li><li><span>2025.03.17</span> <span>1</span></li></ul></div>'
           '<div class="c"><p>정말 좋은 영화</p></div></li><li><div></div><ul><li>둘째</li><li><span>2025.03.16</span></li></ul><div><p>별로예요</p></div></li></ul>')
    one = '<div class="GvYMMD2G sCUeLl5F"><div class="TfbnQJp1 qfFKTvc9">{}</div>{}<div class="tCqzOhhS Jgl_VtOt _4_jash0F"><a href="#"><div><div>{}</div></div></a></div></div>'
    watcha = "<body>" + one.format("별명", '<div class="H7gLZE2m KYbG4TeN"><span>4.5</span></div>', "볼만한 영화") + one.format("둘째", "", "그저 그런 영화") + "</body>"
    df = spark.createDataFrame([(1, "https://a", cine), (2, "https://b", cgv), (3, "https://c", watcha)], "page_id long, url string, html string")
    assert sorted(map(tuple, pg.cine_review_rows(df).drop("page_id").collect()), key=str) == [
        ("expert", "평론가", "좋은 & 깊은\n영화", "8", None), ("netizen", "관객", "재미있는 영화", "3.5", "2025.03.18")]
    assert sorted(map(tuple, pg.cgv_review_rows(df).drop("page_id").collect())) == [("nick", "정말 좋은 영화", "2025.03.17"), ("둘째", "별로예요", "2025.03.16")]
    assert sorted(map(tuple, pg.watcha_review_rows(df).drop("page_id").collect())) == [("둘째", "None", "그저 그런 영화"), ("별명", "4.5", "볼만한 영화")]


def test_named_files_are_written_without_sorting_their_rows(spark, tmp_path, monkeypatch):
    """Files of several names are open side by side, as a sort would hold a name's rows in memory; the setting is given back."""
    from pyspark.sql import DataFrameWriter

    from reviewlake.sources import sinks

    seen, csv, setting = [], DataFrameWriter.csv, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting, None)
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, *a, **k: (seen.append(spark.conf.get(setting, "0")), csv(self, *a, **k))[1])
    rows = spark.range(300).selectExpr("id", "concat('n', id % 3) AS f", "'a\"b' AS t")
    assert sinks.write_named_csv(rows, str(tmp_path), "f") == 3
    assert int(seen[0]) >= 3 and spark.conf.get(setting, None) == before
    got = {n: spark.read.options(header=True, escape='"').csv(f"{tmp_path}/{n}.csv").collect() for n in ("n0", "n1", "n2")}
    assert {n: sorted(int(r.id) for r in v) for n, v in got.items()} == {f"n{k}": list(range(k, 300, 3)) for k in range(3)}
    assert {r.t for v in got.values() for r in v} == {'a"b'}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_drifting_responses_are_parsed_once(spark, tmp):
    """Neither the rows nor the audit parse a response again for each mention of it, and both come out of one reading."""
    import json

    from reviewlake.sources.responses import lost_fields, read_boxoffice_drifting

    lists = [[{"rank": "1", "showCnt": 2}, None, 5, {"rank": [1], "x": {}, "showCnt": {"y": 1}}], [], {"rank": True}, "none", None]
    lines = [json.dumps({"boxOfficeResult": {"showRange": "20250318~20250318", "dailyBoxOfficeList": x}}) for x in lists] + ["{", "{}"]
    with open(os.path.join(tmp, "a.json"), "w") as f:
        f.write("\n".join(lines))
    fields = ("rank", "showCnt")
    rows, audit = read_boxoffice_drifting(spark, tmp, multi_line=False, fields=fields)
    assert sorted(map(repr, (tuple(r)[1:] for r in rows.collect()))) == sorted(map(repr, [("1", "2"), (None, None), (None, None), (None, None), ("true", None)]))
    assert sorted((r.status, r.entries, r.unknown, r.missing, r.mistyped, r.raw is None) for r in audit.collect()) == sorted([
        ("ok", 4, 1, 4, 2, True), ("empty", 0, 0, 0, 0, False), ("single", 1, 0, 1, 0, True), ("mistyped", 0, 0, 0, 0, False), ("absent", 0, 0, 0, 0, False),
        ("absent", 0, 0, 0, 0, False), ("unparsed", 0, 0, 0, 0, False)])
    assert _plan(rows).count("parseJson(") == 1 and _plan(audit).count("parseJson(") == 1
    both = read_boxoffice_drifting(spark, tmp, multi_line=False, fields=fields, together=True)
    assert _plan(both).count("parseJson(") == 1
    assert sorted(map(repr, both.where("place = 0").select(*audit.columns).collect())) == sorted(map(repr, audit.collect()))
    assert sorted(map(repr, both.where("place > 0").select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))
    entry = F.try_parse_json(F.lit('{"b": {}, "x": 1, "a": {"c": [1]}}'))
    assert [sorted(x) for x in spark.range(1).select(*lost_fields(entry, ("a.c", "b", "d"))).first()] == [["a", "x"], ["a.c", "d"], ["a.c", "b"]]


def test_chart_rows_dealt_for_a_grouping(spark, tmp):
    """Rows dealt by a grouping's columns are the same rows, and the grouping need not deal them again."""
    from reviewlake.sources import testdata as td

    orders = [(k, dt.datetime(2024, 1, 1 + k % 3), 10.5 * (k % 4)) for k in range(20)] + [(None, None, None), (20, None, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz, o_totalprice double").write.parquet(f"{tmp}/orders.parquet")
    lines = [(k % 22, k, k, 1 + k % 7, float(k), 1.25 * k, 0.01, 0.02) for k in range(80)] + [(None,) * 8, (3,) + (None,) * 7]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                                 "l_tax double").write.parquet(f"{tmp}/lineitem.parquet")
    keys = ("salesAcc", "openDt")
    dealt = td.raw_chart_strings(spark, tmp, deal=keys)
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, td.raw_chart_strings(spark, tmp).collect())) and dealt.count() > 70
    assert _plan(dealt.groupBy(*keys).agg(F.collect_list("rank"))).count("Exchange hashpartitioning") == 1
