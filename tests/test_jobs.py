"""End-to-end jobs over landed fixture files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from reviewlake.plans import jobs
from tests import fixtures as fx


def test_review_batch_job(spark, tmp):
    folders = fx.write_reviews(os.path.join(tmp, "land"))
    paths = jobs.review_batch_job(spark, folders, os.path.join(tmp, "out"))
    cleaned = spark.read.parquet(paths["cleaned_reviews"])
    assert cleaned.count() == 9   # megabox 2 + 1, cgv 2, cine 2, watcha 2
    tags = {(r.movieNm, r.keyword): r["count"] for r in spark.read.parquet(paths["megabox_keywords"]).collect()}
    assert tags[("Dune [IMAX], Part Two", "연출")] == 2   # m1 once (its duplicate is dropped) and m2
    kws = {r.keyword for r in spark.read.parquet(paths["movie_keywords"]).collect()}
    assert "최고의" in kws and "영화" not in kws
    s = spark.read.parquet(paths["review_sentiment"])
    assert s.count() == cleaned.where(F.col("date").isNotNull()).count()
    assert spark.read.parquet(paths["review_sentiment_wordcloud"]).count() > 0


def test_review_daily_job_is_rerun_safe(spark, tmp):
    folders = fx.write_reviews(os.path.join(tmp, "land"))
    out = os.path.join(tmp, "out")
    jobs.review_daily_job(spark, {"megabox": folders["megabox"]}, out, "2025-03-19")
    p = jobs.review_daily_job(spark, {"megabox": folders["megabox"]}, out, "2025-03-19")
    first = spark.read.parquet(p["cleaned_reviews"]).count()
    jobs.review_daily_job(spark, {"megabox": folders["megabox"]}, out, "2025-03-20")
    raw = spark.read.parquet(p["review_data"])
    assert raw.where("load_date = '2025-03-19'").count() == 6      # the day's file, once
    cleaned = spark.read.parquet(p["cleaned_reviews"])
    assert first == 2 and cleaned.count() == 3                         # m1 and m2, then t1


def test_boxoffice_job(spark, tmp):
    daily = fx.write_box_csv(os.path.join(tmp, "land"))
    paths = jobs.boxoffice_job(spark, daily, os.path.join(tmp, "out"))
    rows = spark.read.parquet(paths["monthly_sales"]).collect()
    assert [(r.month.isoformat(), r.sales, r.audience) for r in rows] == [("2025-03-01", 3000, 300)]


def test_job_cli(spark, tmp, capsys):
    import json
    import sys

    from reviewlake.session import SCALE_SETTINGS

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
    import run_job

    saved = {k: spark.conf.get(k, None) for k in SCALE_SETTINGS}
    try:
        daily = fx.write_box_csv(os.path.join(tmp, "land"))
        run_job.main(["boxoffice", "--out", os.path.join(tmp, "out"), "--daily", daily])
        paths = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
        assert spark.read.parquet(paths["monthly_sales"]).count() == 1
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_daily_analysis_is_the_batch_by_days(spark, tmp):
    """Two days and a rerun give the batch tables of those days."""
    from reviewlake.operators import keywords as kw
    from reviewlake.operators import sentiment as se
    from reviewlake.operators.clean import clean_reviews

    rows = [("A", "u1", "최고 감동 연기 최고였다", "5", "2025.03.18", "megabox", "['연출', '배우']"),
            ("A", "u2", "지루 최악 실망 입니다요", "1", "2025.03.19", "megabox", "['연출']"),
            ("B", "u1", "감동 추천 최고 입니다요", "4", "2025.03.19", "cgv", None),
            ("B", "u3", "다른 날의 리뷰 텍스트입니다", "3", "2025.03.21", "cgv", None)]
    schema = "movieNm string, id string, context string, star string, date string, platform string, recommend_tags string"
    cleaned = os.path.join(tmp, "cleaned")
    clean_reviews(spark.createDataFrame(rows, schema)).write.parquet(cleaned)
    out = os.path.join(tmp, "out")
    for run_date in ("2025-03-19", "2025-03-20", "2025-03-20"):
        paths = jobs.review_analysis_daily_job(spark, cleaned, out, run_date)
    both = spark.read.parquet(cleaned).where("date between '2025-03-18' and '2025-03-19'")

    def same(name, batch):
        got = spark.read.parquet(paths[name]).drop("review_date").groupBy("movieNm", batch.columns[1]).agg(F.sum("count").alias("count"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))

    same("daily_keywords", kw.movie_keywords(both, "hangul"))
    same("daily_tags", kw.platform_tag_counts(both, "megabox"))
    scored = se.score_lexicon(both, charset="hangul")
    got = spark.read.parquet(paths["daily_sentiment"]).select(scored.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, scored.collect()))


def test_boxoffice_daily_job_from_landed_json(spark, tmp):
    import json

    from reviewlake.sources import schemas

    def entry(rank, name):
        return {f: None for f in schemas.BOXOFFICE_FIELDS} | {"rank": str(rank), "movieNm": name, "salesAmt": "1000", "audiCnt": "10"}

    folder, region = os.path.join(tmp, "daily"), os.path.join(tmp, "region")
    os.makedirs(folder)
    os.makedirs(region)
    for day in ("20250318", "20250319"):
        with open(os.path.join(folder, f"{day}.json"), "w", encoding="utf-8") as f:
            json.dump({"boxOfficeResult": {"showRange": f"{day}~{day}", "dailyBoxOfficeList": [entry(1, "A"), entry(2, "B")]}}, f)
        listed = {"boxOfficeResult": {"showRange": f"{day}~{day}", "dailyBoxOfficeList": [{"rank": "1", "movieNm": "A", "audiCnt": "7"}]}}
        for code, data in (("R1", listed), ("R2", {"boxOfficeResult": {"showRange": f"{day}~{day}", "dailyBoxOfficeList": []}}), ("R3", {})):
            with open(os.path.join(region, f"{day}-{code}.json"), "w", encoding="utf-8") as f:
                json.dump({"region_code": code, "region_name": None, "data": data}, f)
    codes = spark.createDataFrame([("R1", "서울"), ("R2", "부산")], "fullCd string, korNm string")
    out = os.path.join(tmp, "out")
    for day in ("2025-03-18", "2025-03-19", "2025-03-19"):
        paths = jobs.boxoffice_daily_job(spark, out, day, folder, region_json=region, region_codes=codes)
    rows = spark.read.parquet(paths["boxoffice"])
    assert sorted((str(r.boxoffice_date), r["rank"], r.movieNm, r.salesAmt) for r in rows.collect()) == [
        (d, k, n, 1000) for d in ("2025-03-18", "2025-03-19") for k, n in ((1, "A"), (2, "B"))]
    regional = spark.read.parquet(paths["region_boxoffice"])
    assert sorted((str(r.boxoffice_date), r.region_name, r.audiCnt) for r in regional.collect()) == [("2025-03-18", "서울", 7), ("2025-03-19", "서울", 7)]


def test_landed_responses_are_packed(spark):
    """Responses of one a line land compressed, and all their rows come back."""
    import glob

    import __spark_entry__ as entry
    from reviewlake.session import checkpoint_dir
    from tests.conftest import SF001

    base = checkpoint_dir(spark).removeprefix("file:")
    for name, tag in (("api_json_ingest", "api-json"), ("region_json_ingest", "region-json"), ("json_drift", "json-drift")):
        old = set(glob.glob(f"{base}/**/{tag}-*/part-*", recursive=True))
        assert entry.queries()[name](spark, SF001).count() > 0
        new = set(glob.glob(f"{base}/**/{tag}-*/part-*", recursive=True)) - old
        assert new and all(f.endswith(".txt.gz") for f in new), name
