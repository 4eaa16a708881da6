"""Stream = batch: review files landing in several drops give
the batch result after each availableNow run."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from reviewlake.functions.dates import parse_review_date
from reviewlake.operators.unify import normalize_platform
from reviewlake.session import checkpoint_dir
from reviewlake.sources import files as src
from reviewlake.streaming import daily as st
from tests import fixtures as fx

HEADER = ["id", "context", "star", "review_date", "recommend_tags"]


def _drop(folder, n, rows):
    fx.write_csv(os.path.join(folder, f"Film {n}_2025031{n}_megabox_reviews.csv"), HEADER, rows)


def test_stream_runs_equal_batch(spark, tmp):
    """Three drops with repeats, a review more than a year late and reviews without a day: nothing is lost or doubled."""
    land = os.path.join(tmp, "megabox_reviews")
    drops = [
        [["a", "첫번째 리뷰 텍스트입니다", "4", "2025.03.11", "[]"],
         ["b", "두번째 리뷰 텍스트입니다", "3", "2025.03.11", "[]"],
         ["x", "날짜 없는 리뷰 텍스트입니다", "3", "", "[]"]],
        [["a", "첫번째 리뷰 텍스트입니다", "4", "2025.03.11", "[]"],      # same key again
         ["c", "세번째 리뷰 텍스트입니다", "5", "2025.03.12", "[]"]],
        [["d", "네번째 리뷰 텍스트입니다", None, "2025.03.13", "[]"],
         ["e", "아주 오래된 리뷰 텍스트입니다", "2", "2023.12.01", "[]"],   # far behind the newest day
         ["y", "날짜 없는 다른 리뷰 텍스트입니다", "3", "", "[]"]],
    ]
    base = checkpoint_dir(spark)
    out, ck1, cnt, ck2 = (os.path.join(base, f"{x}-{uuid.uuid4().hex}") for x in ("upsert", "ck", "counts", "ck"))
    keys = ["movieNm", "id", "context"]
    for n, rows in enumerate(drops, start=1):
        _drop(land, n, [[x if x is not None else "" for x in r] for r in rows])
        stream = st.with_review_day(normalize_platform(st.review_file_stream(spark, land, "megabox"),
                                                       "megabox", file_col="file_name")).withColumn("movieNm", F.lit("one film"))
        st.upsert_batches(stream.select(*keys, "date"), out, keys, ck1).awaitTermination()
        st.counts_to_table(stream, cnt, ck2).awaitTermination()

        batch = normalize_platform(src.read_reviews(spark, land, "megabox"), "megabox", file_col="file_name").withColumn("movieNm", F.lit("one film"))
        want_keys = sorted(tuple(r) for r in batch.select(*keys).distinct().collect())
        got_keys = sorted(tuple(r) for r in spark.read.parquet(out).select(*keys).collect())
        assert got_keys == want_keys
        day = parse_review_date("date")
        want = sorted((str(r[1]), r[2]) for r in batch.groupBy("movieNm", day.alias("review_date")).count().collect())
        got = sorted((str(r.review_date), r["count"]) for r in st.read_counts(spark, cnt).collect())
        assert got == want
    assert ("None", 2) in got and ("2023-12-01", 1) in got
    assert spark.read.parquet(out).count() == 7


def test_a_retried_batch_counts_once(spark, tmp):
    land = os.path.join(tmp, "megabox_reviews")
    _drop(land, 1, [["a", "첫번째 리뷰 텍스트입니다", "4", "2025.03.11", "[]"]])
    base = checkpoint_dir(spark)
    out, ck = os.path.join(base, f"counts-{uuid.uuid4().hex}"), os.path.join(base, f"ck-{uuid.uuid4().hex}")
    stream = st.with_review_day(normalize_platform(st.review_file_stream(spark, land, "megabox"), "megabox", file_col="file_name"))
    st.counts_to_table(stream, out, ck).awaitTermination()
    os.remove(os.path.join(ck, "commits", "0"))  # as if the driver was lost before the batch was committed
    crc = os.path.join(ck, "commits", ".0.crc")
    if os.path.exists(crc):
        os.remove(crc)
    st.counts_to_table(stream, out, ck).awaitTermination()
    assert [r["count"] for r in st.read_counts(spark, out).collect()] == [1]
    st.compact_counts(spark, out, out + "-compact")
    assert [r["count"] for r in st.read_counts(spark, out + "-compact").collect()] == [1]


def test_only_a_missing_folder_means_no_table(spark, tmp):
    assert st.table_or_none(spark, os.path.join(tmp, "nowhere")) is None
    broken = os.path.join(tmp, "broken")
    os.makedirs(broken)
    with open(os.path.join(broken, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        st.table_or_none(spark, broken)


def test_rerun_of_same_input_adds_nothing(spark, tmp):
    land = os.path.join(tmp, "megabox_reviews")
    _drop(land, 1, [["a", "첫번째 리뷰 텍스트입니다", "4", "2025.03.11", "[]"]])
    base = checkpoint_dir(spark)
    out = os.path.join(base, f"upsert-{uuid.uuid4().hex}")
    keys = ["id", "context"]
    for _ in range(2):  # a lost checkpoint: the same file is processed twice
        ck = os.path.join(base, f"ck-{uuid.uuid4().hex}")
        s = st.review_file_stream(spark, land, "megabox").select(*keys)
        st.upsert_batches(s, out, keys, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_partitioned_upsert_reads_only_touched_days(spark, tmp):
    land = os.path.join(tmp, "megabox_reviews")
    base = checkpoint_dir(spark)
    out = os.path.join(base, f"upsert-{uuid.uuid4().hex}")
    ck = os.path.join(base, f"ck-{uuid.uuid4().hex}")
    keys = ["id", "context", "date"]
    drops = [
        [["a", "첫번째 리뷰 텍스트입니다", "4", "2025.03.11", "[]"], ["b", "두번째 리뷰 텍스트입니다", "3", "", "[]"]],
        [["a", "첫번째 리뷰 텍스트입니다", "4", "2025.03.11", "[]"], ["b", "두번째 리뷰 텍스트입니다", "3", "", "[]"],
         ["c", "세번째 리뷰 텍스트입니다", "5", "2025.03.12", "[]"]],
    ]
    for n, rows in enumerate(drops, start=1):
        _drop(land, n, rows)
        s = normalize_platform(st.review_file_stream(spark, land, "megabox", max_files=1), "megabox",
                               file_col="file_name").select(*keys)
        st.upsert_batches(s, out, keys, ck, partition_col="date").awaitTermination()
    got = sorted((r.id, r.date) for r in spark.read.parquet(out).collect())
    assert got == [("a", "2025.03.11"), ("b", None), ("c", "2025.03.12")]
