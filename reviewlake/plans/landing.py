"""Registered queries over landed files, versioned and keyed tables, and streams that commit tables.

Each lands the driver's tables in the shape that the feature is about (named CSV files, drifting JSON, pages with lists in
lists, three or twenty drops) and returns what the library makes of it; ``landing_oracle`` says the same in SQL.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions.files import day_in_review_file, title_from_file
from reviewlake.functions.text import STOPWORDS_KO
from reviewlake.operators import boxoffice as bo
from reviewlake.operators import sentiment as se
from reviewlake.operators.clean import clean_reviews
from reviewlake.operators.evaluation import evaluate_scores
from reviewlake.operators.stems import stem_keywords
from reviewlake.session import checkpoint_dir
from reviewlake.sources import files as src
from reviewlake.sources import pages as pg
from reviewlake.sources import schemas
from reviewlake.sources import testdata as td
from reviewlake.sources.keyindex import merge_into, read_merged
from reviewlake.sources.ledger import ingest_pending
from reviewlake.sources.rejects import land_csv
from reviewlake.sources.responses import read_boxoffice_drifting
from reviewlake.sources.sinks import replace_table, write_csv, write_named_csv
from reviewlake.sources.tables import read_table
from reviewlake.sources.versions import read_version

Query = Callable[[SparkSession, str], DataFrame]

MERGE_KEYS = ("id", "context", "date")
#: Compression of landed responses, whose field names repeat in every line.
LANDED = "gzip"


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex[:12]}")


# ------------------------------------------------------------ keyed merge
# Event days at which the increments of the merges end; the last lands again what the second brought.
FIRST_END, SECOND_END = "2024-01-12", "2024-01-22"


def merge_bucketed(spark, d):
    """S22 + S19: three increments merged by key index; the second runs twice, first with too many rows, and the third repeats old reviews."""
    out = scratch(spark, "merge-bucketed")
    first, second = td.reviews_rt(spark, d, before=FIRST_END), td.reviews_rt(spark, d, since=FIRST_END, before=SECOND_END)
    third = td.reviews_rt(spark, d, since=FIRST_END)
    order = ["movieNm", "star", "platform", "recommend_tags"]
    for batch, rows in (("a", first), ("b", second.unionByName(second.withColumn("id", F.concat("id", F.lit("x"))))), ("b", second), ("c", third)):
        merge_into(rows, out, MERGE_KEYS, batch, buckets=16, expected_keys=100_000, order=order)
    return read_merged(spark, out)


# ------------------------------------------------------------ pages
#: A page's paragraphs as a review list of the site with nested lists and boxes in its reviews.
LIST_OPEN, LIST_CLOSE = '<html><h1>list</h1><ul class="menu"><li>Home</li></ul><ul class="reply_box" id="r">', "</ul><ul><li>Footer</li></ul></html>"


def nested_pages(spark, d):
    """Pages as ``CINE_NETIZEN_RULE`` reads them: one item per paragraph of the article; every second holds a list in a list, every third a box in its text."""
    body = F.regexp_extract("html", "(?s)<article[^>]*>(.*)</article>", 1)
    blocks = F.slice(F.split(body, "<p[^>]*>"), 2, 1_000_000)
    plain = F.transform(blocks, lambda b: F.regexp_replace(b, "<[^>]*>", ""))

    def item(text, i):
        inner = F.when(i % 3 == 0, F.concat(F.lit("<div><div>"), text, F.lit("</div></div> tail"))).otherwise(text)
        nested = F.when(i % 2 == 0, F.lit("<ul><li>like<ul><li>9</li></ul></li><li>share</li></ul><!-- </ul> -->")).otherwise("")
        return F.concat(F.lit('<li class="x"><div class="id">user '), i.cast("string"), F.lit('</div><div class="date">2025.03.18 10:20</div><div><span>8</span></div>'),
                        F.lit('<div class="comment">'), inner, F.lit("</div>"), nested, F.lit("</li>"))

    pages = td.table(spark, d, "pages")
    return pages.select("page_id", "url", F.concat(F.lit(LIST_OPEN), F.array_join(F.transform(plain, item), ""), F.lit(LIST_CLOSE)).alias("html"))


def page_reviews_nested(spark, d):
    """Reviews of lists that hold lists, to the list's own end."""
    rows = pg.cine_review_rows(nested_pages(spark, d))
    return rows.select("page_id", "who", "name", "context", "star", "date")


# ------------------------------------------------------------ CSV
# Fixed parameters of the damage: short records and records with a field too many.
SHORT, LONG = "doc_id % 7 = 3", "doc_id % 11 = 5"


def csv_rejects(spark, d):
    """Whole documents landed as CSV with quotes and line breaks, some records short, some long; rows and rejects together are what landed."""
    out, land = scratch(spark, "csv-rejects"), scratch(spark, "csv-land")
    docs = td.table(spark, d, "documents").select("doc_id", "text", "source")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    record = (F.when(F.expr(SHORT), F.concat_ws(",", "doc_id", quoted)).when(F.expr(LONG), F.concat_ws(",", "doc_id", quoted, "source", F.lit("more")))
              .otherwise(F.concat_ws(",", "doc_id", quoted, "source")))
    docs.select(record.alias("value")).write.text(land)
    landed = land_csv(spark, land, schemas.strings("doc_id", "context", "source"), out, header="false")
    good = landed.good.select(F.lit("row").alias("kind"), "doc_id", "source", F.md5("context").alias("md5"), F.lit(None).cast("string").alias("problem"))
    bad = landed.rejects.select(F.lit("reject").alias("kind"), F.regexp_extract("record", "^([0-9]+)", 1).alias("doc_id"), F.lit(None).cast("string").alias("source"),
                                F.md5("record").alias("md5"), "problem")
    count = spark.range(1).select(F.lit("count").alias("kind"), F.lit(str(landed.rows)).alias("doc_id"), F.lit(None).cast("string").alias("source"),
                                  F.lit(None).cast("string").alias("md5"), F.lit(str(landed.rejected)).alias("problem"))
    return good.unionByName(bad).unionByName(count)


def csv_table_quoted(spark, d):
    """S20 + S21: whole documents through the CSV sink and back as a table, quotes, commas and line breaks included."""
    out = scratch(spark, "csv-quoted")
    docs = td.table(spark, d, "documents").select("doc_id", F.concat(F.lit('he said "'), "text", F.lit('", ok\nnext')).alias("text"), "lang")
    write_csv(docs, out)
    return src.read_csv_table(spark, out, docs.schema).select("doc_id", "lang", F.md5("text").alias("md5"), F.length("text").alias("n_chars"))


# ------------------------------------------------------------ charts
def chart_csv_ingest(spark, d):
    """S3 + S5 + S7 + S8 + C3: daily chart files, named by day, to typed rows with the day; read file by file and all at once, and listed."""
    land = scratch(spark, "chart-csv")
    raw = td.raw_chart_strings(spark, d)
    name = F.concat(F.lit("daily_box_office_"), F.date_format(F.trunc(F.to_date("openDt"), "quarter"), "yyyyMMdd"))
    write_named_csv(raw.withColumn("_file", name), land, "_file")
    whole = src.read_boxoffice_csv(spark, land)
    one = src.read_boxoffice_csv(spark, land, day="1996-04-01")
    listed = src.file_inventory(spark, land, "daily_box_office_*.csv").where("length > 0")
    rows = whole.groupBy("boxoffice_date").agg(F.count(F.lit(1)).alias("n"), F.sum("salesAmt").alias("sales"), F.sum("rankInten").alias("shift"), F.min("openDt").alias("first"))
    files = listed.groupBy(F.lit(None).cast("date").alias("boxoffice_date")).agg(F.count(F.lit(1)).alias("n"))
    day = one.groupBy(F.lit("1900-01-01").cast("date").alias("boxoffice_date")).agg(F.count(F.lit(1)).alias("n"), F.sum("salesAmt").alias("sales"))
    return rows.unionByName(files, allowMissingColumns=True).unionByName(day, allowMissingColumns=True)


def region_csv_ingest(spark, d):
    """S4 + S15 + J1: regional chart files to typed rows; the region's name comes from the region codes, landed as the API's payload and as its CSV."""
    land, codes_json, codes_csv = (scratch(spark, x) for x in ("region-csv", "region-codes", "region-codes-csv"))
    raw = td.raw_region_strings(spark, d)
    name = F.concat(F.lit("daily_region_box_office_"), F.substring("day", 1, 4), F.lit("0101"))
    write_named_csv(raw.withColumn("_file", name).withColumn("region_name", F.lit("?")).drop("day"), land, "_file")
    codes = td.region_codes(spark, d)
    payload = codes.agg(F.to_json(F.struct(F.collect_list(F.struct("fullCd", "korNm")).alias("codes"))).alias("value"))  # one row a region
    payload.write.text(codes_json)
    write_csv(codes, codes_csv)
    both = src.read_region_codes(spark, codes_json).intersect(src.read_region_codes(spark, codes_csv, "csv"))
    rows = bo.region_attach(src.read_region_csv(spark, land).drop("region_name"), both)
    return rows.groupBy("boxoffice_date", "region_code", "region_name").agg(F.count(F.lit(1)).alias("n"), F.sum("salesAcc").alias("acc"), F.sum("rankInten").alias("shift"))


def review_files(spark, d):
    """S8 + S9 + S10 + C1 + C2: review files named by film and day; one film's, one day's and all of them, with film and day from the name."""
    land = scratch(spark, "review-files")
    docs = td.table(spark, d, "documents")
    film = F.concat(F.lit("A%20"), "source")
    stamp = F.concat(F.lit("2024011"), (F.col("doc_id") % 3).cast("string"))
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("context"), F.lit("5").alias("star"), F.lit("2024.01.10").alias("review_date"),
                       F.lit("[]").alias("recommend_tags"), F.concat_ws("_", film, stamp, F.lit("megabox_reviews")).alias("_file"))
    write_named_csv(rows, land, "_file")
    title, day = title_from_file("file_name", "megabox").alias("title"), day_in_review_file("file_name", "megabox").alias("day")
    count = lambda kind, df: df.groupBy(F.lit(kind).alias("kind"), title, day).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("context")).alias("n_chars"))
    found = count("all", src.read_reviews(spark, land, "megabox")).unionByName(count("day", src.read_reviews(spark, land, "megabox", day="2024-01-11")))
    return found.unionByName(count("film", src.read_reviews(spark, land, "megabox", movie="A%20src1")))


def json_drift(spark, d):
    """S13 for drifting payloads: one response per order with all its entries; some lists empty, absent, mistyped or a single entry, some fields nested or unknown."""
    land = scratch(spark, "json-drift")
    raw = td.raw_chart_strings(spark, d, deal=("salesAcc", "openDt")).withColumn("cd", F.col("movieCd").cast("long"))
    entry = F.to_json(F.struct(*schemas.BOXOFFICE_FIELDS))
    nested = F.to_json(F.struct(*[c for c in schemas.BOXOFFICE_FIELDS if c != "showCnt"], F.struct("showCnt").alias("showCnt"), F.lit(1).alias("extra")))
    raw = raw.withColumn("entry", F.when(F.col("cd") % 5 == 0, nested).otherwise(entry))
    per = raw.groupBy("salesAcc", "openDt").agg(F.sort_array(F.collect_list(F.struct("rank", "cd", "entry")))["entry"].alias("entries"),
                                              F.min("cd").alias("cd"))  # an order has seven lines at most
    kind = F.col("cd") % 8
    lst = (F.when(kind == 0, F.lit("[]")).when(kind == 1, F.lit('"none"')).when(kind == 2, F.element_at("entries", 1))
           .otherwise(F.concat(F.lit("["), F.array_join("entries", ","), F.lit("]"))))
    day = F.regexp_replace("openDt", "-", "")
    rest = F.when(kind == 3, F.lit("")).otherwise(F.concat(F.lit(',"dailyBoxOfficeList":'), lst))
    doc = F.concat(F.lit('{"boxOfficeResult":{"showRange":"'), day, F.lit("~"), day, F.lit('"'), rest, F.when(kind == 4, F.lit("}")).otherwise(F.lit("}}")))
    per.select(doc.alias("value")).write.text(land, compression=LANDED)
    both = read_boxoffice_drifting(spark, land, multi_line=False, together=True)
    row, audit = F.col("place") > 0, lambda c: F.when(F.col("place") == 0, c)
    return both.groupBy("boxoffice_date", F.when(row, "rows").otherwise(F.col("status")).alias("status")).agg(
        F.sum(audit(F.lit(1))).alias("responses"), F.sum(F.when(row, 1).otherwise(F.col("entries"))).alias("entries"), F.sum(audit(F.col("unknown"))).alias("unknown"),
        F.sum(F.when(row, F.col("showCnt").isNull().cast("int")).otherwise(F.col("missing"))).alias("missing"), F.sum(audit(F.col("mistyped"))).alias("mistyped"),
        F.sum(F.when(row, F.col("salesAmt").cast("bigint"))).alias("sales"))


# ------------------------------------------------------------ tables
def table_replace(spark, d):
    """S18 + S17 + S12: a table replaced twice, then by a load that fails half-way; the table, and its first version under ``version`` 0."""
    name = f"replaced_{uuid.uuid4().hex[:12]}"
    path = scratch(spark, "table-replace")
    cleaned = clean_reviews(td.reviews_rt(spark, d), columns=("movieNm", "id", "star", "date", "platform"))
    replace_table(cleaned, name, path)
    replace_table(read_table(spark, name).where("star >= 2"), name, path)  # reads the table that it replaces
    broken = cleaned.withColumn("star", F.when(F.col("star") > 4, F.raise_error(F.lit("load stopped")).cast("double")).otherwise(F.col("star")))
    try:
        replace_table(broken, name, path)
    except Exception as e:  # noqa: BLE001 - the failing load is the case
        if "load stopped" not in str(e):
            raise
    try:
        now = read_table(spark, name).withColumn("version", F.lit(1))
        return now.unionByName(read_version(spark, path, 0).withColumn("version", F.lit(0)))
    finally:
        spark.sql(f"DROP TABLE {name}")  # of the catalog only; the versions' files stay


def file_ledger(spark, d):
    """A landing folder read four times: at first, with nothing new, with two sources written again, and with late files; what each run read."""
    land, ledger, out = (scratch(spark, f"ledger-{x}") for x in ("land", "book", "rows"))
    docs = td.table(spark, d, "documents").select("doc_id", "text", "source")
    late, again = F.col("source").isin("src1", "src2"), F.col("source").isin("src3", "src4")

    def write(rows, run):
        rows.select(F.lit(run).alias("run"), "source", F.length("text").alias("n")).write.mode("overwrite").parquet(f"{out}/{run}")

    def read(paths):
        return spark.read.schema(docs.schema).option("basePath", land).parquet(*paths)

    def drop(rows):
        rows.repartition("source").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(land)

    drop(docs.where(~late))
    ingest_pending(spark, land, ledger, read, write, run="1")
    ingest_pending(spark, land, ledger, read, write, run="2")
    drop(docs.where(again & (F.col("doc_id") % 2 == 0)))
    ingest_pending(spark, land, ledger, read, write, run="3")
    drop(docs.where(late))
    ingest_pending(spark, land, ledger, read, write, run="4")
    read_back = spark.read.parquet(*[f"{out}/{r}" for r in ("1", "3", "4")])
    return read_back.groupBy("run", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("n_chars"))


# ------------------------------------------------------------ streams
LANDINGS = 20


def stream_counts_compacted(spark, d):
    """Counts over twenty landings, merged as they gather; the counts and how many folders a read opens."""
    from reviewlake.streaming.daily import count_folders, counts_to_table, parquet_stream, read_counts, with_review_day

    land, out, ckpt = (scratch(spark, f"compacted-{x}") for x in ("land", "table", "ckpt"))
    ev = td.table(spark, d, "events")
    for i in range(LANDINGS):
        part = td.reviews_from_events(ev.where(F.col("event_id") % LANDINGS == i)).select("movieNm", "id", "date")
        part.write.mode("append").parquet(land)
        counts_to_table(with_review_day(parquet_stream(spark, land, part.schema)), out, ckpt).awaitTermination()
    folders = len(count_folders(spark, out))
    return read_counts(spark, out).withColumn("within", F.lit(folders <= LANDINGS.bit_length()))


# Days at which the landings of the high-water mark begin and end; they overlap.
WATERMARKS = ((None, "2024-01-15"), ("2024-01-10", "2024-01-22"), ("2024-01-05", None))


def stream_new_since_latest(spark, d):
    """A15 + J3 + F15 as a stream: three overlapping landings, the query restarted for each; the reviews later than their film's latest day so far."""
    from reviewlake.streaming.daily import parquet_stream, run_to_table

    land, out, ckpt = (scratch(spark, f"latest-{x}") for x in ("land", "table", "ckpt"))
    for lo, hi in WATERMARKS:
        drop = td.reviews_rt(spark, d, since=lo, before=hi).where(F.lit(True) if lo is None else F.col("movieNm") != "movie_7").drop("recommend_tags")
        drop.write.mode("append").parquet(land)
        result = run_to_table(spark, parquet_stream(spark, land, drop.schema), out, ckpt, mode="latest")
    return result


# ------------------------------------------------------------ stems, as-of, evaluation
def stem_keywords_hangul(spark, d):
    """F16 / U2 without a word list: keywords per film over stems that the words' own counts give."""
    return stem_keywords(clean_reviews(td.reviews_ko(spark, d)), "hangul", STOPWORDS_KO)


def movie_list_asof(spark, d):
    """A18 with D19: the film list of daily charts and of regional charts whose opening day is the last daily chart's at or before them."""
    daily = td.boxoffice_rows(spark, d).where("audiCnt >= 48").withColumn("openDt", F.date_add("openDt", F.col("audiCnt") % 3))
    return bo.movie_list([daily, bo.fill_open_dates(td.region_chart_rows(spark, d), daily)])


def sentiment_eval(spark, d):
    """U1(b): naive Bayes fitted on the labelled documents whose text's MD5 begins below 8 and evaluated on both halves."""
    labelled = (td.table(spark, d, "documents").join(td.table(spark, d, "labels"), "doc_id").where("text is not null and quality is not null")
                .select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("context"), F.col("quality").alias("label"), F.md5("text").alias("h")))
    held = F.col("h") >= "8"
    lexicon = se.fit_naive_bayes(labelled.where(~held), charset="latin")
    rows = labelled.select("id", "context", F.lit("m").alias("movieNm"), F.lit("p").alias("platform"), F.lit("2024-01-01").cast("date").alias("date"))
    scored = se.score_lexicon_table(rows, lexicon, "latin").select("id", "score")
    judged = labelled.select("id", "label", F.when(held, "held_out").otherwise("fitted").alias("part")).join(scored, "id")
    return evaluate_scores(judged, by=["part"])


QUERIES: dict[str, Query] = {
    "merge_bucketed": merge_bucketed,
    "page_reviews_nested": page_reviews_nested,
    "csv_rejects": csv_rejects,
    "csv_table_quoted": csv_table_quoted,
    "chart_csv_ingest": chart_csv_ingest,
    "region_csv_ingest": region_csv_ingest,
    "review_files": review_files,
    "json_drift": json_drift,
    "table_replace": table_replace,
    "file_ledger": file_ledger,
    "stream_counts_compacted": stream_counts_compacted,
    "stream_new_since_latest": stream_new_since_latest,
    "stem_keywords_hangul": stem_keywords_hangul,
    "movie_list_asof": movie_list_asof,
    "sentiment_eval": sentiment_eval,
}
