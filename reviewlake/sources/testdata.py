"""Adapters from the driver's test tables to the review and chart model.

The test data holds no films or reviews, so each adapter maps a driver
table onto one of ours (SURVEY §7.3). Every adapter is a projection (and
for charts a star join) over the whole table, so its work grows with the
data. The same mappings are written in SQL in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: The driver's large tables, and the session setting by which a benchmark asks for them in several partitions.
FACT_TABLES = ("events", "documents", "lineitem", "orders", "pages")
SPREAD_CONF = "reviewlake.bench.spread"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read as it lies.

    The test tables are single files of one row group, which Spark reads as
    one task. A benchmark that wants all cores sets ``SPREAD_CONF`` to a
    number of partitions; it is unset everywhere else.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    spread = int(spark.conf.get(SPREAD_CONF, "0"))
    return df.repartition(spread) if spread > 1 and name in FACT_TABLES else df


#: Rows of a large table that one task of a join sorts, where the session's shuffle partitions would give it more.
JOIN_ROWS = 500_000


def spread_join(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join, dealt by key over as many partitions as their rows ask for, so that a task's sort does not grow with them.

    Tables for which the session's shuffle partitions are enough stay as they are (the planner may broadcast one).
    """
    parts = max(left.count(), right.count()) // JOIN_ROWS
    if parts <= int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return left, right
    return left.repartition(parts, left_key), right.repartition(parts, right_key)


def reviews_from_events(events: DataFrame) -> DataFrame:
    """``reviews_rt``: one review per event.

    film = ``movie_{user_id % 20}``, reviewer = user, text = event type and
    props, star = value / 20 (none for views; many above 5, so the range
    filter bites) as 4-decimal text, day as ``yyyy.MM.dd`` text, platform =
    event type.
    """
    return events.select(
        F.concat(F.lit("movie_"), (F.col("user_id") % 20).cast("string")).alias("movieNm"),
        F.col("user_id").cast("string").alias("id"),
        F.concat_ws(" ", "event_type", "props").alias("context"),
        F.when(F.col("event_type") != "view", F.format_string("%.4f", F.col("value") / 20)).alias("star"),
        F.date_format("ts", "yyyy.MM.dd").alias("date"),
        F.col("event_type").alias("platform"),
        F.lit(None).cast("string").alias("recommend_tags"),
    )


def reviews_rt(spark: SparkSession, sf_dir: str, since: str | None = None,
               before: str | None = None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if since is not None:
        ev = ev.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if before is not None:
        ev = ev.where(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    return reviews_from_events(ev)


def reviews_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reviews_tx``: one review per document.

    film = source, reviewer = doc id, text = the whole document, platform =
    language, day = 2024-01-01 plus ``doc_id % 30`` days, no star.
    """
    d = table(spark, sf_dir, "documents")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
    return d.select(
        F.col("source").alias("movieNm"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("context"),
        F.lit(None).cast("string").alias("star"),
        F.date_format(day, "yyyy.MM.dd").alias("date"),
        F.col("lang").alias("platform"),
        F.lit(None).cast("string").alias("recommend_tags"),
    )


# One Hangul syllable for each latin letter, in alphabetical order.
HANGUL_LETTERS = "가나다라마바사아자차카타파하거너더러머버서어저처커터"


def reviews_ko(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reviews_tx`` written in Hangul: each letter a-z becomes a syllable; accented letters stay latin and
    are what the Hangul charset filter removes."""
    return reviews_tx(spark, sf_dir).withColumn(
        "context", F.translate(F.lower("context"), "abcdefghijklmnopqrstuvwxyz", HANGUL_LETTERS))


def tag_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tags``: one review per part: film = brand, platform = type, tags =
    the words of the part name as a Python list literal."""
    p = table(spark, sf_dir, "part")
    tags = F.concat(F.lit("['"), F.replace("p_name", F.lit(" "), F.lit("', '")), F.lit("']"))
    return p.select(
        F.col("p_brand").alias("movieNm"),
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("context"),
        F.lit(None).cast("string").alias("star"),
        F.lit(None).cast("string").alias("date"),
        F.col("p_type").alias("platform"),
        tags.alias("recommend_tags"),
    )


def raw_tags_with_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag lists as the site shows them, with collapse markers (``+n``,
    ``… 외``) and a blank entry, for the tag cleaner."""
    p = table(spark, sf_dir, "part")
    tags = F.concat(
        F.lit("['"), F.replace("p_name", F.lit(" "), F.lit("', '")),
        F.lit("', '+"), (F.col("p_size") % 4).cast("string"),
        F.lit("', '"), F.col("p_type"), F.lit(" 외', '']"),
    )
    return p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("movieNm"), tags.alias("recommend_tags"))


def _brand_no(c="p_brand"):
    return F.split_part(F.col(c), F.lit("#"), F.lit(2)).cast("int")


def boxoffice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``boxoffice``: one chart row per line item (lineitem ⋈ orders ⋈ part).

    day = order day, film = brand, genres = the words of the part name,
    sales in whole cents, audience = quantity, opening day fixed per brand.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("o_orderdate").cast("date").alias("boxoffice_date"),
        F.col("p_brand").alias("movieNm"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("genreNm"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("salesAmt"),
        F.col("l_quantity").cast("int").alias("audiCnt"),
        F.date_add(F.lit("1994-12-01").cast("date"), _brand_no() * 7).alias("openDt"),
    )


def region_chart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional chart rows before the region name is attached:
    lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ part, region code = the
    nation's region key."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey)
         .join(p, li.l_partkey == p.p_partkey))
    return j.select(
        F.col("o_orderdate").cast("date").alias("boxoffice_date"),
        F.col("n_regionkey").cast("string").alias("region_code"),
        F.col("p_brand").alias("movieNm"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("salesAmt"),
        F.col("l_quantity").cast("int").alias("audiCnt"),
    )


def region_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region-code table (fullCd, korNm) from ``region``."""
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").cast("string").alias("fullCd"), F.col("r_name").alias("korNm"))


def raw_chart_strings(spark: SparkSession, sf_dir: str, deal: Sequence[str] = ()) -> DataFrame:
    """Daily chart rows as landed text (lineitem ⋈ orders), including a
    non-number, numbers above 2^31 and ``yyyy-MM-dd`` days.

    ``deal``: columns by which the rows are dealt to partitions before they are
    spelled out, for a grouping by them; as many partitions as a join's."""
    li = table(spark, sf_dir, "lineitem")
    parts = li.count() // JOIN_ROWS if deal else 0
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    li, o = spread_join(li, "l_orderkey", o, "o_orderkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    s = lambda c: c.cast("string")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    columns = {
        "rank": s(F.col("l_linenumber")),
        "rankInten": F.when(F.col("l_linenumber") == 7, F.lit("x")).otherwise(s(F.col("l_linenumber") - 4)),
        "rankOldAndNew": F.when(F.col("l_linenumber") == 1, F.lit("NEW")).otherwise(F.lit("OLD")),
        "movieCd": s(F.col("l_partkey")),
        "movieNm": F.concat(F.lit("movie_"), s(F.col("l_partkey"))),
        "openDt": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "salesAmt": s(cents),
        "salesShare": s(F.col("l_discount") * 100),
        "salesInten": s(F.round(F.col("l_tax") * 10000).cast("bigint")),
        "salesChange": s(F.col("l_tax") * 100),
        "salesAcc": s(F.round(F.col("o_totalprice") * 100).cast("bigint") * 1000),
        "audiCnt": s(F.col("l_quantity").cast("bigint")),
        "audiInten": F.concat(F.lit(" "), s(F.col("l_quantity").cast("bigint") - 25), F.lit(" ")),
        "audiChange": s(F.col("l_discount")),
        "audiAcc": s(F.col("l_quantity").cast("bigint") * 1000 + F.col("l_linenumber")),
        "scrnCnt": s(F.col("l_suppkey")),
        "showCnt": s(F.col("l_linenumber") * 3),
    }
    if deal:
        keys = [columns[c] for c in deal]
        j = j.repartition(parts, *keys) if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else j.repartition(*keys)
    return j.select(*[c.alias(name) for name, c in columns.items()])


def search_hits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Films to match and their search hits, from ``part``.

    films: one per brand, opening year 1990 + (smallest size % 30);
    hits: one per part, position = part key, title equal to the brand for
    sizes divisible by 4, year 1990 + size % 30, image when size % 3 = 0.
    """
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    films = p.groupBy(F.col("p_brand").alias("movieNm")).agg(
        (F.lit(1990) + F.min("p_size") % 30).cast("string").alias("open_year"))
    hits = p.select(
        F.col("p_brand").alias("movieNm"),
        F.col("p_partkey").alias("hit_id"),
        F.when(F.col("p_size") % 4 == 0, F.col("p_brand"))
        .otherwise(F.concat_ws(" ", "p_brand", "p_type")).alias("title"),
        (F.lit(1990) + F.col("p_size") % 30).cast("string").alias("open_year"),
        F.col("p_partkey").alias("position"),
        (F.col("p_size") % 3 == 0).alias("has_image"),
    )
    return films, hits


def raw_region_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional chart rows as landed text: lineitem ⋈ orders ⋈ customer ⋈
    nation ⋈ region, region code = region key, region name = region name."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice",
                                                  "l_quantity", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey))
    s = lambda x: x.cast("string")
    return j.select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        s(F.col("n_regionkey")).alias("region_code"),
        F.col("r_name").alias("region_name"),
        s(F.col("l_linenumber")).alias("rank"),
        s(F.col("l_linenumber") - 4).alias("rankInten"),
        F.when(F.col("l_linenumber") == 1, F.lit("NEW")).otherwise(F.lit("OLD")).alias("rankOldAndNew"),
        s(F.col("l_partkey")).alias("movieCd"),
        F.concat(F.lit("movie_"), s(F.col("l_partkey"))).alias("movieNm"),
        s(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("salesAmt"),
        s(F.round(F.col("o_totalprice") * 100).cast("bigint") * 1000).alias("salesAcc"),
        s(F.col("l_quantity").cast("bigint")).alias("audiCnt"),
        s(F.col("l_quantity").cast("bigint") * 1000 + F.col("l_linenumber")).alias("audiAcc"),
        s(F.col("l_suppkey")).alias("scrnCnt"),
        s(F.col("l_linenumber") * 3).alias("showCnt"),
    )
