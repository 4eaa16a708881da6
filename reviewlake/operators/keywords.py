"""Keyword and tag counts (T-chain, F9-F13, J4, A4, A5, A10, A13).

The token stream is ``explode`` of a split column feeding straight into a
partial hash aggregate, all inside one whole-stage-codegen span: the
per-word rows are never materialised or shuffled, only ``(film, word,
partial count)`` rows are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.tags import clean_tags, parse_tags
from reviewlake.functions.text import STOPWORDS_KO, clean_for_tokens, split_words


def tokens(df: DataFrame, text_col: str = "context", charset: str = "hangul+jamo",
           stopwords: Sequence[str] = STOPWORDS_KO, min_len: int = 2,
           keep: Sequence[str] = ("movieNm",), word_col: str = "word") -> DataFrame:
    """T-chain: charset filter, lower, strip, split, explode, then drop blank
    words, stop words and words shorter than ``min_len``.

    The words come out of text that holds only ``charset`` letters and
    whitespace, so the reference's whole-word pattern test
    (``word_pattern``) reduces to the length test.
    """
    w = F.col(word_col)
    exploded = df.select(*keep, F.explode(split_words(clean_for_tokens(text_col, charset))).alias(word_col))
    cond = w.isNotNull() & (F.length(w) >= max(min_len, 1))
    if stopwords:  # F9 with C24 membership: a short fixed list is an InSet lookup
        cond = cond & ~w.isin(list(stopwords))
    return exploded.where(cond)


def movie_keywords(df: DataFrame, charset: str = "hangul+jamo",
                   stopwords: Sequence[str] = STOPWORDS_KO, min_len: int = 2) -> DataFrame:
    """A5: keyword count per film."""
    return (
        tokens(df, "context", charset, stopwords, min_len, keep=("movieNm",))
        .groupBy("movieNm", "word").agg(F.count(F.lit(1)).alias("count"))
        .withColumnRenamed("word", "keyword")
    )


def drop_stopwords(words: DataFrame, stop: DataFrame, word_col: str = "word") -> DataFrame:
    """Anti join to a stop-word table (one ``word`` column).

    Stop-word tables are short fixed lists, so the planner broadcasts them
    by size; a large one falls back to a shuffle anti join.
    """
    stop = stop.select(F.col(stop.columns[0]).alias(word_col)).distinct()
    return words.join(stop, word_col, "left_anti")


def tag_rows(df: DataFrame, tag_col: str = "tag", clean: bool = False) -> DataFrame:
    """C9 + C11: one row per tag of a review; null or broken lists give none."""
    arr = parse_tags("recommend_tags")
    if clean:
        arr = clean_tags(arr)
    keep = [c for c in df.columns if c != "recommend_tags"]
    return df.select(*keep, F.explode(arr).alias(tag_col))


def platform_tag_counts(df: DataFrame, platform: str) -> DataFrame:
    """A4: tag count per film on one platform (the reference's megabox table);
    F5: equality and not-null filter."""
    rows = tag_rows(df.where((F.col("platform") == platform) & F.col("recommend_tags").isNotNull()), "keyword")
    return rows.groupBy("movieNm", "keyword").agg(F.count(F.lit(1)).alias("count"))


def tag_counts(df: DataFrame) -> DataFrame:
    """A10: tag count over all films, largest first."""
    return (
        tag_rows(df).groupBy("tag").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "tag")
    )


def tag_counts_by_movie(df: DataFrame) -> DataFrame:
    """Tag count per film; film ascending, count descending."""
    return (
        tag_rows(df).groupBy("movieNm", "tag").agg(F.count(F.lit(1)).alias("count"))
        .orderBy("movieNm", F.desc("count"), "tag")
    )
